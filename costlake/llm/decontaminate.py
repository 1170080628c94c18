"""Benchmark decontamination by winnowing, in DataFrame functions only.

Documents and benchmark items are cut into words. The fingerprint of a window of words is the least hash of
the k-word grams in it, so windows that are equal have equal fingerprints and a text has far fewer distinct
fingerprints than windows. Fingerprints are joined first; only windows whose fingerprint occurs on the other
side are then compared word by word, and every shared window is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import LOWER, UPPER, texts

#: Words of a window, and of the grams that are hashed in it.
WINDOW, GRAM = 13, 7
#: What separates words is everything below 0x80 that is neither a digit nor a letter.
BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    return F.array_remove(F.split(F.translate(text, UPPER + BETWEEN, LOWER + " " * len(BETWEEN)), " "), "")


def _run(values: Column, at: Column, length: int) -> list[Column]:
    return [F.get(values, at + j) for j in range(length)]  # much cheaper than a slice per place


def gram_hashes(hashed: Column, gram: int) -> Column:
    """A hash of every run of ``gram`` words, given the words' hashes."""
    last = F.size(hashed) - gram
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*_run(hashed, i, gram))))


def fingerprints(grams: Column, wide: int) -> Column:
    """The fingerprint of every window of ``wide`` grams, in the order of the windows."""
    last = F.size(grams) - wide
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.least(*_run(grams, i, wide)) if wide > 1 else F.get(grams, i)))


def _with_prints(df: DataFrame, length: int, gram: int) -> DataFrame:
    """``df`` with ``prints`` and the length, from its column ``hashed``."""
    gram = min(gram, length)
    return (df.withColumn("grams", gram_hashes(F.col("hashed"), gram))
            .withColumn(f"prints{length}", fingerprints(F.col("grams"), length - gram + 1)).drop("grams"))


def _spans(length: int) -> Column:
    """(length, print, start, span) of every window of a row with words and prints."""
    return F.transform(f"prints{length}", lambda p, i: F.struct(
        F.lit(length).alias("length"), p.alias("print"), i.alias("start"), F.array_join(F.slice("words", i + 1, length), " ").alias("span")))


def _own_prints(length: int) -> Column:
    """(length, print) of every distinct fingerprint of a row."""
    return F.transform(F.array_distinct(f"prints{length}"), lambda p: F.struct(F.lit(length).alias("length"), p.alias("print")))


def _met_spans(length: int) -> Column:
    """(start, length, span) of the windows whose fingerprint is in ``met``."""
    start = F.transform(f"prints{length}", lambda p, i: F.when(F.array_contains("met", F.struct(F.lit(length).alias("length"), p.alias("print"))), i))
    return F.transform(F.filter(start, lambda i: i.isNotNull()), lambda i: F.struct(
        i.alias("start"), F.lit(length).alias("length"), F.array_join(F.slice("words", i + 1, length), " ").alias("span")))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", share: float = 0.05) -> DataFrame:
    """(id column, rid, kb, n_words, n_hit, n_items, items array<string>, contaminated) of every row.

    A document word is hit inside any occurrence of a window of an item: ``window`` words in a row, or all
    words of an item that has fewer. ``items`` are the ids, as sorted text, of the items with a window in the
    document; contaminated means some hits, at least ``share`` of the words. NULL and empty texts have no
    words: such items match nothing, such documents are clean. Rows with NULL or repeated ids keep apart; items
    with equal ids count once, items with NULL id count as hits but not as items.
    """
    rows = texts(docs, id_col, text_col)
    hashed = F.transform("words", lambda w: F.xxhash64(w))
    bench = items.select(items[item_col].cast("string").alias("item"),
                         words(F.coalesce(items[item_text_col].cast("string"), F.lit(""))).alias("words")).filter(F.size("words") > 0)
    short = [r[0] for r in bench.filter(F.size("words") < window).select(F.size("words").alias("n")).distinct().collect()]
    lengths = sorted({window, *short})  # at most ``window`` of them
    bench = bench.withColumn("own", F.least(F.size("words"), F.lit(window))).withColumn("hashed", hashed)
    mine = rows.select("rid", words(F.col("text")).alias("words")).select("rid", hashed.alias("hashed"))
    for length in lengths:
        bench, mine = _with_prints(bench, length, gram), _with_prints(mine, length, gram)
    windows = F.flatten(F.array(*[F.when(F.col("own") == n, _spans(n)).otherwise(F.filter(_spans(n), lambda _: F.lit(False))) for n in lengths]))
    spans = bench.select("item", F.explode(windows).alias("w")).select("item", "w.length", "w.print", "w.span").distinct()
    every = F.flatten(F.array(*[_own_prints(n) for n in lengths]))
    met = (mine.select("rid", F.explode(every).alias("p")).select("rid", "p.*").join(spans.select("length", "print").distinct(), ["length", "print"])
           .groupBy("rid").agg(F.collect_set(F.struct("length", "print")).alias("met")))
    # from here on a row meets its own fingerprints again; windows are made only of those that met
    near = rows.join(met, "rid", "left").select("id", "rid", "kb", "met", words(F.col("text")).alias("words"))
    near = near.withColumn("hashed", F.when(F.col("met").isNull(), F.array().cast("array<bigint>")).otherwise(hashed))
    for length in lengths:
        near = _with_prints(near, length, gram)
    marker = F.struct(F.lit(-1).alias("start"), F.lit(0).alias("length"), F.concat(F.lit(" "), F.hex("rid")).alias("span"))
    tried = [_met_spans(n) for n in lengths]
    tried = F.when(F.col("met").isNull(), F.array(marker)).otherwise(F.concat(F.array(marker), *tried))
    tried = near.select("id", "rid", "kb", F.size("words").cast("long").alias("n_words"), F.explode(tried).alias("w")).select("id", "rid", "kb", "n_words", "w.*")
    found = tried.join(spans.select("length", "span", "item", F.lit(True).alias("hit")).distinct(), ["length", "span"], "left")
    per_row = found.groupBy("rid").agg(
        F.first("id").alias("id"), F.first("kb").alias("kb"), F.first("n_words").alias("n_words"),
        F.count(F.when(F.col("start") < 0, 1)).alias("copies"),
        F.sort_array(F.collect_set(F.when(F.col("hit"), F.struct("start", (F.col("start") + F.col("length")).alias("end"))))).alias("runs"),
        F.sort_array(F.collect_set("item")).alias("items"))
    covered = F.aggregate("runs", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")), lambda s, r: F.struct(
        F.greatest(s["end"], r["end"]).alias("end"), (s["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(s["end"], r["start"]))).alias("n")))["n"]
    counted = per_row.withColumn("n_hit", covered).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return counted.select(
        F.col("id").alias(id_col), "rid", "kb", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        ((F.col("n_hit") > 0) & (F.col("n_hit") >= F.col("n_words") * F.lit(share).cast("decimal(10,6)"))).alias("contaminated"))
