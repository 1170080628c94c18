"""Sharding by a Feistel permutation with cycle walking over global row numbers.

A row's number is permuted within 0..n-1; the shard is the permuted number modulo the shard count and the
slot what is left of it, so counts differ by one at most, slots have no gaps and either can be computed
from the number alone (and back) without touching another row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 4
#: Steps within which a walk is back inside 0..n-1. The grid is less than one row larger than n, so for n up
#: to 4,096 no walk is longer, and for larger n a step stays outside with a chance below 1/64.
WALK = 64
#: Buckets that row numbers are dealt from; each is numbered on its own. A fixed bound of what is broadcast.
BUCKETS = 4096


def _grid(n: Column) -> tuple[Column, Column]:
    """(a, b) with n <= a * b < n + a and a the rounded root of n."""
    a = F.greatest(F.lit(1), F.ceil(F.sqrt(n.cast("double")))).cast("long")
    return a, ((n + a - 1 - (n + a - 1) % a) / a).cast("long")


def permute(number: Column, n: Column, seed: int = 7, inverse: bool = False) -> Column:
    """The place of ``number`` in a pseudo-random order of 0..n-1; ``inverse`` gives the number at a place.

    The number is split into two digits of a mixed base. Each round adds a hash of one digit to the other,
    modulo that one's base, which can be undone; numbers that leave 0..n-1 are permuted again until they are
    back, which keeps it a permutation.
    """
    a, b = _grid(n)

    def turn(s: Column, r: Column) -> Column:
        sign = F.lit(-1 if inverse else 1)
        left = F.pmod(s["l"] + sign * F.pmod(F.xxhash64(F.lit(seed), r, s["r"]), a), a)
        right = F.pmod(s["r"] + sign * F.pmod(F.xxhash64(F.lit(seed), r, s["l"]), b), b)
        even = r % 2 == 0
        return F.struct(F.when(even, left).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(right).alias("r"))

    turns = F.array(*[F.lit(r) for r in (reversed(range(ROUNDS)) if inverse else range(ROUNDS))])

    def step(x: Column) -> Column:
        start = F.struct((x % a).alias("l"), ((x - x % a) / a).cast("long").alias("r"))
        return F.aggregate(turns, start, turn, lambda s: s["l"] + a * s["r"])

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), step(number),
                         lambda x, _: F.when(x < n, x).otherwise(step(x)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("a walk did not come back")).cast("long"))


def number_rows(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``row_no`` 0..n-1 and ``n_rows``, numbered by a hash of ``order``, then by ``order``.

    Rows are dealt into a fixed number of buckets by hash and numbered there; a bucket's first number is the
    count of rows in the buckets before it. So the number depends on the rows alone and not on partitions,
    and no task sees more than its share. Rows that are equal in all of ``order`` are interchangeable.
    """
    of = F.pmod(F.xxhash64(*order), F.lit(BUCKETS)).cast("int")
    counts = rows.groupBy(of.alias("bucket")).agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most BUCKETS rows
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
                            F.sum("n").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n_rows"))
    within = F.row_number().over(Window.partitionBy("bucket").orderBy(F.xxhash64(*order), *order))
    numbered = rows.withColumn("bucket", of).withColumn("within", within)
    return (numbered.join(F.broadcast(offsets), "bucket")
            .withColumn("row_no", F.col("first") + F.col("within") - 1).drop("bucket", "within", "first"))


def shard(docs: DataFrame, shards: int = 16, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id column, size, text_crc32, row_no, n_rows, shard, slot) of every row; law ``rows``.

    ``size`` is the text's UTF-8 bytes plus 1 (NULL text: 1, with the CRC of the empty text). NULL and
    repeated ids are rows like any other; rows equal in id and text are interchangeable. An empty table gives
    an empty result.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    slim = docs.select(docs[id_col].alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    placed = number_rows(slim, "id", "text_hash").withColumn("place", permute(F.col("row_no"), F.col("n_rows"), seed))
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", "row_no", "n_rows",
                         (F.col("place") % shards).cast("int").alias("shard"),
                         ((F.col("place") - F.col("place") % shards) / shards).cast("long").alias("slot"))
