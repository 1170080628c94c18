"""From raw documents to token ids: the text operators one after another.

Each stage takes what its predecessor kept and returns rows with the columns of ``documents``; the last
returns token ids and a digest of the text that they decode to. :func:`run` writes every stage's result into the shared folder and goes on from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from costlake.llm.common import row_key, stow
from costlake.llm.queries import table, tokenizer_path

#: The columns of documents.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document is toxic from this score on; a line is boilerplate in so many documents.
TOXIC, LINE_DOCUMENTS = 0.5, 10


def _only(docs: DataFrame, rids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose row key is in ``rids``."""
    keyed = docs.withColumn("rid", row_key(docs))
    return keyed.join(rids, "rid", "left_semi")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model trained on these documents and the labels does not call toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_rows(docs, model).filter(F.col("score") < TOXIC).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; a document that loses all lines stays, empty."""
    index = line_dedup.LineIndex.empty(spark).insert(docs)
    kept = line_dedup.drop_lines(docs, index.repeated(LINE_DOCUMENTS), carry=("lang", "source"))
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.char_length("kept").cast("long").alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id; repeated rows of it go, too."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid"))["rid"]
    kept = simhash.near_duplicates(docs).groupBy("root").agg(first.alias("rid")).select("rid")
    return _only(docs, kept).dropDuplicates(["rid"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words fewer than a twentieth stand in benchmark passages."""
    judged = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _only(docs, judged.filter(~F.col("contaminated")).select("rid")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): every document that is left as token ids, and the digest of what they decode to."""
    path = tokenizer_path()
    coded = bpe.decode(bpe.encode(docs, path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_repeated_lines), ("SimHash near-dedup", drop_near_duplicates),
          ("benchmark decontamination", drop_contaminated), ("BPE encoding and decoding", encode)]

#: A trained model and a tokenizer's merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stow(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
