"""Term statistics of a token column and the text stages of a model."""

from __future__ import annotations

from pyspark.ml.feature import IDF, CountVectorizerModel, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.functions.text import inverse_document_frequency
from costlake.operators.ranking import top_rows


def term_frequencies(df: DataFrame, words: str) -> DataFrame:
    """Rows ``term, occurrences, documents`` in one pass and one shuffle."""
    every = F.transform(words, lambda w: F.struct(w.alias("term"), F.lit(1).alias("o"), F.lit(0).alias("d")))
    once = F.transform(F.array_distinct(words),
                       lambda w: F.struct(w.alias("term"), F.lit(0).alias("o"), F.lit(1).alias("d")))
    return (df.select(F.inline(F.concat(every, once))).groupBy("term")
            .agg(F.sum("o").alias("occurrences"), F.sum("d").alias("documents")))


def document_frequencies(df: DataFrame, words: str) -> DataFrame:
    return (df.select(F.explode(F.array_distinct(words)).alias("term")).groupBy("term")
            .agg(F.count(F.lit(1)).alias("documents")))


def inverse_document_frequencies(df: DataFrame, words: str, min_documents: int = 5) -> DataFrame:
    """Rows ``term, documents, idf``; the number of rows of ``df`` enters as a scalar subquery."""
    total = df.agg(F.count(F.lit(1))).scalar()
    weight = inverse_document_frequency(total, F.col("documents"), min_documents)
    return document_frequencies(df, words).withColumn("idf", weight)


def vocabulary(df: DataFrame, words: str, size: int = 1500, min_documents: int = 20) -> DataFrame:
    """The ``size`` most frequent terms found in at least ``min_documents`` rows, ties by term."""
    frequent = term_frequencies(df, words).filter(F.col("documents") >= min_documents)
    return top_rows(frequent, "occurrences", size, ["term"])


def vocabulary_terms(df: DataFrame, words: str, size: int = 1500, min_documents: int = 20) -> list[str]:
    """The vocabulary as a list (at most ``size`` strings): a model's shape depends on it."""
    ranked = vocabulary(df, words, size, min_documents).collect()
    return [r["term"] for r in ranked]


def token_stages(text: str, words: str, min_length: int) -> list:
    return [
        RegexTokenizer(inputCol=text, outputCol=f"{text}_tokens", pattern=r"\W+", gaps=True,
                       minTokenLength=min_length, toLowercase=True),
        StopWordsRemover(inputCol=f"{text}_tokens", outputCol=words),
    ]


def hashed_tfidf_stages(text: str, features: int = 4096, min_length: int = 2,
                        min_documents: int = 5) -> tuple[list, str]:
    """Stages and output column of a binary hashed TF-IDF vector."""
    words, counts, out = f"{text}_words", f"{text}_tf", f"{text}_tfidf"
    return token_stages(text, words, min_length) + [
        HashingTF(inputCol=words, outputCol=counts, numFeatures=features, binary=True),
        IDF(inputCol=counts, outputCol=out, minDocFreq=min_documents),
    ], out


def vocabulary_stage(terms: list[str], words: str, out: str) -> CountVectorizerModel:
    """Binary term vector over a fixed, ordered vocabulary."""
    return CountVectorizerModel.from_vocabulary(terms, inputCol=words, outputCol=out).setBinary(True)
