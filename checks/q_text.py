"""Tokens, term statistics and term effects (TXT, XAI)."""

from __future__ import annotations

from pyspark.ml.feature import IDF
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from costlake.functions.text import ENGLISH_STOP_WORDS, without_stop_words
from costlake.operators import explain, models, text

_STOPS = fx.sql_list(ENGLISH_STOP_WORDS)


def _digest(words: str) -> list:
    return [F.size(words).alias("n_words"), F.md5(F.concat_ws(" ", words)).alias("digest")]


def _words(min_length: int) -> str:
    """CTE ``w``: documents as word lists without stop words."""
    return (f"w AS (SELECT doc_id, list_filter({fx.sql_tokens('text', min_length)}, "
            f"lambda t: NOT list_contains({_STOPS}, t)) AS words FROM documents)")


def _content_words(spark, sf, min_length):
    docs = fx.document_words(spark, sf, min_length)
    return docs.withColumn("words", without_stop_words(F.col("words")))


@check("txt_01_tokens", f"""WITH w AS (SELECT doc_id, {fx.sql_tokens('text', 2)} AS words FROM documents)
 SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words, md5(array_to_string(words, ' ')) AS digest FROM w""")
def _(spark, sf):
    return fx.document_words(spark, sf).select("doc_id", *_digest("words"))


@check("txt_01_tokenizer_stage", f"""WITH w AS (SELECT doc_id, {fx.sql_tokens('text', 3)} AS words FROM documents)
 SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words, md5(array_to_string(words, ' ')) AS digest FROM w""")
def _(spark, sf):
    tokenizer = text.token_stages("text", "words", 3)[0]
    return tokenizer.transform(fx.table(spark, sf, "documents")).select("doc_id", *_digest("text_tokens"))


_REMOVED = """ SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words, md5(array_to_string(words, ' ')) AS digest FROM w"""


@check("txt_02_stop_words", f"WITH {_words(2)}{_REMOVED}")
def _(spark, sf):
    return _content_words(spark, sf, 2).select("doc_id", *_digest("words"))


@check("txt_02_stop_word_stage", f"WITH {_words(2)}{_REMOVED}")
def _(spark, sf):
    docs = fx.table(spark, sf, "documents")
    for stage in text.token_stages("text", "words", 2):
        docs = stage.transform(docs)
    return docs.select("doc_id", *_digest("words"))


@check("txt_03_hashed_terms")
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    stages, _ = text.hashed_tfidf_stages("text")
    docs = fx.table(spark, sf, "documents")
    for stage in stages[:3]:
        docs = stage.transform(docs)
    slots = vector_to_array("text_tf")
    return docs.select("doc_id", F.size(slots).alias("slots"),
                       F.aggregate(slots, F.lit(0.0), lambda a, v: a + v).cast("int").alias("set_slots"))


@check("txt_04_inverse_document_frequency", f"""WITH {_words(2)}, t AS (SELECT unnest(list_distinct(words)) AS term FROM w),
 d AS (SELECT term, count(*) AS documents FROM t GROUP BY term)
 SELECT term, documents, round(CASE WHEN documents >= 5 THEN ln(((SELECT count(*) FROM documents) + 1.0) / (documents + 1.0))
 ELSE 0 END, 6) AS idf FROM d""")
def _(spark, sf):
    found = text.inverse_document_frequencies(_content_words(spark, sf, 2), "words", 5)
    return found.withColumn("idf", F.round("idf", 6))


_VOCABULARY = f"""{_words(3)}, o AS (SELECT doc_id, unnest(words) AS term FROM w),
 v AS (SELECT term, count(*) AS occurrences, count(DISTINCT doc_id) AS documents FROM o GROUP BY term
 HAVING count(DISTINCT doc_id) >= 20 ORDER BY occurrences DESC, term LIMIT 1500)"""


@check("txt_04_idf_stage", f"""WITH {_VOCABULARY} SELECT term,
 round(ln(((SELECT count(*) FROM documents) + 1.0) / (documents + 1.0)), 6) AS idf FROM v""")
def _(spark, sf):
    docs = _content_words(spark, sf, 3)
    terms = text.vocabulary_terms(docs, "words")
    fitted = models.fit_stages([text.vocabulary_stage(terms, "words", "counts"),
                                IDF(inputCol="counts", outputCol="features", minDocFreq=5)], docs)
    weights = fitted.stages[-1].idf.toArray().tolist()
    return spark.createDataFrame(list(zip(terms, weights)), "term string, idf double").withColumn(
        "idf", F.round("idf", 6))


@check("txt_05_vocabulary", f"WITH {_VOCABULARY} SELECT term, occurrences, documents FROM v")
def _(spark, sf):
    return text.vocabulary(_content_words(spark, sf, 3), "words")


@check("txt_06_document_frequency", f"""WITH {_words(2)}, t AS (SELECT unnest(list_distinct(words)) AS term FROM w)
 SELECT term, count(*) AS documents FROM t GROUP BY term""")
def _(spark, sf):
    return text.document_frequencies(_content_words(spark, sf, 2), "words")


@check("xai_01_term_effects", f"""WITH {fx.TERMS} SELECT term, coefficient_log10,
 round(pow(10, coefficient_log10), 6) AS prediction_multiplier,
 CASE WHEN coefficient_log10 > 0 THEN 'higher' ELSE 'lower' END AS direction FROM terms""")
def _(spark, sf):
    effects = explain.term_effects(fx.terms(spark, sf).drop("documents"))
    return effects.withColumn("prediction_multiplier", F.round("prediction_multiplier", 6))


@check("xai_05_display_terms", f"""WITH {fx.TERMS} SELECT term, coefficient_log10 FROM terms
 WHERE NOT regexp_full_match(term, '[0-9]+') ORDER BY coefficient_log10 DESC, term LIMIT 12""")
def _(spark, sf):
    return explain.display_terms(fx.terms(spark, sf)).select("term", "coefficient_log10")
