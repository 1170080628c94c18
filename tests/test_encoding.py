"""Labels numbered in a table against StringIndexer."""

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from costlake.operators import encode, models


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(3_000).select(F.concat(F.lit("k"), F.floor(F.sqrt("id"))).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("b"))


@pytest.mark.parametrize("order", ["frequencyDesc", "alphabetDesc"])
def test_same_numbers_as_string_indexer(labelled, order):
    known = labelled.dropna()
    mine = encode.LabelIndexer(["a", "b"], ["x", "y"], order).fit(known).transform(known)
    theirs = StringIndexer(inputCols=["a", "b"], outputCols=["x", "y"], stringOrderType=order).fit(known).transform(known)
    assert mine.exceptAll(theirs).count() == 0 and mine.count() == theirs.count()


def test_unseen_labels_and_nulls_share_the_next_number(spark, labelled):
    fitted = encode.LabelIndexer(["b"], ["y"]).fit(labelled)
    rows = spark.createDataFrame([("q", 99), ("q", None), ("q", 1)], "a string, b bigint")
    assert sorted(r["y"] for r in fitted.transform(rows).collect())[1:] == [5.0, 5.0]
    with pytest.raises(PySparkException):
        encode.LabelIndexer(["b"], ["y"], unseen="error").fit(labelled).transform(rows).collect()
    hot = OneHotEncoder(inputCols=["y"], outputCols=["v"], handleInvalid="keep", dropLast=True).fit(fitted.transform(labelled))
    assert hot.categorySizes == [6]


def test_the_guard_picks_the_way(labelled):
    assert isinstance(encode.indexer(labelled, ["a"], ["x"]), StringIndexer)
    assert isinstance(encode.indexer(labelled, ["a"], ["x"], most=20), encode.LabelIndexer)
    fitted = encode.indexer(labelled, ["a"], ["x"], most=20).fit(labelled)
    assert "k54" not in fitted.transform(labelled)._jdf.queryExecution().toString()


def test_medians_are_exact_where_a_sketch_is_off(spark):
    # 40,001 distinct numbers, NULL and NaN besides; a sketch with an error of 0.001 may be 40 ranks off
    rows = spark.range(40_003).select(
        "id", F.when(F.col("id") < 40_001, (F.col("id") * 7919 % 40_001).cast("int")).alias("whole"),
        F.when(F.col("id") < 40_001, (F.col("id") * 7919 % 40_001) / 4).when(F.col("id") == 40_001, float("nan")).alias("part"))
    plain = encode.structured_stages([], ["whole", "part"], quantile_error=0, train=rows)[0]
    filled = models.fit_stages(plain, rows).transform(rows).filter("id > 40000")
    assert [(r["whole__imp"], r["part__imp"]) for r in filled.collect()] == [(20_000, 5_000.0)] * 2
    assert filled.schema["whole__imp"].dataType.simpleString() == "int"
    standard = models.fit_stages(encode.standardized_stages(rows, ["whole"]), rows).transform(rows).filter("id > 40000")
    # the mean is the median here
    assert [r["features"][0] for r in standard.collect()] == pytest.approx([0.0] * 2, abs=1e-9)


def test_a_column_without_values_has_no_median(spark):
    rows = spark.createDataFrame([(1.0, None), (2.0, float("nan"))], "a double, b double")
    with pytest.raises(ValueError, match="b have no values"):
        encode.standardized_stages(rows, ["a", "b"])
