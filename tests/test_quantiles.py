import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlake.operators import quantiles as q


def nearest(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(len(ordered) * p), 1) - 1]


@pytest.mark.parametrize("size,sort_rows", [(1, 10), (2, 1), (7, 100), (99, 1), (5_000, 3)])
def test_exact_quantiles_equal_brute_force(spark, size, sort_rows):
    rng = random.Random(size)
    values = [float(rng.randint(0, size * 2)) for _ in range(size)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    disc = {r["probability"]: r["quantile"] for r in q.exact_quantiles(df, "v", probs, sort_rows=sort_rows).collect()}
    cont = {r["probability"]: r["quantile"]
            for r in q.exact_quantiles(df, "v", probs, interpolate=True, sort_rows=sort_rows).collect()}
    for p in probs:
        assert disc[p] == nearest(values, p)
        assert cont[p] == pytest.approx(np.quantile(values, p))


def test_one_key_holding_most_rows_and_heavy_ties(spark):
    # one key has nine tenths of the rows, half of them one single value; a NULL key counts too
    hot = spark.range(9_000).select(F.lit("hot").alias("k"), F.when(F.col("id") % 2 == 0, 1.0)
                                    .otherwise(F.col("id").cast("double")).alias("v"))
    cold = spark.range(1_000).select(F.lit(None).cast("string").alias("k"), (F.col("id") * 0.5).alias("v"))
    df = hot.unionByName(cold)
    found = {(r["k"], r["probability"]): r["quantile"]
             for r in q.exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["k"], sort_rows=20).collect()}
    values = {"hot": [1.0 if i % 2 == 0 else float(i) for i in range(9_000)], None: [i * 0.5 for i in range(1_000)]}
    assert found == {(k, p): nearest(v, p) for k, v in values.items() for p in (0.1, 0.5, 0.9)}


def test_nulls_and_nans_are_not_values(rows):
    df = rows("v double", (None,), (float("nan"),), (2.0,), (4.0,))
    assert [r["quantile"] for r in q.exact_quantiles(df, "v", [0.5], interpolate=True).collect()] == [3.0]


def test_outliers_and_extreme_ranges(rows):
    values = [-1.7e308, 1.7e308, 0.0, 1e-300, 2e-300, float("inf")] + [5.0 + i * 1e-12 for i in range(50)]
    df = rows("v double", *[(v,) for v in values])
    found = q.exact_quantiles(df, "v", [0.05, 0.06, 0.5], sort_rows=2)
    assert {r["probability"]: r["quantile"] for r in found.collect()} == {p: nearest(values, p) for p in (0.05, 0.06, 0.5)}


def test_no_values_gives_no_rows_and_trims_everything(rows):
    df = rows("v double", (None,))
    assert q.exact_quantiles(df, "v", [0.5]).count() == 0
    assert q.trim_to_quantiles(df, "v", exact=True).count() == 0


def test_bounds_are_inclusive_unless_told(spark):
    df = spark.range(1, 102).select(F.col("id").cast("double").alias("v"))
    kept = q.trim_to_quantiles(df, "v", 0.05, 0.95, exact=True, interpolate=True)
    assert kept.agg(F.min("v"), F.max("v")).first() == (6.0, 96.0)
    strict = q.trim_to_quantiles(df, "v", 0.05, 0.95, exact=True, interpolate=True, inclusive=False)
    assert strict.agg(F.min("v"), F.max("v")).first() == (7.0, 95.0)


def test_sketch_is_within_its_rank_error(spark):
    df = spark.range(100_000).select(F.col("id").cast("double").alias("v"))
    for r in q.sketch_quantiles(df, "v", [0.1, 0.5, 0.9], accuracy=1_000).collect():
        assert abs(r["quantile"] - r["probability"] * 100_000) <= 100


def test_equal_labels_do_not_collide(spark):
    df = spark.range(1_000).select(F.col("id").cast("double").alias("v"))
    assert q.trim_to_quantiles(df, "v", 0.501, 0.504, exact=True).count() == 4


def test_nan_never_moves_a_bound(rows):
    df = rows("v double", (float("nan"),), (2.0,), (4.0,), (None,))
    for exact in (True, False):
        assert tuple(q.quantiles_row(df, "v", [0.5, 1.0], exact=exact).first()) == (2.0, 4.0)
        assert sorted(r["v"] for r in q.trim_to_quantiles(df, "v", 0.0, 0.99, exact=exact).collect()) == [2.0, 4.0]
    assert [r["quantile"] for r in q.sketch_quantiles(df, "v", [1.0]).collect()] == [4.0]
    only = rows("v double", (float("nan"),))
    assert q.exact_quantiles(only, "v", [0.5]).count() == 0


@pytest.mark.parametrize("sort_rows", [1, 50_000])
def test_integers_and_decimals_come_back_exactly(spark, sort_rows):
    base = 1 << 60
    values = [base + i for i in range(-3, 400, 3)] + [-(1 << 63), (1 << 63) - 1]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(3)
    found = {r["probability"]: r["quantile"] for r in q.exact_quantiles(df, "v", [0.0, 0.1, 0.5, 0.9, 1.0], sort_rows=sort_rows).collect()}
    assert found == {p: nearest(values, p) for p in found} and isinstance(found[0.5], int)
    cents = [Decimal(f"9007199254740993.{i:02d}") for i in range(100)]
    money = spark.createDataFrame([(v,) for v in cents], "v decimal(20,2)")
    exact = {r["probability"]: r["quantile"] for r in q.exact_quantiles(money, "v", [0.05, 0.5, 0.95], sort_rows=sort_rows).collect()}
    assert exact == {p: nearest(cents, p) for p in exact}


def test_brackets_hold_on_more_rows_than_a_sketch(spark, monkeypatch):
    monkeypatch.setattr(q, "BRACKET_ACCURACY", 100)
    monkeypatch.setattr(q, "BRACKET_SHARE", 0.025)
    df = spark.range(60_000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") * 37 % 60_013).alias("v"))
    table = df.toPandas()
    for keys in ([], ["k"]):
        found = q.exact_quantiles(df, "v", [0.001, 0.3, 0.5, 0.999], keys, sort_rows=200).collect()
        for r in found:
            part = table if not keys else table[table.k == r["k"]]
            assert r["quantile"] == nearest(part.v.tolist(), r["probability"])
        assert len(found) == (4 if not keys else 12)


def test_the_input_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(5_000).mapInArrow(count, "id bigint")
    q.exact_quantiles(df, "id", [0.25, 0.5], sort_rows=10).collect()
    assert seen.value == 5_000
