"""NULL and edge rules of cleaning, one table per rule set."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from costlake.functions import cleaning as fc
from costlake.operators import cleaning, dedupe
from costlake.operators.cleaning import QualityPlan, TypePlan


def test_text_to_value_rules(rows):
    df = rows("t string", ("5.0",), ("1,234",), (" 7 ",), ("abc",), ("5d",), ("99999999999",), ("-3",), (None,))
    got = [tuple(r) for r in df.select("t", fc.parse_int(F.col("t")), fc.parse_money(F.col("t"))).collect()]
    assert [g[1] for g in got] == [5, 1234, 7, None, None, None, -3, None]
    assert [g[2] for g in got][:4] == [5.0, 1234.0, 7.0, None]

    dates = rows("t string", ("2019/09/19 03:31:40 PM",), ("2019/09/19 15:31:40",), ("2019/09/19",),
                 ("09/19/2019 03:31:40 PM",), ("09/19/2019 15:31:40",), ("09/19/2019",), ("2019-09-19",),
                 ("2019-09-19T15:31:40.000",), ("soon",), ("13/45/2019",), (None,))
    parsed = [r[0] for r in dates.select(fc.parse_date(F.col("t"))).collect()]
    assert parsed == [dt.date(2019, 9, 19)] * 8 + [None] * 3


def test_null_tokens_hold_for_every_string_column(rows):
    df = rows("a string, n int", (" None ", 1), ("NaN", 2), ("n/a", 3), ("NULL", 4), ("  ", 5), (" nonesuch ", 6), (None, 7))
    assert [r["a"] for r in cleaning.null_tokens(df).orderBy("n").collect()] == [None] * 5 + ["nonesuch", None]


def test_snake_case_strips_marks_and_refuses_collisions(rows):
    df = rows("`_x Ingested-At` string, `Permit  Number (old)` string", ("a", "b"))
    assert cleaning.snake_case_columns(df).columns == ["x_ingested_at", "permit_number_old"]
    with pytest.raises(ValueError, match="a_b"):
        cleaning.snake_case_columns(rows("`A b` string, `a-B` string", ("1", "2")))


def test_flags_are_never_null_and_missing_columns_are_skipped(rows):
    df = rows("id string, cost string", ("1", "$5"), (None, None), ("2", "-1"))
    typed = cleaning.apply_types(df, TypePlan(amounts=("cost", "absent"), dates=("absent_date",)))
    flagged = cleaning.quality_flags(typed, QualityPlan({"has_id": "id"}, {"valid": "cost"}))
    assert [(r["has_id"], r["valid"]) for r in flagged.collect()] == [(True, True), (False, False), (True, False)]


def test_small_text_rules(rows):
    df = rows("zip string, street string, suffix string, kind string, amount double",
              ("94110.0", "03rd", "Bl", "III", 1234567.8), (None, "La Playa", "St", None, 12.0),
              ("0.0", "10th", None, "5.0", -1000.5))
    got = [tuple(r) for r in df.select(
        fc.legacy_zip(F.col("zip")), fc.street_name(F.col("street")),
        fc.street_suffix(F.col("suffix"), F.col("street")), fc.construction_type(F.col("kind")),
        fc.money_text(F.col("amount"))).collect()]
    assert got == [("94110", "3rd", "Blvd", "3", "1 234 567"), ("", "La Playa", "Street", "99", "12"),
                   ("", "10th", " ", "5", "-1 000")]


def test_latest_version_is_repeatable_and_keeps_rows_without_key(spark, rows):
    values = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "q"), (None, 1, "n"), (None, 1, "n")]
    df = rows("k string, version int, payload string", *values)
    runs = [sorted(map(tuple, dedupe.latest_version(df.repartition(n), "k", ["version"]).collect()), key=repr)
            for n in (1, 3, 5)]
    assert runs[0] == runs[1] == runs[2]
    assert [r[:2] for r in runs[0]] == [("a", 3), ("b", None), (None, 1), (None, 1)]
    again = dedupe.latest_version(rows("k string, version int, payload string", *runs[0]), "k", ["version"])
    assert sorted(map(tuple, again.collect()), key=repr) == runs[0]
    collapsed = dedupe.drop_duplicates(df, ["k"], ["version"], collapse_null_keys=True)
    assert collapsed.count() == 3


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedupe.latest_version(df, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    limit = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange hashpartitioning(k") < limit  # printed above, so it runs after
