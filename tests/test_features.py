import pytest
from pyspark.sql import functions as F

from costlake.functions import features as fx
from costlake.functions.text import ENGLISH_STOP_WORDS, tokens, without_stop_words
from costlake.operators import features, joins, metrics, profile, ranking, splits


def test_story_text_rules(rows):
    df = rows("n double, t string", (20.0, "erect a two-story home"), (None, "fourteen-story tower"), (0.5, "no mention"),
              (3.0, "five story"), (None, "story"), (16.0, None), (None, "12 story block"))
    got = df.select(fx.repaired_story_count(F.col("n"), F.col("t")),
                    fx.word_to_int(fx.story_word(F.col("t")), legacy=True)).collect()
    assert [g[0] for g in got] == [2.0, None, 0.5, 3.0, None, 16.0, 12.0]
    assert got[1][1] == 4  # "fourteen" holds "four"

    labels = rows("n double", (2.9,), (3.0,), (5.0,), (8.0,), (10.0,), (None,)).select(
        fx.story_range(F.col("n")), fx.story_range(F.col("n"), legacy=True)).collect()
    assert [r[0] for r in labels] == ["0-2 stories", "3-4 stories", "5-7 stories", "8-9 stories", "More than 10 stories", None]
    assert labels[-1][1] == "More than 10 stories"


def test_scalar_null_rules(rows):
    df = rows("p double, a int, b int, w string", (None, None, 2, "maybe"), (9.0, 3, None, " YES "), (-5.0, 1, 1, "0"))
    got = df.select(fx.amount_from_log10(F.col("p"), 100.0, 1e6), fx.zero_filled_difference(F.col("a"), F.col("b"))).collect()
    assert [tuple(g) for g in got] == [(None, -2), (1e6, 3), (100.0, 0)]
    assert rows("x double", (0.0,), (10.0,)).select(F.log10("x")).collect()[0][0] is None


def test_target_prefers_the_first_positive_amount(rows):
    df = rows("r double, e double, vr boolean, ve boolean", (5.0, 9.0, True, True), (0.0, 9.0, False, True), (None, None, False, False))
    out = features.choose_target(df, [("r", "vr"), ("e", "ve")]).select("target_cost", "target_source").collect()
    assert [tuple(r) for r in out] == [(5.0, "r"), (9.0, "e"), (None, None)]


def test_rare_categories_and_codes(spark):
    # one category has most rows; NULL and rare ones fold
    df = spark.range(1000).select("id", F.when(F.col("id") % 100 == 7, "rare").when(F.col("id") % 10 == 0, None)
                                  .otherwise("hot").alias("c"))
    folded = {r["c_"]: r["rows"] for r in profile.group_count(features.fold_rare(df, "c", 20, "Other"), ["c_"]).collect()}
    assert folded == {"hot": 890, "Other": 110}
    coded = features.first_appearance_codes(df, "c", "id").select("c", "c_code").distinct().collect()
    assert {r["c"]: r["c_code"] for r in coded} == {"hot": 0, "rare": 1, None: -1}


def test_lookup_join_gives_the_same_rows_broadcast_or_shuffled(spark):
    big = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, 1).when(F.col("id") % 7 > 0, F.col("id") % 50).alias("k"))
    table = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = joins.lookup_join(big, table, ["k"])
    large = joins.lookup_join(big, table, ["k"], max_rows=0)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(small) == key(large) and len(key(small)) == 2000


def test_global_numbers_are_consecutive(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
    out = ranking.global_row_number(df, [F.col("v")], "n")
    assert out.filter("v != n").count() == 0 and out.count() == 5000


def test_metric_identities(rows):
    df = rows("m string, y double, p double", ("same", 1.0, 1.0), ("same", 3.0, 3.0), ("flat", 2.0, 1.0), ("flat", 2.0, 4.0),
              ("zero", 0.0, 1.0), ("zero", 4.0, 2.0))
    got = {r["m"]: r for r in metrics.regression_metrics(df, "y", "p", ["m"]).collect()}
    assert got["same"]["r2"] == 1.0 and got["same"]["rmse"] == 0.0
    assert got["flat"]["r2"] is None and got["flat"]["rmse"] >= got["flat"]["mae"]
    assert got["zero"]["mape"] == 50.0  # the zero actual is left out


# Published model scores and the percentages published beside them.
PUBLISHED = [
    ("structured", "validation", 105455.83791657598, -0.009156768042527075, 0.12697524155338202),
    ("structured_text", "validation", 92834.37574577623, 0.2179490887500365, 0.4784665303704636),
    ("structured", "test", 122138.51298147175, -0.027178956459821935, 0.11824073511079924),
    ("structured_text", "test", 105812.1583871424, 0.22907522307121708, 0.4641062825588994),
    ("median_baseline", "validation", 110346.18214123936, -0.10492298213483253, -0.0010206159212795551),
]


def test_published_percentages(rows):
    table = rows("model string, split string, rmse double, r2 double, log_r2 double", *PUBLISHED)
    cut = {r["split"]: r["rmse_reduction_percent"] for r in metrics.ablation(table, "structured", "structured_text").collect()}
    assert cut["validation"] == pytest.approx(11.968481233617759)
    assert cut["test"] == pytest.approx(13.367081517363848)
    gain = {r["model"]: r["improvement_percent"] for r in metrics.improvement(table, "median_baseline").collect()}
    assert gain["structured_text"] == pytest.approx(15.870, abs=5e-4)
    on_validation = table.filter("split = 'validation'")
    assert ranking.best_row(on_validation, "rmse", "model").first()["model"] == "structured_text"


def test_tokens_agree_with_the_model_stages(spark, rows):
    from pyspark.ml.feature import StopWordsRemover

    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    df = rows("t string", ("Étion of THE a kitchen_2, don't re-roof!",), ("",), ("   ",))
    got = df.select(without_stop_words(tokens(F.col("t"), 2)), tokens(F.col("t"), 2, unicode=True)).collect()
    assert got[0][0] == ["tion", "kitchen_2", "re", "roof"]  # "don" is a stop word
    assert got[0][1][0] == "étion" and got[1][0] == [] and got[2][0] == []


def test_splits_are_disjoint_stable_and_guarded(spark):
    df = spark.range(5000)
    one = splits.hash_split(df.repartition(3), "id", 80, 1)
    two = splits.hash_split(df.repartition(7), "id", 80, 1)
    assert one.exceptAll(two).count() == 0
    years = df.select((F.col("id") % 4 + 2020).cast("int").alias("y"))
    labelled = splits.year_split(years, "y", (2020, 2021), 2022, 2024)
    assert labelled.count() == 3750
    with pytest.raises(splits.EmptySplitError, match="test"):
        splits.require_rows(labelled)
