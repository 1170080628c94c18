"""Train, compare, choose, save and explain cost models on the feature table."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import IDF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.operators import cleaning, encode, explain, features, metrics, models, ranking, splits, text
from costlake.operators.profile import columns_with_values
from costlake.operators.quantiles import quantiles_row
from costlake.plans import permits
from costlake.plans.permits import PERMITS, CostTable
from costlake.session import settle
from costlake.sources import reports
from costlake.sources.models import save_model

BASELINE = "median_baseline"


@dataclass(frozen=True)
class Policy:
    """Which rows train, validate and test a model."""

    low: float = permits.MIN_COST
    high: float = permits.MAX_COST
    train: tuple[int, int] = permits.TRAIN_YEARS
    validation: int = permits.VALIDATION_YEAR
    test_from: int = permits.TEST_FROM
    only_source: str | None = None


@dataclass(frozen=True)
class Trained:
    models: dict[str, Model]
    metrics: DataFrame
    best: str
    improvement: DataFrame
    policy: Policy = Policy()
    split_rows: dict[str, int] = field(default_factory=dict)
    features: dict[str, list[str] | int] = field(default_factory=dict)
    median: float | None = None


def training_rows(ready: DataFrame, policy: Policy, table: CostTable = PERMITS) -> DataFrame:
    """Eligible rows with their split, label, and filled categories and text."""
    rows = features.eligible_rows(ready, "target_cost", policy.low, policy.high, table.year,
                                  policy.train[0], ["target_cost_log10"], "target_source",
                                  policy.only_source)
    for number, label in table.category_numbers.items():
        if number in rows.columns:
            rows = features.category_text(rows, number, label)
    rows = splits.year_split(rows, table.year, policy.train, policy.validation, policy.test_from)
    rows = cleaning.fill_categories(rows, [c for c in table.categorical if c in rows.columns])
    if table.text in rows.columns:
        rows = cleaning.fill_text(rows, [table.text])
    return rows.withColumn("label", F.col("target_cost_log10"))


def _measured(scored: DataFrame) -> DataFrame:
    return metrics.regression_metrics(scored, "target_cost", "prediction_cost", ["model", "split"],
                                      "label", "prediction")


def _choose(fitted: dict[str, Model], scored: DataFrame, exclude: list[str]) -> Trained:
    measured = settle(_measured(scored))  # a handful of rows, kept past the caches they came from
    on_validation = measured.filter(F.col("split") == "validation")
    best = ranking.best_row(on_validation, "rmse", "model", exclude=exclude).first()["model"]
    return Trained(fitted, measured, best, metrics.improvement(measured, BASELINE))


def _described(result: Trained, policy: Policy, sizes: dict[str, int], categorical: list[str], numeric: list[str], width: int, train: DataFrame) -> Trained:
    """What a summary needs to know besides the scores."""
    median = quantiles_row(train, "target_cost", [0.5]).first()[0]
    return replace(result, policy=policy, split_rows=sizes, features={"categorical": categorical, "numeric": numeric, "vector_size": width}, median=median)


def _with_baseline(train: DataFrame, held_out: DataFrame, scored: DataFrame, policy: Policy) -> DataFrame:
    baseline = models.median_baseline(train, held_out, "target_cost").withColumn("model", F.lit(BASELINE))
    columns = ["model", "split", "target_cost", "label", "prediction", "prediction_cost"]
    return models.with_amounts(scored, policy.low, policy.high).select(*columns).unionByName(
        baseline.select(*columns))


def compare_structured(ready: DataFrame, policy: Policy = Policy(), table: CostTable = PERMITS,
                       model_dir: str | None = None, estimators: dict | None = None) -> Trained:
    """Linear, forest and boosted models on shared structured features; lowest validation RMSE wins.

    The baseline is measured but cannot win.
    """
    rows = training_rows(ready, policy, table).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _compare_structured(rows, policy, table, model_dir, estimators)
    finally:
        rows.unpersist()


def _compare_structured(rows: DataFrame, policy: Policy, table: CostTable, model_dir: str | None, estimators: dict | None) -> Trained:
    sizes = splits.require_rows(rows)
    train = rows.filter(F.col("split") == "train")
    numeric = columns_with_values(train, list(table.numeric))
    categorical = [c for c in table.categorical if c in rows.columns]
    stages, encoded = encode.structured_stages(categorical, numeric)
    prepared = models.fit_stages(stages + [encode.assembler(encoded)], train)
    vectors = (prepared.transform(rows).select(table.key, "split", "target_cost", "label", "features")
               .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        fitted, scored = models.compare(
            estimators or {"linear_regression": models.ridge_log_cost(iterations=60),
                           "random_forest": models.random_forest(),
                           "gradient_boosted_trees": models.boosted_trees()},
            vectors.filter(F.col("split") == "train"), vectors.filter(F.col("split") != "train"),
            ["split", "target_cost", "label"])
        result = _choose(fitted, _with_baseline(train, vectors.filter(F.col("split") != "train"),
                                                scored, policy), exclude=[BASELINE])
        width = len(models.feature_names(vectors))
        result = _described(result, policy, sizes, categorical, numeric, width, train)
    finally:
        vectors.unpersist()
    if model_dir is not None:
        save_model(prepared, f"{model_dir}/preprocessor")
        save_model(PipelineModel([prepared, fitted[result.best]]), f"{model_dir}/best")
    return result


def compare_with_text(ready: DataFrame, policy: Policy = Policy(only_source="revised_cost"),
                      table: CostTable = PERMITS, model_dir: str | None = None,
                      text_features: int = 4096, penalty: float = 0.05) -> Trained:
    """Ridge on structured features against ridge on structured features and hashed TF-IDF text.

    Texts are counted once: the rows that every fit and score reads hold the counts instead of them.
    """
    (*counting, weighting), weighted = text.hashed_tfidf_stages(table.text, text_features)
    counted = PipelineModel(counting).transform(training_rows(ready, policy, table))
    rows = counted.drop(table.text, *[s.getOutputCol() for s in counting[:-1]]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = splits.require_rows(rows)
        train = rows.filter(F.col("split") == "train")
        held_out = rows.filter(F.col("split") != "train")
        numeric = columns_with_values(train, list(table.numeric))
        categorical = [c for c in table.categorical if c in rows.columns]
        stages, encoded = encode.structured_stages(categorical, numeric)
        regression = models.ridge_log_cost(penalty=penalty)
        chains = {
            "structured": [*stages, encode.assembler(encoded), regression],
            "structured_text": [*stages, weighting, encode.assembler([*encoded, weighted]), regression],
        }
        fitted, scored = {}, None
        for name, chain in chains.items():
            fitted[name] = models.fit_stages(chain, train)
            part = fitted[name].transform(held_out).select(
                F.lit(name).alias("model"), "split", "target_cost", "label", "prediction")
            scored = part if scored is None else scored.unionByName(part)
        result = _choose(fitted, _with_baseline(train, held_out, scored, policy), exclude=[])
        width = fitted["structured_text"].stages[-1].numFeatures
        result = _described(result, policy, sizes, [*categorical, table.text], numeric, width, train)
        fitted["structured_text"] = PipelineModel([*counting, *fitted["structured_text"].stages])  # for rows with a text
    finally:
        rows.unpersist()
    if model_dir is not None and result.best in fitted:
        save_model(fitted[result.best], f"{model_dir}/best")
    return result


def explain_text(ready: DataFrame, policy: Policy = Policy(only_source="revised_cost"),
                 table: CostTable = PERMITS, size: int = 1500, min_documents: int = 20,
                 penalty: float = 0.08, top: int = 30) -> dict[str, DataFrame]:
    """A companion model over an explicit vocabulary, so coefficients map back to words.

    Returns its terms, the strongest of them in both directions, and its quality per split.
    """
    rows = training_rows(ready, policy, table)
    tokens = models.fit_stages(text.token_stages(table.text, "words", 3), rows).transform(rows)
    tokens = tokens.select("split", "label", "words").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train = tokens.filter(F.col("split") == "train")
        terms = text.vocabulary_terms(train, "words", size, min_documents)
        chain = [text.vocabulary_stage(terms, "words", "counts"),
                 IDF(inputCol="counts", outputCol="features", minDocFreq=5),
                 models.ridge_log_cost(penalty=penalty)]
        model = models.fit_stages(chain, train)
        scored = model.transform(tokens.filter(F.col("split") != "train"))
        quality = metrics.log_metrics(scored, "label", "prediction", ["split"])
        quality = settle(quality)
    finally:
        tokens.unpersist()
    effects = explain.term_effects(explain.coefficient_rows(
        ready.sparkSession, terms, model.stages[-1].coefficients.toArray().tolist()))
    return {"terms": effects, "quality": quality,
            "strongest": ranking.signed_extremes(effects, "coefficient_log10", "term", top)}


def training_summary(result: Trained) -> DataFrame:
    """One nested row: policy, rows of each split, features, baseline, the chosen model, and every model's scores."""
    spark = result.metrics.sparkSession
    policy, chosen = result.policy, result.metrics.filter((F.col("model") == result.best) & (F.col("split") == "validation"))
    gain = result.improvement.filter((F.col("model") == result.best) & (F.col("split") == "validation"))
    listed = result.metrics.agg(F.sort_array(F.collect_list(F.struct("model", "split", *[c for c in result.metrics.columns if c not in ("model", "split")]))).alias("m"))
    names = lambda values: F.lit(list(values)) if values else F.array().cast("array<string>")
    return spark.range(0, 1, 1, 1).select(
        F.struct(F.lit("log10(target_cost)").alias("target"), F.lit(policy.low).alias("minimum_cost"), F.lit(policy.high).alias("maximum_cost"),
                 F.lit(policy.train[0]).alias("train_from"), F.lit(policy.train[1]).alias("train_to"), F.lit(policy.validation).alias("validation_year"),
                 F.lit(policy.test_from).alias("test_from")).alias("training_policy"),
        F.struct(*[F.lit(n).alias(split) for split, n in sorted(result.split_rows.items())]).alias("split_rows"),
        F.struct(names(result.features["categorical"]).alias("categorical"), names(result.features["numeric"]).alias("numeric"),
                 F.lit(result.features["vector_size"]).alias("vector_size")).alias("features"),
        F.struct(F.lit(result.median).cast("double").alias("training_median_cost")).alias("baseline"),
        F.struct(F.lit("validation RMSE").alias("criterion"), F.lit(result.best).alias("best_model"), chosen.select("rmse").scalar().alias("best_validation_rmse"),
                 gain.select("improvement_percent").scalar().alias("rmse_improvement_vs_median_percent")).alias("selection"),
        listed.scalar().alias("metrics"))


def write_training_reports(result: Trained, out: str) -> None:
    """Metric table, improvement over the baseline, and the summary of the run."""
    reports.write_report_csv(result.metrics, f"{out}/metrics", ["split", "rmse"])
    reports.write_report_csv(result.improvement, f"{out}/improvement")
    training_summary(result).write.mode("overwrite").json(f"{out}/results")


def explanation_summary(found: dict[str, DataFrame], compared: Trained, without: str = "structured", with_: str = "structured_text") -> DataFrame:
    """One nested row: the model that is explained, what text adds per split, and the companion model's size and quality."""
    ablation = metrics.ablation(compared.metrics, without, with_)
    listed = lambda df, key: df.agg(F.sort_array(F.collect_list(F.struct(key, *[c for c in df.columns if c != key]))).alias("l")).scalar()
    return compared.metrics.sparkSession.range(0, 1, 1, 1).select(
        F.struct(F.lit(compared.best).alias("name"), F.lit("hashed TF-IDF: hashed slots can't be traced back to words").alias("text_method")).alias("production_model"),
        listed(ablation, "split").alias("ablation_analysis"),
        F.struct(F.lit("counts by word, TF-IDF, ridge; explains, doesn't predict").alias("method"),
                 found["terms"].agg(F.count(F.lit(1))).scalar().alias("vocabulary_size"), listed(found["quality"], "split").alias("quality")).alias("companion_model"))


def write_explanation(found: dict[str, DataFrame], compared: Trained, out: str,
                      without: str = "structured", with_: str = "structured_text") -> None:
    """Strongest terms in both directions, companion quality, and what text adds per split."""
    strongest = found["strongest"]
    for direction in ("higher", "lower"):
        reports.write_report_csv(strongest.filter(F.col("direction") == direction), f"{out}/terms_{direction}",
                                 [F.abs("coefficient_log10").desc(), "term"])
    reports.write_report_csv(found["quality"], f"{out}/companion_quality")
    reports.write_report_csv(metrics.ablation(compared.metrics, without, with_), f"{out}/text_ablation")
    explanation_summary(found, compared, without, with_).write.mode("overwrite").json(f"{out}/summary")
