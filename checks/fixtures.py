"""Views the queries run on, built from the given tables.

Each view keeps every row of its source. Where a value should sometimes be missing or spelled
differently, the row's key decides (``key % n``), so Spark and SQL render the same thing.
Column expressions that both engines understand are written once and used by both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.functions import geometry as g
from costlake.operators.cleaning import QualityPlan, TypePlan
from costlake.operators.metrics import regression_metrics
from costlake.operators.quantiles import quantiles_row
from costlake.plans.permits import CostTable

TRAIN, VALIDATION, TEST_FROM = (1995, 1999), 2000, 2001


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _columns(text: str) -> dict[str, str]:
    """``name = expression`` lines."""
    return dict(line.strip().split(" = ", 1) for line in text.strip().splitlines() if line.strip())


def _spark_select(columns: dict[str, str]) -> list[str]:
    return [f"{e} AS {n}" for n, e in columns.items()]


def _sql_select(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


# ------------------------------------------------------------------------- jobs

JOB_COLUMNS = _columns("""
record_id = o_orderkey
permit_number = CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE concat('P', o_orderkey) END
created = CAST(o_orderdate AS DATE)
permit_creation_year = CAST(year(o_orderdate) AS INTEGER)
permit_creation_month = CAST(month(o_orderdate) AS INTEGER)
revised_cost = CASE WHEN o_orderstatus = 'F' THEN o_totalprice END
estimated_cost = CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(floor(o_totalprice * 0.9) AS DOUBLE) END
category = o_orderpriority
zone = n_name
segment = c_mktsegment
district = CAST(o_orderkey % 11 + 1 AS INTEGER)
existing_stories = CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS DOUBLE) END
proposed_stories = CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 9 + 1 AS DOUBLE) END
existing_units = CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 10 AS INTEGER) END
proposed_units = CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 13 AS INTEGER) END
adu = CASE o_orderkey % 6 WHEN 0 THEN 'Y' WHEN 1 THEN ' no ' WHEN 2 THEN 'TRUE' WHEN 3 THEN '0' WHEN 4 THEN 'maybe' END
""")

JOBS = (f"jobs AS (SELECT {_sql_select(JOB_COLUMNS)} FROM orders JOIN customer ON o_custkey = c_custkey "
        "JOIN nation ON c_nationkey = n_nationkey)")

# jobs with a positive target
TARGETS = JOBS + """, targets AS (SELECT * FROM (SELECT *,
  CASE WHEN revised_cost > 0 THEN revised_cost WHEN estimated_cost > 0 THEN estimated_cost END AS target_cost,
  CASE WHEN revised_cost > 0 THEN 'revised_cost' WHEN estimated_cost > 0 THEN 'estimated_cost' END AS target_source,
  CASE WHEN permit_creation_year BETWEEN 1995 AND 1999 THEN 'train'
       WHEN permit_creation_year = 2000 THEN 'validation'
       WHEN permit_creation_year >= 2001 THEN 'test' END AS split
  FROM jobs) WHERE target_cost > 0)"""


def jobs(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.selectExpr(*_spark_select(JOB_COLUMNS))


JOB_TABLE = CostTable(
    key="record_id", newest=("created",),
    types=TypePlan(dates=("created",), integers=("existing_units", "proposed_units", "district"),
                   amounts=("revised_cost", "estimated_cost", "existing_stories", "proposed_stories"),
                   zips=("zipcode",)),
    quality=QualityPlan(
        present={"dq_has_record_id": "record_id", "dq_has_permit_number": "permit_number"},
        positive={"dq_valid_estimated_cost": "estimated_cost", "dq_valid_revised_cost": "revised_cost"}),
    creation_date="created", year="permit_creation_year", month="permit_creation_month",
    amounts=(("revised_cost", "dq_valid_revised_cost"), ("estimated_cost", "dq_valid_estimated_cost")),
    differences={"story_change": ("proposed_stories", "existing_stories"),
                 "unit_change": ("proposed_units", "existing_units")},
    yes_no={"is_adu": "adu"},
    feature_columns=("record_id", "permit_number", "target_cost", "target_cost_log10", "target_source",
                     "permit_creation_year", "permit_creation_month", "zone", "category", "segment",
                     "district", "existing_stories", "proposed_stories", "story_change",
                     "existing_units", "proposed_units", "unit_change", "is_adu", "not_in_this_table"),
    null_checked=("permit_number", "existing_stories", "proposed_stories", "existing_units",
                  "proposed_units", "is_adu"),
    category_numbers={"district": "district_cat"},
    categorical=("zone", "category", "segment", "district_cat"),
    numeric=("permit_creation_year", "permit_creation_month", "existing_stories", "proposed_stories",
             "story_change", "existing_units", "proposed_units", "unit_change", "is_adu"),
    text="description",
    profiles={"target_source": (("target_source",), (), None), "zones_top20": (("zone",), ("zone",), 20),
              "segments_top20": (("category", "segment"), ("segment",), 20), "districts_top20": (("district",), ("district",), 20),
              "annual_trend": (("permit_creation_year",), ("permit_creation_year",), None)},
    scale_averages={f"avg_{c}": c for c in ("existing_stories", "proposed_stories", "story_change",
                                            "existing_units", "proposed_units", "unit_change")},
)


def flagged_jobs(spark: SparkSession, sf: str) -> DataFrame:
    from costlake.operators.cleaning import quality_flags

    return quality_flags(jobs(spark, sf), JOB_TABLE.quality)


def target_jobs(spark: SparkSession, sf: str) -> DataFrame:
    from costlake.plans.layers import with_targets

    return with_targets(flagged_jobs(spark, sf), JOB_TABLE)


def split_jobs(spark: SparkSession, sf: str) -> DataFrame:
    from costlake.operators.splits import year_split

    return year_split(target_jobs(spark, sf), "permit_creation_year", TRAIN, VALIDATION, TEST_FROM)


# --------------------------------------------------------------------- raw text

def _raw_columns():
    return {
        "Record ID": F.col("record_id").cast("string"),
        "Permit Number": F.coalesce("permit_number", F.lit(" N/A ")),
        "Permit Creation Date": F.expr("""CASE WHEN record_id % 17 = 0 THEN 'null' WHEN record_id % 23 = 0 THEN 'soon'
            WHEN record_id % 4 = 0 THEN date_format(created, 'yyyy/MM/dd') || ' 03:31:40 PM'
            WHEN record_id % 4 = 1 THEN date_format(created, 'MM/dd/yyyy')
            WHEN record_id % 4 = 2 THEN ' ' || date_format(created, 'yyyy-MM-dd') || ' '
            ELSE date_format(created, 'yyyy-MM-dd') || 'T00:00:00.000' END"""),
        "Revised Cost": F.expr("""CASE WHEN revised_cost IS NOT NULL THEN '$' || format_number(revised_cost, 2)
            WHEN record_id % 3 = 0 THEN '' WHEN record_id % 3 = 1 THEN 'NaN' ELSE 'unknown' END"""),
        "Estimated Cost": F.expr("coalesce(cast(cast(estimated_cost AS bigint) AS string), 'None')"),
        "Existing Units": F.expr("""CASE WHEN existing_units IS NULL THEN 'n/a'
            WHEN record_id % 2 = 0 THEN format_number(existing_units * 1000, 0)
            ELSE cast(existing_units AS string) || '.0' END"""),
        "Zipcode": F.expr("""CASE WHEN record_id % 13 = 0 THEN 'unknown'
            ELSE '94' || lpad(cast(record_id % 158 AS string), 3, '0') || '-0000' END"""),
        "ADU": F.coalesce("adu", F.lit("  ")),
        "Description": F.expr(r"""'Job ' || record_id || ', "quoted"' || chr(10) || 'second line'"""),
    }


def raw_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """``jobs`` spelled as messy text under human-readable headers."""
    return jobs(spark, sf).select(*[c.alias(n) for n, c in _raw_columns().items()])


def clean_text_jobs(spark: SparkSession, sf: str) -> DataFrame:
    from costlake.operators.cleaning import null_tokens, snake_case_columns

    return null_tokens(snake_case_columns(raw_jobs(spark, sf)))


# --------------------------------------------------------------------- versions

VERSION_COLUMNS = _columns("""
version_key = CASE WHEN l_quantity = 50 THEN NULL ELSE l_orderkey END
shipped = CAST(l_shipdate AS DATE)
line = l_linenumber
part = l_partkey
supplier = l_suppkey
price = l_extendedprice
""")
VERSIONS = f"versions AS (SELECT {_sql_select(VERSION_COLUMNS)} FROM lineitem)"


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Many rows per key, and rows without a key."""
    return table(spark, sf, "lineitem").selectExpr(*_spark_select(VERSION_COLUMNS))


# ---------------------------------------------------------------------- phrases

PHRASE_COLUMNS = _columns("""
phrase_id = p_partkey
description = CASE p_partkey % 6 WHEN 0 THEN concat('erect a two-story block of ', p_size, ' units') WHEN 1 THEN concat('five story ', p_name) WHEN 2 THEN concat(p_size, ' story ', p_name) WHEN 3 THEN 'one fourteen-story tower' WHEN 4 THEN concat(p_name, ' with no mention') ELSE 'Eleven story annex' END
stories = CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0.5E0 WHEN 2 THEN 20E0 ELSE CAST(p_size % 12 + 1 AS DOUBLE) END
units = CAST(p_size AS DOUBLE)
price = p_retailprice
area = CAST(p_size % 7 * 25 AS DOUBLE)
""")
PHRASES = f"phrases AS (SELECT {_sql_select(PHRASE_COLUMNS)} FROM part)"


def phrases(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*_spark_select(PHRASE_COLUMNS))


# ------------------------------------------------------------ places and shapes

PLACE_COLUMNS = _columns("""
place_id = c_custkey
number = CAST(c_custkey % 900 + 100 AS VARCHAR(10))
street = CASE WHEN c_custkey % 10 = 0 THEN 'La Playa' WHEN c_custkey % 4 = 0 THEN concat('0', c_custkey % 40, 'th') ELSE concat(c_mktsegment, ' ', c_custkey) END
suffix = CASE c_custkey % 5 WHEN 0 THEN 'Bl' WHEN 1 THEN 'Tr' WHEN 2 THEN 'Cr' WHEN 3 THEN 'St' END
zip_float = CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE concat(94100 + c_custkey % 59, '.0') END
place_type = CASE c_custkey % 7 WHEN 0 THEN 'III' WHEN 1 THEN '5.0' WHEN 2 THEN '1' WHEN 3 THEN NULL WHEN 4 THEN '4.0' ELSE '2' END
x = c_custkey % 60 / 8E0
y = c_custkey % 70 / 8E0
balance = c_acctbal
""")
PLACES = f"places AS (SELECT {_sql_select(PLACE_COLUMNS)} FROM customer)"


def places(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(*_spark_select(PLACE_COLUMNS))


POINT_COLUMNS = _columns("""
point_id = c_custkey
x = c_custkey % 60 / 8E0 + 0.0625E0
y = c_custkey % 70 / 8E0 + 0.0625E0
balance = c_acctbal
""")
# 25 unit squares on a 5 x 5 grid (points beyond 5 match none), one of them doubled by a later,
# larger square so that "first match" has something to decide
POINTS = f"""points AS (SELECT {_sql_select(POINT_COLUMNS)} FROM customer),
cells AS (SELECT CAST(n_nationkey AS BIGINT) AS polygon_id, n_nationkey % 5 AS x0, n_nationkey // 5 AS y0,
  CASE WHEN n_nationkey = 3 THEN 3.5 ELSE 1.0 END AS side FROM nation)"""


def points(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(*_spark_select(POINT_COLUMNS))


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """Square polygons ``polygon_id, rings`` at whole coordinates."""
    k = F.col("n_nationkey")
    x0, y0 = k % 5, F.floor(k / 5)
    side = F.when(k == 3, 3.5).otherwise(1.0)
    return table(spark, sf, "nation").select(
        k.cast("bigint").alias("polygon_id"),
        F.array(g.box_ring(x0, y0, x0 + side, y0 + side)).alias("rings"))


# A town of square footprints, one per order, 400 to a row; events are the points. The squares
# cover 64 percent of their lot, so many points match none.
SITE_COLUMNS = _columns("""
site_id = event_id
x = (user_id * 7 + event_id) % 4000 / 1E1 + 0.05E0
y = (user_id * 11 + event_id * 3) % 500 / 1E1 + 0.05E0
""")
FOOTPRINTS = f"""sites AS (SELECT {_sql_select(SITE_COLUMNS)} FROM events),
footprints AS (SELECT o_orderkey AS polygon_id, o_orderkey % 400 AS x0, o_orderkey // 400 AS y0 FROM orders)"""


def sites(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(*_spark_select(SITE_COLUMNS))


def footprints(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    x0, y0 = k % 400, F.floor(k / 400)
    return table(spark, sf, "orders").select(
        k.alias("polygon_id"), F.array(g.box_ring(x0, y0, x0 + 0.8, y0 + 0.8)).alias("rings"))


# -------------------------------------------------- predictions, metrics, terms

# three predictors of the log target, all learnt on the training years
PREDICTIONS = TARGETS + """,
logs AS (SELECT record_id, split, zone, category, target_cost AS y, log10(target_cost) AS log_y,
  record_id % 4 AS fold FROM targets),
train AS (SELECT * FROM logs WHERE split = 'train'),
by_zone AS (SELECT zone, round(avg(log_y), 6) AS log_p FROM train GROUP BY zone),
by_both AS (SELECT zone, category, round(avg(log_y), 6) AS log_p FROM train GROUP BY zone, category),
base AS (SELECT log10(quantile_disc(y, 0.5)) AS log_p FROM train),
stacked AS (
  SELECT 'median_baseline' AS model, record_id, split, fold, y, log_y, log_p FROM logs, base UNION ALL
  SELECT 'structured', record_id, split, fold, y, log_y, log_p FROM logs JOIN by_zone USING (zone) UNION ALL
  SELECT 'structured_text', record_id, split, fold, y, log_y, log_p FROM logs JOIN by_both USING (zone, category)),
predictions AS (SELECT *, pow(10, log_p) AS p FROM stacked)"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    rows = split_jobs(spark, sf).select(
        "record_id", "split", "zone", "category", F.col("target_cost").alias("y"),
        F.log10("target_cost").alias("log_y"), (F.col("record_id") % 4).alias("fold"))
    train = rows.filter(F.col("split") == "train")
    keep = ["record_id", "split", "fold", "y", "log_y", "log_p"]
    median = quantiles_row(train, "y", [0.5], exact=True).scalar()
    parts = [rows.withColumn("log_p", F.log10(median)).select(F.lit("median_baseline").alias("model"), *keep)]
    for name, keys in (("structured", ["zone"]), ("structured_text", ["zone", "category"])):
        means = train.groupBy(*keys).agg(F.round(F.avg("log_y"), 6).alias("log_p"))
        parts.append(rows.join(means, keys).select(F.lit(name).alias("model"), *keep))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("p", F.pow(F.lit(10.0), F.col("log_p")))


METRIC_ROWS = PREDICTIONS + """,
metric_rows AS (SELECT model, split, count(*) AS rows, avg(abs(y - p)) AS mae,
  sqrt(avg((y - p) * (y - p))) AS rmse,
  CASE WHEN var_pop(y) > 0 THEN 1 - avg((y - p) * (y - p)) / var_pop(y) END AS r2,
  avg(abs((y - p) / y)) * 100 AS mape, avg(abs(log_y - log_p)) AS log_mae,
  sqrt(avg((log_y - log_p) * (log_y - log_p))) AS log_rmse,
  CASE WHEN var_pop(log_y) > 0 THEN 1 - avg((log_y - log_p) * (log_y - log_p)) / var_pop(log_y) END AS log_r2
  FROM predictions GROUP BY model, split)"""


def metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    return regression_metrics(predictions(spark, sf), "y", "p", ["model", "split"], "log_y", "log_p")


# ---------------------------------------------------------------- documents

def sql_tokens(text: str, min_length: int) -> str:
    """SQL for the ASCII word split: lower-case, break on anything but a-z, 0-9 and _."""
    return (f"list_filter(string_split_regex(lower({text}), '[^a-z0-9_]+'), "
            f"lambda w: length(w) >= {min_length})")


def sql_list(words) -> str:
    """A list of strings as a SQL literal."""
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


# how much longer (log10) documents holding a term are than the average document
TERMS = f"""doc_words AS (SELECT doc_id, log10(n_chars) AS size, {sql_tokens('text', 2)} AS words FROM documents),
doc_terms AS (SELECT size, unnest(list_distinct(words)) AS term FROM doc_words),
terms AS (SELECT term, count(*) AS documents,
  round(avg(size) - (SELECT avg(size) FROM doc_words), 6) AS coefficient_log10
  FROM doc_terms GROUP BY term HAVING count(*) >= 20)"""


def document_words(spark: SparkSession, sf: str, min_length: int = 2) -> DataFrame:
    from costlake.functions.text import tokens

    return table(spark, sf, "documents").select(
        "doc_id", "lang", F.log10("n_chars").alias("size"), tokens(F.col("text"), min_length).alias("words"))


def terms(spark: SparkSession, sf: str) -> DataFrame:
    docs = document_words(spark, sf)
    overall = docs.agg(F.avg("size")).scalar()
    return (docs.select("size", F.explode(F.array_distinct("words")).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("documents"), F.avg("size").alias("mean"))
            .filter(F.col("documents") >= 20)
            .select("term", "documents", F.round(F.col("mean") - overall, 6).alias("coefficient_log10")))


def ready_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in the shape of a feature table: text, target, source, year."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("record_id"), F.col("n_chars").cast("double").alias("target_cost"),
        F.log10("n_chars").alias("target_cost_log10"), F.lit("revised_cost").alias("target_source"),
        (F.col("doc_id") % 7 + 1995).cast("int").alias("permit_creation_year"),
        F.col("lang").alias("zone"), F.col("source").alias("category"), F.col("text").alias("description"))
