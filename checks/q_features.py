"""Features, windows, sets and splits (FTR, WIN, SET, SPL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from costlake.functions import cleaning as fc
from costlake.functions import features as ff
from costlake.operators import cleaning, dedupe, features, profile, quantiles, ranking, splits


@check("ftr_01_choose_target", f"WITH {fx.TARGETS} SELECT record_id, target_cost, target_source FROM targets")
def _(spark, sf):
    chosen = features.choose_target(fx.flagged_jobs(spark, sf), list(fx.JOB_TABLE.amounts))
    return chosen.filter(F.col("target_cost").isNotNull()).select("record_id", "target_cost", "target_source")


@check("ftr_02_positive_only", f"WITH {fx.TARGETS} SELECT record_id FROM targets")
def _(spark, sf):
    chosen = features.choose_target(fx.flagged_jobs(spark, sf), list(fx.JOB_TABLE.amounts))
    return features.positive_only(chosen).select("record_id")


@check("ftr_03_quantile_trim", f"""WITH {fx.TARGETS} SELECT record_id, target_cost FROM targets
 WHERE target_cost >= (SELECT quantile_disc(target_cost, 0.01) FROM targets)
   AND target_cost <= (SELECT quantile_disc(target_cost, 0.99) FROM targets)""")
def _(spark, sf):
    return quantiles.trim_to_quantiles(fx.target_jobs(spark, sf), "target_cost", exact=True).select(
        "record_id", "target_cost")


@check("ftr_04_log10_target", f"WITH {fx.TARGETS} SELECT record_id, round(log10(target_cost), 6) AS log_cost FROM targets")
def _(spark, sf):
    return fx.target_jobs(spark, sf).select("record_id", F.round(F.log10("target_cost"), 6).alias("log_cost"))


@check("ftr_05_zero_filled_difference", f"""WITH {fx.JOBS} SELECT record_id,
 coalesce(proposed_stories, 0) - coalesce(existing_stories, 0) AS story_change,
 coalesce(proposed_units, 0) - coalesce(existing_units, 0) AS unit_change FROM jobs""")
def _(spark, sf):
    return fx.jobs(spark, sf).select(
        "record_id",
        ff.zero_filled_difference(F.col("proposed_stories"), F.col("existing_stories")).alias("story_change"),
        ff.zero_filled_difference(F.col("proposed_units"), F.col("existing_units")).alias("unit_change"))


@check("ftr_06_yes_flag", f"""WITH {fx.JOBS} SELECT record_id, CASE WHEN record_id % 6 IN (0, 2) THEN 1
 WHEN record_id % 6 IN (1, 3) THEN 0 END AS is_adu FROM jobs""")
def _(spark, sf):
    return fx.jobs(spark, sf).select("record_id", fc.yes_flag(F.col("adu")).alias("is_adu"))


@check("ftr_07_project_present", f"WITH {fx.TARGETS} SELECT record_id, target_cost, zone FROM targets")
def _(spark, sf):
    return cleaning.project_present(fx.target_jobs(spark, sf), ["record_id", "no_such_column", "target_cost", "zone"])


@check("ftr_08_category_text", f"""WITH {fx.JOBS} SELECT record_id, CAST(district AS VARCHAR) AS district_cat FROM jobs""")
def _(spark, sf):
    return features.category_text(fx.jobs(spark, sf), "district", "district_cat").select("record_id", "district_cat")


@check("ftr_09_fill_missing", f"""WITH {fx.JOBS} SELECT record_id, coalesce(permit_number, '__MISSING__') AS permit_number,
 coalesce(adu, '') AS adu FROM jobs""")
def _(spark, sf):
    filled = cleaning.fill_text(cleaning.fill_categories(fx.jobs(spark, sf), ["permit_number"]), ["adu"])
    return filled.select("record_id", "permit_number", "adu")


@check("ftr_10_eligible_rows", f"""WITH {fx.TARGETS} SELECT record_id FROM targets WHERE target_cost BETWEEN 1000 AND 300000
 AND permit_creation_year >= 1997 AND target_source = 'revised_cost' AND proposed_stories IS NOT NULL""")
def _(spark, sf):
    return features.eligible_rows(
        fx.target_jobs(spark, sf), "target_cost", 1000, 300000, "permit_creation_year", 1997,
        ["proposed_stories"], "target_source", "revised_cost").select("record_id")


@check("ftr_11_amount_from_log10", f"""WITH {fx.JOBS} SELECT record_id, CASE WHEN revised_cost IS NOT NULL THEN
 round(CASE WHEN revised_cost < 50000 THEN 50000 WHEN revised_cost > 300000 THEN 300000 ELSE revised_cost END, 4)
 END AS amount FROM jobs""")
def _(spark, sf):
    back = ff.amount_from_log10(F.log10("revised_cost"), 50000.0, 300000.0)
    return fx.jobs(spark, sf).select("record_id", F.round(back, 4).alias("amount"))


@check("ftr_12_has_text", """SELECT doc_id, length(trim(text)) > 0 AS has_text FROM documents""")
def _(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", ff.has_text(F.col("text")).alias("has_text"))


@check("ftr_13_numeric_text", f"""WITH {fx.TERMS} SELECT term FROM terms WHERE NOT regexp_full_match(term, '[0-9]+')""")
def _(spark, sf):
    return fx.terms(spark, sf).filter(~ff.is_numeric_text(F.col("term"))).select("term")


@check("ftr_14_population", f"""SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
 WHERE CAST(left(o_orderpriority, 1) AS INTEGER) < 3 AND o_orderstatus = 'F'
 AND c_mktsegment IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD')""")
def _(spark, sf):
    o, c = fx.table(spark, sf, "orders"), fx.table(spark, sf, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).withColumn("permit_type", F.substring("o_orderpriority", 1, 1).cast("int"))
    return features.population(rows, "permit_type", "o_orderstatus", "c_mktsegment", "o_totalprice",
                               ["BUILDING", "FURNITURE", "HOUSEHOLD"], done="F").select("o_orderkey")


@check("ftr_15_days_between", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
 CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(spark, sf):
    li, o = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        ff.days_between(F.col("l_shipdate"), F.col("o_orderdate")).alias("days"))


@check("ftr_16_point_xy", f"WITH {fx.PLACES} SELECT place_id, x, -y AS y FROM places")
def _(spark, sf):
    text = fx.places(spark, sf).select("place_id", ff.point_text(F.col("x"), -F.col("y")).alias("p"))
    return text.select("place_id", ff.point_x(F.col("p")).alias("x"), ff.point_y(F.col("p")).alias("y"))


@check("ftr_17_interaction", f"WITH {fx.PLACES} SELECT place_id, x * y AS lat_lon FROM places")
def _(spark, sf):
    return fx.places(spark, sf).select("place_id", ff.interaction(F.col("x"), F.col("y")).alias("lat_lon"))


_STORY = """CASE phrase_id % 6 WHEN 0 THEN 2 WHEN 1 THEN 5 WHEN 2 THEN CAST(units AS INTEGER) WHEN 5 THEN 11 {extra} END"""


@check("ftr_18_story_count", f"""WITH {fx.PHRASES} SELECT phrase_id, {_STORY.format(extra='')} AS stories_in_text,
 {_STORY.format(extra='WHEN 3 THEN 4')} AS stories_legacy FROM phrases""")
def _(spark, sf):
    text = F.col("description")
    return fx.phrases(spark, sf).select("phrase_id", ff.story_count(text).alias("stories_in_text"),
                                        ff.story_count(text, legacy=True).alias("stories_legacy"))


_REPAIRED = f"""CASE WHEN (stories IS NULL OR stories < 1 OR stories > 15) AND contains(description, 'story')
 THEN CAST({_STORY.format(extra='')} AS DOUBLE) ELSE stories END"""


@check("ftr_19_repair_stories", f"WITH {fx.PHRASES} SELECT phrase_id, {_REPAIRED} AS stories FROM phrases")
def _(spark, sf):
    return features.repair_stories(fx.phrases(spark, sf), "stories", "description", "stories").select(
        "phrase_id", "stories")


_RANGE = """CASE WHEN units < 3 THEN '0-2 stories' WHEN units < 5 THEN '3-4 stories' WHEN units < 8 THEN '5-7 stories'
 WHEN units < 10 THEN '8-9 stories' ELSE 'More than 10 stories' END"""


@check("ftr_20_story_range", f"WITH {fx.PHRASES} SELECT phrase_id, {_RANGE} AS story_range FROM phrases")
def _(spark, sf):
    return fx.phrases(spark, sf).select("phrase_id", ff.story_range(F.col("units")).alias("story_range"))


@check("ftr_21_coarse_range", f"""WITH {fx.PHRASES} SELECT phrase_id, CASE WHEN units < 3 THEN '0-2 stories'
 WHEN units < 5 THEN '3-4 stories' ELSE '5 and more stories' END AS story_range FROM phrases""")
def _(spark, sf):
    return fx.phrases(spark, sf).select(
        "phrase_id", ff.coarse_story_range(ff.story_range(F.col("units"))).alias("story_range"))


@check("ftr_22_trim_outliers", f"""WITH {fx.JOBS} SELECT record_id FROM jobs
 WHERE revised_cost >= (SELECT quantile_cont(revised_cost, 0.01) FROM jobs)
 AND revised_cost <= (SELECT quantile_cont(revised_cost, 0.99) FROM jobs)
 AND proposed_units >= (SELECT quantile_cont(proposed_units, 0.01) FROM jobs)
 AND proposed_units <= (SELECT quantile_cont(proposed_units, 0.99) FROM jobs)
 AND proposed_stories <= 8""")
def _(spark, sf):
    return features.trim_outliers(fx.jobs(spark, sf), ["revised_cost", "proposed_units"],
                                  caps={"proposed_stories": 8}).select("record_id")


@check("ftr_23_fold_rare", f"""WITH {fx.JOBS}, n AS (SELECT zone, count(*) AS n FROM jobs GROUP BY zone)
 SELECT record_id, CASE WHEN n.n >= (SELECT avg(n) FROM n) THEN jobs.zone ELSE 'Other' END AS zone_
 FROM jobs LEFT JOIN n ON jobs.zone = n.zone""")
def _(spark, sf):
    rows = fx.jobs(spark, sf)
    # the smallest whole count that is at least the mean count
    mean = rows.groupBy("zone").count().agg(F.ceil(F.avg("count"))).first()[0]
    return features.fold_rare(rows, "zone", mean, "Other").select("record_id", "zone_")


@check("ftr_24_first_appearance_codes", f"""WITH {fx.JOBS}, firsts AS (SELECT adu, min(record_id) AS first FROM jobs WHERE adu IS NOT NULL GROUP BY adu),
 codes AS (SELECT adu, row_number() OVER (ORDER BY first) - 1 AS code FROM firsts)
 SELECT record_id, coalesce(code, -1) AS adu_code FROM jobs LEFT JOIN codes ON jobs.adu = codes.adu""")
def _(spark, sf):
    return features.first_appearance_codes(fx.jobs(spark, sf), "adu", "record_id").select("record_id", "adu_code")


@check("ftr_25_mean_imputed_box_cox", f"""WITH {fx.JOBS}, m AS (SELECT avg(proposed_units) AS u, avg(proposed_stories) AS s FROM jobs)
 SELECT record_id, round((pow(1 + coalesce(proposed_units, u), 0.1) - 1) / 0.1, 6) AS proposed_units_bct,
 round((pow(1 + coalesce(proposed_stories, s), 0.1) - 1) / 0.1, 6) AS proposed_stories_bct FROM jobs, m""")
def _(spark, sf):
    out = features.mean_imputed_box_cox(fx.jobs(spark, sf), ["proposed_units", "proposed_stories"])
    return out.select("record_id", F.round("proposed_units_bct", 6).alias("proposed_units_bct"),
                      F.round("proposed_stories_bct", 6).alias("proposed_stories_bct"))


@check("ftr_26_area_costs", f"""WITH {fx.PHRASES} SELECT phrase_id, area * stories AS total_area_m2,
 round(CASE WHEN area * stories <> 0 THEN price / (area * stories) END, 6) AS cost_per_m2,
 round(CASE WHEN area * stories <> 0 THEN price / (area * stories) / 10.764 END, 6) AS cost_per_ft2 FROM phrases""")
def _(spark, sf):
    out = features.area_costs(fx.phrases(spark, sf), "area", "stories", "price")
    return out.select("phrase_id", "total_area_m2", F.round("cost_per_m2", 6).alias("cost_per_m2"),
                      F.round(ff.per_square_foot(F.col("cost_per_m2")), 6).alias("cost_per_ft2"))


@check("ftr_27_uplift", f"""WITH {fx.JOBS} SELECT record_id, round(estimated_cost * 1.6204, 4) AS revised FROM jobs""")
def _(spark, sf):
    return fx.jobs(spark, sf).select("record_id", F.round(ff.uplift(F.col("estimated_cost")), 4).alias("revised"))


# ------------------------------------------------------------------- windows

@check("win_01_latest_version", f"""WITH {fx.VERSIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY version_key
 ORDER BY shipped DESC NULLS LAST, line DESC, part DESC, supplier DESC, price DESC) AS n FROM versions)
 SELECT version_key, shipped, line, part, supplier, price FROM r WHERE n = 1 OR version_key IS NULL""")
def _(spark, sf):
    return dedupe.latest_version(fx.versions(spark, sf), "version_key",
                                 ["shipped", "line", "part", "supplier", "price"])


@check("win_02_share_of_total", f"""WITH {fx.TARGETS}, c AS (SELECT split, zone, count(*) AS rows FROM targets GROUP BY split, zone)
 SELECT split, zone, rows, round(rows * 100.0 / sum(rows) OVER (PARTITION BY split), 6) AS share_percent FROM c""")
def _(spark, sf):
    counts = profile.group_count(fx.split_jobs(spark, sf), ["split", "zone"])
    shares = profile.share_of_total(counts, "rows", ["split"])
    return shares.withColumn("share_percent", F.round("share_percent", 6))


@check("win_03_top_k_per_group", """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_extendedprice, rank FROM (
 SELECT *, CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey)
  AS INTEGER) AS rank FROM lineitem) WHERE rank <= 5""")
def _(spark, sf):
    return ranking.top_k_per_group(
        fx.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", 5,
        ["l_orderkey", "l_linenumber", "l_partkey"]).select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "rank")


# ---------------------------------------------------------------------- sets

@check("set_01_split_and_reunite", f"""WITH {fx.VERSIONS} SELECT version_key, shipped, line, part, supplier,
 CASE WHEN version_key IS NULL THEN 'no key' ELSE 'keyed' END AS branch FROM versions""")
def _(spark, sf):
    rows = fx.versions(spark, sf).drop("price")
    keyed = rows.filter(F.col("version_key").isNotNull()).withColumn("branch", F.lit("keyed"))
    loose = rows.filter(F.col("version_key").isNull()).withColumn("branch", F.lit("no key"))
    return dedupe.concat_rows(keyed, loose)


@check("set_02_concat_rows", """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
 UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def _(spark, sf):
    customers = fx.table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    suppliers = fx.table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance")
    return dedupe.concat_rows(customers, suppliers)


@check("set_03_drop_duplicates", f"""WITH {fx.VERSIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY version_key, line
 ORDER BY shipped DESC, part DESC, supplier DESC, price DESC) AS n FROM versions)
 SELECT version_key, shipped, line, part, supplier, price FROM r WHERE n = 1 OR version_key IS NULL""")
def _(spark, sf):
    return dedupe.drop_duplicates(fx.versions(spark, sf), ["version_key", "line"], ["shipped", "part", "supplier", "price"])


# -------------------------------------------------------------------- splits

@check("spl_01_year_split", f"WITH {fx.TARGETS} SELECT record_id, split FROM targets")
def _(spark, sf):
    return fx.split_jobs(spark, sf).select("record_id", "split")


@check("spl_02_hash_split", """SELECT count(*) AS rows, count(*) AS labelled, true AS share_is_close FROM orders""")
def _(spark, sf):
    labelled = splits.hash_split(fx.table(spark, sf, "orders"), "o_orderkey", 80, seed=7)
    share = F.count_if(F.col("split") == "train") / F.count(F.lit(1))
    return labelled.agg(F.count(F.lit(1)).alias("rows"), F.count("split").alias("labelled"),
                        (F.abs(share - 0.8) < 0.05).alias("share_is_close"))


@check("spl_03_fold_column", """SELECT 5 AS folds, count(*) AS rows FROM orders""")
def _(spark, sf):
    folded = splits.fold_column(fx.table(spark, sf, "orders"), "o_orderkey", 5, seed=7)
    sizes = folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count_if(F.col("fold").between(0, 4)).cast("int").alias("folds"), F.sum("n").alias("rows"))
