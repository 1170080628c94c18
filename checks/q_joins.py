"""Joins (JON)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from costlake.functions import geometry as g
from costlake.operators import joins, metrics, spatial

# Yearly mean order price plays the price index; years are the rows, so it is small by nature.
_INDEX = "price_index AS (SELECT permit_creation_year AS year, round(avg(revised_cost), 2) AS index FROM jobs GROUP BY 1)"


@check("jon_01_inflation_adjust", f"""WITH {fx.JOBS}, {_INDEX} SELECT record_id,
 round(estimated_cost * (SELECT index FROM price_index WHERE year = 2001) / index, 4) AS adjusted
 FROM jobs LEFT JOIN price_index ON year = permit_creation_year""")
def _(spark, sf):
    rows = fx.jobs(spark, sf)
    index = rows.groupBy(F.col("permit_creation_year").alias("year")).agg(
        F.round(F.avg("revised_cost"), 2).alias("index"))
    out = joins.inflation_adjust(rows, index, "estimated_cost", "permit_creation_year", 2001, "adjusted")
    return out.select("record_id", F.round("adjusted", 4).alias("adjusted"))


# The gazetteer knows a third of the places by full address and a third by the short one.
_ADDRESS = "number || ' ' || street || coalesce(' ' || suffix, '') || ' #' || place_id"
_SHORT = "number || ' ' || street || ' #' || place_id"
_GEOCODED = f"""geocoded AS (SELECT place_id, CASE WHEN place_id % 3 = 0 OR (place_id % 3 = 1) THEN x END AS x,
 CASE WHEN place_id % 3 = 0 OR (place_id % 3 = 1) THEN y END AS y FROM places)"""


def _geocoded(spark, sf):
    full, short = F.expr(_ADDRESS), F.expr(_SHORT)
    rows = fx.places(spark, sf).select("place_id", "x", "y", full.alias("full"), short.alias("short"))
    known = F.when(F.col("place_id") % 3 == 0, F.col("full")).when(F.col("place_id") % 3 == 1, F.col("short"))
    gazetteer = rows.select(known.alias("address"), "x", "y").filter(F.col("address").isNotNull())
    return joins.geocode(rows.drop("x", "y"), gazetteer, "full", "short").select("place_id", "x", "y")


@check("jon_02_geocode", f"WITH {fx.PLACES}, {_GEOCODED} SELECT place_id, x, y FROM geocoded")
def _(spark, sf):
    return _geocoded(spark, sf)


@check("jon_03_with_and_without_coordinates", f"""WITH {fx.PLACES}, {_GEOCODED}
 SELECT place_id, 'located' AS kind FROM geocoded WHERE x IS NOT NULL UNION ALL
 SELECT place_id, 'missing' FROM geocoded WHERE x IS NULL""")
def _(spark, sf):
    rows = _geocoded(spark, sf)
    located = joins.with_coordinates(rows).select("place_id", F.lit("located").alias("kind"))
    missing = joins.without_coordinates(rows).select("place_id", F.lit("missing").alias("kind"))
    return located.unionByName(missing)


@check("jon_03_semi_and_anti", """SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS has_lines
 FROM orders""")
def _(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey")
    lines = fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    kept = joins.keep_matching(orders, lines, ["o_orderkey"]).withColumn("has_lines", F.lit(True))
    left = joins.keep_unmatched(orders, lines, ["o_orderkey"]).withColumn("has_lines", F.lit(False))
    return kept.unionByName(left)


@check("jon_04_match_polygons", f"""WITH {fx.POINTS} SELECT point_id, min(polygon_id) AS polygon_id
 FROM points LEFT JOIN cells ON x >= x0 AND x < x0 + side AND y >= y0 AND y < y0 + side GROUP BY point_id""")
def _(spark, sf):
    return spatial.match_polygons(fx.points(spark, sf), fx.cells(spark, sf),
                                  cell_size=1.0).select("point_id", "polygon_id")


@check("jon_04_match_polygons_shuffled", f"""WITH {fx.POINTS} SELECT point_id, min(polygon_id) AS polygon_id
 FROM points LEFT JOIN cells ON x >= x0 AND x < x0 + side AND y >= y0 AND y < y0 + side GROUP BY point_id""")
def _(spark, sf):
    # the way taken when the polygons are too many to broadcast
    return spatial.match_polygons(fx.points(spark, sf), fx.cells(spark, sf), cell_size=1.0,
                                  max_vertices=0).select("point_id", "polygon_id")


@check("jon_04_match_polygons_any_ids", f"""WITH {fx.POINTS}, matched AS (SELECT point_id, min(polygon_id) AS polygon_id
 FROM points LEFT JOIN cells ON x >= x0 AND x < x0 + side AND y >= y0 AND y < y0 + side GROUP BY point_id)
 SELECT nullif(point_id % 3, 0) AS id, polygon_id, count(*) AS points FROM matched GROUP BY 1, 2""")
def _(spark, sf):
    # ids that repeat or are NULL
    points = fx.points(spark, sf).withColumn("point_id", F.nullif(F.col("point_id") % 3, F.lit(0)))
    found = spatial.match_polygons(points, fx.cells(spark, sf), cell_size=1.0)
    return found.groupBy(F.col("point_id").alias("id"), "polygon_id").agg(F.count(F.lit(1)).alias("points"))


@check("jon_04_match_footprints", f"""WITH {fx.FOOTPRINTS} SELECT site_id, polygon_id,
 CASE WHEN polygon_id IS NOT NULL THEN 0.64E0 END AS area FROM sites LEFT JOIN footprints
 ON x0 = CAST(floor(x) AS BIGINT) AND y0 = CAST(floor(y) AS BIGINT) AND x < x0 + 0.8 AND y < y0 + 0.8""")
def _(spark, sf):
    shapes = fx.footprints(spark, sf).withColumn("area", F.round(g.polygon_area(F.col("rings")), 9))
    found = spatial.match_polygons(fx.sites(spark, sf), shapes, cell_size=1.0, carry=["area"])
    return found.select("site_id", "polygon_id", "area")


@check("jon_05_near_point", f"""WITH {fx.POINTS} SELECT point_id FROM points
 WHERE abs(x - 4.0) < 1.2 AND abs(y - 5.0) < 1.0""")
def _(spark, sf):
    return spatial.near_point(fx.points(spark, sf), "x", "y", 4.0, 5.0, 0.3, 0.2).select("point_id")


@check("jon_05_nearby_summary", f"""WITH {fx.POINTS} SELECT a.point_id, count(*) AS nearby,
 round(avg(b.balance), 7) AS nearby_mean FROM points a JOIN points b
 ON abs(a.x - b.x) < 0.3 AND abs(a.y - b.y) < 0.2 GROUP BY a.point_id""")
def _(spark, sf):
    pts = fx.points(spark, sf)
    out = spatial.nearby_summary(pts.drop("balance"), pts, "x", "y", "balance", 0.3, 0.2)
    return out.select("point_id", "nearby", F.round("nearby_mean", 7).alias("nearby_mean"))


@check("jon_06_attach_by_key", """SELECT o_orderkey, o_totalprice, lines FROM orders LEFT JOIN
 (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""")
def _(spark, sf):
    lines = (fx.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
             .agg(F.count(F.lit(1)).alias("lines")))
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return joins.attach_by_key(orders, lines, ["o_orderkey"])


@check("jon_07_attach_totals", """SELECT o_orderkey, o_totalprice - (SELECT min(o_totalprice) FROM orders) AS above_min,
 (SELECT count(*) FROM orders) AS rows FROM orders""")
def _(spark, sf):
    orders = fx.table(spark, sf, "orders")
    totals = orders.agg(F.min("o_totalprice").alias("low"), F.count(F.lit(1)).alias("rows"))
    return joins.attach_totals(orders, totals).select(
        "o_orderkey", (F.col("o_totalprice") - F.col("low")).alias("above_min"), "rows")


_ABLATION = f"""WITH {fx.METRIC_ROWS} SELECT a.split, round(a.rmse, 4) AS structured_rmse,
 round(b.rmse, 4) AS text_structured_rmse, round((a.rmse - b.rmse) / a.rmse * 100, 6) AS rmse_reduction_percent,
 round(a.r2, 6) AS structured_r2, round(b.r2, 6) AS text_structured_r2, round(a.log_r2, 6) AS structured_log_r2,
 round(b.log_r2, 6) AS text_structured_log_r2
 FROM metric_rows a JOIN metric_rows b ON a.split = b.split
 WHERE a.model = 'structured' AND b.model = 'structured_text'"""


def _ablation(spark, sf):
    wide = metrics.ablation(fx.metric_rows(spark, sf), "structured", "structured_text")
    return wide.select("split", *[F.round(c, 4 if c.endswith("_rmse") else 6).alias(c)
                                  for c in wide.columns if c != "split"])


@check("jon_08_metric_pairs", _ABLATION)
def _(spark, sf):
    return _ablation(spark, sf)


@check("xai_03_text_ablation", _ABLATION.replace("SELECT a.split", "SELECT a.split, a.rows", 1))
def _(spark, sf):
    rows = fx.metric_rows(spark, sf)
    sizes = rows.filter(F.col("model") == "structured").select("split", "rows")
    return joins.attach_by_key(_ablation(spark, sf), sizes, ["split"])
