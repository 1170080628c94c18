"""Planar geometry (GEO)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from costlake.functions import geometry as g

_K = g.conic_constants(g.CALIFORNIA_ZONE_3_FEET)
_GRID = g.CALIFORNIA_ZONE_3_FEET


def _project_sql(lon: str, lat: str) -> tuple[str, str]:
    """The conic projection as two SQL expressions."""
    es = f"({_K['e']!r} * sin(radians({lat})))"
    t = f"(tan(pi() / 4 - radians({lat}) / 2) / pow((1 - {es}) / (1 + {es}), {_K['e'] / 2!r}))"
    rho = f"({_K['scale']!r} * pow({t}, {_K['n']!r}))"
    theta = f"({_K['n']!r} * radians({lon} - ({_GRID.origin_lon!r})))"
    return (f"(({rho} * sin({theta}) + {_GRID.false_east_m!r}) / {_GRID.metres_per_unit!r})",
            f"(({_K['rho0']!r} - {rho} * cos({theta}) + {_GRID.false_north_m!r}) / {_GRID.metres_per_unit!r})")


_LON, _LAT = "(-122.5 + x / 100)", "(37.7 + y / 100)"
_PX, _PY = _project_sql(_LON, _LAT)


@check("geo_01_project_point", f"WITH {fx.POINTS} SELECT point_id, round({_PX}, 4) AS east, round({_PY}, 4) AS north FROM points")
def _(spark, sf):
    p = g.project_point(F.lit(-122.5) + F.col("x") / 100, F.lit(37.7) + F.col("y") / 100)
    return fx.points(spark, sf).select("point_id", F.round(p["x"], 4).alias("east"), F.round(p["y"], 4).alias("north"))


@check("geo_02_polygon_area", f"""WITH {fx.POINTS} SELECT polygon_id, CAST(side * side AS DOUBLE) AS area,
 round(CAST(side * side AS DOUBLE) * 0.09290304, 8) AS area_m2 FROM cells""")
def _(spark, sf):
    area = g.polygon_area(F.col("rings"))
    return fx.cells(spark, sf).select("polygon_id", area.alias("area"),
                                      F.round(area * g.SQUARE_METRES_PER_SQUARE_FOOT, 8).alias("area_m2"))


_CORNERS = [("p.x", "p.y"), ("p.x + 0.1", "p.y"), ("p.x + 0.1", "p.y + 0.2"), ("p.x", "p.y + 0.2")]
_SHAPE = ", ".join(f"{e} AS {axis}{i}" for i, (cx, cy) in enumerate(_CORNERS)
                   for axis, e in zip("ab", _project_sql(f"(-122.5 + ({cx}) / 100)", f"(37.7 + ({cy}) / 100)")))


@check("geo_02_footprint_area_m2", f"""WITH {fx.POINTS}, s AS (SELECT point_id, {_SHAPE} FROM points p)
 SELECT point_id, round(abs((a2 - a0) * (b3 - b1) - (a3 - a1) * (b2 - b0)) / 2 * 0.09290304, 2) AS area_m2 FROM s""")
def _(spark, sf):
    lon, lat = F.lit(-122.5) + F.col("x") / 100, F.lit(37.7) + F.col("y") / 100
    far_lon, far_lat = F.lit(-122.5) + (F.col("x") + 0.1) / 100, F.lit(37.7) + (F.col("y") + 0.2) / 100
    ring = g.box_ring(lon, lat, far_lon, far_lat)
    return fx.points(spark, sf).select("point_id", F.round(g.footprint_area_m2(ring), 2).alias("area_m2"))


@check("geo_03_contains", f"""WITH {fx.POINTS} SELECT point_id, x >= x0 AND x < x0 + side AND y >= y0 AND y < y0 + side AS inside
 FROM points JOIN customer ON point_id = c_custkey JOIN cells ON polygon_id = c_nationkey""")
def _(spark, sf):
    home = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("point_id"),
                                                  F.col("c_nationkey").cast("bigint").alias("polygon_id"))
    pairs = fx.points(spark, sf).join(home, "point_id").join(fx.cells(spark, sf), "polygon_id")
    return pairs.select("point_id", g.polygon_contains(F.col("rings"), F.col("x"), F.col("y")).alias("inside"))
