"""Planar geometry on ring columns (``array<struct<x double, y double>>``).

A ring is closed: its last vertex repeats the first.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

RING_TYPE = "array<struct<x:double,y:double>>"

# Fixed value: square metres in one (international) square foot.
SQUARE_METRES_PER_SQUARE_FOOT = 0.09290304


@dataclass(frozen=True)
class ConicGrid:
    """Lambert conformal conic grid with two standard parallels, angles in degrees."""

    semi_major_m: float
    inverse_flattening: float
    origin_lat: float
    origin_lon: float
    parallel_1: float
    parallel_2: float
    false_east_m: float
    false_north_m: float
    metres_per_unit: float


# EPSG:2227 (NAD83 / California zone 3, US survey feet), from the EPSG registry.
CALIFORNIA_ZONE_3_FEET = ConicGrid(
    semi_major_m=6378137.0,
    inverse_flattening=298.257222101,
    origin_lat=36.5,
    origin_lon=-120.5,
    parallel_1=38.0 + 26.0 / 60.0,
    parallel_2=37.0 + 4.0 / 60.0,
    false_east_m=2000000.0001016,
    false_north_m=500000.0001016001,
    metres_per_unit=1200.0 / 3937.0,
)


def conic_constants(grid: ConicGrid) -> dict[str, float]:
    """The constants of the forward projection (Snyder 1987, eq. 14-15, 15-7 to 15-10)."""
    f = 1.0 / grid.inverse_flattening
    e = math.sqrt(f * (2.0 - f))

    def m(lat):
        return math.cos(lat) / math.sqrt(1.0 - (e * math.sin(lat)) ** 2)

    def t(lat):
        es = e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - es) / (1 + es)) ** (e / 2)

    p1, p2, p0 = (math.radians(v) for v in (grid.parallel_1, grid.parallel_2, grid.origin_lat))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    scale = grid.semi_major_m * m(p1) / (n * t(p1) ** n)
    return {"e": e, "n": n, "scale": scale, "rho0": scale * t(p0) ** n}


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body mentions it."""
    return F.transform(F.array(value), body)[0]


def project_point(lon: Column, lat: Column, grid: ConicGrid = CALIFORNIA_ZONE_3_FEET) -> Column:
    """Planar ``struct<x, y>`` of a longitude / latitude pair in degrees."""
    k = conic_constants(grid)
    phi = F.radians(lat)
    es = F.lit(k["e"]) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(k["e"] / 2))
    polar = F.struct((F.lit(k["scale"]) * F.pow(t, F.lit(k["n"]))).alias("rho"),
                     (F.lit(k["n"]) * F.radians(lon - F.lit(grid.origin_lon))).alias("theta"))
    unit = F.lit(grid.metres_per_unit)
    return _let(polar, lambda p: F.struct(
        ((p["rho"] * F.sin(p["theta"]) + F.lit(grid.false_east_m)) / unit).alias("x"),
        ((F.lit(k["rho0"]) - p["rho"] * F.cos(p["theta"]) + F.lit(grid.false_north_m)) / unit).alias("y")))


def project_ring(ring: Column, grid: ConicGrid = CALIFORNIA_ZONE_3_FEET) -> Column:
    return F.transform(ring, lambda v: project_point(v["x"], v["y"], grid))


def ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs as ``array<struct<a, b>>``."""
    last = F.size(ring) - 1
    return F.zip_with(F.slice(ring, 1, last), F.slice(ring, 2, last),
                      lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def ring_area(ring: Column) -> Column:
    """Unsigned area by the shoelace sum, relative to the first vertex for precision."""

    def shoelace(r: Column) -> Column:
        def cross(total, edge):
            ax, ay = edge["a"]["x"] - r[0]["x"], edge["a"]["y"] - r[0]["y"]
            bx, by = edge["b"]["x"] - r[0]["x"], edge["b"]["y"] - r[0]["y"]
            return total + (ax * by - bx * ay)

        return F.abs(F.aggregate(ring_edges(r), F.lit(0.0), cross)) / 2

    return _let(ring, shoelace)


def footprint_area_m2(ring: Column, grid: ConicGrid = CALIFORNIA_ZONE_3_FEET) -> Column:
    """Area in m2 of a longitude / latitude ring measured on the foot grid."""
    return ring_area(project_ring(ring, grid)) * F.lit(SQUARE_METRES_PER_SQUARE_FOOT)


def ring_contains(ring: Column, x: Column, y: Column) -> Column:
    """Ray casting. Low edges are inside and high edges outside (half-open)."""

    def crosses(edge):
        a, b = edge["a"], edge["b"]
        straddles = (a["y"] > y) != (b["y"] > y)
        # a["y"] != b["y"] whenever the edge straddles, so the divisor is never zero there
        at_x = a["x"] + F.try_divide((b["x"] - a["x"]) * (y - a["y"]), b["y"] - a["y"])
        return straddles & (x < at_x)

    hits = F.filter(ring_edges(ring), crosses)
    return F.pmod(F.size(hits), F.lit(2)) == 1


def ring_bounds(ring: Column) -> dict[str, Column]:
    xs = F.transform(ring, lambda v: v["x"])
    ys = F.transform(ring, lambda v: v["y"])
    return {"min_x": F.array_min(xs), "max_x": F.array_max(xs),
            "min_y": F.array_min(ys), "max_y": F.array_max(ys)}


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Closed ring of an axis-aligned box."""
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
                     for x, y in corners])


def grid_cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(float(size))).cast("bigint")


# A polygon with holes is an array of rings, outer ring first.


def polygon_contains(rings: Column, x: Column, y: Column) -> Column:
    """Inside the outer ring and outside every hole."""
    holes = F.filter(F.slice(rings, 2, F.size(rings)), lambda hole: ring_contains(hole, x, y))
    return ring_contains(rings[0], x, y) & (F.size(holes) == 0)


def polygon_area(rings: Column) -> Column:
    areas = F.transform(rings, ring_area)
    return F.aggregate(F.slice(areas, 2, F.size(areas)), areas[0], lambda total, hole: total - hole)


def polygon_area_m2(rings: Column, grid: ConicGrid = CALIFORNIA_ZONE_3_FEET) -> Column:
    projected = F.transform(rings, lambda ring: project_ring(ring, grid))
    return polygon_area(projected) * F.lit(SQUARE_METRES_PER_SQUARE_FOOT)
