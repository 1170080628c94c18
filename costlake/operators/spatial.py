"""Point-in-polygon and nearby search as grid equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.functions import geometry as g
from costlake.session import settle

# Polygons with at most this many vertices in all (about 16 bytes each) may be broadcast.
BROADCAST_VERTICES = 2_000_000

# No grid cell is smaller than ``cell_size / 2**20``.
FINEST_LEVEL = -20


def _polygon_cells(polygons: DataFrame, rings: str, cell_size: float) -> DataFrame:
    """One row per polygon and grid cell its bounding box touches.

    A polygon uses the level (cell side ``cell_size * 2**level``, finer ones negative) whose
    cells are just as wide as its box, so it touches at most four cells however large it is,
    and a cell holds few polygons however small they are.
    """
    box = g.ring_bounds(F.get(F.col(rings), F.lit(0)))
    boxed = polygons.withColumns({f"__{n}": c for n, c in box.items()})
    side = F.greatest(F.col("__max_x") - F.col("__min_x"), F.col("__max_y") - F.col("__min_y"))
    level = F.ceil(F.log2(side / F.lit(float(cell_size)))).cast("int")
    leveled = boxed.withColumn("__level", F.greatest(F.lit(FINEST_LEVEL), level))
    step = _step(F.col("__level"), cell_size)

    def span(low: str, high: str) -> Column:
        return F.sequence(F.floor(F.col(low) / step), F.floor(F.col(high) / step))

    return (leveled.withColumn("__cx", F.explode(span("__min_x", "__max_x")))
            .withColumn("__cy", F.explode(span("__min_y", "__max_y")))
            .drop("__min_x", "__max_x", "__min_y", "__max_y"))


def _step(level: Column, cell_size: float) -> Column:
    return F.lit(float(cell_size)) * F.pow(F.lit(2.0), level)


def match_polygons(points: DataFrame, polygons: DataFrame, x: str = "x", y: str = "y",
                   polygon_id: str = "polygon_id", rings: str = "rings", cell_size: float = 0.001,
                   carry: list[str] | None = None, max_vertices: int = BROADCAST_VERTICES) -> DataFrame:
    """Attach to each point the first polygon (lowest id) that contains it, else NULL.

    Distinct places meet polygons on grid cells, so a crowded spot is one row and points need no
    id. A small polygon table is broadcast; a large one is shuffled, and adaptive execution splits
    cells with many places. ``carry`` names polygon columns (an area, say) to bring along. Points
    without coordinates match nothing.
    """
    carry = list(carry or [])
    cells = settle(_polygon_cells(polygons.select(polygon_id, rings, *carry), rings, cell_size))
    # distinct levels: at most the number of doublings between two doubles
    levels = sorted(r[0] for r in cells.select("__level").distinct().collect())
    vertices = F.aggregate(F.transform(rings, lambda r: F.size(r)), F.lit(0), lambda a, n: a + n)
    total = cells.agg(F.sum(vertices)).first()[0] or 0
    keys = ["__level", "__cx", "__cy"]

    probe = points.select(F.col(x).alias("__x"), F.col(y).alias("__y")).dropna().distinct()
    probe = probe.withColumn("__level", F.explode(F.array(*[F.lit(v) for v in levels])
                                                  if levels else F.array().cast("array<int>")))
    step = _step(F.col("__level"), cell_size)
    probe = probe.withColumns({"__cx": F.floor(F.col("__x") / step), "__cy": F.floor(F.col("__y") / step)})
    if total <= max_vertices:
        cells = F.broadcast(cells)
    inside = g.polygon_contains(F.col(rings), F.col("__x"), F.col("__y"))
    hits = probe.join(cells, keys).filter(inside).groupBy(F.col("__x").alias(x), F.col("__y").alias(y))
    first = hits.agg(F.min(F.struct(polygon_id, *carry)).alias("__hit"))
    matched = points.join(first, [x, y], "left").select(*points.columns, "__hit")
    return matched.withColumns({c: F.col("__hit")[c] for c in [polygon_id, *carry]}).drop("__hit")


def near_point(df: DataFrame, x: str, y: str, x0: float, y0: float, share_x: float = 0.0003,
               share_y: float = 0.0005) -> DataFrame:
    """Rows strictly inside a box around one point, its half-sides a share of the coordinates."""
    return df.filter((F.abs(F.col(x) - x0) < abs(x0) * share_x)
                     & (F.abs(F.col(y) - y0) < abs(y0) * share_y))


def nearby_summary(probes: DataFrame, points: DataFrame, x: str, y: str, value: str, half_x: float,
                   half_y: float) -> DataFrame:
    """For every probe, how many points lie strictly inside its box and their mean value.

    Points are first summed per location and probes reduced to distinct locations, so a
    crowded spot is one row on either side; each location then meets only its own and the
    eight neighbouring cells.
    """
    # a little wider than the box, so rounding cannot put a close pair two cells apart
    cell_x, cell_y = half_x * 1.001, half_y * 1.001
    spots = (points.filter(F.col(value).isNotNull()).groupBy(F.col(x).alias("__px"), F.col(y).alias("__py"))
             .agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__total")))
    spots = spots.withColumns({"__cx": g.grid_cell(F.col("__px"), cell_x),
                               "__cy": g.grid_cell(F.col("__py"), cell_y)})
    around = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    places = (probes.select(x, y).distinct()
              .withColumn("__cx", F.explode(F.transform(around, lambda d: g.grid_cell(F.col(x), cell_x) + d)))
              .withColumn("__cy", F.explode(F.transform(around, lambda d: g.grid_cell(F.col(y), cell_y) + d))))
    close = (F.abs(F.col("__px") - F.col(x)) < half_x) & (F.abs(F.col("__py") - F.col(y)) < half_y)
    found = (places.join(spots, ["__cx", "__cy"]).filter(close).groupBy(x, y)
             .agg(F.sum("__n").alias("nearby"), F.sum("__total").alias("__total")))
    joined = probes.join(found, [x, y], "left")
    return joined.withColumns({"nearby": F.coalesce("nearby", F.lit(0)),
                               "nearby_mean": F.try_divide("__total", F.col("nearby"))}).drop("__total")
