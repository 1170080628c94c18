import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from costlake.functions import geometry as g
from costlake.operators import explain, models, spatial
from costlake.sources import geo, tables


def _polygon(cx, cy, radius, corners, rng):
    angles = sorted(rng.uniform(0, 2 * np.pi) for _ in range(corners))
    ring = [(cx + radius * float(np.cos(a)), cy + radius * float(np.sin(a))) for a in angles]
    return ring + ring[:1]


def _inside(ring, x, y):
    hit = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        if (ay > y) != (by > y) and x < ax + (bx - ax) * (y - ay) / (by - ay):
            hit = not hit
    return hit


def test_grid_match_equals_brute_force_with_a_crowded_cell(spark):
    rng = random.Random(5)
    # sizes over three orders of magnitude, so several grid levels are used; one polygon has a hole
    polygons = [[_polygon(rng.uniform(0, 20), rng.uniform(0, 20), 10 ** rng.uniform(-1.5, 1.2), rng.randint(3, 9), rng)]
                for _ in range(60)]
    polygons[0] = [[(0, 0), (20, 0), (20, 20), (0, 20), (0, 0)], [(5, 5), (15, 5), (15, 15), (5, 15), (5, 5)]]
    points = [(i, rng.uniform(-1, 21), rng.uniform(-1, 21)) for i in range(300)]
    points += [(1000 + i, 10.0 + rng.uniform(0, 0.01), 10.0 + rng.uniform(0, 0.01)) for i in range(150)]
    want = {}
    for i, x, y in points:
        hits = [k for k, rings in enumerate(polygons) if _inside(rings[0], x, y) and not any(_inside(h, x, y) for h in rings[1:])]
        want[i] = min(hits) if hits else None
    pts = spark.createDataFrame(points, "id int, x double, y double")
    table = spark.createDataFrame([(k, [[(float(a), float(b)) for a, b in ring] for ring in rings]) for k, rings in enumerate(polygons)],
                                  f"polygon_id int, rings array<{g.RING_TYPE}>")
    for vertices in (10**6, 0):
        out = spatial.match_polygons(pts, table, cell_size=0.1, max_vertices=vertices)
        assert {r["id"]: r["polygon_id"] for r in out.collect()} == want


def test_areas_and_projection(spark):
    square = g.box_ring(F.lit(0), F.lit(0), F.lit(4), F.lit(4))
    hole = g.box_ring(F.lit(1), F.lit(1), F.lit(2), F.lit(3))
    origin = g.project_point(F.lit(-120.5), F.lit(36.5))
    row = spark.range(1).select(g.ring_area(square), g.polygon_area(F.array(square, hole)), origin["x"], origin["y"]).first()
    assert row[0] == 16.0 and row[1] == 14.0
    # at its origin the grid reads its false easting and northing, in US survey feet
    assert row[2] == pytest.approx(6561666.667, abs=1e-3) and row[3] == pytest.approx(1640416.667, abs=1e-3)


def test_nearby_summary_counts_crowded_spots_once(spark):
    pts = spark.createDataFrame([(1.0, 1.0, 10.0)] * 500 + [(1.05, 1.0, 20.0), (1.2, 1.0, 99.0)], "x double, y double, v double")
    probes = spark.createDataFrame([(1, 1.0, 1.0), (2, 1.0, 1.0), (3, 9.0, 9.0)], "id int, x double, y double")
    got = {r["id"]: (r["nearby"], r["nearby_mean"]) for r in spatial.nearby_summary(probes, pts, "x", "y", "v", 0.1, 0.1).collect()}
    assert got == {1: (501, pytest.approx((5000 + 20) / 501)), 2: (501, pytest.approx((5000 + 20) / 501)), 3: (0, None)}


def test_quadratic_ridge_equals_the_kernel_solution(spark):
    rng = np.random.default_rng(3)
    x, alpha, gamma, c = rng.normal(size=(60, 3)), 0.5, 0.05, 1.0
    y = x[:, 0] ** 2 - x[:, 1] * x[:, 2] + 0.1 * rng.normal(size=60)
    kernel = (gamma * x @ x.T + c) ** 2
    want = kernel @ np.linalg.solve(kernel + alpha * np.eye(60), y)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "id int, a double, b double, c double, label double")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    fitted = models.fit_quadratic_ridge(df, "features", 3, alpha=alpha, gamma=gamma, coef0=c)
    scored = fitted.transform(models.quadratic_features(df, "features", 3, gamma, c)).orderBy("id").collect()
    assert np.allclose([r["prediction"] for r in scored], want, atol=1e-8)


def test_guards(spark, tmp_path):
    with pytest.raises(ValueError, match="2 terms but 1"):
        explain.checked_pairs(["a", "b"], [1.0])
    empty = spark.range(0)
    with pytest.raises(tables.VerificationError):
        tables.write_verified(empty, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="year"):
        from pyspark.sql.types import IntegerType, StructField, StructType

        models.conform(empty, StructType([StructField("year", IntegerType(), False)]))


def test_only_simple_polygons_are_read(spark, tmp_path):
    path = tmp_path / "f.jsonl"
    path.write_text('{"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]},"properties":{"id":"a"}}\n'
                    '{"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]]]},"properties":{"id":"b"}}\n'
                    '{"geometry":{"type":"Point","coordinates":[0,0]},"properties":{"id":"c"}}\n')
    out = geo.simple_polygons(geo.read_feature_lines(spark, str(path)), "id").collect()
    assert [(r["polygon_id"], len(r["rings"][0])) for r in out] == [("a", 4)]
