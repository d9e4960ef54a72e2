"""Points in features with holes and parts against ray casting over all rings, for several sizes of cells."""

import math
import random

import pytest

from rollcall.operators import cover


def holds(rings, x, y):
    odd = False
    for ring in rings:
        if len(ring) < 3:
            continue
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def star(rng, x, y, size, corners):
    return [(x + size * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / corners), y + size * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / corners)) for k in range(corners)]


@pytest.mark.parametrize("cell", [0.4, 1.0, 7.0, 50.0])
def test_features_of_many_rings(spark, cell):
    rng = random.Random(int(cell * 10))
    shapes = []
    for i in range(12):
        x, y = rng.uniform(-15, 15), rng.uniform(-15, 15)
        rings = [star(rng, x, y, 6, 14), star(rng, x, y, 1.8, 9), star(rng, x + 14, y - 3, 3, 7), [(x, y), (x + 1, y)]]
        rings[0] += rings[0][:1] if i % 2 else []  # closed or not
        shapes.append((i, rings))
    shapes.append((99, [[(float(a), float(b)) for a, b in ((-3, -3), (3, -3), (3, 3), (-3, 3))], [(float(a), float(b)) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1))]]))  # on the cells' own lines
    points = [(k, rng.uniform(-25, 35), rng.uniform(-25, 25)) for k in range(1500)] + [(5000 + k, rng.randint(-30, 30) / 10 + 0.05, rng.randint(-30, 30) / 10 + 0.05) for k in range(300)] + [(9000, None, 1.0)]
    df = spark.createDataFrame([(i, [[{"x": a, "y": b} for a, b in r] for r in rs]) for i, rs in shapes], "pid long, rings array<array<struct<x: double, y: double>>>")
    at = spark.createDataFrame([(k, x, y, "kept") for k, x, y in points], "id long, lon double, lat double, edges string")
    out = cover.in_polygon(at, df, "pid", ring="rings", cell=cell)
    assert out.columns == ["id", "lon", "lat", "edges", "pid"]
    got = {(r["id"], r["pid"]) for r in out.collect()}
    want = {(k, i) for k, x, y in points if x is not None for i, rs in shapes if holds(rs, x, y)}
    assert got == want and len(want) > 300


def test_only_border_cells_keep_edges(spark):
    df = spark.createDataFrame([(1, [{"x": 0.2, "y": 0.2}, {"x": 20.7, "y": 0.2}, {"x": 20.7, "y": 20.7}, {"x": 0.2, "y": 20.7}])], "pid long, ring array<struct<x: double, y: double>>")
    cells = cover.cell_cover(df, "pid", cell=1.0).collect()
    assert len(cells) == len({(r["cx"], r["cy"]) for r in cells}) == 21 * 21
    assert sum(r["edges"] is None for r in cells) == 19 * 19 and max(len(r["edges"]) for r in cells if r["edges"]) == 2


def test_points_on_edges(spark):
    df = spark.createDataFrame([(1, [{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 4.0}, {"x": 0.0, "y": 4.0}])], "pid long, ring array<struct<x: double, y: double>>")
    at = spark.createDataFrame([(1, 2.0, 0.0), (2, 4.0, 4.0), (3, 2.0, 2.0), (4, 4.5, 4.0)], "id long, lon double, lat double")
    for edges, want in ((False, {3}), (True, {1, 2, 3})):
        assert {r["id"] for r in cover.in_polygon(at, df, "pid", edges=edges).collect()} == want
    assert cover.in_polygon(at, df.limit(0), "pid").count() == 0
