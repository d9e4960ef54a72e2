"""Hard cases of names, directories, e-mail domains, raster tiles, simplified lines and moved children."""

import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.functions import directories, geo
from rollcall.operators import checks, linkage, raster


def test_abbreviations_and_places(spark):
    places = directories.saint_places(spark.createDataFrame([("St. Louis city",), ("East St. Paul",), ("Gary",), (None,)], "place string"), "place")
    assert {r["word"] for r in places.collect()} == {"LOUIS", "PAUL"}
    cases = {
        "The St. Mary Church of St. Louis": "SAINT Mary Church of St. Louis", "ST. PAUL & St. PAULA": "ST. PAUL AND SAINT PAULA", "Mt. Zion AMEZ": "MOUNT Zion A.M.E. ZION", "MT Zion ame": "MOUNT Zion A.M.E.",
        "St Mark at Ft. Hope": "SAINT Mark at FORT Hope", "N. Oak A.M.E. Hall": "NORTH Oak A.M.E. Hall", "First — Hope": "First - Hope", "THE  Ark": "Ark", "West. Hall": "West. Hall", "": "", "Best. Mary": "Best. Mary", "St.": "St.", "A M E": "A.M.E.",
    }
    df = spark.createDataFrame([*enumerate(cases), (99, None)], "id long, name string")
    got = {r["name"]: r["out"] for r in directories.spelled_out(df, "id", "name", places, "out").collect()}
    assert got == {**cases, None: None}
    assert directories.spelled_out(df.limit(0), "id", "name", places, "out").count() == 0


def test_directory_entries(spark):
    text = "Churches\n\nOld 1 Elm St\n\nCHURCHES AND SYNAGOGUES\n\nFirst Baptist Church, 12 N Main St. (AB) Elder Jones Tel 5\n\n\n  CALVARY TEMPLE OF HOPE\n34\n56 Oak Rd\nCHURCHES CONTD\n\nGrace Plumbing 7 Elm St\n\nshort\n\nHall of nobody 9 Elm St\n\nCONTD Zion Church\r\n\nSt. Mary’s Parish 5 A"
    rows = [(1, text), (2, "no section here"), (3, None), (4, "")]
    got = [tuple(r) for r in directories.directory_entries(spark.createDataFrame(rows, "id long, t string"), "id", "t").orderBy("id", "entry_no").collect()]
    assert got == [(1, 1, "First Baptist Church", "12 N Main St. Elder Jones"), (1, 2, "Calvary Temple Of Hope", "56 Oak Rd"), (1, 3, "Zion Church", ""), (1, 4, "St. Mary's Parish 5 A", "")]


def test_domain_conflicts(spark):
    cities = spark.createDataFrame([("springfield", "IL"), ("springfield", "MO"), ("field", "TX"), ("gary", "IN"), ("", "ZZ")], "city string, state string")
    rows = [(1, "a@firstspringfield.org", "OH"), (2, "a@firstspringfield.org", "MO"), (3, "a@GaryChurch.com", "IN"), (4, "a@garychurch.com", "OH"), (5, None, "OH"), (6, "a@gary.org", None), (7, "gary.org", "OH"), (8, "a@gary@x.org", "OH"), (9, "a@field.org", "TX"), (10, "a@", "OH"), (11, "a@gary.org", "")]
    df = spark.createDataFrame(rows, "id long, email string, state string").withColumn("score", F.lit(0.5))
    found = checks.domain_conflicts(df, cities, "id", "email", "state")
    assert {(r["id"], r["city"], r["expected"]) for r in found.collect()} == {(1, "springfield", "IL|MO"), (2, "field", "TX"), (4, "gary", "IN"), (8, "gary", "IN")}
    after = {r["id"]: (r["email"], r["score"]) for r in checks.without_conflicts(df, found, "id", "email", "score").collect()}
    assert after[1] == ("", None) and after[3] == ("a@GaryChurch.com", 0.5) and len(after) == 11 and after[5] == (None, 0.5)
    assert checks.domain_conflicts(df, cities.limit(0), "id", "email", "state").count() == 0


def test_tiles_are_read_from_files(spark, tmp_path):
    side = 1201
    grid = (np.arange(side)[:, None] * 7 - np.arange(side)[None, :] * 3 - 900).astype(">i2")
    grid[600, 600] = -32768
    (tmp_path / "N40W087.hgt").write_bytes(grid.tobytes())
    (tmp_path / "s01e005.hgt").write_bytes(grid.tobytes()[: 2 * side * 3 + 5])  # cut short
    rng = random.Random(1)
    points = [(i, 40 + rng.random(), -87 + rng.random()) for i in range(200)] + [(900, 40.5, -86.5), (901, 41.5, -86.5), (902, None, 1.0), (903, -0.0005, 5.001), (904, -0.9, 5.5), (905, 40.0, -87.0)]
    got = {r["id"]: r["height"] for r in raster.with_heights(spark.createDataFrame(points, "id long, lat double, lon double"), raster.read_tiles(spark, str(tmp_path))).collect()}

    def want(lat, lon, south, west, body):
        row, col = round((south + 1 - lat) * 1200), round((lon - west) * 1200)
        raw = body[(row * side + col) * 2 :][:2]
        value = struct.unpack(">h", raw)[0] if len(raw) == 2 else None
        return None if value in (None, -32768) else float(value)

    for i, lat, lon in points[:201]:
        assert got[i] == want(lat, lon, 40, -87, grid.tobytes()), i
    assert got[900] is None and got[901] is None and got[902] is None and got[904] is None
    assert got[903] == want(-0.0005, 5.001, -1, 5, grid.tobytes()[: 2 * side * 3 + 5]) and got[905] == want(40.0, -87.0, 40, -87, grid.tobytes())


def recursive(points, tolerance):
    """Douglas-Peucker by the book."""
    (x1, y1), (x2, y2) = points[0], points[-1]
    best, at = -1.0, 0
    for k, (x, y) in enumerate(points[1:-1], 1):
        dx, dy = x2 - x1, y2 - y1
        t = min(1.0, max(0.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
        d = float(np.hypot(x - x1 - t * dx, y - y1 - t * dy))
        if d > best:
            best, at = d, k
    if best <= tolerance:
        return [points[0], points[-1]]
    return recursive(points[: at + 1], tolerance)[:-1] + recursive(points[at:], tolerance)


@pytest.mark.parametrize("tolerance", [0.0, 0.05, 0.4, 3.0])
def test_simplified_lines_and_rings(spark, tolerance):
    rng = random.Random(6)
    lines = [[(k + rng.uniform(-0.3, 0.3), rng.gauss(0, 0.5)) for k in range(rng.choice([1, 2, 3, 9, 60]))] for _ in range(60)]
    df = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in line]) for i, line in enumerate(lines)] + [(999, None), (998, [])], "id long, line array<struct<x: double, y: double>>")
    got = {r["id"]: r["out"] and [tuple(p) for p in r["out"]] for r in df.select("id", geo.simplify(F.col("line"), tolerance).alias("out")).collect()}
    for i, line in enumerate(lines):
        assert got[i] == (recursive(line, tolerance) if len(line) > 2 else line)
    assert got[999] is None and got[998] == []
    for n in (4, 5, 30):
        ring = [(float(np.cos(2 * np.pi * k / n)), float(np.sin(2 * np.pi * k / n))) for k in range(n)]
        ring.append(ring[0])
        keep = geo.simplified_corners(np.array([p[0] for p in ring]), np.array([p[1] for p in ring]), tolerance)
        assert keep[0] == 0 and keep[-1] == n and len(keep) >= 4 and list(keep) == sorted(set(keep))
        for a, b in zip(keep, keep[1:], strict=False):  # what goes lies near what stays
            assert len(keep) == 4 or all(geo._off_segment(np.array([ring[k][0]]), np.array([ring[k][1]]), *ring[a], *ring[b])[0] <= tolerance for k in range(a + 1, b))


def test_a_very_long_line_is_no_deep_recursion():
    n = 20_000
    x, y = np.arange(n) / 100.0, np.sin(np.arange(n) / 50.0)
    assert 100 < len(geo.simplified_corners(x, y, 0.01)) < 5000


def test_numbers_with_far_ids(spark):
    ids = [*range(500, 900, 3), 10**15, -(10**15)]
    got = {r["id"]: r["n"] for r in linkage.numbered(spark.createDataFrame([(i,) for i in ids], "id long"), "id", "n", slices=16).collect()}
    assert got == {i: k + 1 for k, i in enumerate(sorted(ids))}
