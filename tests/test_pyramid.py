"""The k nearest against all pairs: crowded places, poles, the date line, groups, few partners and far ones."""

import math
import random

import pytest

from rollcall.functions.geo import EARTH_KM
from rollcall.operators import pyramid


def km_between(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * EARTH_KM * math.asin(math.sqrt(min(1.0, h)))


def scattered(rng, n):
    """Places all over the Earth, in a town, at a pole, at the date line, and many at one spot."""
    out = []
    for i in range(n):
        kind = i % 5
        at = [(rng.uniform(-90, 90), rng.uniform(-180, 180)), (41 + rng.gauss(0, 0.01), -87 + rng.gauss(0, 0.01)), (rng.uniform(89, 90), rng.uniform(-180, 180)), (rng.uniform(-5, 5), rng.choice([179.9, -179.9, 180.0]) + rng.uniform(-0.05, 0.05)), (10.0, 10.0)][kind]
        out.append((i, at[0], at[1], f"g{i % 3}" if i % 17 else None))
    return out


def brute(left, right, k, exclude, same, max_km):
    out = set()
    for i, la, lo, g in left:
        found = sorted((km_between((la, lo), (ra, ro)), j) for j, ra, ro, h in right if not (exclude and i == j) and (not same or (g is not None and g == h)) and None not in (la, ra))
        found = [x for x in found if max_km is None or x[0] <= max_km][:k]
        out |= {(i, j, round(km, 5), n + 1) for n, (km, j) in enumerate(found)}
    return out


@pytest.mark.parametrize(("k", "exclude", "same", "max_km"), [(1, False, (), None), (10, True, (), None), (3, False, ("g",), None), (4, True, (), 30.0)])
def test_nearest_are_those_of_all_pairs(spark, monkeypatch, k, exclude, same, max_km):
    monkeypatch.setattr(pyramid, "CROWD", 3)  # go deep
    monkeypatch.setattr(pyramid, "PER_WANTED", 3)
    monkeypatch.setattr(pyramid, "FIRST_PAIRS", 2000)
    monkeypatch.setattr(pyramid, "MANY", 20)
    rng = random.Random(4)
    left, right = scattered(rng, 220) + [(999, None, 3.0, "g1")], [(j + 100, *x) for j, *x in scattered(rng, 200)] + [(998, 3.0, None, "g1")]
    schema = "lat double, lon double, g string"
    l, r = spark.createDataFrame(left, f"id long, {schema}"), spark.createDataFrame(right, f"rid long, {schema}")
    got = {(x["id"], x["rid"], round(x["km"], 5), x["rank"]) for x in pyramid.nearest(l, r, "id", "rid", k=k, exclude_equal_ids=exclude, same=same, max_km=max_km).collect()}
    assert got == brute([x for x in left if x[1] is not None], [x for x in right if x[2] is not None], k, exclude, same, max_km)


def test_few_partners_and_none(spark):
    schema = "lat double, lon double"
    l = spark.createDataFrame([(i, i * 1.0, i * 2.0) for i in range(50)], f"id long, {schema}")
    r = spark.createDataFrame([(1, -80.0, 170.0), (2, 1.0, 1.0)], f"rid long, {schema}")
    assert pyramid.nearest(l, r, "id", "rid", k=5).count() == 100
    assert pyramid.nearest(l, r.limit(0), "id", "rid").count() == 0
    assert pyramid.nearest(l.limit(0), r, "id", "rid").count() == 0


def test_candidates_do_not_grow_with_the_table(spark, monkeypatch):
    """Twice the partners, twice the askers: each asker still meets about as many partners."""
    met = []
    real = pyramid._descend
    monkeypatch.setattr(pyramid, "FIRST_PAIRS", 50_000)

    def counted(here, there, *more):
        found = real(here, there, *more)
        per = found.join(there, ["level", "x", "y", "z"]).groupBy("level", "qx", "qy", "qz").sum("n").agg({"sum(n)": "max"}).first()[0]
        met.append(per)
        return found

    monkeypatch.setattr(pyramid, "_descend", counted)
    for n in (2000, 8000):
        rng = random.Random(n)
        rows = [(i, math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for i in range(n)]
        df = spark.createDataFrame(rows, "id long, lat double, lon double")
        assert pyramid.nearest(df, df.withColumnRenamed("id", "rid"), "id", "rid", k=2).count() == 2 * n
    assert max(met) <= pyramid.CROWD and met[1] < 2 * met[0]
