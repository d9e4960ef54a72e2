"""Order statistics by selection against sorting: ties, outliers, one hot group, null keys, odd types, many passes."""

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from rollcall.operators import selection


def groups(rows):
    out = {}
    for k, v in rows:
        if v is not None:
            out.setdefault(k, []).append(v)
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize(("buckets", "few", "broadcast"), [(4, 3, 50_000), (16, 1, 0), (4096, 20_000, 50_000)])
def test_values_at_places(spark, monkeypatch, buckets, few, broadcast):
    monkeypatch.setattr(selection, "BUCKETS", buckets)
    monkeypatch.setattr(selection, "FEW", few)
    monkeypatch.setattr(selection, "MOST_TARGETS", broadcast)
    rng = random.Random(3)
    rows = [("hot", rng.choice([rng.gauss(0, 1), round(rng.gauss(0, 3)) / 1.0, 1e300 * rng.random(), -1e308, 1e-300])) for _ in range(600)]
    rows += [("same", 7.5)] * 40 + [(None, float(k)) for k in range(9)] + [("one", -3.0), ("none", None), ("hot", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r["k"]: r for r in selection.values_at(df, ["k"], "v", {"a": F.lit(0), "b": F.floor(F.col("n") * 0.25), "c": F.floor(F.col("n") / 2), "d": F.col("n") - 1, "e": F.lit(10**9)}).collect()}
    want = groups(rows)
    assert set(got) == set(want)
    for k, v in want.items():
        n = len(v)
        assert [got[k][c] for c in "abcde"] == [v[0], v[int(n * 0.25)], v[n // 2], v[-1], v[-1]], k


def test_other_types_and_no_keys(spark, monkeypatch):
    monkeypatch.setattr(selection, "BUCKETS", 5)
    monkeypatch.setattr(selection, "FEW", 2)
    days = [date(2020, 1, 1) + timedelta(days=(k * 37) % 501) for k in range(300)]
    big = [2**60 + (k * 7) % 300 for k in range(300)]  # alike as doubles
    df = spark.createDataFrame(list(zip(days, big, strict=True)), "d date, n long")
    assert selection.values_at(df, [], "d", {"m": F.floor(F.col("n") / 2)}).first()["m"] == sorted(days)[150]
    assert selection.values_at(df.withColumnRenamed("n", "v"), [], "v", {"m": F.lit(17)}).first()["m"] == sorted(big)[17]
    assert selection.values_at(df.limit(0), [], "d", {"m": F.lit(0)}).count() == 0
    odd = spark.createDataFrame([(float("nan"),), (1.0,), (float("inf"),), (float("-inf"),), (2.0,)], "v double")
    r = selection.values_at(odd, [], "v", {f"p{i}": F.lit(i) for i in range(5)}).first()
    assert list(r)[:4] == [float("-inf"), 1.0, 2.0, float("inf")] and math.isnan(r["p4"])


def test_quantiles_between_values(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 4, 8)] + [(None, 5.0)], "k string, v double")
    got = {r["k"]: (r["m"], r["q"]) for r in selection.quantiles(df, ["k"], "v", {"m": 0.5, "q": 0.9}).collect()}
    assert got == {"a": (3.0, pytest.approx(6.8)), None: (5.0, 5.0)}
