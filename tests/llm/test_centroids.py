"""Elkan's bounds against plain rounds in whole numbers: same clusters, ties and distances, fewer distances computed."""

import hashlib
import math

import numpy as np
import pytest

import __spark_entry__ as entry
from rollcall.llm.centroids import cluster_rows, cluster_vectors
from tests.compare import DATA, both

SCHEMA = "vec_id long, embedding array<float>, cluster string, id long, distance int"


def plain_rounds(rows, k, rounds, dim, scale, seed="3"):
    """vec_id -> sorted (cluster, distance), final centroids."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None) + sorted(("~", v) for i, v in kept if i is None)
    centroids = [v for _, v in named[:k]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds if kept else 0):
        own = nearest()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, own, strict=True) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = {}
    for (i, _), (d, c) in zip(kept, nearest() if kept else [], strict=True):
        out.setdefault(i, []).append((c, d))
    return {i: sorted(x) for i, x in out.items()}, centroids


def compared(spark, rows, **how):
    found = cluster_vectors(spark.createDataFrame([(i, v, "x", 7, 1) for i, v in rows], SCHEMA).repartition(3), **how)
    got = {}
    for r in cluster_rows(found).collect():
        got.setdefault(r["vec_id"], []).append((r["cluster"], r["distance"]))
        assert r["inertia"] == sum(found.inertia) and r["cluster_inertia"] == found.inertia[r["cluster"]]
    want, centroids = plain_rounds(rows, **how)
    assert {i: sorted(x) for i, x in got.items()} == want
    assert found.centroids == centroids and found.inertia == [sum(d for x in want.values() for c, d in x if c == j) for j in range(len(centroids))]
    return found


def test_groups_of_vectors_need_fewer_distances(spark):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(6, 16)) * 4
    rows = [(i, (middles[i % 6] + rng.normal(size=16)).astype(np.float32).tolist()) for i in range(1200)]
    found = compared(spark, rows, k=6, rounds=6, dim=16, scale=64)
    assert found.computed < 0.5 * 1200 * 6 * 7


def test_ties_repeats_and_bad_vectors(spark):
    """Small whole coordinates tie all the time; equal seeds leave clusters empty; what is not a vector of the length goes."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, size=3).astype(float).tolist()) for i in range(300)]
    rows += [(5, [1.0, 1.0, 1.0])] * 40 + [(None, [0.0, 0.0, 0.0])] * 3 + [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 0.0]), (904, [float("nan"), 0.0, 0.0]), (905, [float("inf"), 0.0, 0.0]), (906, [0.0] * 4)]
    for k, scale in ((8, 1), (8, 2), (3, 1), (40, 1)):
        compared(spark, rows, k=k, rounds=5, dim=3, scale=scale)
    compared(spark, [(i, [1.0, 2.0]) for i in range(20)], k=4, rounds=3, dim=2, scale=1)


def test_few_and_no_vectors(spark):
    compared(spark, [(1, [0.5, -0.5]), (2, [3.0, 1.0])], k=8, rounds=4, dim=2, scale=1024)
    empty = spark.createDataFrame([], SCHEMA)
    assert cluster_rows(cluster_vectors(empty)).count() == 0
    assert cluster_rows(cluster_vectors(spark.createDataFrame([(1, [1.0], "x", 1, 1)], SCHEMA))).count() == 0


def test_components_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="fit a long"):
        cluster_vectors(spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>"), dim=2)


@pytest.mark.parametrize("name", ["op12_rendezvous_shards", "op13_centroid_clusters"])
def test_query_equals_its_sql(spark, name):
    columns, got, names, want = both(spark, entry.queries()[name], entry.oracle_sql()[name], f"{DATA}/sf0.001")
    assert columns == names and got == want
