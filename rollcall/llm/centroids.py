"""Centroid clustering of whole-number vectors with Elkan's bounds: the result of plain rounds, with fewer distances.

A vector keeps an upper bound of the distance to its own centroid and a lower bound for each centroid. A centroid is passed
over if its lower bound, or half its distance to the vector's own centroid, exceeds the upper bound; bounds are rounded away
from the truth and compared strictly, so what could be nearer or equally near is always computed, in whole numbers. Every
round is one narrow pass over the vectors: read, assigned, written with the new bounds, and summed up by task. Only
sums and centroids, numbers by cluster, leave the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import discard, materialize

#: Components beyond this (before scaling) have squared distances that no long holds.
MOST = 1 << 16
STATE = "id long, v array<long>, own int, upper double, lower array<double>, computed long, sums array<long>"


@dataclass(frozen=True)
class Clustering:
    rows: DataFrame  # id, cluster, distance
    centroids: list[list[int]]
    sizes: list[int]
    inertia: list[int]
    computed: int  # distances between vectors and centroids, the final ones included
    rounds: int


def whole_vectors(vectors: DataFrame, dim: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): vectors with exactly dim components, none null or non-finite, as floor(scale * x)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    sound = (F.size("x") == dim) & ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    large = F.raise_error(F.lit(f"a component beyond {MOST}: its distances don't fit a long"))
    whole = F.transform("x", lambda c: F.when(F.abs(c) <= MOST, F.floor(c * scale)).otherwise(large.cast("long")))
    return rows.where(F.coalesce(sound, F.lit(False))).select("id", whole.alias("v"))


def first_centroids(kept: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors with the smallest sha256 of `seed:id`, in that order; of rows that share an id the smaller vectors, null ids last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return [list(r["v"]) for r in kept.select(order.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()]


def cluster_vectors(vectors: DataFrame, *, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: str = "3", id_col: str = "vec_id", vector_col: str = "embedding") -> Clustering:
    """Clusters of the whole-number vectors after `rounds` rounds and one more assignment; columns besides id and vector are not read.

    A vector goes to the nearest centroid, of equally near ones to the smaller number; a centroid becomes the floor of its
    vectors' mean by component, an empty one stays. Rows that repeat an id or a vector count one by one. With fewer
    vectors than k there are as many centroids as vectors, with none there are no rows. A component beyond MOST is an error.
    The rows are those of plain rounds that compute every distance.
    """
    state = materialize(whole_vectors(vectors, dim, scale, id_col, vector_col).select("*", F.lit(None).cast("int").alias("own"), F.lit(None).cast("double").alias("upper"), F.lit(None).cast("array<double>").alias("lower"), F.lit(None).cast("array<long>").alias("sums")), "vectors")
    centroids = np.array(first_centroids(state, k, seed), np.int64).reshape(-1, dim)
    moved, computed = np.zeros(len(centroids)), 0
    if not len(centroids):
        return Clustering(state.select("id", F.col("own").alias("cluster"), F.lit(None).cast("long").alias("distance")), [], [], [], 0, 0)
    for _ in range(rounds):
        after = materialize(state.select("id", "v", "own", "upper", "lower").mapInArrow(_assigner(centroids, moved), STATE), "vector-bounds")
        discard(state)
        state, (sums, spent) = after, _collected(after, len(centroids) * (dim + 1))
        sums, computed = sums.reshape(len(centroids), dim + 1), computed + spent
        new = np.where(sums[:, :1] > 0, sums[:, 1:] // np.maximum(sums[:, :1], 1), centroids)
        moved = _root_above(_squares(new - centroids))
        centroids = new
    last = materialize(state.select("id", "v", "own", "upper", "lower").mapInArrow(_assigner(centroids, moved, final=True), "id long, cluster int, distance long, computed long, sums array<long>"), "vector-clusters")
    discard(state)
    sums, spent = _collected(last, 2 * len(centroids))
    return Clustering(last.where("sums IS NULL").select("id", "cluster", "distance"), centroids.tolist(), sums[: len(centroids)].tolist(), sums[len(centroids) :].tolist(), computed + spent, rounds)


def cluster_rows(found: Clustering, id_col: str = "vec_id") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256): every row with what holds for its cluster, one row each."""
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    table = [(c, found.inertia[c], sum(found.inertia), digest[c]) for c in range(len(digest))]
    about = found.rows.sparkSession.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.join(F.broadcast(about), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _collected(state: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Totals of the tasks' sums by place, and of the distances they computed."""
    sums = state.where("sums IS NOT NULL")
    out, spent = np.zeros(width, np.int64), 0
    for r in sums.select(F.posexplode("sums").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x")).collect():
        out[r["place"]] = r["x"]
    spent = sums.agg(F.coalesce(F.sum("computed"), F.lit(0)).alias("n")).first()["n"]
    return out, spent


def _squares(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(-1)


def _root_above(squares: np.ndarray) -> np.ndarray:
    return np.where(squares > 0, np.nextafter(np.nextafter(np.sqrt(squares.astype(float)), np.inf), np.inf), 0.0)


def _root_below(squares: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter(np.nextafter(np.sqrt(squares.astype(float)), 0.0), 0.0), 0.0)


def _assigner(centroids: np.ndarray, moved: np.ndarray, final: bool = False):
    """A round over the batches of a task: rows with their new bounds, then one row of sums."""
    k, dim = centroids.shape
    between = _root_below(_squares(centroids[:, None] - centroids[None, :])) / 2  # halving is exact
    lone = np.where(np.eye(k, dtype=bool), np.inf, between).min(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, inertia, computed = np.zeros((k, dim + 1), np.int64), np.zeros(k, np.int64), 0
        for batch in batches:
            batch = batch.filter(batch.column("v").is_valid())  # the sums of the round before are no vectors
            n = len(batch)
            if not n:
                continue
            x = batch.column("v").flatten().to_numpy().reshape(n, dim)
            if batch.column("own").null_count:
                own, upper, lower = np.zeros(n, np.int32), np.full(n, np.inf), np.zeros((n, k))
            else:
                own = batch.column("own").to_numpy().copy()
                upper = np.nextafter(batch.column("upper").to_numpy() + moved[own], np.inf)
                lower = batch.column("lower").flatten().to_numpy().reshape(n, k)
                lower = np.where(moved > 0, np.maximum(np.nextafter(lower - moved, -np.inf), 0.0), lower)
            exact, spent = nearest(x, own, upper, lower)
            computed += spent
            np.add.at(sums, own, np.c_[np.ones(n, np.int64), x])
            if not final:
                offsets = lambda m: pa.array(np.arange(n + 1) * m, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("v"), pa.array(own), pa.array(upper), pa.ListArray.from_arrays(offsets(k), pa.array(lower.ravel())), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))],
                    names=["id", "v", "own", "upper", "lower", "computed", "sums"],
                )
                continue
            open_rows = np.flatnonzero(exact < 0)
            exact[open_rows] = _squares(x[open_rows] - centroids[own[open_rows]])
            computed += len(open_rows)
            np.add.at(inertia, own, exact)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(own), pa.array(exact), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))], names=["id", "cluster", "distance", "computed", "sums"])
        if final:
            total = pa.array([np.r_[sums[:, 0], inertia].tolist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.array([computed], pa.int64()), total], names=["id", "cluster", "distance", "computed", "sums"])
        else:
            total = pa.array([sums.ravel().tolist()], pa.list_(pa.int64()))
            empty = [pa.nulls(1, t) for t in (pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.float64(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*empty, pa.array([computed], pa.int64()), total], names=["id", "v", "own", "upper", "lower", "computed", "sums"])

    def nearest(x: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, int]:
        """Sets own, upper and lower; gives the exact squared distances where they were computed, else -1, and their number."""
        exact, spent = np.full(len(x), -1, np.int64), 0
        # nothing else can be as near as a centroid within half its distance to any other
        rows = np.flatnonzero(~(upper < lone[own]))
        for c in range(k):
            at = rows[own[rows] != c]
            at = at[~(upper[at] < lower[at, c]) & ~(upper[at] < between[own[at], c])]
            loose = at[exact[at] < 0]
            if len(loose):
                exact[loose] = _squares(x[loose] - centroids[own[loose]])
                spent += len(loose)
                upper[loose] = _root_above(exact[loose])
                lower[loose, own[loose]] = _root_below(exact[loose])
                at = at[~(upper[at] < lower[at, c]) & ~(upper[at] < between[own[at], c])]
            if not len(at):
                continue
            d = _squares(x[at] - centroids[c])
            spent += len(at)
            lower[at, c] = _root_below(d)
            nearer = (d < exact[at]) | ((d == exact[at]) & (c < own[at]))
            won = at[nearer]
            own[won], exact[won], upper[won] = c, d[nearer], _root_above(d[nearer])
        return exact, spent

    return run


def clustering_sql(k: int, rounds: int, dim: int, scale: int, seed: str) -> str:
    """DuckDB SQL for cluster_rows(cluster_vectors(...)) over the table embeddings, with every distance computed."""
    below = lambda s, n: f"(({s} - (({s} % {n}) + {n}) % {n}) // {n})"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS MATERIALIZED (SELECT r, c, sum((p.x - q.x) * (p.x - q.x))::BIGINT AS d FROM parts p JOIN c{r} q USING (i) GROUP BY r, c)""")
        steps.append(f"""a{r} AS MATERIALIZED (SELECT r, (arg_min(c, (d, c)))::INT AS c, min(d) AS d FROM d{r} GROUP BY r)""")
        if r < rounds:
            mean = below("sum(p.x)", "count(*)")
            steps.append(f"""m{r} AS (SELECT a.c, p.i, {mean} AS x FROM a{r} a JOIN parts p USING (r) GROUP BY a.c, p.i)""")
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT o.c, o.i, coalesce(m.x, o.x)::BIGINT AS x FROM c{r} o LEFT JOIN m{r} m ON m.c = o.c AND m.i = o.i)""")
    chain = ",\n        ".join(steps)
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
        parts AS MATERIALIZED (SELECT r, unnest(range({dim})) AS i, unnest(v) AS x FROM kept),
        seeds AS (SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR), v) - 1 AS c FROM kept QUALIFY c < {k}),
        c0 AS MATERIALIZED (SELECT c, i, x FROM seeds JOIN parts USING (r)),
        {chain},
        digest AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c),
        held AS (SELECT c, sum(d)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY c)
        SELECT vec_id, c AS cluster, d AS distance, cluster_inertia, (SELECT sum(d)::BIGINT FROM a{rounds}) AS inertia, centroid_sha256
        FROM kept JOIN a{rounds} USING (r) JOIN held USING (c) JOIN digest USING (c)"""
