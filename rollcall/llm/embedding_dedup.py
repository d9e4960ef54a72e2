"""Near-duplicate vectors through an inverted multi-index.

Unit vectors are cut in two halves, each half has its own codebook, and the pairs of nearest centroids form a product
grid. A vector lies in one cell and visits cells in the order of the summed distances of its halves (the multi-sequence
traversal), as many as the target recall needs. Visitors and residents of a cell meet in blocks, and the cosine of every
such pair is computed in double precision. Blocks give counts and spanning edges, so that pairs never leave them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialize
from ..operators.graph import connected_components as components


#: Cells that every vector visits at least; the smallest grids have no more, and are searched whole.
LEAST_VISITS = 4
#: Distances held at once in a task.
MOST_DISTANCES = 4_000_000


@dataclass(frozen=True)
class MultiIndex:
    first: np.ndarray
    second: np.ndarray
    visits: int
    expected_recall: float

    @property
    def dim(self) -> int:
        return self.first.shape[1] + self.second.shape[1]

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.first.shape[1]
        return _squared(x[:, :h], self.first), _squared(x[:, h:], self.second)

    def traverse(self, x: np.ndarray) -> np.ndarray:
        """The `visits` nearest cells of each row of x, nearest first; the first is the row's own cell."""
        m = min(self.visits, len(self.first), len(self.second))
        some = max(1, MOST_DISTANCES // max(m * m, len(self.first)))  # rows at a time, so that memory doesn't grow with the batch
        parts = [self._traverse(x[at : at + some]) for at in range(0, len(x), some)]
        return np.concatenate(parts) if parts else np.zeros((0, 1), np.int64)

    def _traverse(self, x: np.ndarray) -> np.ndarray:
        d1, d2 = self.distances(x)
        m = min(self.visits, d1.shape[1], d2.shape[1])  # the k-th nearest cell is among the k nearest of either half
        i, j = (np.argsort(d, axis=1, kind="stable")[:, :m] for d in (d1, d2))
        total = np.take_along_axis(d1, i, 1)[:, :, None] + np.take_along_axis(d2, j, 1)[:, None, :]
        order = np.argsort(total.reshape(len(x), -1), axis=1, kind="stable")[:, : self.visits]
        a, b = order // m, order % m
        return np.take_along_axis(i, a, 1).astype(np.int64) * len(self.second) + np.take_along_axis(j, b, 1)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 15) -> np.ndarray:
    x = np.unique(x, axis=0)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    some = max(1, MOST_DISTANCES // len(c))
    for _ in range(rounds):
        near = np.concatenate([_squared(x[at : at + some], c).argmin(1) for at in range(0, len(x), some)])
        sums, n = np.zeros_like(c), np.bincount(near, minlength=len(c))
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def fit_index(units: DataFrame, dim: int, n_rows: int, *, threshold: float, target_recall: float, sample_rows: int, cell_rows: int, seed: int) -> MultiIndex | None:
    """Codebooks from sample_rows unit vectors at most (or four for each centroid), and the visits that reach target_recall.

    As many centroids as give cells of cell_rows rows on average, whatever the number of rows. None for under two rows.
    The visits are set for the hardest pairs, those just at the threshold: every vector of the sample gets a partner at
    that cosine in a random direction, and the traversal must reach the partner's cell, or the partner's traversal the
    vector's, in a share target_recall of the cases. This holds whatever pairs the table has.
    """
    k = max(2, round((n_rows / cell_rows) ** 0.5))
    sample_rows = max(sample_rows, 4 * k)
    share = min(1.0, 1.2 * sample_rows / max(n_rows, 1))
    picked = units.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    got = picked.select("id", "x").limit(int(1.5 * sample_rows)).toPandas().sort_values("id")
    if len(got) < 2:
        return None
    x = np.array(got["x"].tolist(), float)[:sample_rows]
    rng, h = np.random.default_rng(seed), dim // 2
    index = MultiIndex(_codebook(x[:, :h], k, rng), _codebook(x[:, h:], k, rng), 1, 1.0)
    side = x[rng.choice(len(x), min(len(x), 1500), replace=False)]
    away = rng.standard_normal(side.shape)
    away -= (away * side).sum(1)[:, None] * side
    away /= np.linalg.norm(away, axis=1)[:, None]
    other = threshold * side + (1 - threshold**2) ** 0.5 * away
    rank = np.minimum(_ranks(index, side, other), _ranks(index, other, side))
    visits = max(int(np.quantile(rank, target_recall)) + 1, LEAST_VISITS)
    return MultiIndex(index.first, index.second, visits, float((rank < visits).mean()))


def _ranks(index: MultiIndex, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = []
    some = max(1, MOST_DISTANCES // (len(index.first) * len(index.second)))
    for at in range(0, len(x), some):
        (d1, d2), (e1, e2) = index.distances(x[at : at + some]), index.distances(y[at : at + some])
        all_cells = d1[:, :, None] + d2[:, None, :]
        rows = np.arange(len(d1))
        goal = d1[rows, e1.argmin(1)] + d2[rows, e2.argmin(1)]
        out.append((all_cells < goal[:, None, None]).sum((1, 2)))
    return np.concatenate(out)


def link_embeddings(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, target_recall: float = 0.98, sample_rows: int = 8000, cell_rows: int = 64, block_rows: int = 256, seed: int = 7
) -> DataFrame:
    """(id, n_links, component_id, kept, expected_recall) for every row of vectors; other columns are not read.

    n_links: other rows with cosine >= threshold that were found; component_id: the smallest id within reach of links;
    kept: the row is its component's smallest id. Vectors that are null, zero, empty, or hold null or non-finite components
    link with nothing; vectors of each length are searched in an index of their own. Rows with equal vectors link with each
    other and are searched as one. A row without an id links with nothing and is kept; rows that repeat an id count as links
    of each other. An empty table gives no rows. expected_recall: of pairs just at the threshold, by the fitted index.
    Found links are never below the threshold; the expected recall at the threshold is target_recall, above it more.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = F.coalesce(F.col("id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists("v", lambda c: c != 0), F.lit(False))
    rows = rows.select("id", F.when(sound, F.col("v")).alias("v"))
    text = F.concat_ws(",", F.transform("v", lambda c: F.when(c == 0, F.lit(0.0)).otherwise(c).cast("string")))
    rows = rows.withColumn("key", F.when(F.col("v").isNotNull(), F.sha2(text, 256)))
    classes = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    classes = materialize(classes.withColumn("d", F.size("v")), "vector-classes")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))
    units = classes.select("id", "n", "d", F.transform("v", lambda c: c / norm).alias("x"))
    found = rows.sparkSession.createDataFrame([], "u long, v long, more long")
    recall = F.lit(1.0)
    for r in classes.groupBy("d").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("d").collect():  # one row a length
        own = units.where(F.col("d") == r["d"]).drop("d")
        index = fit_index(own, r["d"], r["n"], threshold=threshold, target_recall=target_recall, sample_rows=sample_rows, cell_rows=cell_rows, seed=seed)
        if index is not None:
            found = found.unionByName(materialize(_meet(own, index, threshold, block_rows), "vector-links"))
            recall = F.when(F.size("v") == r["d"], F.lit(index.expected_recall)).otherwise(recall)
    counts = found.where("v IS NULL").groupBy(F.col("u").alias("rep")).agg(F.sum("more").alias("linked"))
    labels = components(found.where("v IS NOT NULL")).select(F.col("node").alias("rep"), "component")
    known = classes.select("key", F.col("id").alias("rep"), "n").join(counts, "rep", "left").join(labels, "rep", "left")
    known = known.select("key", "rep", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.select("id", "key", recall.alias("expected_recall")).join(known, "key", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"), "expected_recall")


def _meet(units: DataFrame, index: MultiIndex, threshold: float, block_rows: int) -> DataFrame:
    """(u, v, more): rows with v null add `more` links to u, the others are edges that join u and v."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(2).to_pylist(), float).reshape(len(batch), -1)
            cells = index.traverse(x) if len(x) else np.zeros((0, 1), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(list(cells), pa.list_(pa.int64()))], names=["id", "n", "x", "cells"])

    placed = materialize(units.mapInArrow(visit, "id long, n long, x array<double>, cells array<long>"), "vector-cells")
    at_home = placed.withColumn("cell", F.get("cells", F.lit(0)))
    calls = placed.withColumn("home", F.get("cells", F.lit(0))).withColumn("cell", F.explode("cells"))

    blocks_of = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias(name))
    deal = lambda blocks: F.pmod(F.xxhash64("id", F.lit(1)), F.col(blocks))
    crowds = blocks_of(at_home, "rooms")
    residents = at_home.join(crowds, "cell").groupBy("cell", deal("rooms").alias("room")).agg(F.collect_list(F.struct("id", "n", "x", "cells")).alias("residents"))
    # visitors go to every block of a cell's residents, so that a crowded cell is dealt out; empty cells are not visited
    guests = calls.drop("cells").join(blocks_of(calls, "parties").join(crowds, "cell"), "cell")
    guests = guests.withColumn("party", deal("parties")).withColumn("room", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rooms") - 1)))
    visitors = guests.groupBy("cell", "room", "party").agg(F.collect_list(F.struct("id", "n", "x", "home")).alias("visitors"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, more = [], [], []
            for mine, theirs in zip(batch.column("visitors"), batch.column("residents"), strict=True):
                a, b = _block(mine.values), _block(theirs.values)
                near = (a["x"] @ b["x"].T >= threshold) & (a["id"][:, None] != b["id"][None, :])
                if not near.any():
                    continue
                hit = near.any(1)
                u.append(a["id"][hit])
                v.append(np.full(hit.sum(), -1))
                more.append((near @ b["n"])[hit])
                # a visitor that its neighbour does not visit in turn: the neighbour hears of the link here
                known = (a["home"][:, None, None] == b["cells"][None, :, :]).any(2)
                unheard = near & ~known
                if unheard.any():
                    hit = unheard.any(0)
                    u.append(b["id"][hit])
                    v.append(np.full(hit.sum(), -1))
                    more.append((a["n"] @ unheard)[hit])
                for ids, root in _forest(near, a["id"], b["id"]):
                    u.append(ids)
                    v.append(root)
                    more.append(np.zeros(len(ids), np.int64))
            if u:
                u, v, more = map(np.concatenate, (u, v, more))
                edge = more == 0
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64(), mask=~edge), pa.array(more, pa.int64())], names=["u", "v", "more"])

    return visitors.join(residents, ["cell", "room"]).select("visitors", "residents").mapInArrow(compare, "u long, v long, more long")


def _block(values: pa.StructArray) -> dict[str, np.ndarray]:
    n = len(values)
    out = {}
    for i, field in enumerate(values.type):
        column = values.field(i)
        out[field.name] = column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if pa.types.is_list(field.type) else column.to_numpy(zero_copy_only=False)
    return out


def _forest(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges from each node to the smallest id of its part of the block's own graph: as many as nodes, not as pairs."""
    big = np.iinfo(np.int64).max
    a, b = np.where(near.any(1), left, big), np.where(near.any(0), right, big)
    while True:
        b2 = np.minimum(b, np.where(near, a[:, None], big).min(0))
        a2 = np.minimum(a, np.where(near, b2[None, :], big).min(1))
        if (a2 == a).all() and (b2 == b).all():
            break
        a, b = a2, b2
    for ids, root in ((left, a), (right, b)):
        keep = (root != big) & (root != ids)
        yield ids[keep], root[keep]
