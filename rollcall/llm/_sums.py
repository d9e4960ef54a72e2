"""Sums of numbered vectors over all tasks, added up in two steps so that no group holds a row from every task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What tasks emit: the number of a vector, and its float64 values, packed.
SHAPE = "name long, vector binary"


def pack(x: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x, float).tobytes())


def unpack(x: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), float)


def batch_of(vectors: dict[int, np.ndarray]) -> pa.RecordBatch:
    keys = sorted(vectors)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([pack(vectors[k]) for k in keys], pa.binary())], names=["name", "vector"])


def add_up(rows: DataFrame, fan: int = 64) -> Iterator[tuple[int, np.ndarray]]:
    """The sum of the vectors of each name, one after another. Sums over no vectors are left out."""

    def add(t: pa.Table) -> pa.Table:
        total = 0.0
        for v in t["vector"]:
            total = total + unpack(v.as_py())
        return pa.table({"name": t["name"].slice(0, 1), "vector": pa.array([pack(total)], pa.binary())})

    some = rows.withColumn("salt", F.spark_partition_id() % fan).groupBy("name", "salt").applyInArrow(lambda t: add(t.select(["name", "vector"])), SHAPE)
    for r in some.groupBy("name").applyInArrow(add, SHAPE).toLocalIterator():
        yield r["name"], unpack(r["vector"])
