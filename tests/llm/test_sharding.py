"""Rendezvous hashing: who moves, shares by weight, gapless slots also for hot keys and repeated rows."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollcall.llm import sharding
from rollcall.llm.sharding import Shard, equal_shards, shard_rows

SCHEMA = "doc_id long, text string, shard string, id string, size int"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", None, 5) for i, t in rows], SCHEMA)


def placed(df):
    return [r.asDict() for r in df.collect()]


def test_every_row_has_one_place(spark):
    rows = [(i, f"text {i % 7} ä") for i in range(500)] + [(3, "again")] * 4 + [(None, None), (None, None), (None, ""), (9, None), (10, "long " * 40_000)]
    out = placed(shard_rows(rows_of(spark, rows), equal_shards(5), added=Shard(5), bucket_rows=16))
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    for s in range(5):
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))
    by_id = {}
    for r in out:
        assert by_id.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 5)
    ranges = {n: sorted((r["doc_id"] or 0, r["size"], r["slot"], r["shard"]) for r in placed(shard_rows(rows_of(spark, rows), equal_shards(5), bucket_rows=n))) for n in (4, 100_000)}
    assert ranges[4] == ranges[100_000]  # how a shard is cut for numbering changes no slot


def test_copies_of_one_row_are_written_out_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE", 7)
    out = placed(shard_rows(rows_of(spark, [(1, "a")] * 100 + [(2, "b")] * 7 + [(3, "c")]), equal_shards(1)))
    assert sorted(r["slot"] for r in out) == list(range(108))
    for i, n in ((1, 100), (2, 7), (3, 1)):
        mine = sorted(r["slot"] for r in out if r["doc_id"] == i)
        assert len(mine) == n and mine[-1] - mine[0] == n - 1  # side by side


def test_weights_and_changes_of_the_shards(spark):
    """Shares follow weights; a new, a heavier or a lost shard moves only what it takes or leaves."""
    ids = spark.range(40_000).select(F.col("id").alias("doc_id"))
    at = lambda shards: {r[0]: r[1] for r in ids.select("doc_id", sharding.rendezvous(F.col("doc_id"), shards)).collect()}
    base = [Shard(0, 1.0), Shard(1, 2.0), Shard(2, 5.0)]
    before = at(base)
    share = Counter(before.values())
    assert all(abs(share[k] / 40_000 - w / 8) < 0.012 for k, w in ((0, 1), (1, 2), (2, 5)))
    grown = at([*base, Shard(3, 2.0)])
    assert all(grown[i] in (before[i], 3) for i in before) and abs(sum(v == 3 for v in grown.values()) / 40_000 - 0.2) < 0.012
    heavier = at([Shard(0, 3.0), *base[1:]])
    assert all(heavier[i] in (before[i], 0) for i in before)
    lost = at([base[0], base[2]])
    assert all(lost[i] == before[i] for i in before if before[i] != 1)
    assert at(base[::-1]) == before  # the order in which shards are named doesn't matter


def test_empty_tables_and_unusable_shards(spark):
    assert shard_rows(rows_of(spark, []), equal_shards(3)).count() == 0
    for shards in ([], [Shard(1), Shard(1)], [Shard(1, 0.0)]):
        with pytest.raises(ValueError, match="distinct numbers"):
            sharding.rendezvous(F.col("doc_id"), shards)
