"""What must not grow with a table: rows held together, pairs of copies, caps on what is read."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rollcall.functions import directories, geo
from rollcall.llm.suffix_dedup import CHUNKS_AT_ONCE, remove_repeats
from rollcall.operators import linkage, matching, spatial
from rollcall.operators.settled import shared_dir
from tests.compare import both


def test_chunks_are_loaded_a_few_at_once(spark):
    docs = spark.range(60).selectExpr("id AS doc_id", "repeat(concat('text ', id, ' '), 40) AS text").coalesce(1)
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("chunks-*"))
    assert remove_repeats(docs, chunk_bytes=1000).count() == 60
    written = [f for d in set(folder.glob("chunks-*")) - before for f in d.glob("*.parquet")]
    groups = [m.row_group(g).num_rows for m in (pq.ParquetFile(f).metadata for f in written) for g in range(m.num_row_groups)]
    assert sum(groups) > CHUNKS_AT_ONCE and max(groups) <= CHUNKS_AT_ONCE


def test_long_directory_keeps_its_end(spark):
    entry = "Hope Chapel\n12 Elm Rd\n\n"
    text = spark.sql(f"SELECT 1 AS id, concat('Churches and\nSynagogues\n\n', repeat('{entry}', 6000)) AS text")
    assert directories.directory_entries(text, "id", "text").count() == 6000


def test_ids_of_six_digits_are_not_cut(spark):
    seen = spark.range(100_002).selectExpr("id AS cluster", "'n' AS name", "1L AS era")
    ids = linkage.roll_up(seen, "cluster", "name", "era").where("cluster % 10000 IN (0, 1)").select("cluster", "entity_id")
    got = {r["cluster"]: r["entity_id"] for r in ids.collect()}
    assert got[0] == "e_00001" and got[90_000] == "e_90001" and got[100_000] == "e_100001" and got[100_001] == "e_100002"


def test_every_cluster_of_six_digits_has_an_id(spark, tmp_path):
    k = np.arange(133_340)
    days = np.datetime64("1994-01-01", "us") + (k % 2000).astype("timedelta64[D]")
    pq.write_table(pa.table({"o_custkey": k, "o_orderpriority": (k % 5).astype(str), "o_orderdate": days}), tmp_path / "orders.parquet")
    columns, got, names, want = both(spark, entry.queries()["rolled_up"], entry.oracle_sql()["rolled_up"], str(tmp_path))
    assert columns == names and got == want
    assert {r[columns.index("entity_id")] for r in got} == {f"e_{n:05d}" for n in range(1, 100_006)}


def test_radius_sums_of_copies(spark):
    """100,000 points on one place and as many centres on another: 10^10 pairs, if rows met one by one."""
    centres = spark.range(100_000).selectExpr("id", "10.0 AS lat", "20.0 AS lon").unionByName(spark.sql("SELECT -1L AS id, CAST(NULL AS DOUBLE) AS lat, 1.0 AS lon"))
    points = spark.range(100_000).selectExpr("10.5 AS lat", "20.0 AS lon", "IF(id % 2 = 0, 1.0D, NULL) AS v")
    n = spatial.radius_sums(centres, points, "id", None, [10.0, 100.0]).groupBy("within_10", "within_100").count().collect()
    assert sorted(map(tuple, n)) == [(0, 0, 1), (0, 100_000, 100_000)]
    v = spatial.radius_sums(centres, points, "id", "v", [100.0]).groupBy("within_100").count().collect()
    assert sorted(map(tuple, v)) == [(0.0, 1), (50_000.0, 100_000)]


def test_near_alike_of_copies(spark):
    """100,000 rows of one place and name on each side meet once, and the smallest id wins."""
    left = spark.range(100_000).selectExpr("id", "10.0D AS lat", "20.0D AS lon", "'hope chapel' AS name")
    right = spark.range(100_000).selectExpr("id + 5 AS partner", "10.001D AS lat", "20.0D AS lon", "'hope chapels' AS name")
    got = matching.near_alike(left, right, "id", "partner", "name").groupBy("partner").count().collect()
    assert [tuple(r) for r in got] == [(5, 100_000)]


def test_first_words_of_many_partners(spark):
    """50,000 names on each side that share two first words, in one region, and differ in the rest."""
    left = spark.range(50_000).selectExpr("id", "'IL' AS state", "concat('Old Zion ', id) AS name")
    right = spark.range(50_000).selectExpr("id + 7 AS partner", "'il' AS state", "concat('zion old ', id * 3, ' hall') AS name")
    got = matching.first_words_match(left, right, "id", "partner", "name", "state")
    three = {r["id"]: r["partner"] for r in got.where("score = 3").collect()}
    assert got.count() == 50_000 and len(three) == 16_667 and all(b == a // 3 + 7 for a, b in three.items())
    assert {r["partner"] for r in got.where("score = 2").select("partner").distinct().collect()} == {7}


def test_held_beginnings_of_any_length(spark):
    """A name that the other holds at any place, with one shared word: as a search over all pairs finds it."""
    names = ["", "a", "zion", "zion h", "hope of the long road to zion", "hope of the long roadside", "ope of", "the hope of the long road home", "my zion", "old-zion", " zion", "zion hope of the"]
    rows = [(i, "s", x) for i, x in enumerate(names)]
    l = spark.createDataFrame(rows, "id long, k string, name string")
    words = [list(dict.fromkeys(re.split(r"\s+", x.replace("-", " ").strip(" "))[:3])) for x in names]
    want = {}
    for i, x in enumerate(names):
        scores = [(-len(set(words[i]) & set(words[j])), j) for j, y in enumerate(names)]
        good = [(s, j) for s, j in scores if s <= -2 or (s == -1 and x[:20] in names[j])]
        if good:
            want[i] = (min(good)[1], float(-min(good)[0]))
    got = matching.first_words_match(l, l.withColumnRenamed("id", "partner"), "id", "partner", "name", "k")
    assert {r["id"]: (r["partner"], r["score"]) for r in got.collect()} == want


def test_clusters_broadcast_nothing(spark):
    points = spark.range(100).selectExpr("id", "CAST(id AS DOUBLE) AS lat", "20.0D AS lon")
    out = spatial.dbscan(points, "id", 1.0, 1, lambda edges: edges.selectExpr("u AS node", "v AS component"))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("core").count() == 100


def test_block_pairs_come_once_without_being_aggregated(spark):
    l = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (2, None, 5), (3, "a", None), (3, "c", 6)], "a long, x string, y long")
    r = spark.createDataFrame([(9, "a", 5), (9, "b", 6), (8, None, 5), (7, "c", None)], "b long, x string, y int")
    blocks = [(F.col("x"), F.col("x")), (F.col("y"), F.col("y"))]
    out = linkage.block_pairs(l, r, "a", "b", blocks)
    assert sorted(map(tuple, out.collect())) == [(1, 8), (1, 9), (2, 8), (2, 9), (3, 7), (3, 9)]
    assert "Aggregate" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, linkage.block_pairs(l, r, "a", "b", blocks, most=2).collect())) == [(1, 9), (3, 7), (3, 9)]


def test_lines_of_every_kind_are_simplified(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(geo, "simplified_corners", lambda x, y, t: calls.append(1) or np.arange(len(x)))
    point = lambda x, y: {"x": x, "y": y}
    lines = pa.array([[point(0.0, 0.0), point(1.0, 2.0)], None, [], [point(0.0, 0.0), point(1.0, 2.0)], [point(3.0, 4.0)]])
    assert geo._simplified.func(lines, pa.array([0.1] * 5)).to_pylist() == lines.to_pylist()
    assert len(calls) == 3  # equal lines once
    monkeypatch.undo()
    got = spark.sql("SELECT NULLIF(array(struct(0 AS x, 0 AS y), struct(1 AS x, 0 AS y), struct(2 AS x, 0 AS y)), IF(id = 1, array(struct(0 AS x, 0 AS y), struct(1 AS x, 0 AS y), struct(2 AS x, 0 AS y)), NULL)) AS l FROM range(2)").select(geo.simplify(F.col("l"), 0.1).alias("s"))
    assert sorted([None if r["s"] is None else [tuple(p) for p in r["s"]] for r in got.collect()], key=str) == [None, [(0.0, 0.0), (2.0, 0.0)]]
