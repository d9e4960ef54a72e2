"""Small fixtures with hand-derived results for the library's functions, operators, sources and increments."""

import random

import pytest
from pyspark.sql import functions as F

from rollcall.functions import geo, rules, similarity, text
from rollcall.operators import dml, graph, linkage, spatial
from rollcall.sources import files
from rollcall.streaming import increments


def one(spark, column, *values):
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return df.select(column(*[F.col(n) for n in names]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "column, value, want",
    [
        (text.clean_text, "  a   b ,; ", "a b"), (text.clean_label, "Friends ''Old'' (X20)", "Friends 'Old'"), (text.clean_name, "Grace (North) Chapel Inc. LLC", "Grace Chapel"),
        (text.clean_domain, "HTTPS://www.Example.org:80/a?b", "example.org"), (text.clean_phone, "1-312-555-0199", "(312) 555-0199"), (text.clean_phone, " 555-0199 ", "555-0199"),
        (text.clean_zip, "60614-1234", "60614"), (text.zip_key, "1234-55", "01234"), (text.clean_email, "mailto:<A@B.org>", "a@b.org"), (text.clean_email, "bad", "bad"),
        (text.match_name, "The Hope Inc", "HOPE"), (text.without_po_box, "Hall, PO Box 9, Town, IL, 60000", "Town, IL, 60000"), (text.scripts_in, "Храм カ教会 ひ", ["Cyrillic", "CJK", "Hiragana", "Katakana"]), (text.scripts_in, "Hall", []),
        (text.scripts_in, "\u1000 \u0f40 \u3400", ["CJK", "Myanmar", "Tibetan"]), (text.clean_label, "Old (ABC) ;", "Old"), (text.clean_label, "Old (2010)", "Old"), (text.clean_label, "Old (a1)", "Old (a1)"),
        (text.strip_tags, "<p>a&amp;b</p><script>x</script> c", "a&b c"), (text.ensure_url, "x.org", "https://x.org"), (text.mailbox_score, "noreply", 0.0), (similarity.phonetic_key, "Robert", "R163"),
        (similarity.block_keys, "12 of", "XXXX"), (similarity.block_keys, "St. Mark", "S363|M620"), (similarity.block_keys, "Mt Zion Ch", "M530|Z500"), (similarity.phonetic_key, "", "0000"),
        (similarity.street_block_key, "12 N. Mt Oak Rd", "M530"), (similarity.street_block_key, "12", "XXXX"), (text.linkage_name, "St. Mary Ch", "STREET MARY CHURCH"),
    ],
)
def test_text(spark, column, value, want):
    assert one(spark, column, value) == want
    assert one(spark, column, None) is None or column in (similarity.block_keys, text.linkage_name, text.mailbox_score, text.scripts_in, similarity.street_block_key)


def test_structs(spark):
    a = one(spark, text.parse_address, "1200 N. Main St.")
    assert (a["number"], a["direction"], a["stem"], a["suffix"]) == ("1200", "NORTH", "MAIN", "STREET")
    for raw, parts in (("12B West Oak Ave", ("12B", "WEST", "OAK", "AVENUE")), ("Broadway", (None, None, "BROADWAY", None)), ("12 NE Oak Rd", ("12", None, "NE OAK RD", None)), ("E Mt Road", (None, "EAST", "MOUNT", "ROAD")), ("E Street", (None, "EAST", None, "STREET")), ("", (None,) * 4)):
        assert tuple(one(spark, text.parse_address, raw)) == parts
    for raw, parts in (
        ("1200 SWINGINGDALE DR, COLUMBIA, SC, 29210", ("1200 SWINGINGDALE DR", "COLUMBIA", "SC", "29210")), ("12 Elm, Flat 3, Ohio City, OH", ("12 Elm", "Flat 3", "OH", None)), ("Nowhere", ("Nowhere", None, None, None)),
        ("1 Oak Ave, Springfield, IL 62704-1000", ("1 Oak Ave", "Springfield", None, None)), ("1 Oak,, IL , 62704-1000", ("1 Oak", None, "IL", "62704")), ("46401", ("46401", None, None, "46401")), (" , ", (None,) * 4),
    ):
        assert tuple(one(spark, text.split_address_line, raw)) == parts
    assert tuple(one(spark, text.split_city_state, "Gary, in")) == ("Gary", "IN")
    assert tuple(one(spark, text.phone_e164, "(312) 555-0199")) == ("+13125550199", 1.0)
    assert one(spark, text.emails_in, "Write a@b.org, A@B.org or logo@2x.png") == ["a@b.org"]


def test_jaro_winkler_is_symmetric_and_one_for_equals():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 7))) for _ in range(2))
        assert abs(similarity.jaro_winkler_of(a, b) - similarity.jaro_winkler_of(b, a)) < 0.12  # transpositions may pair differently
        assert similarity.jaro_winkler_of(a, a) == 1.0 and 0 <= similarity.jaro_winkler_of(a, b) <= 1
    assert abs(similarity.jaro_winkler_of("MARTHA", "MARHTA") - 0.961111) < 1e-6


def test_rules(spark):
    df = spark.createDataFrame([("X21", None, ""), ("X2", "unknown", "b"), (None, "a", "b")], "code string, first string, second string")
    pick = rules.cascade([("first", F.col("first")), ("second", F.col("second"))])
    rows = df.select(rules.longest_prefix(F.col("code"), {"X2": "two", "X21": "more"}).alias("p"), pick["value"].alias("v"), pick["source"].alias("s")).collect()
    assert [tuple(r) for r in rows] == [("more", "unknown", "none"), ("two", "b", "second"), (None, "a", "first")]
    a = spark.createDataFrame([(90.0, 3, 3), (90.0, 3, 2), (90.0, 1, 1), (None, 3, 3), (90.0, 2, 3)], "r double, n int, m int").select(rules.allocate(F.col("r"), F.col("n"), F.col("m")).alias("x")).collect()
    assert [r["x"] and tuple(r["x"]) for r in a] == [(30.0, 0.9), (30.0, 0.7), (90.0, 1.0), None, (30.0, 0.8)]


def test_upsert_and_policies(spark):
    old = spark.createDataFrame([(1, "", 1), (2, "b", 2)], "k int, a string, n int")
    new = spark.createDataFrame([(1, "x", 0), (2, "y", 5), (3, "z", 9)], "k int, a string, n int")
    assert sorted(map(tuple, dml.upsert(old, new, ["k"], {"a": dml.fill_blank, "n": dml.keep_larger}).collect())) == [(1, "x", 1), (2, "b", 5), (3, "z", 9)]
    assert sorted(map(tuple, dml.update_from(old, new, ["k"], {"a": dml.append_text("; ")}).collect())) == [(1, "x", 1), (2, "b; y", 2)]


def test_publish_checks_before_it_replaces(spark, tmp_path):
    path = str(tmp_path / "table")
    dml.publish(spark.range(3), path, {"rows": lambda d: d.count() == 3})
    with pytest.raises(ValueError, match="rows"):
        dml.publish(spark.range(5), path, {"rows": lambda d: d.count() == 3})
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("km", [200, 800, 3000])
def test_radius_join_and_nearest_close_to_the_date_line(spark, km):
    """Against all pairs, on points on both sides of longitude 180."""
    rng = random.Random(7)
    points = [(k, rng.uniform(-75, 75), (180 + rng.uniform(-25, 25) + 180) % 360 - 180) for k in range(400)]
    df = spark.createDataFrame(points, "id long, lat double, lon double")
    a, b = df.where("id < 200"), df.where("id >= 200")
    apart = a.alias("a").crossJoin(b.alias("b")).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), geo.haversine_km(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")).alias("km")).collect()
    got = {(r["a"], r["b"]) for r in spatial.within_radius(a, b, km).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).collect()}
    assert got == {(r["a"], r["b"]) for r in apart if r["km"] <= km}
    near = {r["id"]: r["km"] for r in spatial.nearest(a, b.withColumnRenamed("id", "rid"), "id", "rid").collect()}
    assert near == {k: min(r["km"] for r in apart if r["a"] == k) for k in range(200)}


def test_radius_join_over_the_date_line_and_poles(spark):
    rng = random.Random(5)
    points = [(i, rng.choice([rng.uniform(-90, 90), rng.uniform(85, 90), rng.uniform(-1, 1)]), rng.choice([rng.uniform(-180, 180), rng.uniform(179, 180), rng.uniform(-180, -179)])) for i in range(120)]
    df = spark.createDataFrame(points, "id int, lat double, lon double")
    got = {(r["a"], r["b"]) for r in spatial.within_radius(df, df, 300).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).collect()}
    cross = df.crossJoin(df.select(F.col("id").alias("id2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2")))
    want = {(r["id"], r["id2"]) for r in cross.where(geo.haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) <= 300).collect()}
    assert got == want


def test_pointers_with_loops_chains_cycles_and_dangling_ends(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 4), (4, None), (5, 6), (6, 5), (7, 99)], "id long, to long")
    got = {r["id"]: (r["terminal"], r["state"]) for r in graph.flatten_pointers(df, "id", "to").collect()}
    assert got == {1: (1, "self"), 2: (4, "ok"), 3: (4, "ok"), 5: (None, "cycle"), 6: (None, "cycle"), 7: (99, "dangling")}


def test_components_are_those_of_union_find(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    group = list(range(60))
    for u, v in edges:
        a, b = sorted((group[u], group[v]))
        group = [a if g == b else g for g in group]
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: group[n] for n in range(60) if any(n in e and e[0] != e[1] for e in edges)}


def test_tree_audit(spark):
    tree = spark.createDataFrame([(1, None, " A"), (2, 1, "b"), (3, 1, "B "), (4, 9, "c"), (5, 5, "d"), (6, 1, "a")], "id long, parent long, name string")
    found = {(r["issue"], r["id"]) for r in graph.audit_tree(tree, "id", "parent", "name").collect()}
    assert found == {("orphan", 4), ("self_parent", 5), ("same_as_parent", 6), ("name_elsewhere", 1), ("name_elsewhere", 6), ("duplicate_sibling", 2), ("duplicate_sibling", 3), ("unreachable", 4), ("unreachable", 5)}


def test_ambiguous_links_are_held(spark):
    links = spark.createDataFrame([(1, "x", 1), (1, "x", 3), (2, "x", 2), (2, "x", 3), (3, "y", 3)], "rec int, era string, tier int")
    got = sorted((r["rec"], r["tier"], r["held"]) for r in linkage.hold_ambiguous(links, "rec", "era", "tier").collect())
    assert got == [(1, 1, False), (1, 3, True), (2, 2, True), (2, 3, True), (3, 3, False)]


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿name , n\nx,1\ny,bad\n".encode())
    got = sorted(map(tuple, files.read_delimited(spark, str(tmp_path / "a.csv"), "name string, n int").collect()), key=str)
    assert got == [("x", 1), ("y", None)]
    files.write_geojson_lines(spark.createDataFrame([(1, 2.0, 3.0)], "id int, lat double, lon double"), str(tmp_path / "g"), "lat", "lon", ["id"])
    assert '"coordinates":[3.0,2.0]' in spark.read.text(str(tmp_path / "g")).first()[0]


def test_stream_upserts_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    merge = lambda old, new: dml.insert_or_replace(old, new, ["k"], [F.desc("v")])
    for batch in ([(1, 1), (2, 2)], [(2, 5), (3, 3)]):
        spark.createDataFrame(batch, "k long, v long").coalesce(1).write.mode("append").parquet(source)
        increments.run_once(spark.readStream.schema("k long, v long").parquet(source), str(tmp_path / "ck"), increments.upsert_into(target, merge)).awaitTermination(60)
    assert sorted(map(tuple, increments.newest(spark, target).collect())) == [(1, 1), (2, 5), (3, 3)]
