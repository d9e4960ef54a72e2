"""Queries that write files and read them back, change tables, place points in polygons, and search and group by distance."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dml, linkage, spatial
from ..operators.settled import shared_dir
from ..sources import files
from ..streaming import increments
from .curation import KM, _places, _points, _squares
from .registry import query, stated, table


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


PART_SQL = "SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN p_name || ', \"' || p_brand || '\"' ELSE p_name END AS name, p_retailprice AS price FROM part"


def _parts(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.when(k % 7 == 0, F.lit(None)).when(k % 5 == 0, F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"'))).otherwise(F.col("p_name"))
    return table(spark, d, "part").select(k.alias("id"), name.alias("name"), F.col("p_retailprice").alias("price"))


@query("csv_round_trip", PART_SQL)
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Nulls, commas and quotes; many files, read by column names of a stated schema."""
    path = _folder(spark, "csv")
    files.write_csv(_parts(spark, d).repartition(3), path)
    return files.read_delimited(spark, path, "id long, name string, price double")


def _write_bytes(spark: SparkSession, path: str, body: bytes) -> None:
    """One small file in a shared folder, through Spark's own file system."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/file")
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(body))
    out.close()


@query("gzip_and_zip", """SELECT 'gzip' AS kind, n_nationkey AS id, n_name AS name FROM nation UNION ALL SELECT 'zip', 1, 'a, b' UNION ALL SELECT 'zip', 2, NULL""")
def gzip_and_zip(spark: SparkSession, d: str) -> DataFrame:
    import io
    import zipfile

    path, packed = _folder(spark, "gzip"), _folder(spark, "zip")
    rows = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    rows.write.option("header", True).option("compression", "gzip").csv(path)
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        z.writestr("in/rows.csv", '﻿id,name\n1,"a, b"\n2,\n')
        z.writestr("in/notes.txt", "no rows")
    _write_bytes(spark, packed, body.getvalue())
    read = files.read_delimited(spark, path, "id long, name string").select(F.lit("gzip").alias("kind"), "id", "name")
    return read.unionByName(files.read_zipped_csv(spark, packed, "id long, name string").select(F.lit("zip").alias("kind"), "id", "name"))


@query("json_round_trip", PART_SQL)
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "json")
    _parts(spark, d).write.json(path)
    return files.read_json_lines(spark, path, "id long, name string, price double")


@query("xml_round_trip", """SELECT n_nationkey AS id, n_name AS name FROM nation""")
def xml_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "xml")
    table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")).write.format("xml").option("rowTag", "row").save(path)
    return files.read_xml(spark, path, "row", "id long, name string")


@query("latest_partition", """SELECT o_orderkey, year(o_orderdate)::BIGINT AS yr FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""")
def latest_partition(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "years")
    table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").cast("long").alias("yr")).write.partitionBy("yr").parquet(path)
    return files.read_latest_partition(spark, path, "yr").select("o_orderkey", F.col("yr").cast("long").alias("yr"))


@query("state_folders", """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'IN' WHEN c_custkey % 3 = 1 THEN 'OH' ELSE '__none__' END AS state FROM customer""")
def state_folders(spark: SparkSession, d: str) -> DataFrame:
    path, k = _folder(spark, "states"), F.col("c_custkey")
    place = F.when(k % 3 == 0, "Gary, in").when(k % 3 == 1, "Lima,OH").when(k % 2 == 0, "nowhere")
    files.write_csv_by_state(table(spark, d, "customer").select(k.alias("id"), place.alias("place")), path, "place")
    return spark.read.option("header", True).schema("id long, place string, state string").csv(path).select("id", "state")


@query("feature_collections", f"""SELECT id, lon, lat FROM ({_points('customer', 'c_custkey')}) WHERE id % 4 <> 0""")
def feature_collections(spark: SparkSession, d: str) -> DataFrame:
    """Points without coordinates are features without geometry, which readers of points pass over."""
    path = _folder(spark, "features")
    places = _places(table(spark, d, "customer"), "c_custkey").withColumn("lat", F.when(F.col("id") % 4 != 0, F.col("lat")))
    files.write_feature_collection(places.repartition(3), path, "lat", "lon", ["id"])
    return files.read_geojson_points(spark, path, "id: long").select("id", "lon", "lat")


CUSTOMERS = "SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 0 THEN '' END AS segment, c_acctbal AS balance FROM customer"


def _customers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("id"), F.when(k % 2 == 0, F.col("c_mktsegment")).when(k % 3 == 0, "").alias("segment"), F.col("c_acctbal").alias("balance"))


@query("updates_from", f"""WITH c AS ({CUSTOMERS}), n AS (SELECT o_custkey AS id, count(*) AS k, round(max(o_totalprice), 2) AS best FROM orders GROUP BY 1)
    SELECT c.id, CASE WHEN n.id IS NULL THEN segment ELSE coalesce(segment, 'NEW') END AS null_filled, CASE WHEN n.id IS NULL THEN segment ELSE coalesce(nullif(segment, ''), 'NEW') END AS blank_filled,
      CASE WHEN n.id IS NULL THEN balance ELSE best END AS taken FROM c LEFT JOIN n ON n.id = c.id""")
def updates_from(spark: SparkSession, d: str) -> DataFrame:
    """One update from a join, by three policies: null fields filled, blank ones too, values taken."""
    c = _customers(spark, d).select("id", F.col("segment").alias("null_filled"), F.col("segment").alias("blank_filled"), F.col("balance").alias("taken"))
    n = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.round(F.max("o_totalprice"), 2).alias("taken"))
    n = n.withColumns({"null_filled": F.lit("NEW"), "blank_filled": F.lit("NEW")})
    return dml.update_from(c, n, ["id"], {"null_filled": dml.fill_null, "blank_filled": dml.fill_blank, "taken": dml.take_new})


@query("deleted_and_undone", f"""WITH c AS ({CUSTOMERS}) SELECT 'left' AS kind, id, NULL AS field, NULL AS old_value FROM c WHERE id NOT IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'undo', id, 'segment', segment FROM c WHERE id % 4 = 1 AND segment IS DISTINCT FROM 'X'""")
def deleted_and_undone(spark: SparkSession, d: str) -> DataFrame:
    c = _customers(spark, d)
    left = dml.delete(c, table(spark, d, "orders").select(F.col("o_custkey").alias("id")), ["id"]).select(F.lit("left").alias("kind"), "id", F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("old_value"))
    after = c.withColumn("segment", F.when(F.col("id") % 4 == 1, "X").otherwise(F.col("segment")))
    return left.unionByName(dml.before_image(c, after, "id", ["segment", "balance"]).select(F.lit("undo").alias("kind"), "id", "field", "old_value"))


@query("constraint_report", """SELECT 'positive' AS kind, count(*) FILTER (c_acctbal <= 0) AS n FROM customer UNION ALL SELECT 'orphans', count(*) FROM orders WHERE o_custkey % 7 = 0 AND o_custkey IS NOT NULL
    UNION ALL SELECT 'twice', count(*) FROM (SELECT c_nationkey, c_mktsegment FROM customer GROUP BY 1, 2 HAVING count(*) > 1)""")
def constraint_report(spark: SparkSession, d: str) -> DataFrame:
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    known = dml.violations(c, {"positive": F.col("c_acctbal") > 0}).select(F.col("check").alias("kind"), F.col("violations").alias("n"))
    count = lambda kind, df: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
    lost = dml.orphans(o, "o_custkey", c.where("c_custkey % 7 <> 0"), "c_custkey")
    return known.unionByName(count("orphans", lost)).unionByName(count("twice", dml.duplicate_keys(c, ["c_nationkey", "c_mktsegment"])))


@query("published_checked", """SELECT n_nationkey AS id FROM nation WHERE n_nationkey < 20""")
def published_checked(spark: SparkSession, d: str) -> DataFrame:
    """The second version fails its check and the third is a trial, so the first stays."""
    path, n = _folder(spark, "published"), table(spark, d, "nation").select(F.col("n_nationkey").alias("id"))
    dml.publish(n.where("id < 20"), path, {"rows": lambda df: df.count() == 20})
    try:
        dml.publish(n, path, {"rows": lambda df: df.count() == 20})
    except ValueError:
        pass
    dml.publish(n.where("id < 3"), path, {}, dry_run=True)
    return spark.read.schema("id long").parquet(path)


SQUARES = "SELECT n_nationkey::BIGINT AS nation, (n_nationkey * 37) % 100 - 50 AS qlat, (n_nationkey * 101) % 320 - 160 AS qlon, n_nationkey % 6 AS risk FROM nation"
INSIDE = "lat > qlat - 10 AND lat < qlat + 10 AND lon > qlon - 10 AND lon < qlon + 10"


@query("polygon_choices", f"""WITH p AS ({_points('customer', 'c_custkey')}), q AS ({SQUARES}), h AS (SELECT id, nation, risk FROM p JOIN q ON {INSIDE})
    SELECT p.id, min(nation) AS first_nation, arg_min(nation, (risk, nation)) AS mildest, coalesce(max(risk), -1)::BIGINT AS severity FROM p LEFT JOIN h ON h.id = p.id GROUP BY 1""")
def polygon_choices(spark: SparkSession, d: str) -> DataFrame:
    """Of several polygons the first, the one least by a measure, and the greatest severity with a default for misses."""
    points, shapes = _places(table(spark, d, "customer"), "c_custkey"), _squares(table(spark, d, "nation")).withColumn("risk", F.col("nation") % 6)
    hits = spatial.in_polygon(points, shapes, "nation", cell=5.0)
    pick = lambda order, name: spatial.one_polygon(hits, shapes, "id", "nation", order).withColumnRenamed("nation", name)
    severe = spatial.with_severity(points, hits, shapes, "id", "nation", "risk", -1).select("id", F.col("risk").cast("long").alias("severity"))
    return severe.join(pick(F.lit(0), "first_nation"), "id", "left").join(pick(F.col("risk"), "mildest"), "id", "left")


@query("two_nearest", f"""WITH s AS ({_points('supplier', 's_suppkey')}), d AS (SELECT a.id AS id, b.id AS partner, {KM} AS km FROM s a JOIN s b ON a.id <> b.id)
    SELECT id, partner, round(km, 6) AS km, rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY km, partner) AS rank FROM d) WHERE rank <= 2 AND km <= 3000""")
def two_nearest(spark: SparkSession, d: str) -> DataFrame:
    """The two nearest others within 3,000 km."""
    s = _places(table(spark, d, "supplier"), "s_suppkey")
    found = spatial.nearest(s, s.withColumnRenamed("id", "partner"), "id", "partner", k=2, max_km=3000.0, exclude_equal_ids=True)
    return found.select("id", "partner", F.round("km", 6).alias("km"), "rank")


@query("nearest_of_kinds", f"""WITH s AS (SELECT *, 'k' || id % 3 AS kind FROM ({_points('supplier', 's_suppkey')})), d AS (SELECT a.id AS id, a.kind AS kind, b.kind AS other, {KM} AS km FROM s a JOIN s b ON a.kind <> b.kind)
    SELECT id, kind, round(min(km) FILTER (other = 'k0'), 6) AS km_k0, round(min(km) FILTER (other = 'k1'), 6) AS km_k1, round(min(km) FILTER (other = 'k2'), 6) AS km_k2, round(min(km), 6) AS km_other FROM d GROUP BY 1, 2""")
def nearest_of_kinds(spark: SparkSession, d: str) -> DataFrame:
    s = _places(table(spark, d, "supplier"), "s_suppkey").withColumn("kind", F.concat(F.lit("k"), F.col("id") % 3))
    right = s.withColumnRenamed("id", "partner")
    out = spatial.nearest_by_category(s, right, "id", "partner", "kind", ["k0", "k1", "k2"])
    return out.select("id", "kind", *[F.round(c, 6).alias(c) for c in ("km_k0", "km_k1", "km_k2", "km_other")])


@query("radius_totals", f"""WITH s AS ({_points('supplier', 's_suppkey', ', s_acctbal AS v')}), c AS ({_points('supplier', 's_suppkey')})
    SELECT a.id, round(coalesce(sum(b.v) FILTER ({KM} <= 800), 0), 2) AS within_800, round(coalesce(sum(b.v) FILTER ({KM} <= 2500), 0), 2) AS within_2500 FROM c a CROSS JOIN s b GROUP BY 1""")
def radius_totals(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    centres, points = _places(s, "s_suppkey"), _places(s, "s_suppkey").join(s.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("v")), "id")
    sums = spatial.radius_sums(centres, points, "id", "v", [800.0, 2500.0])
    return sums.select("id", *[F.round(c, 2).cast("double").alias(c) for c in ("within_800", "within_2500")])


MOVES = [(2, 1), (3, 1)]


@query("repointed_children", """SELECT o_orderkey, CASE WHEN o_custkey % 5 IN (2, 3) THEN o_custkey - o_custkey % 5 ELSE o_custkey END AS o_custkey FROM orders""")
def repointed_children(spark: SparkSession, d: str) -> DataFrame:
    moves = table(spark, d, "customer").where("c_custkey % 5 IN (2, 3)").select(F.col("c_custkey").alias("loser"), (F.col("c_custkey") - F.col("c_custkey") % 5).alias("winner"))
    return linkage.repoint(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", moves, "loser", "winner")


@query("canonical_wins", """SELECT a.c_custkey AS id, CASE WHEN b.c_custkey IS NULL THEN a.c_mktsegment ELSE CASE WHEN b.c_custkey % 4 <> 0 THEN b.c_mktsegment END END AS segment FROM
    (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS c_mktsegment, c_custkey % 10 AS to_id FROM customer) a LEFT JOIN customer b ON b.c_custkey = a.to_id""")
def canonical_wins(spark: SparkSession, d: str) -> DataFrame:
    """The row pointed at wins, nulls included."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(k.alias("id"), F.when(k % 4 != 0, F.col("c_mktsegment")).alias("segment"), (k % 10).alias("to"))
    return linkage.reconcile(rows, "to", "id", ["segment"]).select("id", "segment")


@query("blocked_pairs", """WITH l AS (SELECT c_custkey AS a, c_custkey // 5 AS k1, c_nationkey || ':' || c_custkey % 97 AS k2 FROM customer), r AS (SELECT s_suppkey AS b, s_suppkey AS k1, CASE WHEN s_suppkey % 3 <> 0 THEN s_nationkey || ':' || s_suppkey % 97 END AS k2 FROM supplier)
    SELECT DISTINCT a, b FROM l JOIN r ON l.k1 = r.k1 OR l.k2 = r.k2""")
def blocked_pairs(spark: SparkSession, d: str) -> DataFrame:
    key = lambda n, k: F.concat_ws(":", F.col(n).cast("string"), (F.col(k) % 97).cast("string"))
    blocks = [(F.floor(F.col("c_custkey") / 5), F.col("s_suppkey")), (key("c_nationkey", "c_custkey"), F.when(F.col("s_suppkey") % 3 != 0, key("s_nationkey", "s_suppkey")))]
    pairs = linkage.block_pairs(table(spark, d, "customer"), table(spark, d, "supplier"), "c_custkey", "s_suppkey", blocks)
    return pairs.select(F.col("c_custkey").alias("a"), F.col("s_suppkey").alias("b"))


@query("pending_work", """SELECT 'pending' AS kind, c_custkey::VARCHAR AS k, NULL::BIGINT AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 2 = 0)""")
def pending_work(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "orders").where("o_custkey % 2 = 0").select(F.col("o_custkey").alias("c_custkey"))
    left = increments.pending(table(spark, d, "customer").select("c_custkey"), done, "c_custkey")
    return left.select(F.lit("pending").alias("kind"), F.col("c_custkey").cast("string").alias("k"), F.lit(None).cast("long").alias("n"))
