"""Queries that match places and give them coordinates and attributes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import geocode, matching, spatial
from ..operators.settled import shared_dir
from ..sources import files
from .curation import _places as _around
from .curation import _points
from .registry import query, table

#: Suppliers and customers on a lattice so that some share cells, some lie next to each other, and some lack a place.
_AT = "CASE WHEN {k} % 17 = 0 THEN NULL ELSE 40 + ({k} * 7 % 50) * 0.004 END AS lat, -87 + ({k} * 3 % 40) * 0.004 AS lon"
HAVERSINE = "2 * 6371.0088 * asin(sqrt(least(1.0, power(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * power(sin(radians({d} - {b}) / 2), 2))))"


def _places(df: DataFrame, key: str, *more) -> DataFrame:
    k = F.col(key)
    lat = F.when(k % 17 == 0, F.lit(None)).otherwise(F.lit(40) + (k * 7 % 50) * 0.004)
    return df.select(k.alias("id"), lat.cast("double").alias("lat"), (F.lit(-87) + (k * 3 % 40) * 0.004).alias("lon"), *more)


KM = HAVERSINE.format(a="l.lat", b="l.lon", c="r.lat", d="r.lon")


@query(
    "near_and_alike",
    f"""WITH l AS (SELECT p_partkey AS id, p_name AS name, {_AT.format(k="p_partkey")} FROM part), r AS (SELECT p_partkey + 1000000 AS id, p_name || ' co' AS name, lat + 0.001 AS lat, lon FROM (SELECT *, {_AT.format(k="p_partkey")} FROM part)),
    h AS (SELECT l.id AS a, r.id AS b, round(jaro_winkler_similarity(l.name, r.name), 6) AS score FROM l JOIN r ON r.lat BETWEEN l.lat - 0.006 AND l.lat + 0.006 AND r.lon BETWEEN l.lon - 0.008 AND l.lon + 0.008 WHERE {KM} <= 0.5 AND jaro_winkler_similarity(l.name, r.name) >= 0.9)
    SELECT a AS id, min(b) FILTER (score = best)::BIGINT AS partner, max(score) AS score FROM (SELECT *, max(score) OVER (PARTITION BY a) AS best FROM h) GROUP BY a""",
)
def near_and_alike(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    left = _places(part, "p_partkey", F.col("p_name").alias("name"))
    right = _places(part, "p_partkey", F.concat("p_name", F.lit(" co")).alias("name")).select((F.col("id") + 1_000_000).alias("partner"), (F.col("lat") + 0.001).alias("lat"), "lon", "name")
    return matching.near_alike(left, right, "id", "partner", "name").withColumn("score", F.round("score", 6))


@query(
    "guarded_names",
    f"""WITH l AS (SELECT c_custkey AS id, 'n' || c_custkey AS name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 2 END AS region, {_AT.format(k="c_custkey")} FROM customer),
    r AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 10 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN 'n' || p_partkey // 9 ELSE 'n' || p_partkey // 2 END AS name, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_partkey % 2 END AS region, {_AT.format(k="p_partkey")} FROM part)
    SELECT l.id, r.id AS partner FROM l JOIN r USING (name) WHERE name <> '' AND name IN (SELECT name FROM r GROUP BY 1 HAVING count(*) < 3)
      AND (l.region IS NULL OR r.region IS NULL OR l.region = r.region) AND (l.lat IS NULL OR r.lat IS NULL OR {KM} <= 12)""",
)
def guarded_names(spark: SparkSession, d: str) -> DataFrame:
    c, p, k = table(spark, d, "customer"), table(spark, d, "part"), F.col("p_partkey")
    region = lambda k, m: F.when(F.col(k) % m == 0, F.lit(None)).otherwise(F.col(k) % 2).alias("region")
    named = lambda n: F.concat(F.lit("n"), n.cast("string"))
    left = _places(c, "c_custkey", named(F.col("c_custkey")).alias("name"), region("c_custkey", 5))
    right = _places(p, "p_partkey", F.when(k % 10 == 0, "").when(k % 3 == 0, named(F.floor(k / 9))).otherwise(named(F.floor(k / 2))).alias("name"), region("p_partkey", 7))
    return matching.same_name_guarded(left, right.withColumnRenamed("id", "partner"), "id", "partner", "name", "region", km=12)


@query(
    "cell_first",
    f"""WITH r AS (SELECT p_partkey AS id, {_AT.format(k="p_partkey")} FROM part), l AS (SELECT c_custkey AS id, {_AT.format(k="c_custkey")} FROM customer),
    m AS (SELECT round(lat, 4) AS y, round(lon, 4) AS x, min(id) AS partner FROM r WHERE lat IS NOT NULL GROUP BY 1, 2)
    SELECT 'first' AS kind, l.id, partner FROM l JOIN m ON y = round(lat, 4) AND x = round(lon, 4)
    UNION ALL SELECT 'free', l.id, NULL FROM l WHERE lat IS NULL OR NOT EXISTS (SELECT 1 FROM (SELECT n_nationkey, {_AT.format(k="n_nationkey")} FROM nation) r WHERE round(r.lat, 2) = round(l.lat, 2) AND round(r.lon, 2) = round(l.lon, 2))""",
)
def cell_first(spark: SparkSession, d: str) -> DataFrame:
    left, right = _places(table(spark, d, "customer"), "c_custkey"), _places(table(spark, d, "part"), "p_partkey")
    first = matching.same_cell_first(left, right.withColumnRenamed("id", "partner"), "id", "partner").select(F.lit("first").alias("kind"), "id", "partner")
    free = matching.without_occupied(left, _places(table(spark, d, "nation"), "n_nationkey")).select(F.lit("free").alias("kind"), "id", F.lit(None).cast("long").alias("partner"))
    return first.unionByName(free)


@query(
    "county_attributes",
    """SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey * 1.5 END::DOUBLE AS rate, CASE WHEN c_nationkey % 2 = 0 AND c_nationkey % 3 <> 0 THEN c_nationkey END::BIGINT AS flag FROM customer""",
)
def county_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Codes without leading zeros meet padded ones; values that are no numbers become null; odd codes have no row."""
    k = F.col("n_nationkey")
    attributes = table(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.lpad(k.cast("string"), 5, "0").alias("fips"), (k * 1.5).cast("string").alias("rate"), F.when(k % 3 == 0, "n/a").otherwise(k.cast("string")).alias("flag"))
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("fips"))
    return geocode.with_attributes(rows, attributes, "fips", {"rate": "double", "flag": "bigint"}).select("c_custkey", "rate", "flag")


#: A square of 20 degrees around each nation's place with a diamond as a hole, a square island in the hole, and a second part.
FEATURES = "SELECT n_nationkey::BIGINT AS nation, (n_nationkey * 37) % 100 - 50 AS qlat, (n_nationkey * 101) % 320 - 160 AS qlon FROM nation"
IN_FEATURE = "(abs(lon - qlon) < 10.05 AND abs(lat - qlat) < 10.05 AND NOT abs(lon - qlon) + abs(lat - qlat) < 6.05) OR (abs(lon - qlon) < 1.55 AND abs(lat - qlat) < 1.55) OR abs(lon - qlon) + abs(lat - qlat - 24) < 7.05"


def _features(df: DataFrame, wider: float = 0.0) -> DataFrame:
    k = F.col("n_nationkey")
    lat, lon = (k * 37) % 100 - 50, (k * 101) % 320 - 160
    ring = lambda corners: F.array(*[F.struct((lon + x).cast("double").alias("x"), (lat + y).cast("double").alias("y")) for x, y in corners])
    square = lambda r: ring([(-r, -r), (r, -r), (r, r), (-r, r)])
    diamond = lambda r, up: ring([(0, up - r), (r, up), (0, up + r), (-r, up)])
    return df.select(k.cast("long").alias("nation"), F.array(square(10 + wider), diamond(6 + wider, 0), square(1.5 + wider), diamond(7 + wider, 24)).alias("rings"))


@query(
    "points_in_features",
    f"""WITH p AS ({_points('customer', 'c_custkey')}), q AS ({FEATURES}) SELECT p.id, q.nation FROM p JOIN q ON {IN_FEATURE}""",
)
def points_in_features(spark: SparkSession, d: str) -> DataFrame:
    """Polygons with a hole, an island in it and a second part, written as GeoJSON and read back."""
    path = f"{shared_dir(spark)}/features-{uuid.uuid4().hex}"
    files.write_geojson_polygons(_features(table(spark, d, "nation"), 0.05), path, "rings", ["nation"])
    shapes = files.read_geojson_features(spark, path, "nation: long", lines=True)
    return spatial.in_polygon(_around(table(spark, d, "customer"), "c_custkey"), shapes, "nation", ring="rings", cell=2.0).select("id", "nation")


@query(
    "edge_points",
    """WITH p AS (SELECT s_suppkey::BIGINT AS id, s_nationkey::BIGINT AS nation, (s_nationkey * 37) % 100 - 50 + CASE s_suppkey % 4 WHEN 0 THEN 10 WHEN 1 THEN 3 WHEN 2 THEN 24 ELSE 1 END AS lat,
        (s_nationkey * 101) % 320 - 160 + CASE s_suppkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 7 ELSE 0.5 END AS lon FROM supplier)
    SELECT id, true AS touches, id % 4 = 3 AS inside FROM p""",
)
def edge_points(spark: SparkSession, d: str) -> DataFrame:
    """Points on the shell, on the hole's slope and at a corner of the second part touch their nation's feature, and only those within are inside."""
    k, kind = F.col("s_nationkey"), F.col("s_suppkey") % 4
    at = lambda a, b, c, e: F.when(kind == 0, a).when(kind == 1, b).when(kind == 2, c).otherwise(e)
    s = table(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("id"), k.cast("long").alias("own"), ((k * 37) % 100 - 50 + at(10.0, 3.0, 24.0, 1.0)).alias("lat"), ((k * 101) % 320 - 160 + at(2.0, 3.0, 7.0, 0.5)).alias("lon"))
    shapes = _features(table(spark, d, "nation"))
    found = lambda edges, name: spatial.in_polygon(s, shapes, "nation", ring="rings", cell=2.5, edges=edges).where("own = nation").select("id", F.lit(True).alias(name))
    return s.select("id").join(found(True, "touches"), "id", "left").join(found(False, "inside"), "id", "left").fillna(False)
