"""Readers and writers for the file formats in use; all lazy, distributed and without schema inference on large inputs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import split_city_state


def read_delimited(spark: SparkSession, path: str, schema: str, *, sep: str = ",", encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """CSV or TSV with a header, gzip included. Names come from schema, so byte-order marks and padded headers don't matter.

    Columns are read as text and cast: values that don't parse are null, rows are kept. Read Latin-1 with its encoding.
    multi_line: quoted values may hold line ends; such files are read whole, one a task, so it is off unless asked for.
    """
    want = T.StructType.fromDDL(schema)
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in want])
    df = spark.read.option("header", True).option("enforceSchema", True).option("sep", sep).option("encoding", encoding).option("multiLine", multi_line).option("escape", '"').schema(raw).csv(path)
    return df.select(*[F.trim(f.name).try_cast(f.dataType).alias(f.name) for f in want])


def read_zipped_lines(spark: SparkSession, path: str, suffix: str = ".csv") -> DataFrame:
    """(path, member, line_no, line) of the text members of zip files; a task holds one archive's bytes."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import zipfile

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(body)) as z:
                    for member in sorted(n for n in z.namelist() if n.endswith(suffix)):
                        with z.open(member) as f:
                            lines = [x.rstrip("\r\n") for x in io.TextIOWrapper(f, "utf-8-sig", errors="replace")]
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(lines)), pa.array([member] * len(lines)), pa.array(range(len(lines)), pa.int64()), pa.array(lines, pa.string())], names=["path", "member", "line_no", "line"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(unpack, "path string, member string, line_no long, line string")


def read_zipped_csv(spark: SparkSession, path: str, schema: str, *, sep: str = ",", suffix: str = ".csv") -> DataFrame:
    """The rows of the CSV members of zip files, with header, as read_delimited gives them; one archive is a task's share."""
    lines = read_zipped_lines(spark, path, suffix).where("line_no > 0 AND trim(line) <> ''")
    want = T.StructType.fromDDL(schema)
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in want])
    rows = lines.select(F.from_csv("line", raw.simpleString()[len("struct<") : -1].replace(":", " "), {"sep": sep, "escape": '"'}).alias("r"))
    return rows.select(*[F.trim(F.col(f"r.{f.name}")).try_cast(f.dataType).alias(f.name) for f in want])


def read_json_lines(spark: SparkSession, path: str, schema: str, *, array: bool = False) -> DataFrame:
    """JSON lines, or (array=True) files that each hold one array."""
    return spark.read.schema(schema).option("multiLine", array).json(path)


def read_geojson_points(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """The points of FeatureCollections: properties, lon, lat."""
    schema = f"features array<struct<geometry: struct<type: string, coordinates: array<double>>, properties: struct<{properties}>>>"
    features = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f")).where("f.geometry.type = 'Point'")
    return features.select("f.properties.*", F.get("f.geometry.coordinates", F.lit(0)).alias("lon"), F.get("f.geometry.coordinates", F.lit(1)).alias("lat"))


def _polygon_parts(spark: SparkSession, path: str, properties: str, lines: bool) -> DataFrame:
    """(f, parts) of polygons and multipolygons: parts of rings of [x, y] pairs; other geometries have null parts."""
    schema = f"geometry struct<type: string, coordinates: string>, properties struct<{properties}>"
    if lines:
        features = spark.read.schema(schema).json(path).select(F.struct("geometry", "properties").alias("f"))
    else:
        whole = spark.read.schema(f"features array<struct<{schema.replace('geometry ', 'geometry: ').replace(', properties ', ', properties: ')}>>")
        features = whole.option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    many = "array<array<array<array<double>>>>"
    one = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    parts = F.when(F.col("f.geometry.type") == "Polygon", F.array(one)).when(F.col("f.geometry.type") == "MultiPolygon", F.from_json("f.geometry.coordinates", many))
    return features.select("f", parts.alias("parts"))


def _corners(ring: Column) -> Column:
    return F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def read_geojson_polygons(spark: SparkSession, path: str, properties: str, *, lines: bool = False) -> DataFrame:
    """The rings of polygons and multipolygons: properties, part, ring_no (0 is the shell), ring (array of x, y).

    FeatureCollections are read whole, one a task; lines: a feature a line, as `write_geojson_lines` writes them. Other
    geometries and features without one give no row.
    """
    rings = _polygon_parts(spark, path, properties, lines).select("f.properties.*", F.posexplode("parts").alias("part", "rings"))
    return rings.select("*", F.posexplode("rings").alias("ring_no", "__r")).withColumn("ring", _corners(F.col("__r"))).drop("rings", "__r")


def read_geojson_features(spark: SparkSession, path: str, properties: str, *, lines: bool = False) -> DataFrame:
    """Polygons and multipolygons whole: properties, and rings, all rings of all parts as one array, for `in_polygon`."""
    rings = F.transform(F.flatten("parts"), _corners)
    return _polygon_parts(spark, path, properties, lines).where("parts IS NOT NULL").select("f.properties.*", rings.alias("rings"))


def write_geojson_polygons(df: DataFrame, path: str, rings: str, properties: Sequence[str]) -> None:
    """One GeoJSON polygon a line, with all its rings; parallel, whatever the size."""
    pairs = F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"].cast("double"), p["y"].cast("double"))))
    shape = F.struct(F.lit("Polygon").alias("type"), pairs.alias("coordinates"))
    df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*properties).alias("properties")), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in every file, quotes doubled, nulls empty; a folder of files, written by all tasks."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_feature_collection(df: DataFrame, path: str, lat: str, lon: str, properties: Sequence[str]) -> None:
    """One FeatureCollection a file, written by all tasks; partitions without rows write an empty one."""
    schema = "value string"
    features = df.select(_point_feature(lat, lon, properties).alias("value"))

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            lines = []
            for value in batch.column(0).to_pylist():
                lines.append(('{"type":"FeatureCollection","features":[' if first else ",") + value)
                first = False
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(['{"type":"FeatureCollection","features":[]}' if first else "]}"], pa.string())], names=["value"])

    features.mapInArrow(wrap, schema).write.mode("overwrite").text(path)


def _point_feature(lat: str, lon: str, properties: Sequence[str]):
    here = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    point = F.when(here, F.struct(F.lit("Point").alias("type"), F.array(F.col(lon).cast("double"), F.col(lat).cast("double")).alias("coordinates")))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*properties).alias("properties")), {"ignoreNullFields": "false"})


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def read_with_path(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with the file that each row comes from."""
    return spark.read.parquet(path).withColumn("file_path", F.col("_metadata.file_path"))


def read_latest_partition(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """The rows of the largest value of a partition column; only its files are read."""
    df = spark.read.parquet(path)
    last = df.agg(F.max(partition)).first()[0]
    return df.where(F.col(partition) == F.lit(last))


def decode_wkb_polygons(df: DataFrame, id_col: str, wkb: str) -> DataFrame:
    """(id, ring_no, ring): the rings of WKB polygons and multipolygons as arrays of (x, y); ring 0 of a part is its shell."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import struct

        def polygon(b: bytes, at: int) -> tuple[list, int]:
            order = "<" if b[at] else ">"
            kind, n = struct.unpack_from(order + "II", b, at + 1)
            at += 9
            rings = []
            if kind == 6:
                for _ in range(n):
                    more, at = polygon(b, at)
                    rings += more
                return rings, at
            for k in range(n):
                (m,) = struct.unpack_from(order + "I", b, at)
                flat = struct.unpack_from(f"{order}{2 * m}d", b, at + 4)
                at += 4 + 16 * m
                rings.append((k, [{"x": x, "y": y} for x, y in zip(flat[::2], flat[1::2], strict=True)]))
            return rings, at

        for batch in batches:
            ids, numbers, out = [], [], []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for k, ring in polygon(value, 0)[0] if value else []:
                    ids.append(key)
                    numbers.append(k)
                    out.append(ring)
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(numbers, pa.int32()), pa.array(out, pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))], names=[id_col, "ring_no", "ring"])

    schema = df.select(id_col).schema.add("ring_no", "integer").add("ring", T.ArrayType(T.StructType.fromDDL("x double, y double")))
    return df.select(id_col, wkb).mapInArrow(decode, schema)


def html_tables(df: DataFrame, id_col: str, html: str) -> DataFrame:
    """(id, row, cells): the rows of all tables of a page, in order, cells as trimmed text without tags."""
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), 1)
    cell = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"), 1), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]*>", " "), r"\s+", " ")))
    return df.select(id_col, F.posexplode(F.transform(rows, cell)).alias("row", "cells"))


def write_csv_by_state(df: DataFrame, path: str, city_state: str) -> None:
    """CSV with a folder for each state that is read from a `City, ST` column; others go to state=__none__."""
    state = F.coalesce(split_city_state(F.col(city_state))["state"], F.lit("__none__"))
    df.withColumn("state", state).write.mode("overwrite").option("header", True).partitionBy("state").csv(path)


def write_geojson_lines(df: DataFrame, path: str, lat: str, lon: str, properties: Sequence[str]) -> None:
    """One GeoJSON feature a line: parallel, whatever the size. Rows without coordinates have a null geometry."""
    df.select(_point_feature(lat, lon, properties).alias("value")).write.mode("overwrite").text(path)


def markdown_table(df: DataFrame, rows: int) -> str:
    """The first rows as a Markdown table; for reports, `rows` at most come to the driver."""
    head = df.limit(rows).collect()
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *map(line, head)])
