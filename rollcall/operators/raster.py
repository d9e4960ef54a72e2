"""Heights from square tiles of two-byte samples, one degree each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import raster_cell

#: The sample that says that nothing was measured.
VOID = -32768


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """(tile, content) of .hgt files, named as the tile's south-west corner (N40W087)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.hgt").load(path)
    return files.select(F.upper(F.regexp_extract("path", r"([^/]+)\.hgt$", 1)).alias("tile"), "content")


def tile_rows(tiles: DataFrame, side: int = 1201) -> DataFrame:
    """(tile, row, samples): the rows of tiles from north to south, as bytes; rows that a short file lacks are missing."""
    row = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    rows = tiles.select("tile", "content", row.alias("row"))
    return rows.select("tile", "row", F.substring("content", F.col("row") * (2 * side) + 1, F.lit(2 * side)).alias("samples")).where(F.octet_length("samples") > 0)


def sample(samples: Column, at: Column) -> Column:
    """The signed big-endian two-byte number at place `at`; null for voids and beyond the end."""
    pair = F.substring(samples, at * 2 + 1, F.lit(2))
    value = F.conv(F.hex(pair), 16, 10).cast("int")
    signed = F.when(value >= 1 << 15, value - (1 << 16)).otherwise(value)
    return F.when((F.octet_length(pair) == 2) & (signed > VOID), signed.cast("double"))


def with_heights(points: DataFrame, tiles: DataFrame, *, side: int = 1201, out: str = "height") -> DataFrame:
    """points with the sample nearest to them; null without coordinates, a tile or a measurement.

    Points meet the row of their tile that they lie in, some kilobytes, by equality of tile and row: neither a tile nor a
    crowded one's points are one task's.
    """
    cell = raster_cell(F.col("lat"), F.col("lon"), side)
    asked = points.withColumn("__c", cell)
    rows = tile_rows(tiles, side).withColumnsRenamed({"tile": "__t", "row": "__r"})
    found = asked.join(rows, (F.col("__c.tile") == F.col("__t")) & (F.col("__c.row") == F.col("__r")), "left")
    return found.withColumn(out, sample(F.col("samples"), F.col("__c.col"))).drop("__c", "__t", "__r", "samples")
