"""Coordinates and attributes by code: ZIP centres, precedence of geocoders, cross-checks, address merges, county tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_km
from ..functions.text import null_if_empty, zip_key


def by_zip(df: DataFrame, centres: DataFrame, zip_col: str, *, prefix: str = "zip") -> DataFrame:
    """df with the centre (prefix_lat, prefix_lon) of its ZIP code, read without +4 and padded to five digits; null on a miss."""
    c = centres.select(zip_key(F.col("zip")).alias("__z"), F.col("lat").alias(f"{prefix}_lat"), F.col("lon").alias(f"{prefix}_lon")).dropDuplicates(["__z"])
    return df.join(c, zip_key(F.col(zip_col)) == F.col("__z"), "left").drop("__z")


def geocoded(df: DataFrame, streets: DataFrame, centres: DataFrame, id_col: str, zip_col: str) -> DataFrame:
    """df with lat, lon and source: a street match (id, lat, lon) before the ZIP's centre; source is null without either."""
    s = streets.select(F.col(id_col), F.col("lat").alias("__la"), F.col("lon").alias("__lo"))
    both = by_zip(df, centres, zip_col, prefix="__zip").join(s, id_col, "left")
    exact = F.col("__la").isNotNull() & F.col("__lo").isNotNull()
    source = F.when(exact, "census_street").when(F.col("__zip_lat").isNotNull(), "zip_centroid")
    pick = lambda a, b: F.when(exact, F.col(a)).otherwise(F.col(b))
    return both.withColumns({"lat": pick("__la", "__zip_lat"), "lon": pick("__lo", "__zip_lon"), "source": source}).drop("__la", "__lo", "__zip_lat", "__zip_lon")


def wrong_places(places: DataFrame, hits: DataFrame, id_col: str, *, km: float = 50.0, many: int = 3, scattered_km: float = 300.0) -> DataFrame:
    """(id, hits, wrong): places (id, lat, lon) whose hits of the same name (id, lat, lon) all lie farther than km.

    With `many` or more hits of which two are over scattered_km apart the name is a common one, and nothing can be told
    (false); so it is without hits. Hits of one place are compared with each other; a search gives ten or so.
    """
    h = hits.where("lat IS NOT NULL AND lon IS NOT NULL").select(F.col(id_col), F.struct("lat", "lon").alias("h"))
    far = haversine_km(F.col("lat"), F.col("lon"), F.col("h.lat"), F.col("h.lon"))
    told = places.join(h, id_col).groupBy(id_col).agg(F.count(F.lit(1)).alias("hits"), F.min(far).alias("nearest"), F.collect_list("h").alias("all"))
    apart = F.array_max(F.flatten(F.transform("all", lambda a: F.transform("all", lambda b: haversine_km(a["lat"], a["lon"], b["lat"], b["lon"])))))
    wrong = (F.col("nearest") > km) & ~((F.col("hits") >= many) & (apart > scattered_km))
    out = places.select(id_col).join(told.select(id_col, "hits", wrong.alias("wrong")), id_col, "left")
    return out.select(id_col, F.coalesce("hits", F.lit(0)).cast("long").alias("hits"), F.coalesce("wrong", F.lit(False)).alias("wrong"))


def merged_address(df: DataFrame, sources: Sequence[str], fields: Sequence[str] = ("city", "state", "zip"), street: str = "street") -> DataFrame:
    """df with each field filled from the first of sources (prefixes of columns) that has it, blanks as none; a street with a
    house number goes before one without."""
    value = lambda f, s: null_if_empty(F.trim(F.col(f"{s}_{f}")))
    streets = [value(street, s) for s in sources]
    numbered = F.coalesce(*[F.when(c.rlike(r"^\d+"), c) for c in streets])
    return df.withColumns({street: F.coalesce(numbered, *streets), **{f: F.coalesce(*[value(f, s) for s in sources]) for f in fields}})


def with_attributes(df: DataFrame, table: DataFrame, key: str, columns: dict[str, str], width: int = 5) -> DataFrame:
    """df with the named columns of a table of codes (county, tract), cast to their types; codes are padded with zeros to
    width on both sides. One row a code in the table; a miss leaves nulls."""
    code = lambda c: F.lpad(F.trim(F.col(c).cast("string")), width, "0")
    t = table.select(code(key).alias("__c"), *[F.expr(f"try_cast(`{c}` AS {kind})").alias(c) for c, kind in columns.items()]).dropDuplicates(["__c"])
    return df.join(t, code(key) == F.col("__c"), "left").drop("__c")
