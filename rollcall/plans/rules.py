"""Queries of shares and confidences; those of the other rules are in derived.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels, rules
from .registry import query, table


@query(
    "attendance_shares",
    """WITH t AS (SELECT c_custkey, c_custkey % 7 AS orgs, c_custkey % 5 AS listed, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 0 ELSE c_custkey % 997 END AS reported FROM customer)
    SELECT c_custkey, CASE WHEN reported IS NULL OR listed = 0 OR orgs = 0 OR reported = 0 THEN NULL WHEN orgs = 1 AND listed = 1 THEN reported WHEN orgs = listed THEN round(reported / listed)
      WHEN orgs > listed THEN round(reported / orgs) ELSE round(reported / listed) END::DOUBLE AS value,
      CASE WHEN reported IS NULL OR listed = 0 THEN NULL WHEN orgs = 0 OR reported = 0 THEN 0.0 WHEN orgs = 1 AND listed = 1 THEN 1.0 WHEN orgs = listed THEN 0.9 WHEN orgs > listed THEN 0.7 ELSE 0.8 END::DOUBLE AS confidence FROM t""",
)
def attendance_shares(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    reported = F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, 0).otherwise(k % 997)
    x = rules.allocate(reported, k % 7, k % 5)
    return table(spark, d, "customer").select("c_custkey", x["value"].alias("value"), x["confidence"].alias("confidence"))


@query(
    "field_confidences",
    """WITH t AS (SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN 'x.org' WHEN 1 THEN '' END AS w, CASE c_custkey % 4 WHEN 0 THEN 'a@x.org' WHEN 1 THEN '' END AS e,
      CASE c_custkey % 5 WHEN 0 THEN 0.8 WHEN 1 THEN 0.0 END AS z, CASE c_custkey % 7 WHEN 0 THEN 'census_street' WHEN 1 THEN 'zip_centroid' WHEN 2 THEN 'manual' END AS s, CASE WHEN c_custkey % 2 = 0 THEN 1.5 END AS lat FROM customer)
    SELECT k, CASE WHEN w <> '' THEN 0.7 WHEN w = '' THEN 0.3 END::DOUBLE AS website, CASE WHEN z > 0 THEN z WHEN e <> '' THEN 0.5 END::DOUBLE AS email,
      CASE WHEN s = 'census_street' THEN 0.95 WHEN s = 'zip_centroid' THEN 0.6 WHEN lat IS NOT NULL THEN 0.3 END::DOUBLE AS geocode, CASE WHEN s IS NULL THEN 'name' ELSE s || ',name' END AS sources FROM t""",
)
def field_confidences(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    one_of = lambda m, *vs: F.coalesce(*[F.when(k % m == i, F.lit(v)) for i, v in enumerate(vs)])
    s, lat = one_of(7, "census_street", "zip_centroid", "manual"), F.when(k % 2 == 0, 1.5)
    x = labels.field_confidence(one_of(3, "x.org", ""), one_of(4, "a@x.org", ""), one_of(5, 0.8, 0.0), lat, lat, s)
    return table(spark, d, "customer").select(k.alias("k"), *[x[c].alias(c) for c in ("website", "email", "geocode")], labels.with_source(s, "name").alias("sources"))
