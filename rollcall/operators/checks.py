"""Checks that compare parts of a record with reference tables, and what they change, as rows for the change log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def domain_conflicts(df: DataFrame, cities: DataFrame, id_col: str, email: str, state: str, *, city: str = "city", city_state: str = "state") -> DataFrame:
    """(id, old_value, city, expected): rows whose e-mail domain names a city that lies in none but other states.

    cities: names without blanks, in lower case, with their states; a city may have several. Of several cities that a
    domain names the longest that contradicts counts, then the first by name. Domains are cut into all strings of the
    cities' lengths, and these meet the cities by equality: no name is searched in every domain. Rows without a state, an
    e-mail or an @ are no conflict.
    """
    known = cities.where(F.col(city) != "").groupBy(F.lower(city).alias("word")).agg(F.array_sort(F.collect_set(city_state)).alias("states"))
    span = known.agg(F.min(F.length("word")).alias("low"), F.max(F.length("word")).alias("high"))  # one row
    domain = F.lower(F.split(F.col(email), "@")[1])
    rows = df.where(F.col(email).contains("@") & (F.col(state) != "")).select(F.col(id_col).alias("id"), F.col(email).alias("old_value"), F.col(state).alias("own"), domain.alias("domain"))
    domains = rows.select("domain").distinct().join(F.broadcast(span))
    pieces = F.flatten(F.transform(F.sequence(F.lit(1), F.length("domain")), lambda i: F.transform(F.sequence(F.col("low"), F.col("high")), lambda n: F.substring("domain", i, n))))
    named = domains.where((F.col("domain") != "") & F.col("low").isNotNull()).select("domain", F.explode(F.array_distinct(pieces)).alias("word")).join(known, "word")
    hits = rows.join(named, "domain").where(~F.array_contains("states", F.col("own")))
    first = hits.groupBy("id", "old_value").agg(F.min(F.struct((-F.length("word")).alias("l"), "word", "states")).alias("m"))
    return first.select(F.col("id").alias(id_col), "old_value", F.col("m.word").alias("city"), F.array_join("m.states", "|").alias("expected"))


def without_conflicts(df: DataFrame, conflicts: DataFrame, id_col: str, email: str, *also: str) -> DataFrame:
    """df with the e-mail of conflicting rows emptied, and the columns `also` nulled."""
    bad = conflicts.select(F.col(id_col).alias("__id")).distinct()
    hit = df.join(bad, F.col(id_col) == F.col("__id"), "left")
    bare = {email: F.when(F.col("__id").isNull(), F.col(email)).otherwise("")} | {c: F.when(F.col("__id").isNull(), F.col(c)) for c in also}
    return hit.withColumns(bare).drop("__id")


def conflict_log(conflicts: DataFrame, id_col: str, field: str) -> DataFrame:
    """(id, field, old_value, new_value, source) of what without_conflicts changes."""
    return conflicts.select(id_col, F.lit(field).alias("field"), "old_value", F.lit("").alias("new_value"), F.concat_ws("_", F.lit("sanity_clean"), "city", "expected").alias("source"))
