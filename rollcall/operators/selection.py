"""Exact order statistics by group, by selection: histograms first, then ranks within the one bucket that holds a place.

No task sorts the values of a group. Every pass counts the values of a group in equal buckets between their least and their
greatest, in partial sums; the bucket in which a place lies is kept, with the rank that is left, and the rows of the other
buckets go. After few passes a bucket has few values or only one, whatever the distribution, as each pass looks between
the least and the greatest value of the bucket itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .settled import discard, settle

#: Buckets of a pass, and rows of a bucket that are ranked as they are.
BUCKETS, FEW = 4096, 20_000
#: Targets up to this number are broadcast to the rows; more are joined by a shuffle.
MOST_TARGETS = 50_000


def values_at(df: DataFrame, keys: Sequence[str], value: str, places: dict[str, Column]) -> DataFrame:
    """(keys, name...): for each name the value at a place among the group's values in ascending order, nulls left out.

    places: expressions of `n`, the group's number of values, counted from 0; places outside are moved to the ends. Values
    are numbers, dates or timestamps, and keep their type; NaN is greater than all others. Null keys are a group. Groups without a value have no row.
    """
    number = {"date": lambda c: F.unix_date(c), "timestamp": lambda c: c.cast("double"), "timestamp_ntz": lambda c: c.cast("timestamp").cast("double")}.get(df.schema[value].dataType.simpleString(), lambda c: c)
    key_names = [f"__k{i}" for i in range(max(1, len(keys)))]  # without keys all rows are one group
    rows = df.where(F.col(value).isNotNull()).select(*[F.col(k).alias(n) for k, n in zip(keys, key_names, strict=False)] or [F.lit(0).alias("__k0")], F.col(value).alias("v"), number(F.col(value)).cast("double").alias("x"))
    rows = rows.withColumn("x", F.when(F.isnan("x"), F.lit(1.7976931348623157e308)).otherwise(F.greatest(F.least("x", F.lit(1.7976931348623157e308)), F.lit(-1.7976931348623157e308))))
    path = [*[f"{n}" for n in key_names], "path"]
    first = rows.groupBy(*key_names).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.greatest(F.lit(0), F.least(F.floor(at).cast("long"), F.col("n") - 1)).alias("rank")) for name, at in places.items()]))
    targets = first.select(*key_names, F.lit("").alias("path"), "n", "low", "high", wanted.alias("t")).select(*path, "n", "low", "high", "t.name", "t.rank")
    rows, held = rows.withColumn("path", F.lit("")), []
    crowded = not first.where((F.col("n") > FEW) & (F.col("high") > F.col("low"))).isEmpty()
    if crowded:
        targets = settle(targets, "targets")
    while crowded:
        open_targets = targets.where((F.col("n") > FEW) & (F.col("high") > F.col("low")))
        if open_targets.isEmpty():
            break
        done = targets.where((F.col("n") <= FEW) | (F.col("high") <= F.col("low")))
        # half-differences don't overflow; every step is monotone, so that a smaller value never has a higher bucket
        share = F.try_divide(F.col("x") / 2 - F.col("low") / 2, F.col("high") / 2 - F.col("low") / 2)
        bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
        ranges = open_targets.select(*path, "low", "high").distinct()
        dealt = _beside(rows, ranges, path).withColumn("bucket", bucket)
        counts = dealt.groupBy(*path, "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        before = F.sum("n").over(Window.partitionBy(*path).orderBy("bucket")) - F.col("n")  # BUCKETS rows at most
        sums = counts.withColumn("before", before)
        on = [open_targets[c].eqNullSafe(sums[c]) for c in path] + [open_targets["rank"] >= sums["before"], open_targets["rank"] < sums["before"] + sums["n"]]
        deeper = F.concat(open_targets["path"], F.lit("/"), sums["bucket"].cast("string")).alias("path")
        inner = open_targets.join(sums, on).select(*[open_targets[k] for k in key_names], deeper, sums["n"], sums["low"], sums["high"], "name", (F.col("rank") - F.col("before")).alias("rank"))
        after = settle(inner.unionByName(done), "targets")
        kept = after.where("path <> ''").select(*path).distinct()
        # rows of ranges that are done already go on as they are, those of the others by their bucket
        still = dealt.withColumn("path", F.concat("path", F.lit("/"), F.col("bucket").cast("string"))).select(*rows.columns)
        rest = _beside(rows, done.select(*path).distinct(), path).select(*rows.columns)
        rows = settle(_beside(still, kept, path).unionByName(rest), "selected")
        discard(targets, *held)
        targets, held = after, [rows]
    if crowded:  # else every group is one that is ranked whole
        rows = _beside(rows, targets.select(*path).distinct(), path)
    counts = rows.groupBy(*path, "v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*path).orderBy("v"))
    ranked = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
    on = [targets[c].eqNullSafe(ranked[c]) for c in path] + [targets["rank"] >= ranked["before"], targets["rank"] < ranked["upto"]]
    found = targets.join(ranked, on).select(*[targets[k] for k in key_names], "name", "v")
    out = found.groupBy(*key_names).agg(*[F.first(F.when(F.col("name") == name, F.col("v")), ignorenulls=True).alias(name) for name in places])
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, key_names, strict=False)], *places)


def _beside(rows: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """rows with the columns of side, which has one row for each value of `on`; null keys are equal."""
    small = side.limit(MOST_TARGETS + 1).count() <= MOST_TARGETS
    side = side.withColumnsRenamed({c: f"__{c}" for c in on})
    return rows.join(F.broadcast(side) if small else side, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on]).drop(*[f"__{c}" for c in on])


def percentile_at_offset(df: DataFrame, keys: Sequence[str], value: str, share: float, out: str) -> DataFrame:
    """The value at place int(n * share), counted from 0, among the non-null values of each key in ascending order."""
    return values_at(df, keys, value, {out: F.floor(F.col("n") * F.lit(share))})


def quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(keys, name...): the quantile of each share, between the two values next to (n - 1) * share in proportion, as double."""
    places, parts = {}, {}
    for name, share in shares.items():
        at = (F.col("n") - 1) * F.lit(share)
        places |= {f"__lo_{name}": F.floor(at), f"__hi_{name}": F.floor(at) + 1}
        parts[name] = share
    n = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    found = values_at(df, keys, value, places)
    both = found.join(n, [found[k].eqNullSafe(n[k]) for k in keys]) if keys else found.crossJoin(n)
    rest = lambda share: (F.col("__n") - 1) * F.lit(share) - F.floor((F.col("__n") - 1) * F.lit(share))
    value_of = lambda name, share: F.col(f"__lo_{name}").cast("double") + rest(share) * (F.col(f"__hi_{name}").cast("double") - F.col(f"__lo_{name}").cast("double"))
    return both.select(*[found[k] for k in keys], *[value_of(name, share).alias(name) for name, share in parts.items()])
