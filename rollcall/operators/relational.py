"""Relational building blocks that DataFrames lack under one name: best rows, bands, offsets, shares, indices, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key, the first in `order` (give a total order). Null keys are a key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def top_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank_name: str = "rank") -> DataFrame:
    """The first k rows of each key, with their rank from 1; Spark cuts each task's rows to k before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank_name, rank).where(F.col(rank_name) <= k)


def band(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """The label of the band (edges[i], edges[i + 1]] that holds value; null outside all bands and for nulls."""
    assert len(edges) == len(labels) + 1 and list(edges) == sorted(edges)
    out = F.when((value <= edges[0]) | value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels, strict=True):
        out = out.when(value <= edge, F.lit(label))
    return out.otherwise(F.lit(None).cast("string"))


def strict_least(*values: Column) -> Column:
    """The smallest of values; null if any is null (F.least skips nulls)."""
    return _if_all(values, F.least(*values))


def strict_greatest(*values: Column) -> Column:
    return _if_all(values, F.greatest(*values))


def _if_all(values: Sequence[Column], result: Column) -> Column:
    every = values[0].isNotNull()
    for v in values[1:]:
        every = every & v.isNotNull()
    return F.when(every, result)


def glob(value: Column, pattern: str) -> Column:
    """Case-sensitive match of the whole value: * any run, ? one character, [...] a set, [^...] its complement."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "[" and (end := pattern.find("]", i + 2)) > 0:
            out, i = out + "[" + pattern[i + 1 : end].replace("\\", "\\\\") + "]", end
        else:
            out += {"*": "(?s:.*)", "?": "(?s:.)"}.get(c) or (c if c.isalnum() or c == " " else "\\" + c)
        i += 1
    return value.rlike(f"^{out}$")


def missing_report(df: DataFrame, columns: Sequence[str], blank_is_missing: bool = True) -> DataFrame:
    """(column, missing, total, pct_missing) for each of columns, in one pass."""
    gone = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "" if blank_is_missing else F.lit(False))
    one = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(gone(c)).alias(f"m{i}") for i, c in enumerate(columns)])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(columns)]))
    return one.select("total", pairs.alias("p")).select("p.column", "p.missing", "total", F.round(F.try_divide(F.col("p.missing") * 100.0, F.col("total")), 2).alias("pct_missing"))


def share_of(df: DataFrame, value: str, within: Sequence[str], out: str) -> DataFrame:
    """Adds value as a share of its sum within the keys `within` (all rows if empty); null where that sum is 0.

    The sums are aggregated and joined back, so that no window gathers all rows in one task.
    """
    if within:
        sums = df.groupBy(*within).agg(F.sum(value).alias("__sum"))
        joined = df.join(sums, [df[k].eqNullSafe(sums[k]) for k in within]).drop(*[sums[k] for k in within])
    else:
        joined = df.crossJoin(F.broadcast(df.agg(F.sum(value).alias("__sum"))))  # one row
    return joined.withColumn(out, F.try_divide(F.col(value).cast("double"), F.col("__sum").cast("double"))).drop("__sum")


def standardise(df: DataFrame, columns: Sequence[str], low: float = -2.0, high: float = 2.0, population: bool = False) -> DataFrame:
    """Adds z_<column> for each: its distance from the mean in standard deviations, clipped; null if they are 0 or unknown."""
    std = F.stddev_pop if population else F.stddev_samp
    stats = df.agg(*[f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", std))])
    out = df.crossJoin(F.broadcast(stats))  # one row
    z = {f"z_{c}": F.least(F.greatest(F.try_divide(F.col(c) - F.col(f"__m_{c}"), F.col(f"__s_{c}")), F.lit(low)), F.lit(high)) for c in columns}
    return out.withColumns(z).drop(*stats.columns)


def index_to_average(df: DataFrame, columns: Sequence[str], composite: str) -> DataFrame:
    """Adds idx_<column>, the value over the average of all rows, and composite, the mean of the indices that are known."""
    stats = df.agg(*[F.avg(c).alias(f"__m_{c}") for c in columns])
    out = df.crossJoin(F.broadcast(stats))  # one row
    out = out.withColumns({f"idx_{c}": F.try_divide(F.col(c), F.col(f"__m_{c}")) for c in columns}).drop(*stats.columns)
    known = F.array_compact(F.array(*[F.col(f"idx_{c}") for c in columns]))
    return out.withColumn(composite, F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda s, x: s + x) / F.size(known)))


def arg_max_column(columns: Sequence[str]) -> Column:
    """The name of the column with the largest value, the first of them on ties; null if all are null."""
    entries = F.array(*[F.struct(F.col(c).cast("double").alias("v"), F.lit(-i).alias("o"), F.lit(c).alias("name")) for i, c in enumerate(columns)])
    return F.array_max(F.filter(entries, lambda e: e["v"].isNotNull()))["name"]


def mode_smallest(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """The most frequent non-null value of each key, the smallest of them on ties."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    return best_row(counts, keys, [F.desc("__n"), F.asc(value)]).select(*keys, F.col(value).alias(out))


def without_hot_keys(df: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """Rows whose key has fewer than `most` rows; the counts are taken with partial sums before any shuffle of rows."""
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= most).select(*keys)
    return df.join(hot, list(keys), "left_anti")


def group_ids(df: DataFrame, order: Sequence[Column], is_first: Column, keys: Sequence[str], out: str) -> DataFrame:
    """Numbers, from 0, the runs that begin where is_first holds, within each of keys (gaps and islands)."""
    running = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(F.when(is_first, 1).otherwise(0)).over(running) - 1)


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, out: str) -> DataFrame:
    running = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(running))


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """n rows in the order of a seeded hash of the id: the same rows however the table is partitioned."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary")), F.col(id_col)).limit(n)


def keyword_labels(df: DataFrame, text: str, keywords: DataFrame, id_col: str, *, keyword: str = "keyword", label: str = "label", most_keywords: int = 10_000) -> DataFrame:
    """(id, keyword, label): for each row the longest keyword, then the first by name, that its text holds.

    The keywords are broadcast; there must be at most most_keywords of them (checked).
    """
    n = keywords.count()
    if n > most_keywords:
        raise ValueError(f"{n} keywords; the limit for a broadcast is {most_keywords}")
    words = F.broadcast(keywords.select(F.lower(keyword).alias("keyword"), F.col(label).alias("label")))
    hits = df.select(F.col(id_col), F.lower(text).alias("__text")).join(words, F.contains(F.col("__text"), F.col("keyword")))
    first = hits.groupBy(id_col).agg(F.max(F.length("keyword")).alias("__len"), F.collect_set(F.struct("keyword", "label")).alias("__all"))
    longest = F.array_min(F.filter("__all", lambda e: F.length(e["keyword"]) == F.col("__len")))
    return first.select(id_col, longest["keyword"].alias("keyword"), longest["label"].alias("label"))


def not_in(df: DataFrame, key: str, listed: DataFrame, value: str) -> DataFrame:
    """The rows of df that SQL's NOT IN keeps: none if the list holds a null, all if it is empty, else those whose key is
    known and not in it.

    An anti join on the key; whether the list is empty or holds a null is one row that is joined to it.
    """
    values = listed.select(F.col(value).alias("__v"))
    told = F.broadcast(values.agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col("__v").isNull()).alias("__nulls")))  # one row
    rest = df.join(values, F.col(key) == F.col("__v"), "left_anti").crossJoin(told)
    return rest.where((F.col("__n") == 0) | ((F.col("__nulls") == 0) & F.col(key).isNotNull())).drop("__n", "__nulls")
