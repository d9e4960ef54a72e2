"""Rule classification: ordered patterns, longest code prefixes, priority cascades, scores and state machines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.relational import strict_least


def first_pattern(text: Column, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first regular expression (case-insensitive, Unicode) that is found in text."""
    out = F.when(text.isNull(), F.lit(default).cast("string"))
    for pattern, label in rules:
        out = out.when(text.rlike(f"(?iU){pattern}"), F.lit(label))
    return out.otherwise(F.lit(default).cast("string"))


def weighted_pattern(text: Column, rules: Sequence[tuple[str, str, float]]) -> Column:
    """A struct (label, confidence) of the most confident pattern that is found, the first of them on ties; else null."""
    hits = F.array(*[F.when(text.rlike(f"(?iU){p}"), F.struct(F.lit(float(c)).alias("confidence"), F.lit(-i).alias("o"), F.lit(label).alias("label"))) for i, (p, label, c) in enumerate(rules)])
    best = F.array_max(F.array_compact(hits))
    return F.when(best.isNotNull(), F.struct(best["label"].alias("label"), best["confidence"].alias("confidence")))


def longest_prefix(code: Column, table: Mapping[str, str], longest: int | None = None) -> Column:
    """The entry of the longest prefix of code that table holds; the whole code counts as a prefix."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    c = F.upper(F.trim(code))
    n = longest or max(map(len, table))
    return F.coalesce(*[F.try_element_at(entries, F.when(F.length(c) >= k, F.substring(c, 1, k))) for k in range(n, 0, -1)])


def prefix_join(df: DataFrame, code: str, table: DataFrame, prefix: str, label: str, longest: int) -> DataFrame:
    """df with label by the longest prefix that table (of any size) holds: one equi-join over the prefixes of each code."""
    codes = df.select(code).distinct().where(F.col(code).isNotNull())
    parts = codes.select(code, F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length(code), F.lit(longest))), lambda k: F.substring(F.col(code), F.lit(1), k))).alias("__p")).where(F.length(code) > 0)
    hits = parts.join(table.select(F.col(prefix).alias("__p"), F.col(label).alias("__l")), "__p")
    best = hits.groupBy(code).agg(F.max(F.struct(F.length("__p").alias("n"), F.col("__l"))).alias("b")).select(code, F.col("b.__l").alias(label))
    return df.join(best, code, "left")


def cascade(candidates: Sequence[tuple[str, Column]], unknown: str = "unknown") -> Column:
    """A struct (value, source): the first candidate that is neither null, blank nor `unknown`, with its name."""
    out = None
    for name, c in candidates:
        hit = c.isNotNull() & (F.trim(c) != "") & (F.lower(c) != unknown)
        pair = F.struct(c.alias("value"), F.lit(name).alias("source"))
        out = F.when(hit, pair) if out is None else out.when(hit, pair)
    return out.otherwise(F.struct(F.lit(unknown).alias("value"), F.lit("none").alias("source")))


def fallback(df: DataFrame, levels: Sequence[tuple[Sequence[str], DataFrame, str, float]], out: str, confidence: str) -> DataFrame:
    """Adds out and confidence from the first level whose table has a value for the row's keys.

    levels: (keys, table with unique keys, value column, confidence), from the finest to the coarsest.
    """
    for i, (keys, table, value, _) in enumerate(levels):
        df = df.join(table.select(*keys, F.col(value).alias(f"__v{i}")), list(keys), "left")
    values = [F.col(f"__v{i}") for i in range(len(levels))]
    sure = F.coalesce(*[F.when(v.isNotNull(), F.lit(level[3])) for v, level in zip(values, levels, strict=True)])
    return df.withColumns({out: F.coalesce(*values), confidence: sure}).drop(*[f"__v{i}" for i in range(len(levels))])


def collect_signals(signals: Sequence[tuple[str, Column]]) -> tuple[Column, Column]:
    """(flag, sources): whether any signal holds, and the names of those that do, joined by commas (null if none)."""
    found = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in signals]))
    return F.size(found) > 0, F.nullif(F.array_join(found, ","), F.lit(""))


# Statuses and where they may go from.
STATUS_STEPS = {
    "pending": ("found", "not_found", "error"), "found": ("verified", "not_found", "error"), "not_found": ("found", "error"),
    "verified": ("error",), "error": ("pending", "found", "not_found"),
}
FIRST_STATUS = ("pending",)
FROM_UNKNOWN = ("found", "not_found", "verified", "error")


def transition_allowed(
    old: Column, new: Column, allowed: Mapping[str, Sequence[str]] = STATUS_STEPS, first: Sequence[str] = FIRST_STATUS, unlisted: Sequence[str] = FROM_UNKNOWN
) -> Column:
    """Whether a status may change from old to new: from null or empty to `first`, from one that is not listed to `unlisted`.

    Staying is a change like any other. Never null: a null new status is not allowed.
    """
    pairs = F.array(*[F.lit(f"{a}>{b}") for a, bs in allowed.items() for b in bs])
    step = F.when(old.isNull() | (old == ""), new.isin(*first)).when(old.isin(*allowed), F.array_contains(pairs, F.concat(old, F.lit(">"), new)))
    return F.coalesce(step.otherwise(new.isin(*unlisted)), F.lit(False))


def needs_check(status: Column) -> Column:
    """Whether a record is still to be looked at: no status yet, pending or in error."""
    return F.coalesce(status.isin("", "pending", "error"), F.lit(True))


def is_done(status: Column) -> Column:
    return F.coalesce(status.isin("found", "not_found", "verified"), F.lit(False))


def capped_score(parts: Sequence[tuple[Column, float, float]], most: float = 100.0, places: int = 1) -> Column:
    """The sum over (value, weight, cap) of min(cap, value * weight), missing values as 0, at most `most`, rounded."""
    total = F.lit(0.0)
    for value, weight, cap in parts:
        total = total + F.coalesce(strict_least(value * F.lit(float(weight)), F.lit(float(cap))), F.lit(0.0))
    return F.round(F.least(total, F.lit(most)), places)


def saturation(population: Column, n: Column, served: float = 300.0) -> Column:
    """People for each place that n organisations of `served` seats offer; null without organisations."""
    return F.try_divide(population.cast("double"), n * F.lit(served))


def allocate(reported: Column, organisations: Column, listed: Column) -> Column:
    """A struct (value, confidence) of attendance for one of `listed` entries, from a report over `organisations`.

    A single one on both sides takes all at 1.0; equal numbers share evenly at 0.9; more organisations than entries share
    among the organisations at 0.7, fewer among the entries at 0.8. Nothing reported, or no organisation (0), gives a null
    at 0.0; a null number, or no entry, gives null.
    """
    share = lambda n: F.round(reported / n, 0)
    pair = lambda v, c: F.struct(v.cast("double").alias("value"), F.lit(c).alias("confidence"))
    out = F.when(reported.isNull() | organisations.isNull() | F.coalesce(listed <= 0, F.lit(True)), F.lit(None))
    out = out.when((organisations == 0) | (reported == 0), pair(F.lit(None), 0.0)).when((organisations == 1) & (listed == 1), pair(reported, 1.0))
    out = out.when(organisations == listed, pair(share(listed), 0.9)).when(organisations > listed, pair(share(organisations), 0.7))
    return out.otherwise(pair(share(listed), 0.8))


def filter_with_reasons(df: DataFrame, steps: Sequence[tuple[str, Column]], out: str = "reason") -> DataFrame:
    """Adds the name of the first step that a row fails (nulls fail), `passed` if none."""
    reason = None
    for name, holds in steps:
        fails = ~F.coalesce(holds, F.lit(False))
        reason = F.when(fails, F.lit(name)) if reason is None else reason.when(fails, F.lit(name))
    return df.withColumn(out, reason.otherwise(F.lit("passed")))
