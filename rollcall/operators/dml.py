"""Table changes as pure functions from DataFrames to the table after the change, and safe ways to publish it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import best_row


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c.cast("string")) != "", c)


def insert_ignore(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """target, and of each new key the first row by order; rows whose key target has, or holds a null, go as they would."""
    new = best_row(rows, keys, order).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def insert_or_replace(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """target with the last row by order of each key in rows put in its place."""
    new = best_row(rows, keys, order)
    return target.join(new.select(*keys), list(keys), "left_anti").unionByName(new.select(*target.columns))


def upsert(target: DataFrame, rows: DataFrame, keys: Sequence[str], policies: Mapping[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """Full outer join on keys (unique in rows); a column of a key that both have becomes policies[column](old, new).

    Columns without a policy keep the old value. A key only one side has keeps that side's row. One shuffle of each side.
    """
    old = target.withColumn("__old", F.lit(True)).alias("o")
    new = rows.withColumn("__new", F.lit(True)).alias("n")
    both = old.join(new, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full")
    had, has = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    out = [F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in keys]
    for c in target.columns:
        if c in keys:
            continue
        o = F.col(f"o.{c}")
        if c not in rows.columns:
            out.append(o.alias(c))
            continue
        n = F.col(f"n.{c}")
        merged = policies[c](o, n) if c in policies else o
        out.append(F.when(had & has, merged).when(had, o).otherwise(n).alias(c))
    return both.select(*out).select(*target.columns)


def take_new(old: Column, new: Column) -> Column:
    return new


def fill_null(old: Column, new: Column) -> Column:
    return F.coalesce(old, new)


def fill_blank(old: Column, new: Column) -> Column:
    return F.coalesce(blank_to_null(old), new)


def prefer_new_unless_blank(old: Column, new: Column) -> Column:
    return F.coalesce(blank_to_null(new), old)


def keep_larger(old: Column, new: Column) -> Column:
    return F.greatest(old, new)


def append_text(separator: str) -> Callable[[Column, Column], Column]:
    """Old and new text joined; a missing side leaves the other."""
    return lambda old, new: F.nullif(F.concat_ws(separator, blank_to_null(old), blank_to_null(new)), F.lit(""))


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], policies: Mapping[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """target with the policies applied where source has its key (keys unique in source); no row comes or goes."""
    return upsert_matched(target, source, keys, policies)


def upsert_matched(target: DataFrame, source: DataFrame, keys: Sequence[str], policies: Mapping[str, Callable[[Column, Column], Column]]) -> DataFrame:
    new = source.select(*keys, *policies).withColumn("__hit", F.lit(True)).alias("n")
    both = target.alias("o").join(new, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "left")
    hit = F.col("__hit").isNotNull()
    return both.select(*[F.when(hit, policies[c](F.col(f"o.{c}"), F.col(f"n.{c}"))).otherwise(F.col(f"o.{c}")).alias(c) if c in policies else F.col(f"o.{c}") for c in target.columns])


def update_counts(target: DataFrame, children: DataFrame, key: str, foreign_key: str, out: str) -> DataFrame:
    """Sets out to the number of children of each row; children are counted before the join."""
    n = children.groupBy(F.col(foreign_key).alias("__fk")).agg(F.count(F.lit(1)).alias("__n"))
    return target.join(n, F.col(key) == F.col("__fk"), "left").withColumn(out, F.coalesce("__n", F.lit(0))).drop("__fk", "__n")


def delete(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(gone.select(*keys), list(keys), "left_anti")


def before_image(target: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, field, old_value): what an undo has to write, for the fields that after changes."""
    return changed_fields(target, after, key, columns).select(key, "field", "old_value")


def changed_fields(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str], cut: int | None = None) -> DataFrame:
    """(key, field, old_value, new_value) for each field that differs, nulls included; values as text, cut to `cut`."""
    text = lambda c: F.substring(c.cast("string"), 1, cut) if cut else c.cast("string")
    both = before.alias("b").join(after.alias("a"), F.col(f"b.{key}") == F.col(f"a.{key}"))
    fields = F.array(*[F.struct(F.lit(c).alias("field"), text(F.col(f"b.{c}")).alias("old_value"), text(F.col(f"a.{c}")).alias("new_value"), F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")).alias("same")) for c in columns])
    return both.select(F.col(f"b.{key}").alias(key), F.inline(F.filter(fields, lambda f: ~f["same"]))).drop("same")


def violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(check, violations): rows for which a condition is false; nulls pass, as in SQL."""
    counts = df.agg(*[F.count_if(~c).alias(name) for name, c in checks.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in checks])))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(children: DataFrame, foreign_key: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows of children whose non-null foreign key no parent has."""
    return children.where(F.col(foreign_key).isNotNull()).join(parents.select(F.col(key).alias("__pk")), F.col(foreign_key) == F.col("__pk"), "left_anti")


def publish(df: DataFrame, path: str, post_conditions: Mapping[str, Callable[[DataFrame], bool]], *, partition_by: Sequence[str] = (), dry_run: bool = False) -> DataFrame:
    """Writes df beside path, checks it as written, then moves it in place of path; an earlier version stays at path.old.

    If a condition fails, path is left alone and ValueError names the condition. dry_run: nothing is written.
    """
    if dry_run:
        return df
    spark = df.sparkSession
    staged, old = path.rstrip("/") + ".staged", path.rstrip("/") + ".old"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(staged)
    written = spark.read.schema(df.schema).parquet(staged)
    failed = [name for name, holds in post_conditions.items() if not holds(written)]
    if failed:
        raise ValueError(f"not published, failed: {', '.join(failed)}")
    jvm = spark._jvm.org.apache.hadoop.fs
    to = jvm.Path(path)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(to):
        fs.delete(jvm.Path(old), True)
        fs.rename(to, jvm.Path(old))
    if not fs.rename(jvm.Path(staged), to):
        raise OSError(f"could not move {staged} to {path}")
    return spark.read.schema(df.schema).parquet(path)
