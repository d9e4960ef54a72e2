"""Runs, sources, snapshots and write-once fields: what happened to a table, and how to undo it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .dml import blank_to_null

RUNS = "run_id string, script string, started timestamp, ended timestamp, status string, rows_written long, error string"


def utc_text(at: Column) -> Column:
    """A time as ISO text to the second; with a literal of the run's start all rows of a run carry the same."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")


class Run:
    def __init__(self, run_id: str):
        self.run_id, self.rows_written = run_id, 0


@contextmanager
def recorded_run(spark: SparkSession, path: str, run_id: str, script: str) -> Iterator[Run]:
    """Appends a row to the runs at path when the block ends: `completed`, or `failed` with the error, which goes on.

    The block sets rows_written. One row a run, so that a reader sees no half-written one.
    """
    from datetime import UTC, datetime

    run, started = Run(run_id), datetime.now(UTC)

    def told(status: str, error: str | None) -> None:
        row = (run_id, script, started, datetime.now(UTC), status, run.rows_written, error)
        spark.createDataFrame([row], RUNS).write.mode("append").parquet(path)

    try:
        yield run
    except Exception as e:
        told("failed", f"{type(e).__name__}: {e}"[:500])
        raise
    told("completed", None)


def append_batch(rows: DataFrame, path: str) -> None:
    """Rows added to a table of files, as they are."""
    rows.write.mode("append").parquet(path)


def register_sources(known: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """known with the sources of found whose key is new; running it twice adds nothing. Null keys are never registered.

    Of several new rows with one key the first by all columns stays.
    """
    new = found.where(F.col(key).isNotNull()).join(known.select(key), key, "left_anti")
    rest = [c for c in known.columns if c != key]
    first = new.groupBy(key).agg(F.min(F.struct(*rest)).alias("m")).select(key, *[F.col(f"m.{c}").alias(c) for c in rest])
    return known.unionByName(first.select(*known.columns))


def write_once(old: Column, new: Column) -> Column:
    """A policy for fields that are set once: a value that is there stays; blanks count as none."""
    return F.coalesce(blank_to_null(old), blank_to_null(new))


def empty_like(df: DataFrame) -> DataFrame:
    """The columns of df without rows, as a table to fill."""
    return df.where(F.lit(False))


def snapshot(table: DataFrame, ids: DataFrame, key: str, path: str) -> DataFrame:
    """The rows of table that a change by id will touch, written to path: what `restore` puts back."""
    table.join(ids.select(key).distinct(), key, "left_semi").write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def restore(changed: DataFrame, saved: DataFrame, key: str) -> DataFrame:
    """changed as it was before: saved rows in place of those with their keys, deleted ones back again."""
    return changed.join(saved.select(key), key, "left_anti").unionByName(saved)


def stacked(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of tables with differing columns; what one lacks is null."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def named_view(df: DataFrame, name: str) -> DataFrame:
    """df under a name for SQL, for the session."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
