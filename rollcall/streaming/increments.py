"""Incremental work: the same transforms over batches and streams, and upserts of micro-batches into stored tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def latest(log: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Mapping[str, str]) -> DataFrame:
    """The fields of the last row by order of each key, and the number n of its rows; aggregates partially."""
    last = F.struct(*order)
    return log.groupBy(*keys).agg(*[F.max_by(F.col(c), last).alias(name) for name, c in fields.items()], F.count(F.lit(1)).alias("n"))


def tumbling(events: DataFrame, width: str, keys: Sequence[str], value: str, *, ts: str = "ts", watermark: str | None = None) -> DataFrame:
    """(window_start, keys, n, total); with a watermark (for streams), later rows than that are dropped."""
    rows = events.withWatermark(ts, watermark) if watermark else events
    grouped = rows.groupBy(F.window(ts, width).alias("__w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 4).alias("total"))
    return grouped.select(F.col("__w.start").alias("window_start"), *keys, "n", "total")


def sessions(events: DataFrame, key: str, gap: str, *, ts: str = "ts", watermark: str | None = None) -> DataFrame:
    """(key, session_start, last_ts, n): runs of rows of a key that are less than gap apart."""
    rows = events.where(F.col(key).isNotNull())
    rows = rows.withWatermark(ts, watermark) if watermark else rows
    grouped = rows.groupBy(F.session_window(ts, gap).alias("__w"), key).agg(F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n"))
    return grouped.select(key, F.col("__w.start").alias("session_start"), "last_ts", "n")


def month_cutoff(at: Column, months_back: int) -> Column:
    """The first moment of the month `months_back` before."""
    return F.date_trunc("month", F.add_months(at, -months_back).cast("timestamp"))


def due(log: DataFrame, key: str, ts: str, months_back: int) -> DataFrame:
    """(key, last_ts) of keys whose last row is before the cutoff, counted from the last row of the log."""
    cutoff = log.agg(month_cutoff(F.max(ts), months_back).alias("__cutoff"))  # one row
    last = log.groupBy(key).agg(F.max(ts).alias("last_ts"))
    return last.crossJoin(F.broadcast(cutoff)).where("last_ts < __cutoff").drop("__cutoff")


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of work whose key is not in done: where to resume."""
    return work.join(done.select(key), key, "left_anti")


def monthly_quota(log: DataFrame, provider: str, ts: str, quota: int) -> DataFrame:
    """(provider, month, used, left) of each provider's calls."""
    used = log.groupBy(provider, F.date_format(ts, "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("used"))
    return used.withColumn("left", F.greatest(F.lit(quota) - F.col("used"), F.lit(0)))


def without_repeats(events: DataFrame, keys: Sequence[str], watermark: str, ts: str = "ts") -> DataFrame:
    """Streams: each key once within the watermark."""
    return events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


def run_once(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Works off what is there in micro-batches, then stops; a later call goes on from the checkpoint."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()


def upsert_into(path: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges a batch into the newest version below path and writes the next.

    Versions are folders named by batch, so a batch that is run again after a failure replaces its own version only.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = newest(spark, path, before=number)
        out = merge(old, batch) if old is not None else merge(batch.limit(0), batch)
        out.write.mode("overwrite").parquet(f"{path}/v{number:09d}")

    return apply


def newest(spark, path: str, before: int | None = None) -> DataFrame | None:
    """The table in the last version below path, of those under number `before` if given; None if there is none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    names = [n for n in names if before is None or int(n[1:]) < before]
    return spark.read.parquet(f"{path}/{names[-1]}") if names else None
