"""Shared helpers of the corpus operators: reading tables, cutting lineage, bounded samples."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.settled import discard, shared_dir
from ..operators.settled import settle as materialize

__all__ = ["discard", "materialize", "shared_dir"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """What is written meanwhile sends Python at most so many rows at once: a batch of long texts lies in JVM and worker, with its copies."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(most, int(before)) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def split_of(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as remainder -1, so they are never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus, F.lit(-1))


def labelled_sample(docs: DataFrame, label: str, text: str, per_label: int, max_chars: int, slice_chars: int, max_labels: int = 1000) -> dict[object, list[str]]:
    """The first slice_chars characters of at most per_label distinct texts of each label, spread evenly over the table by a hash.

    The bounded sample that a classifier is fitted on: texts over max_chars characters, empty and null texts and null
    labels are left out of the fit, and so are all but the max_labels most frequent labels. Two passes: counts by label,
    then a scan that keeps a share of each label. Texts are cut before they are exchanged; per_label * 1.5 * labels *
    slice_chars characters come to the driver, or a little more.
    """
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= max_chars) & (F.length(text) > 0))
    counts = label_counts(rows, label, max_labels)
    some = rows.where(_even_share(F.xxhash64(text, label), label, counts, per_label))
    picked = some.groupBy(F.xxhash64(text).alias("h"), F.col(label).alias("k")).agg(F.min(F.substring(text, 1, slice_chars)).alias("t"))
    return _by_label(picked.orderBy("h", "k").limit(3 * per_label * max(1, len(counts))).collect(), per_label)


def joined_sample(docs: DataFrame, labels: DataFrame, key: str, label: str, text: str, per_label: int, max_chars: int) -> dict[object, list[str]]:
    """As labelled_sample, for labels in a table of their own: the sample is drawn there, so that texts are not shuffled.

    At most 3 * per_label keys of each label are broadcast to the scan of docs.
    """
    rows = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(key, label)
    counts = label_counts(rows, label)
    keys = rows.where(_even_share(F.xxhash64(key, label), label, counts, per_label)).limit(3 * per_label * max(1, len(counts)))
    texts = docs.where(F.col(text).isNotNull() & (F.length(text) <= max_chars) & (F.length(text) > 0)).select(key, text).join(F.broadcast(keys), key)
    picked = texts.select(F.xxhash64(text).alias("h"), F.col(label).alias("k"), F.col(text).alias("t"))
    return _by_label(picked.orderBy("h", "k", "t").limit(3 * per_label * max(1, len(counts))).collect(), per_label)


def label_counts(rows: DataFrame, label: str, most: int = 1000) -> dict[object, int]:
    """Rows of each of the `most` commonest labels."""
    counts = rows.groupBy(F.col(label).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return {r["k"]: r["n"] for r in counts.orderBy(F.desc("n"), "k").limit(most).collect()}


def _even_share(point: Column, label: str, counts: dict[object, int], per_label: int) -> Column:
    keep, place = F.lit(False), F.pmod(point, F.lit(1 << 20))
    for value, n in counts.items():
        keep = keep | ((F.col(label) == F.lit(value)) & (place < min(1 << 20, int((1 << 20) * 1.5 * per_label / n) + 1)))
    return keep


def _by_label(rows: list, per_label: int) -> dict[object, list[str]]:
    found: dict[object, list[str]] = {}
    for r in rows:
        found.setdefault(r["k"], []).append(r["t"])
    return {k: sorted(set(v), key=lambda t: (hash_text(t), t))[:per_label] for k, v in found.items()}


def hash_text(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode("utf-8", "surrogatepass"))
