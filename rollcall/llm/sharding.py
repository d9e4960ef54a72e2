"""Sharding by weighted rendezvous hashing, and a gapless place for every row of a shard.

Every key draws a number for every shard from md5(key:shard), and goes where -ln(u) / weight is least: a shard's share of
the keys is its share of the weights. The draws of two shards have nothing to do with each other, so a new shard takes keys
only into itself, and a shard that goes gives its keys to the others and moves no other key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialize

#: Bytes that a row takes beside its text.
ROW_BYTES = 16
#: Equal rows that one task writes out.
PIECE = 10_000


@dataclass(frozen=True)
class Shard:
    number: int
    weight: float = 1.0


def equal_shards(count: int) -> list[Shard]:
    return [Shard(k) for k in range(count)]


def draw(key: Column, shard: Column) -> Column:
    """A number between 0 and 1, neither included, from the first 52 bits of md5(key:shard)."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), shard.cast("string")).cast("binary")), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def rendezvous(key: Column, shards: list[Shard]) -> Column:
    """The number of the shard that has the least draw for its weight; of equal ones the smaller number. Null keys count as ''."""
    if not shards or len({s.number for s in shards}) < len(shards) or min(s.weight for s in shards) <= 0:
        raise ValueError("shards need distinct numbers and weights above zero")
    key = F.coalesce(key.cast("string"), F.lit(""))
    table = F.array(*(F.struct(F.lit(s.number).alias("shard"), F.lit(float(s.weight)).alias("weight")) for s in shards))
    bids = F.transform(table, lambda s: F.struct((-F.log(draw(key, s["shard"])) / s["weight"]).alias("cost"), s["shard"].alias("shard")))
    return F.array_min(bids)["shard"]


def shard_rows(docs: DataFrame, shards: list[Shard], *, added: Shard | None = None, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 50_000) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row of docs; other columns are not read.

    shard: by the id alone, so rows that share an id share a shard, null ids too. grown_shard: where the row goes once
    `added` is there as well, null without it. size: UTF-8 bytes of the text and ROW_BYTES; a null text has no bytes, and
    the checksum of none. slot: the row's place in its shard, from 0 without gaps, in the order of md5(id:size:checksum),
    then id, size and checksum; rows alike in all three stand side by side. An empty table gives no rows.

    Rows alike are counted before anything is dealt out, and a shard is numbered by ranges of its order of some
    bucket_rows rows: no task holds a shard, nor the rows of one id. Which ranges there are changes no slot.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    grown = rendezvous(F.col("id"), [*shards, added]) if added else F.lit(None)
    # the draws are made where the rows are read, by as many tasks; the exchange after it is small and gets few
    rows = rows.withColumns({"shard": rendezvous(F.col("id"), shards), "grown_shard": grown.cast("int")})
    keys = rows.groupBy("id", "size", "text_crc32", "shard", "grown_shard").agg(F.count(F.lit(1)).alias("copies"))
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    order = F.md5(F.concat_ws(":", name, F.col("size").cast("string"), F.col("text_crc32").cast("string")).cast("binary"))
    keys = materialize(keys.withColumn("place", order), "shard-keys")

    digits, n = 1, keys.count()
    while len(shards) * 16**digits * bucket_rows < n:
        digits += 1
    keys = keys.withColumn("range", F.substring("place", 1, digits))
    so_far = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = keys.groupBy("shard", "range").agg(F.sum("copies").alias("held")).select("shard", "range", F.coalesce(F.sum("held").over(so_far), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "range").orderBy("place", "id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    numbered = keys.join(starts, ["shard", "range"]).withColumn("first", F.col("before") + F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    numbered = materialize(numbered, "shard-slots")

    one = numbered.where(F.col("copies") == 1).withColumn("slot", F.col("first"))
    many = numbered.where(F.col("copies") > 1).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(PIECE).cast("long"))))
    many = many.repartition("id", "size", "text_crc32", "piece")  # copies of one row are written out by many tasks
    last = F.least(F.col("piece") + PIECE, F.col("copies")) - 1
    many = many.withColumn("copy", F.explode(F.sequence(F.col("piece"), last))).withColumn("slot", F.col("first") + F.col("copy"))
    shape = [F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"]
    return one.select(*shape).unionByName(many.select(*shape))


def sharding_sql(count: int) -> str:
    """DuckDB SQL for shard_rows over the table documents, with `count` equal shards and one that is added."""
    polynomial = 0xEDB88320
    return f"""WITH bytes AS MATERIALIZED (SELECT list(v ORDER BY b) AS crc_of FROM (SELECT b,
            list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {polynomial}) ELSE c >> 1 END, b::BIGINT) AS v FROM (SELECT unnest(range(256)) AS b))),
        body AS (SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM documents),
        docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, (len(b) + {ROW_BYTES})::BIGINT AS size,
            CASE WHEN len(b) = 0 THEN 0 ELSE xor(list_reduce(b, lambda c, x: xor(c >> 8, crc_of[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) END::BIGINT AS text_crc32 FROM body, bytes),
        bids AS (SELECT r, s, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || s::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) AS cost
            FROM docs, (SELECT unnest(range({count + 1})) AS s)),
        won AS (SELECT r, arg_min(s, cost) FILTER (WHERE s < {count})::INT AS shard, arg_min(s, cost)::INT AS grown_shard FROM bids GROUP BY r)
        SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard
            ORDER BY md5(coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR || ':' || text_crc32::VARCHAR), doc_id, size, text_crc32) - 1 AS slot, grown_shard
        FROM docs JOIN won USING (r)"""
