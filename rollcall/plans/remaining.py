"""Queries of streams that resume, quotas, publishing, joins on functions of keys, nullable keys, and smaller rules of pages and names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, similarity, text
from ..operators import dml
from ..operators import relational as R
from ..operators.settled import shared_dir
from ..sources import files
from ..streaming import increments
from .registry import query, table
from .shapes import shapes


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("resumed_stream", """SELECT user_id, 2 * count(*) AS n, max(ts) AS last_ts FROM events GROUP BY 1""")
def resumed_stream(spark: SparkSession, d: str) -> DataFrame:
    """Events that arrive twice, worked off in two runs of one checkpoint: the second run sees only what is new."""
    inbox, state, checkpoint = _folder(spark, "inbox"), _folder(spark, "state"), _folder(spark, "offsets")
    events = table(spark, d, "events").select("user_id", "ts")

    def merge(old: DataFrame, batch: DataFrame) -> DataFrame:
        known = old if "n" in old.columns else old.select("user_id", F.lit(0).cast("long").alias("n"), F.col("ts").alias("last_ts"))
        fresh = batch.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))
        return known.unionByName(fresh).groupBy("user_id").agg(F.sum("n").alias("n"), F.max("last_ts").alias("last_ts"))

    for _ in range(2):
        events.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(events.schema).parquet(inbox)
        increments.run_once(stream, checkpoint, increments.upsert_into(state, merge)).awaitTermination()
    return increments.newest(spark, state)


@query("monthly_quotas", """SELECT event_type, strftime(ts, '%Y-%m') AS month, count(*) AS used, greatest(50 - count(*), 0)::BIGINT AS "left" FROM events GROUP BY 1, 2""")
def monthly_quotas(spark: SparkSession, d: str) -> DataFrame:
    return increments.monthly_quota(table(spark, d, "events"), "event_type", "ts", 50).withColumn("left", F.col("left").cast("long"))


@query("published_twice", """SELECT 'now' AS version, count(*) AS n, sum(s_suppkey)::BIGINT AS total FROM supplier UNION ALL SELECT 'before', count(*), sum(n_nationkey)::BIGINT FROM nation""")
def published_twice(spark: SparkSession, d: str) -> DataFrame:
    """A second version takes the place of the first, which stays beside it."""
    path = _folder(spark, "versions")
    for name, key in (("nation", "n_nationkey"), ("supplier", "s_suppkey")):
        rows = table(spark, d, name).select(F.col(key).cast("long").alias("id"))
        dml.publish(rows, path, {"no nulls": lambda df: df.where("id IS NULL").isEmpty()})
    total = lambda version, at: spark.read.schema("id long").parquet(at).agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("total")).select(F.lit(version).alias("version"), "n", "total")
    return total("now", path).unionByName(total("before", path + ".old"))


@query("rows_with_files", """SELECT n_nationkey, true AS from_nation FROM nation""")
def rows_with_files(spark: SparkSession, d: str) -> DataFrame:
    return files.read_with_path(spark, f"{d}/nation.parquet").select("n_nationkey", F.contains("file_path", F.lit("/nation.parquet")).alias("from_nation"))


@query(
    "numbers_of_names",
    """SELECT c_custkey, s_suppkey, lower(c_mktsegment) = lower(CASE WHEN s_suppkey % 2 = 0 THEN 'building' ELSE 'Machinery' END) AS same FROM customer JOIN supplier ON right(c_name, 9)::INT = right(s_name, 9)::INT""",
)
def numbers_of_names(spark: SparkSession, d: str) -> DataFrame:
    """A join on the number at the end of two names, and texts compared without case."""
    number = lambda c: F.right(F.col(c), F.lit(9)).cast("int")
    c, s = table(spark, d, "customer").withColumn("n", number("c_name")), table(spark, d, "supplier").withColumn("n", number("s_name"))
    word = F.when(F.col("s_suppkey") % 2 == 0, "building").otherwise("Machinery")
    return c.join(s, "n").select("c_custkey", "s_suppkey", (F.lower("c_mktsegment") == F.lower(word)).alias("same"))


@query(
    "first_of_nullable_keys",
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority END AS p, CASE WHEN o_orderkey % 7 > 0 THEN o_custkey % 20 END AS c FROM orders) SELECT p, c, min(o_orderkey) AS o_orderkey FROM o GROUP BY p, c""",
)
def first_of_nullable_keys(spark: SparkSession, d: str) -> DataFrame:
    """Nulls are a key of their own, in each part of a key."""
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select(k, F.when(k % 5 > 0, F.col("o_orderpriority")).alias("p"), F.when(k % 7 > 0, F.col("o_custkey") % 20).alias("c"))
    return R.best_row(o, ["p", "c"], [F.col("o_orderkey")]).select("p", "c", "o_orderkey")


_NAME = shapes("c_custkey", "First Baptist {k}", "Iglesia Bautista {k}", "Grace {k} Reformed Baptist", "House {k}", None)


@query(
    "weighted_labels",
    f"""WITH r AS (SELECT c_custkey AS id, {_NAME} AS name, c_nationkey % 4 AS country, c_acctbal AS b FROM customer),
    w AS (SELECT *, CASE WHEN regexp_matches(lower(name), 'reformed') THEN 'reformed' WHEN regexp_matches(lower(name), 'baptist') THEN 'baptist' WHEN regexp_matches(lower(name), 'iglesia|bautista') THEN 'spanish' END AS label,
      CASE WHEN regexp_matches(lower(name), 'reformed') THEN 0.95 WHEN regexp_matches(lower(name), 'baptist') THEN 0.9 WHEN regexp_matches(lower(name), 'iglesia|bautista') THEN 0.6 END AS sure FROM r)
    SELECT id, coalesce(label, CASE country WHEN 0 THEN 'catholic' WHEN 1 THEN 'orthodox' END) AS label, coalesce(sure, CASE WHEN country < 2 THEN 0.3 END)::DOUBLE AS confidence, 'x' || name AS joined,
      CASE WHEN b IS NULL OR b <= -1000 THEN NULL WHEN b <= 0 THEN 'debt' WHEN b <= 5000 THEN 'small' WHEN b <= 9000 THEN 'mid' WHEN b <= 20000 THEN 'large' END AS tier FROM w""",
)
def weighted_labels(spark: SparkSession, d: str) -> DataFrame:
    """The surest pattern of a name, else what is usual in its country; null names make null texts; sizes by bands."""
    name, country = F.expr(_NAME), F.col("c_nationkey") % 4
    found = rules.weighted_pattern(name, [("iglesia|bautista", "spanish", 0.6), ("baptist", "baptist", 0.9), ("reformed", "reformed", 0.95)])
    usual = F.when(country == 0, F.struct(F.lit("catholic").alias("label"), F.lit(0.3).alias("confidence"))).when(country == 1, F.struct(F.lit("orthodox").alias("label"), F.lit(0.3).alias("confidence")))
    best = F.coalesce(found, usual)
    tier = R.band(F.col("c_acctbal"), [-1000, 0, 5000, 9000, 20000], ["debt", "small", "mid", "large"])
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), best["label"].alias("label"), best["confidence"].alias("confidence"), F.concat(F.lit("x"), name).alias("joined"), tier.alias("tier"))


_TEXT = shapes("page_id", "Sundays at 10:30 AM and Wednesday - 7 p.m, see https://www.facebook.com/Grace.{k}/ and http://twitter.com/x{k}", "Friday, Sat", "saturday 9am https://instagram.com/a_b{k} https://instagram.com/a_b{k}/", None)


@query(
    "page_details",
    rf"""WITH r AS (SELECT page_id AS id, {_TEXT} AS t FROM pages)
    SELECT id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(lower(t), 'https?://(?:www\.)?(?:facebook|instagram|twitter|youtube)\.com/[a-z0-9_./@-]+'), lambda u: regexp_replace(u, '/+$', '')))), ' ') AS links,
      CASE id % 4 WHEN 0 THEN 'sundays at 10:30 am|wednesday 7 p m' WHEN 1 THEN '' WHEN 2 THEN 'saturday 9am' END AS times,
      'gc' || id % 7 || 'gary.org' AS guess, 'Zoe Cafe ' || id AS plain, array_to_string(list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower('The Grace of grace, Hall ' || id), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) >= 3 AND w NOT IN ('the', 'hall')))), ' ') AS words FROM r""",
)
def page_details(spark: SparkSession, d: str) -> DataFrame:
    """Links to profiles, times of services, guessed domains, plain letters, and the words of a name that say something."""
    t, k = F.expr(_TEXT), F.col("page_id")
    guesses = text.domain_guesses(F.concat(F.lit("Grace Chapel "), (k % 7).cast("string")), F.lit("Gary"))
    return table(spark, d, "pages").select(
        k.alias("id"), F.array_join(text.social_links(t), " ").alias("links"), F.array_join(text.service_times(t), "|").alias("times"), F.get(F.filter(guesses, lambda g: g.startswith("gc")), F.lit(0)).alias("guess"),
        similarity.to_ascii(F.concat(F.lit("Zoë Café "), k.cast("string"))).alias("plain"), F.array_join(F.array_sort(text.content_words(F.concat(F.lit("The Grace of grace, Hall "), k.cast("string")), ("the", "hall"))), " ").alias("words"),
    )
