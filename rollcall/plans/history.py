"""Queries of trees and their repair, of runs, snapshots and write-once fields, and of the remaining aggregates, times and arrays."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dml, graph, linkage, matching, provenance
from ..operators.settled import shared_dir
from .registry import query, stated, table


@query(
    "rank_chains",
    """SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS family, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 26 < 25 THEN o_orderkey % 26 END AS nation,
      coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 26 < 25 THEN o_orderkey % 26 END, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END) AS parent FROM orders""",
)
def rank_chains(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    nodes = table(spark, d, "orders").select(k.alias("id"), F.col("o_custkey").alias("family"), F.when(k % 5 != 0, k % 26).alias("nation"))
    families = table(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"))
    return graph.rank_chain(nodes, "id", {"family": families, "nation": table(spark, d, "nation").select(F.col("n_nationkey").alias("id"))}).select("id", "family", "nation", "parent")


@query(
    "rolled_up",
    """WITH o AS (SELECT o_custkey AS cluster, o_orderpriority AS name, year(o_orderdate)::BIGINT AS era FROM orders WHERE o_custkey % 4 <> 0),
    c AS (SELECT cluster, arg_min(name, (-length(name), name)) AS best_name, min(era) AS first_era, max(era) AS last_era, string_agg(DISTINCT era::VARCHAR, ';' ORDER BY era::VARCHAR) AS eras, count(*) AS n_observations, count(DISTINCT era) AS k FROM o GROUP BY 1)
    SELECT cluster, best_name, first_era, last_era, eras, n_observations, last_era >= 1998 AS survives, CASE WHEN k >= 3 THEN 1.0 WHEN k = 2 THEN 0.8 ELSE 0.5 END::DOUBLE AS confidence,
      printf('e_%05d', row_number() OVER (ORDER BY cluster)) AS entity_id FROM c""",
)
def rolled_up(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").where("o_custkey % 4 <> 0").select(F.col("o_custkey").alias("cluster"), F.col("o_orderpriority").alias("name"), F.year("o_orderdate").cast("long").alias("era"))
    return linkage.roll_up(o, "cluster", "name", "era", last=1998)


@query("singletons", """SELECT 'e' || c_custkey AS entity, c_name AS name FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 's_' || c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def singletons(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    entities = c.where("id % 2 = 0").select(F.concat(F.lit("e"), "id").alias("entity"), "name")
    return matching.with_singletons(entities, c, table(spark, d, "orders").select(F.col("o_custkey").alias("id")), "id", "entity", ["name"])


@query("recorded_runs", stated(["run_id", "script", "status", "rows_written", "error"], [("r1", "load", "completed", 25, None), ("r2", "load", "failed", 7, "ValueError: no rows")]))
def recorded_runs(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_dir(spark)}/runs-{uuid.uuid4().hex}"
    with provenance.recorded_run(spark, path, "r1", "load") as run:
        run.rows_written = table(spark, d, "nation").count()
    try:
        with provenance.recorded_run(spark, path, "r2", "load") as run:
            run.rows_written = 7
            raise ValueError("no rows")
    except ValueError:
        pass
    return spark.read.schema(provenance.RUNS).parquet(path).where("started <= ended").select("run_id", "script", "status", "rows_written", "error")


@query("undone_change", """SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def undone_change(spark: SparkSession, d: str) -> DataFrame:
    """A change and a deletion by id, undone from the snapshot that was written before."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    ids = s.where("s_suppkey % 3 = 0").select("s_suppkey")
    saved = provenance.snapshot(s, ids, "s_suppkey", f"{shared_dir(spark)}/before-{uuid.uuid4().hex}")
    changed = s.withColumn("s_acctbal", F.when(F.col("s_suppkey") % 3 == 0, 0.0).otherwise(F.col("s_acctbal"))).where("s_suppkey % 6 <> 0 OR s_suppkey % 3 <> 0")
    return provenance.restore(changed, saved, "s_suppkey")


@query("appended_batches", """SELECT n_nationkey AS k, n_name AS v FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 5""")
def appended_batches(spark: SparkSession, d: str) -> DataFrame:
    """A copy without rows, filled by two batches."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"))
    path = f"{shared_dir(spark)}/batches-{uuid.uuid4().hex}"
    for batch in (provenance.empty_like(n), n, n.where("k < 5")):
        provenance.append_batch(batch, path)
    return spark.read.schema(n.schema).parquet(path)


@query(
    "write_once_fields",
    """SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'old' WHEN c_custkey % 2 = 0 THEN 'new' END AS founded,
      CASE WHEN c_custkey % 2 <> 0 THEN CASE WHEN c_custkey % 5 = 0 THEN 'a' END WHEN c_custkey % 5 = 0 THEN 'a; b' ELSE 'b' END AS notes FROM customer""",
)
def write_once_fields(spark: SparkSession, d: str) -> DataFrame:
    """Set fields stay, null and blank ones are filled; notes grow; rows without news stay as they are."""
    k = F.col("c_custkey")
    old = table(spark, d, "customer").select(k.alias("k"), F.when(k % 3 == 0, "old").when(k % 7 == 0, F.when(k % 2 == 0, " ")).alias("founded"), F.when(k % 5 == 0, "a").alias("notes"))
    new = old.where("k % 2 = 0").select("k", F.lit("new").alias("founded"), F.lit("b").alias("notes"))
    return dml.update_from(old, new, ["k"], {"founded": provenance.write_once, "notes": dml.append_text("; ")})


@query("stacked_tables", """SELECT 'n' || n_nationkey AS id, n_name AS name, NULL::DOUBLE AS balance FROM nation UNION ALL SELECT 's' || s_suppkey, NULL, s_acctbal FROM supplier""")
def stacked_tables(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("name"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return provenance.stacked([n, s]).select("id", "name", "balance")


@query("view_counts", """SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1""")
def view_counts(spark: SparkSession, d: str) -> DataFrame:
    provenance.named_view(table(spark, d, "customer"), "rollcall_customers")
    return spark.sql("SELECT c_mktsegment AS segment, count(*) AS n FROM rollcall_customers GROUP BY 1")


@query("approximate_quantiles", """SELECT event_type, quantile_disc(value, 0.25) AS q25, quantile_disc(value, 0.5) AS q50, quantile_disc(value, 0.9) AS q90 FROM events GROUP BY 1""")
def approximate_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """The sketch's accuracy is above the groups' sizes here, so that its answer is exact; above them it is 1 in 100,000 ranks."""
    q = F.percentile_approx("value", [0.25, 0.5, 0.9], 100_000)
    return table(spark, d, "events").groupBy("event_type").agg(q.alias("q")).select("event_type", *[F.col("q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q90"))])


@query("most_common", """SELECT p_name AS name, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, name LIMIT 5""")
def most_common(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy(F.col("p_name").alias("name")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "name").limit(5)


@query("presence_flags", """SELECT user_id, max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS has_click, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS has_error FROM events GROUP BY 1""")
def presence_flags(spark: SparkSession, d: str) -> DataFrame:
    flag = lambda kind: F.max(F.when(F.col("event_type") == kind, 1).otherwise(0)).alias(f"has_{kind}")
    return table(spark, d, "events").groupBy("user_id").agg(flag("click"), flag("error"))


@query("centroids", """SELECT c_nationkey, round(avg(c_custkey % 90), 6) AS lat, round(sum((c_custkey % 180) * abs(c_acctbal)) / nullif(sum(abs(c_acctbal)), 0), 4) AS lon FROM customer GROUP BY 1""")
def centroids(spark: SparkSession, d: str) -> DataFrame:
    k, w = F.col("c_custkey"), F.abs("c_acctbal")
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.round(F.avg(k % 90), 6).alias("lat"), F.round(F.try_divide(F.sum((k % 180) * w), F.sum(w)), 4).alias("lon"))


@query("code_prefixes", """SELECT substr(p_brand, 1, 7) AS prefix, count(*) AS n, count(DISTINCT p_type) AS kinds FROM part GROUP BY 1""")
def code_prefixes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy(F.substring("p_brand", 1, 7).alias("prefix")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p_type").alias("kinds"))


@query("stale_events", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS at, epoch(TIMESTAMP '2024-01-20 00:00:00') - epoch(date_trunc('second', ts)) > 7 * 86400 AS stale FROM events""")
def stale_events(spark: SparkSession, d: str) -> DataFrame:
    """Ages against a stated time, as a run's own start would be."""
    now = F.unix_timestamp(F.lit("2024-01-20 00:00:00"))
    return table(spark, d, "events").select("event_id", provenance.utc_text(F.col("ts")).alias("at"), (now - F.unix_timestamp("ts") > 7 * 86400).alias("stale"))


@query("tagged_parts", """SELECT p_partkey, list_contains(string_split(p_name, ' '), 'widget') AS tagged, to_json(list_transform(string_split(p_name, ' '), lambda x: upper(x)))::VARCHAR AS words FROM part""")
def tagged_parts(spark: SparkSession, d: str) -> DataFrame:
    words = F.split("p_name", " ")
    return table(spark, d, "part").select("p_partkey", F.exists(words, lambda w: w == "widget").alias("tagged"), F.to_json(F.transform(words, lambda w: F.upper(w))).alias("words"))
