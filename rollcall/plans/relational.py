"""Queries of the relational core over the TPC-H-like tables: filters, joins, aggregates, windows, orders and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import relational as R
from ..operators import selection
from .registry import query, table


@query("filter_buckets", """SELECT CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS bucket, count(*) AS n,
    round(sum(coalesce(nullif(c_acctbal, 0), 0)), 2) AS total FROM customer WHERE c_mktsegment ILIKE '%build%' OR c_nationkey BETWEEN 3 AND 9 GROUP BY 1""")
def filter_buckets(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").where(F.col("c_mktsegment").ilike("%build%") | F.col("c_nationkey").between(3, 9))
    bucket = F.when(F.col("c_acctbal") < 0, "negative").when(F.col("c_acctbal") < 5000, "low").otherwise("high")
    return c.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.coalesce(F.nullif("c_acctbal", F.lit(0.0)), F.lit(0.0))), 2).alias("total"))


@query("filter_patterns", """SELECT p_partkey, p_type, (p_type ILIKE 'promo_%') AS like_prefix, (p_name GLOB '*[a-m]*') AS globbed, regexp_matches(p_type, 'STEEL|BRASS') AS regexped,
    (p_brand LIKE 'Brand#3_' ESCAPE '!') AS escaped FROM part WHERE p_size IN (SELECT DISTINCT p_size FROM part WHERE p_size % 7 = 0)""")
def filter_patterns(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    sizes = p.where("p_size % 7 = 0").select("p_size").distinct()
    return p.join(sizes, "p_size", "left_semi").select(
        "p_partkey", "p_type", F.col("p_type").ilike("promo_%").alias("like_prefix"), R.glob(F.col("p_name"), "*[a-m]*").alias("globbed"), F.col("p_type").rlike("STEEL|BRASS").alias("regexped"),
        F.expr("p_brand LIKE 'Brand#3_' ESCAPE '!'").alias("escaped"),
    )


@query("band_balances", """SELECT band, count(*) AS n FROM (SELECT CASE WHEN c_acctbal <= -1000 THEN NULL WHEN c_acctbal <= 0 THEN 'debt' WHEN c_acctbal <= 4000 THEN 'mid' WHEN c_acctbal <= 10000 THEN 'top' END AS band FROM customer) GROUP BY band""")
def band_balances(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").groupBy(R.band(F.col("c_acctbal"), [-1000, 0, 4000, 10000], ["debt", "mid", "top"]).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("strict_extremes", """SELECT p_partkey, CASE WHEN p_size > 40 THEN NULL ELSE least(p_size * 10.0, p_retailprice) END AS low, CASE WHEN p_size > 40 THEN NULL ELSE greatest(p_size * 10.0, p_retailprice) END AS high FROM part""")
def strict_extremes(spark: SparkSession, d: str) -> DataFrame:
    size = F.when(F.col("p_size") <= 40, F.col("p_size") * F.lit(10.0))
    return table(spark, d, "part").select("p_partkey", R.strict_least(size, F.col("p_retailprice")).alias("low"), R.strict_greatest(size, F.col("p_retailprice")).alias("high"))


@query("missing_values", """SELECT 'c_name' AS "column", count(*) FILTER (c_name IS NULL OR trim(c_name) = '') AS missing, count(*) AS total, round(count(*) FILTER (c_name IS NULL OR trim(c_name) = '') * 100.0 / count(*), 2) AS pct_missing FROM customer
    UNION ALL SELECT 'c_acctbal', count(*) FILTER (c_acctbal IS NULL), count(*), round(count(*) FILTER (c_acctbal IS NULL) * 100.0 / count(*), 2) FROM customer""")
def missing_values(spark: SparkSession, d: str) -> DataFrame:
    return R.missing_report(table(spark, d, "customer"), ["c_name", "c_acctbal"])


@query("star_join", """SELECT r_name AS region, n_name AS nation, count(DISTINCT o_orderkey) AS orders, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE l_shipdate >= TIMESTAMP '1995-01-01' GROUP BY 1, 2""")
def star_join(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").where(F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp")).select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
    per_order = lines.groupBy("l_orderkey").agg(F.sum("net").alias("net"))  # one row an order before the joins
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy("region", "nation").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("net"), 2).alias("revenue"))


@query("outer_joins", """SELECT coalesce(n_nationkey, s_nationkey)::BIGINT AS nation, count(s_suppkey) AS suppliers, max(n_name) AS name FROM (SELECT * FROM nation WHERE n_nationkey % 2 = 0)
    FULL JOIN supplier ON n_nationkey = s_nationkey GROUP BY 1""")
def outer_joins(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").where("n_nationkey % 2 = 0")
    both = nation.join(table(spark, d, "supplier"), F.col("n_nationkey") == F.col("s_nationkey"), "full")
    return both.groupBy(F.coalesce("n_nationkey", "s_nationkey").cast("long").alias("nation")).agg(F.count("s_suppkey").alias("suppliers"), F.max("n_name").alias("name"))


@query("semi_anti", """SELECT 'with_orders' AS kind, count(*) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'without_orders', count(*) FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
    UNION ALL SELECT 'segment_absent', count(*) FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)
    UNION ALL SELECT 'null_listed', count(*) FROM customer WHERE c_nationkey NOT IN (SELECT nullif(n_nationkey, 3) FROM nation WHERE n_nationkey < 5)
    UNION ALL SELECT 'null_key', count(*) FROM customer WHERE nullif(c_nationkey, 7) NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 5)
    UNION ALL SELECT 'empty_list', count(*) FROM customer WHERE nullif(c_nationkey, 7) NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 0)""")
def semi_anti(spark: SparkSession, d: str) -> DataFrame:
    c, o = table(spark, d, "customer"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    rich = table(spark, d, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("c_nationkey"))
    kind = lambda name, df: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("kind"), "n")
    n = table(spark, d, "nation").where("n_nationkey < 5").select("n_nationkey", F.nullif("n_nationkey", F.lit(3)).alias("holed"))
    holed = c.withColumn("k", F.nullif("c_nationkey", F.lit(7)))
    out = kind("with_orders", c.join(o, "c_custkey", "left_semi")).unionByName(kind("without_orders", c.join(o, "c_custkey", "left_anti")))
    for name, left, key, right, value in (
        ("segment_absent", c, "c_nationkey", rich, "c_nationkey"), ("null_listed", c, "c_nationkey", n, "holed"),
        ("null_key", holed, "k", n, "n_nationkey"), ("empty_list", holed, "k", n.where("n_nationkey < 0"), "n_nationkey"),
    ):
        out = out.unionByName(kind(name, R.not_in(left, key, right, value)))
    return out


@query("keyword_join", """WITH k(keyword, label) AS (VALUES ('widget', 'metal'), ('cold widget', 'coated'), ('bolt', 'metal'), ('gear', 'alloy')),
    h AS (SELECT p_partkey, keyword, label, row_number() OVER (PARTITION BY p_partkey ORDER BY length(keyword) DESC, keyword) AS rn FROM part JOIN k ON contains(lower(p_name), keyword))
    SELECT p_partkey, keyword, label FROM h WHERE rn = 1""")
def keyword_join(spark: SparkSession, d: str) -> DataFrame:
    words = spark.createDataFrame([("widget", "metal"), ("cold widget", "coated"), ("bolt", "metal"), ("gear", "alloy")], "keyword string, label string")
    return R.keyword_labels(table(spark, d, "part"), "p_name", words, "p_partkey")


@query("year_over_year", """WITH y AS (SELECT year(o_orderdate)::BIGINT AS yr, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)
    SELECT a.yr, a.n, b.n AS before, round((a.n - b.n) * 100.0 / b.n, 4) AS pct FROM y a LEFT JOIN y b ON b.yr = a.yr - 1""")
def year_over_year(spark: SparkSession, d: str) -> DataFrame:
    y = table(spark, d, "orders").groupBy(F.year("o_orderdate").cast("long").alias("yr")).agg(F.count(F.lit(1)).alias("n"))
    b = y.select((F.col("yr") + 1).alias("yr"), F.col("n").alias("before"))
    return y.join(b, "yr", "left").select("yr", "n", "before", F.round(F.try_divide((F.col("n") - F.col("before")) * 100.0, F.col("before")), 4).alias("pct"))


@query("longitudinal_closure", """SELECT c_custkey FROM (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE year(o_orderdate) = (SELECT min(year(o_orderdate)) FROM orders))
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders))""")
def longitudinal_closure(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("yr"))
    ends = F.broadcast(o.agg(F.min("yr").alias("first"), F.max("yr").alias("last")))  # one row
    seen = o.crossJoin(ends).where((F.col("yr") == F.col("first")) | (F.col("yr") == F.col("last")))
    flags = seen.groupBy("c_custkey").agg(F.bool_or(F.col("yr") == F.col("first")).alias("then"), F.bool_or(F.col("yr") == F.col("last")).alias("now"))
    return flags.where("then AND NOT now").select("c_custkey")


@query("conditional_counts", """SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (l_quantity > 30) AS many, round(sum(CASE WHEN l_discount > 0.05 THEN l_extendedprice ELSE 0 END), 2) AS discounted,
    round(avg(CASE WHEN l_tax > 0.04 THEN 1.0 ELSE 0.0 END), 6) AS taxed_share, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1, 2 HAVING n > 10""")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_quantity") > 30).alias("many"), F.round(F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice")).otherwise(0.0)), 2).alias("discounted"),
        F.round(F.avg(F.when(F.col("l_tax") > 0.04, 1.0).otherwise(0.0)), 6).alias("taxed_share"), F.countDistinct("l_suppkey").alias("suppliers"),
    )
    return rows.where("n > 10")


@query("joined_names", """SELECT n_regionkey::BIGINT AS region, string_agg(n_name, '; ' ORDER BY n_name) AS names, count(*) AS n FROM nation GROUP BY 1""")
def joined_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").groupBy(F.col("n_regionkey").cast("long").alias("region")).agg(F.array_join(F.array_sort(F.collect_list("n_name")), "; ").alias("names"), F.count(F.lit(1)).alias("n"))


@query("percentile_by_offset", """WITH r AS (SELECT c_mktsegment AS segment, c_acctbal, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal) - 1 AS i, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer WHERE c_acctbal IS NOT NULL)
    SELECT segment, c_acctbal AS p90 FROM r WHERE i = floor(n * 0.9)""")
def percentile_by_offset(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").withColumnRenamed("c_mktsegment", "segment")
    return selection.percentile_at_offset(rows, ["segment"], "c_acctbal", 0.9, "p90")


@query("exact_quantiles", """SELECT c_mktsegment AS segment, round(median(c_acctbal), 6) AS med, round(quantile_cont(c_acctbal, 0.25), 6) AS q1, round(stddev_samp(c_acctbal), 4) AS sd, round(stddev_pop(c_acctbal), 4) AS sdp, round(corr(c_acctbal, c_nationkey), 6) AS r FROM customer GROUP BY 1""")
def exact_quantiles(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").withColumnRenamed("c_mktsegment", "segment")
    spread = c.groupBy("segment").agg(F.round(F.stddev_samp("c_acctbal"), 4).alias("sd"), F.round(F.stddev_pop("c_acctbal"), 4).alias("sdp"), F.round(F.corr("c_acctbal", "c_nationkey"), 6).alias("r"))
    found = selection.quantiles(c, ["segment"], "c_acctbal", {"med": 0.5, "q1": 0.25})
    return found.join(spread, "segment").select("segment", F.round("med", 6).alias("med"), F.round("q1", 6).alias("q1"), "sd", "sdp", "r")


@query("share_of_total", """SELECT n_name AS nation, r_name AS region, n, round(n * 1.0 / sum(n) OVER (PARTITION BY r_name), 8) AS in_region FROM
    (SELECT n_name, r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)""")
def share_of_total(spark: SparkSession, d: str) -> DataFrame:
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    n = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    rows = n.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("nation"), F.col("r_name").alias("region"), "n")
    return R.share_of(rows, "n", ["region"], "in_region").withColumn("in_region", F.round("in_region", 8))


@query("pivot_status", """SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def pivot_status(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("priority")).pivot("o_orderstatus", ["F", "O", "P"]).count().fillna(0)


@query("arg_extremes", """SELECT c_nationkey::BIGINT AS nation, arg_max(c_custkey, (c_acctbal, -c_custkey)) AS richest, arg_min(c_custkey, (c_acctbal, c_custkey)) AS poorest, any_value(c_nationkey)::BIGINT AS same FROM customer GROUP BY 1""")
def arg_extremes(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, d, "customer").groupBy(F.col("c_nationkey").cast("long").alias("nation")).agg(
        F.max_by(key, F.struct("c_acctbal", -key)).alias("richest"), F.min_by(key, F.struct("c_acctbal", key)).alias("poorest"), F.any_value(F.col("c_nationkey").cast("long")).alias("same"),
    )


@query("widest_column", """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount >= l_tax AND l_discount >= l_quantity / 1000 THEN 'l_discount' WHEN l_tax >= l_quantity / 1000 THEN 'l_tax' ELSE 'l_per_mille' END AS widest FROM lineitem""")
def widest_column(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("l_per_mille", F.col("l_quantity") / 1000)
    return rows.select("l_orderkey", "l_linenumber", R.arg_max_column(["l_discount", "l_tax", "l_per_mille"]).alias("widest"))


@query("mode_and_samples", """WITH c AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2), m AS (SELECT p_brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_size) AS rn FROM c),
    s AS (SELECT p_brand, list_sort(list_distinct(list(p_name)))[1:3] AS names FROM part GROUP BY 1) SELECT m.p_brand, p_size::BIGINT AS mode_size, array_to_string(names, ' | ') AS samples FROM m JOIN s USING (p_brand) WHERE rn = 1""")
def mode_and_samples(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    first = part.groupBy("p_brand", "p_name").agg(F.lit(1).alias("x"))
    few = R.top_in_group(first, ["p_brand"], [F.asc("p_name")], 3).groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_list("p_name")), " | ").alias("samples"))
    return R.mode_smallest(part, ["p_brand"], "p_size", "mode_size").withColumn("mode_size", F.col("mode_size").cast("long")).join(few, "p_brand")


@query("hot_key_guard", """SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING count(*) >= 600) GROUP BY 1""")
def hot_key_guard(spark: SparkSession, d: str) -> DataFrame:
    return R.without_hot_keys(table(spark, d, "lineitem").select("l_suppkey"), ["l_suppkey"], 600).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("indices_to_average", """SELECT s_suppkey, round(s_acctbal / (SELECT avg(s_acctbal) FROM supplier), 8) AS idx, round((s_acctbal / (SELECT avg(s_acctbal) FROM supplier) + s_nationkey / (SELECT avg(s_nationkey) FROM supplier)) / 2, 8) AS composite,
    round(greatest(-2, least(2, (s_acctbal - (SELECT avg(s_acctbal) FROM supplier)) / (SELECT stddev_samp(s_acctbal) FROM supplier))), 8) AS z FROM supplier""")
def indices_to_average(spark: SparkSession, d: str) -> DataFrame:
    rows = R.index_to_average(table(spark, d, "supplier"), ["s_acctbal", "s_nationkey"], "composite")
    rows = R.standardise(rows, ["s_acctbal"])
    return rows.select("s_suppkey", F.round("idx_s_acctbal", 8).alias("idx"), F.round("composite", 8).alias("composite"), F.round("z_s_acctbal", 8).alias("z"))


@query("best_line", """SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_quantity BETWEEN 10 AND 30 THEN 0 ELSE 1 END, l_extendedprice DESC, l_linenumber) AS rn FROM lineitem) WHERE rn = 1""")
def best_line(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    order = [F.when(F.col("l_quantity").between(10, 30), 0).otherwise(1), F.desc("l_extendedprice"), F.asc("l_linenumber")]
    return R.best_row(rows, ["l_orderkey"], order).drop("l_quantity")


@query("top_customers_by_nation", """SELECT nation, c_custkey, total, rnk AS rank FROM (SELECT c_nationkey::BIGINT AS nation, c_custkey, round(sum(o_totalprice), 2) AS total, row_number() OVER (PARTITION BY c_nationkey ORDER BY round(sum(o_totalprice), 2) DESC, c_custkey) AS rnk
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, c_nationkey) WHERE rnk <= 3""")
def top_customers_by_nation(spark: SparkSession, d: str) -> DataFrame:
    sums = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    rows = sums.join(table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("nation")), "c_custkey")
    return R.top_in_group(rows, ["nation"], [F.desc("total"), F.asc("c_custkey")], 3)


@query("gaps_and_islands", """WITH e AS (SELECT user_id, event_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
    SELECT user_id, event_id, sum(CASE WHEN prev IS DISTINCT FROM event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT - 1 AS island FROM e""")
def gaps_and_islands(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    prev = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return R.group_ids(e.withColumn("prev", prev), [F.col("ts"), F.col("event_id")], ~F.col("prev").eqNullSafe(F.col("event_type")), ["user_id"], "island").select("user_id", "event_id", "island")


@query("forward_filled", """SELECT user_id, event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_value FROM events""")
def forward_filled(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("v"))
    return R.forward_fill(e, ["user_id"], [F.col("ts"), F.col("event_id")], "v", "last_value").select("user_id", "event_id", "last_value")


@query("top_parts", """SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 25 OFFSET 5""")
def top_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", "p_retailprice").orderBy(F.desc_nulls_last("p_retailprice"), "p_partkey").offset(5).limit(25)


@query("seeded_sample", """SELECT c_custkey FROM customer ORDER BY md5('42:' || c_custkey::VARCHAR), c_custkey LIMIT 50""")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return R.seeded_sample(table(spark, d, "customer").select("c_custkey"), "c_custkey", 50, 42)


@query("set_operations", """SELECT 'both' AS kind, k FROM (SELECT c_nationkey::BIGINT AS k FROM customer WHERE c_acctbal > 5000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
    UNION ALL SELECT 'only_customers', k FROM (SELECT c_nationkey::BIGINT AS k FROM customer WHERE c_acctbal > 5000 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
    UNION ALL SELECT 'either', k FROM (SELECT c_nationkey::BIGINT AS k FROM customer WHERE c_acctbal > 5000 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_nationkey").cast("long").alias("k")).distinct()
    s = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").cast("long").alias("k")).distinct()
    kind = lambda name, df: df.select(F.lit(name).alias("kind"), "k")
    return kind("both", c.intersect(s)).unionByName(kind("only_customers", c.subtract(s))).unionByName(kind("either", c.union(s).distinct()))


@query("cube_orders", """SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n, grouping(o_orderstatus)::BIGINT AS all_status FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def cube_orders(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.grouping("o_orderstatus").cast("long").alias("all_status"))
    return rows.withColumnsRenamed({"o_orderstatus": "status", "o_orderpriority": "priority"})


@query("json_properties", """SELECT event_type, count(*) AS n, count(json_extract_string(props, '$.k')) AS with_k, count(DISTINCT json_extract_string(props, '$.k')) AS ks FROM events GROUP BY 1""")
def json_properties(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count(k).alias("with_k"), F.countDistinct(k).alias("ks"))


@query("monthly_orders", """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, count(*) FILTER (o_orderdate >= date_trunc('month', o_orderdate) + INTERVAL 14 DAY) AS late FROM orders GROUP BY 1""")
def monthly_orders(spark: SparkSession, d: str) -> DataFrame:
    late = F.col("o_orderdate") >= F.date_trunc("month", "o_orderdate") + F.expr("INTERVAL 14 DAYS")
    return table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("late"))


@query("conversation_rollup", """SELECT conv_id, count(*) AS turns, string_agg(coalesce(role, ''), '>' ORDER BY turn, role, text) AS roles, max(length(text))::BIGINT AS longest FROM conversations GROUP BY 1""")
def conversation_rollup(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", F.substring("text", 1, 0).alias("t")))), lambda x: F.coalesce(x["role"], F.lit("")))
    return c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.array_join(ordered, ">").alias("roles"), F.max(F.length("text")).cast("long").alias("longest"))
