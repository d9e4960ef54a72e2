"""Queries that curate entities: cleaning and rules, table changes, spatial joins, linkage, graphs, logs and increments.

The tables hold no coordinates and pointers, so these queries derive them from keys by the same arithmetic as their SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, rules, similarity, text
from ..operators import dml, graph, linkage, spatial
from ..streaming import increments
from .registry import query, table
from .shapes import WINKLER

LAT, LON = "(({k} * 37) % 1200) / 10.0 - 60", "(({k} * 101) % 3600) / 10.0 - 180"
KM = "2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"


def _places(df: DataFrame, key: str) -> DataFrame:
    """(id, lat, lon) by integer arithmetic on the key."""
    k = F.col(key)
    return df.select(k.alias("id"), ((k * 37) % 1200 / F.lit(10.0) - 60).alias("lat"), ((k * 101) % 3600 / F.lit(10.0) - 180).alias("lon"))


def _points(name: str, key: str, rest: str = "") -> str:
    return f"SELECT {key} AS id, {LAT.format(k=key)} AS lat, {LON.format(k=key)} AS lon{rest} FROM {name}"


@query("clean_domains", r"""SELECT page_id, nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^[a-z][a-z0-9+.-]*://', ''), '[/?#].*$', ''), '^[^@]*@', ''), ':\d+$', ''), '^www\.', ''), '') AS host FROM pages""")
def clean_domains(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.clean_domain(F.col("url")).alias("host"))


@query("clean_phones", """SELECT c_custkey, '(' || substr(p, 1, 3) || ') ' || substr(p, 4, 3) || '-' || substr(p, 7, 4) AS phone, '+1' || p AS e164, 1.0 AS confidence
    FROM (SELECT c_custkey, (2000000000 + (c_custkey * 7919) % 1000000000)::VARCHAR AS p FROM customer)""")
def clean_phones(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("+1 "), (F.lit(2000000000) + (F.col("c_custkey") * 7919) % 1000000000).cast("string"))
    e = text.phone_e164(raw)
    return table(spark, d, "customer").select("c_custkey", text.clean_phone(raw).alias("phone"), e["phone"].alias("e164"), e["confidence"].alias("confidence"))


@query("clean_names", r"""SELECT s_suppkey, rtrim(regexp_replace(trim(regexp_replace(s_name || ',  Holdings ;', '\s+', ' ', 'g')), '[\s,;:]+$', '')) AS cleaned, upper(s_name) || ', .' AS matched FROM supplier""")
def clean_names(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.col("s_name"), F.lit(",  Holdings ;"))
    return table(spark, d, "supplier").select("s_suppkey", text.clean_text(raw).alias("cleaned"), text.match_name(F.concat(F.lit("The "), F.col("s_name"), F.lit(", Inc."))).alias("matched"))


@query("type_words", """SELECT p_partkey, len(list_intersect(w, ['widget', 'bolt', 'cold']))::DOUBLE / len(list_distinct(list_concat(w, ['widget', 'bolt', 'cold']))) AS score FROM (SELECT p_partkey, list_distinct(string_split(lower(p_name), ' ')) AS w FROM part)""")
def type_words(spark: SparkSession, d: str) -> DataFrame:
    w = F.array_distinct(F.split(F.lower("p_name"), " "))
    return table(spark, d, "part").select("p_partkey", text.jaccard(w, F.array(F.lit("widget"), F.lit("bolt"), F.lit("cold"))).alias("score"))


@query("classify_parts", """SELECT label, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(p_name, '(?i)widget') THEN 'brass' WHEN regexp_matches(p_name, '(?i)bolt|gear') THEN 'hard' WHEN regexp_matches(p_name, '(?i)^cold') THEN 'promo' ELSE 'other' END AS label FROM part) GROUP BY 1""")
def classify_parts(spark: SparkSession, d: str) -> DataFrame:
    label = rules.first_pattern(F.col("p_name"), [("widget", "brass"), ("bolt|gear", "hard"), ("^cold", "promo")], "other")
    return table(spark, d, "part").groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("longest_code", """SELECT p_partkey, CASE WHEN p_brand LIKE 'Brand#11%' THEN 'eleven' WHEN p_brand LIKE 'Brand#1%' THEN 'ten' WHEN p_brand LIKE 'Brand#%' THEN 'brand' END AS label FROM part""")
def longest_code(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", rules.longest_prefix(F.col("p_brand"), {"BRAND#11": "eleven", "BRAND#1": "ten", "BRAND#": "brand"}).alias("label"))


@query("status_machine", """SELECT o_orderstatus AS old, l_linestatus AS new, CASE WHEN o_orderstatus IN ('O', 'P') THEN (o_orderstatus || '>' || l_linestatus) IN ('O>P', 'P>F', 'O>F') ELSE l_linestatus = 'F' END AS allowed, count(*) AS n
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""")
def status_machine(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linestatus").alias("new")).join(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("old")), "l_orderkey")
    pairs = rows.groupBy("old", "new").agg(F.count(F.lit(1)).alias("n"))
    return pairs.select("old", "new", rules.transition_allowed(F.col("old"), F.col("new"), {"O": ["P", "F"], "P": ["F"]}, ["O"], ["F"]).alias("allowed"), "n")


@query("filter_reasons", """SELECT CASE WHEN coalesce(c_acctbal, -1) <= 0 THEN 'balance' WHEN c_nationkey >= 20 THEN 'nation' ELSE 'passed' END AS reason, count(*) AS n FROM customer GROUP BY 1""")
def filter_reasons(spark: SparkSession, d: str) -> DataFrame:
    return rules.filter_with_reasons(table(spark, d, "customer"), [("balance", F.col("c_acctbal") > 0), ("nation", F.col("c_nationkey") < 20)]).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("fallback_cascade", """WITH n AS (SELECT c_nationkey AS k, round(avg(c_acctbal), 4) AS v FROM customer GROUP BY 1 HAVING count(*) > 50), s AS (SELECT c_mktsegment AS k, round(avg(c_acctbal), 4) AS v FROM customer GROUP BY 1)
    SELECT c_custkey, coalesce(n.v, s.v) AS estimate, CASE WHEN n.v IS NOT NULL THEN 0.7 WHEN s.v IS NOT NULL THEN 0.5 END::DOUBLE AS confidence FROM customer LEFT JOIN n ON n.k = c_nationkey LEFT JOIN s ON s.k = c_mktsegment""")
def fallback_cascade(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    mean = F.round(F.avg("c_acctbal"), 4).alias("v")
    n = c.groupBy("c_nationkey").agg(mean, F.count(F.lit(1)).alias("n")).where("n > 50")
    s = c.groupBy("c_mktsegment").agg(mean)
    return rules.fallback(c, [(["c_nationkey"], n, "v", 0.7), (["c_mktsegment"], s, "v", 0.5)], "estimate", "confidence").select("c_custkey", "estimate", "confidence")


@query("upsert_customers", """SELECT coalesce(c_custkey, o_custkey) AS id, coalesce(nullif(c_mktsegment, ''), 'NEW') AS segment, greatest(c_acctbal, best) AS balance FROM (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 3 <> 0)
    FULL JOIN (SELECT o_custkey, round(max(o_totalprice), 2) AS best FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def upsert_customers(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    new = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.round(F.max("o_totalprice"), 2).alias("balance")).withColumn("segment", F.lit("NEW"))
    return dml.upsert(old, new, ["id"], {"segment": dml.fill_blank, "balance": dml.keep_larger})


@query("insert_ignore_replace", """SELECT 'ignore' AS kind, s_suppkey AS id, s_acctbal AS v FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT 'ignore', s_suppkey, 0.0 FROM supplier WHERE s_suppkey % 2 = 1
    UNION ALL SELECT 'replace', s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 0.0 ELSE s_acctbal END FROM supplier WHERE s_suppkey % 2 = 0 OR s_suppkey % 5 = 0""")
def insert_ignore_replace(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("v"))
    even, zero = s.where("id % 2 = 0"), s.withColumn("v", F.lit(0.0))
    ignored = dml.insert_ignore(even, zero, ["id"], [F.asc("v")]).select(F.lit("ignore").alias("kind"), "id", "v")
    replaced = dml.insert_or_replace(even, zero.where("id % 5 = 0"), ["id"], [F.asc("v")]).select(F.lit("replace").alias("kind"), "id", "v")
    return ignored.unionByName(replaced)


@query("update_counts", """SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders FROM customer""")
def update_counts(spark: SparkSession, d: str) -> DataFrame:
    return dml.update_counts(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders"), "c_custkey", "o_custkey", "n_orders")


@query("change_log", """SELECT c_custkey, 'c_mktsegment' AS field, c_mktsegment AS old_value, upper(substr(c_mktsegment, 1, 4)) AS new_value FROM customer WHERE c_mktsegment <> upper(substr(c_mktsegment, 1, 4))
    UNION ALL SELECT c_custkey, 'c_nationkey', c_nationkey::VARCHAR, NULL FROM customer WHERE c_nationkey = 7""")
def change_log(spark: SparkSession, d: str) -> DataFrame:
    before = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    after = before.withColumns({"c_mktsegment": F.upper(F.substring("c_mktsegment", 1, 4)), "c_nationkey": F.when(F.col("c_nationkey") != 7, F.col("c_nationkey"))})
    return dml.changed_fields(before, after, "c_custkey", ["c_mktsegment", "c_nationkey"], cut=500)


@query("constraint_checks", """SELECT 'positive' AS "check", count(*) FILTER (NOT (c_acctbal > 0)) AS violations FROM customer UNION ALL SELECT 'known_segment', count(*) FILTER (NOT (c_mktsegment IN ('BUILDING', 'MACHINERY'))) FROM customer""")
def constraint_checks(spark: SparkSession, d: str) -> DataFrame:
    return dml.violations(table(spark, d, "customer"), {"positive": F.col("c_acctbal") > 0, "known_segment": F.col("c_mktsegment").isin("BUILDING", "MACHINERY")})


@query("radius_counts", f"""WITH a AS ({_points('supplier', 's_suppkey')}), b AS ({_points('customer', 'c_custkey', ', c_acctbal AS v')}),
    p AS (SELECT a.id, {KM} AS km, v FROM a, b) SELECT a.id, coalesce(sum(CASE WHEN km <= 200 THEN 1 END), 0)::BIGINT AS n_200, coalesce(sum(CASE WHEN km <= 800 THEN 1 END), 0)::BIGINT AS n_800 FROM a LEFT JOIN p ON p.id = a.id GROUP BY 1""")
def radius_counts(spark: SparkSession, d: str) -> DataFrame:
    return spatial.radius_sums(_places(table(spark, d, "supplier"), "s_suppkey"), _places(table(spark, d, "customer"), "c_custkey"), "id", None, [200, 800], prefix="n")


@query("nearest_supplier", f"""WITH a AS ({_points('customer', 'c_custkey')}), b AS ({_points('supplier', 's_suppkey')}), p AS (SELECT a.id, b.id AS sid, {KM} AS km FROM a, b),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(km, 6), sid) AS rank FROM p) SELECT id, sid, round(km, 4) AS km FROM r WHERE rank = 1""")
def nearest_supplier(spark: SparkSession, d: str) -> DataFrame:
    s = _places(table(spark, d, "supplier"), "s_suppkey").withColumnRenamed("id", "sid")
    found = spatial.nearest(_places(table(spark, d, "customer"), "c_custkey"), s, "id", "sid")
    return found.select("id", "sid", F.round("km", 4).alias("km"))


def _squares(df: DataFrame) -> DataFrame:
    """A square of 20 degrees around the place of each nation."""
    k = F.col("n_nationkey")
    lat, lon = (k * 37) % 100 - 50, (k * 101) % 320 - 160
    corner = lambda a, b: F.struct((lon + a).cast("double").alias("x"), (lat + b).cast("double").alias("y"))
    return df.select(k.cast("long").alias("nation"), F.array(corner(-10, -10), corner(10, -10), corner(10, 10), corner(-10, 10)).alias("ring"))


@query("points_in_squares", f"""WITH p AS ({_points('customer', 'c_custkey')}), q AS (SELECT n_nationkey::BIGINT AS nation, (n_nationkey * 37) % 100 - 50 AS qlat, (n_nationkey * 101) % 320 - 160 AS qlon FROM nation)
    SELECT id, min(nation) AS nation, count(*) AS hits FROM p JOIN q ON lat > qlat - 10 AND lat < qlat + 10 AND lon > qlon - 10 AND lon < qlon + 10 GROUP BY 1""")
def points_in_squares(spark: SparkSession, d: str) -> DataFrame:
    hits = spatial.in_polygon(_places(table(spark, d, "customer"), "c_custkey"), _squares(table(spark, d, "nation")), "nation", cell=5.0)
    return hits.groupBy("id").agg(F.min("nation").alias("nation"), F.count(F.lit(1)).alias("hits"))


@query("haversine_pairs", f"""WITH a AS ({_points('supplier', 's_suppkey')}), b AS (SELECT s_suppkey AS id, lat, lon FROM (SELECT s_suppkey, {LAT.format(k='(s_suppkey + 1)')} AS lat, {LON.format(k='(s_suppkey + 1)')} AS lon FROM supplier))
    SELECT a.id, round({KM}, 6) AS km FROM a JOIN b USING (id)""")
def haversine_pairs(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    a, b = _places(s, "s_suppkey"), _places(s.select((F.col("s_suppkey") + 1).alias("k")), "k").select((F.col("id") - 1).alias("id"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return a.join(b, "id").select("id", F.round(geo.haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")), 6).alias("km"))


@query("waterfall_match", """WITH l AS (SELECT c_custkey, c_nationkey, c_mktsegment FROM customer), r AS (SELECT s_suppkey, s_nationkey FROM supplier),
    h AS (SELECT c_custkey, s_suppkey, 0 AS o, 'key' AS tier FROM l JOIN r ON s_suppkey = c_custkey UNION ALL SELECT c_custkey, min(s_suppkey), 1, 'nation' FROM l JOIN r ON s_nationkey = c_nationkey GROUP BY 1)
    SELECT c_custkey, s_suppkey, tier FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY o) AS rn FROM h) WHERE rn = 1""")
def waterfall_match(spark: SparkSession, d: str) -> DataFrame:
    return linkage.waterfall(table(spark, d, "customer"), table(spark, d, "supplier"), "c_custkey", "s_suppkey", [("key", F.col("c_custkey"), F.col("s_suppkey")), ("nation", F.col("c_nationkey").cast("long"), F.col("s_nationkey").cast("long"))])


def _clones(df: DataFrame) -> DataFrame:
    return df.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 400).alias("key"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("a"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).alias("b"))


_CLONES = "SELECT c_custkey AS id, c_custkey % 400 AS key, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS a, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS b FROM customer"


@query("merged_duplicates", f"""WITH d AS ({_CLONES}), s AS (SELECT *, first_value(id) OVER (PARTITION BY key ORDER BY (a IS NOT NULL)::INT + (b IS NOT NULL)::INT DESC, id) AS survivor FROM d WHERE key IN (SELECT key FROM d GROUP BY 1 HAVING count(*) > 1))
    SELECT survivor AS id, arg_min(a, (id <> survivor, id)) FILTER (a IS NOT NULL) AS a, arg_min(b, (id <> survivor, id)) FILTER (b IS NOT NULL) AS b FROM s GROUP BY 1""")
def merged_duplicates(spark: SparkSession, d: str) -> DataFrame:
    rows = _clones(table(spark, d, "customer"))
    groups = linkage.duplicate_groups(rows, "id", [F.col("key")]).select("id", "group_id")
    picked = linkage.pick_survivors(rows.join(groups, "id"), "id", "group_id", ["a", "b"])
    return linkage.fill_survivors(picked, "id", "survivor", ["a", "b"])


@query("flat_pointers", """WITH RECURSIVE p(id, cur, hops) AS (SELECT c_custkey, c_custkey // 3, 1 FROM customer WHERE c_custkey // 3 <> c_custkey UNION ALL SELECT p.id, p.cur // 3, hops + 1 FROM p JOIN customer ON c_custkey = p.cur WHERE p.cur // 3 <> p.cur)
    SELECT id, arg_max(cur, hops) AS terminal, max(hops)::BIGINT AS hops, CASE WHEN arg_max(cur, hops) IN (SELECT c_custkey FROM customer) THEN 'ok' ELSE 'dangling' END AS state FROM p GROUP BY id
    UNION ALL SELECT c_custkey, c_custkey, 0, 'self' FROM customer WHERE c_custkey // 3 = c_custkey""")
def flat_pointers(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.floor(F.col("c_custkey") / 3).alias("to"))
    return graph.flatten_pointers(nodes, "id", "to").select("id", "terminal", "hops", "state")


@query("linked_components", """WITH RECURSIVE p(id, cur) AS (SELECT s_suppkey, s_suppkey FROM supplier WHERE s_suppkey % 7 = 1 UNION ALL SELECT p.id, p.cur + 1 FROM p WHERE p.cur % 7 BETWEEN 1 AND 5 AND p.cur + 1 IN (SELECT s_suppkey FROM supplier))
    SELECT cur AS node, id AS component FROM p WHERE id IN (SELECT id FROM p GROUP BY 1 HAVING count(*) > 1)""")
def linked_components(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("u"))
    edges = s.where("u % 7 BETWEEN 1 AND 5").select("u", (F.col("u") + 1).alias("v")).join(s.select(F.col("u").alias("v")), "v", "left_semi")
    return graph.connected_components(edges)


@query("tree_depths", """WITH RECURSIVE t(id, depth) AS (SELECT p_partkey, 0 FROM part WHERE p_partkey // 5 = 0 UNION ALL SELECT p_partkey, depth + 1 FROM part JOIN t ON p_partkey // 5 = t.id WHERE p_partkey // 5 > 0) SELECT depth::BIGINT AS depth, count(*) AS n FROM t GROUP BY 1""")
def tree_depths(spark: SparkSession, d: str) -> DataFrame:
    up = F.floor(F.col("p_partkey") / 5)
    tree = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.when(up > 0, up).alias("parent"))
    return graph.depths(tree, "id", "parent").groupBy(F.col("depth").cast("long").alias("depth")).agg(F.count(F.lit(1)).alias("n"))


@query("tree_closure", """WITH RECURSIVE c(descendant, ancestor, distance) AS (SELECT p_partkey, p_partkey, 0 FROM part UNION ALL SELECT descendant, ancestor // 5, distance + 1 FROM c WHERE ancestor // 5 > 0)
    SELECT ancestor, count(*) AS subtree, max(distance)::BIGINT AS height FROM c WHERE ancestor IN (SELECT p_partkey FROM part) GROUP BY 1""")
def tree_closure(spark: SparkSession, d: str) -> DataFrame:
    up = F.floor(F.col("p_partkey") / 5)
    tree = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.when(up > 0, up).alias("parent"))
    return graph.ancestors(tree, "id", "parent").groupBy("ancestor").agg(F.count(F.lit(1)).alias("subtree"), F.max("distance").cast("long").alias("height"))


@query("similar_types", """WITH n AS (SELECT DISTINCT p_name AS t, string_split(p_name, ' ') AS w FROM part), k AS (SELECT t, unnest([concat_ws(' ', '01', w[1], w[2]), concat_ws(' ', '02', w[1], w[3]), concat_ws(' ', '12', w[2], w[3])]) AS k FROM n),
    p AS (SELECT DISTINCT a.t AS t, b.t AS other FROM k a JOIN k b ON a.k = b.k AND a.t < b.t) SELECT t, other, score FROM (SELECT t, other, round(""" + WINKLER.format(a="t", b="other") + """, 6)::DOUBLE AS score FROM p) WHERE score >= 0.7""")
def similar_types(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of distinct part names that share two words of three, with their Jaro-Winkler similarity from 0.7 on."""
    types = table(spark, d, "part").select(F.col("p_name").alias("t")).distinct()
    words: Column = F.split("t", " ")
    pair = lambda i, j: F.concat_ws(" ", F.lit(f"{i}{j}"), F.get(words, F.lit(i)), F.get(words, F.lit(j)))
    keyed = types.select("t", F.explode(F.array(pair(0, 1), pair(0, 2), pair(1, 2))).alias("k"))
    pairs = keyed.join(keyed.select(F.col("t").alias("other"), "k"), "k").where("t < other").select("t", "other").distinct()
    return pairs.select("t", "other", F.round(similarity.jaro_winkler(F.col("t"), F.col("other")), 6).alias("score")).where("score >= 0.7")


@query("latest_change", """SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type, max(ts) AS last_ts, count(*) AS n FROM events GROUP BY 1""")
def latest_change(spark: SparkSession, d: str) -> DataFrame:
    return increments.latest(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], {"last_type": "event_type", "last_ts": "ts"})


@query("tumbling_counts", """SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def tumbling_counts(spark: SparkSession, d: str) -> DataFrame:
    return increments.tumbling(table(spark, d, "events"), "1 hour", ["event_type"], "value")


@query("session_windows", """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
    s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e) SELECT user_id, min(ts) AS session_start, max(ts) AS last_ts, count(*) AS n FROM s GROUP BY user_id, sid""")
def session_windows(spark: SparkSession, d: str) -> DataFrame:
    return increments.sessions(table(spark, d, "events"), "user_id", "30 minutes")


@query("due_again", """SELECT user_id, max(ts) AS last_ts FROM events GROUP BY 1 HAVING max(ts) < (SELECT date_trunc('month', max(ts)) FROM events) UNION ALL SELECT user_id, max(ts) FROM (SELECT CASE WHEN user_id % 3 = 0 THEN ts - INTERVAL 3 MONTH ELSE ts END AS ts, -user_id - 1 AS user_id FROM events) GROUP BY 1 HAVING max(ts) < (SELECT date_trunc('month', max(ts)) FROM events)""")
def due_again(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    # a third of the users, under numbers of their own, was last seen three months before
    early = F.when(F.col("user_id") % 3 == 0, F.col("ts") - F.expr("INTERVAL 3 MONTH")).otherwise(F.col("ts"))
    moved = events.select((-F.col("user_id") - 1).alias("user_id"), early.alias("ts"))
    return increments.due(events.select("user_id", "ts").unionByName(moved), "user_id", "ts", months_back=0)
