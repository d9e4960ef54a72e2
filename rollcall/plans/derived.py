"""Queries of rules whose hard cases are made from the keys of the tables; the SQL applies the rules to the same inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, labels, rules, similarity, text
from ..operators import geocode, graph, linkage, matching, provenance, pyramid, spatial
from ..operators.settled import settle, shared_dir
from ..sources import files
from .registry import query, table
from .shapes import WINKLER, shapes


SQUEEZE = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
CLEAN = r"rtrim(regexp_replace(" + SQUEEZE + r", '[\s,;:]+$', ''))"
RAW_NAMES = shapes(
    "c_custkey", "Grace (North {k}) Chapel, Inc. LLC", "  The  Hope {k} Corp of  St. Mark ", "Org of Faith and an Ark {k}", "Mt Olive Ch N Side {k} PC", "Corporation Street Mission {k};", "{k} The A Ark an Inc of the PA", None, ""
)


@query(
    "name_keys",
    rf"""WITH r AS (SELECT c_custkey AS id, {RAW_NAMES} AS raw FROM customer), u AS (SELECT id, raw, upper(trim(raw)) AS m FROM r),
    s AS (SELECT id, raw, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(m, '\s+INC\b', ' ', 'g'), '\s+LLC\b', ' ', 'g'), '\s+CORP\b', ' ', 'g'), '\s+PC\b', ' ', 'g'), '\s+PA\b', ' ', 'g'), '\s+THE\b', ' ', 'g'), '\s+A\s+', ' ', 'g'), '\s+AN\s+', ' ', 'g') AS m FROM u)
    SELECT id, {SQUEEZE.format(rf"regexp_replace(regexp_replace({CLEAN.format('raw')}, '(?i)\b(?:INC|LLC|CORP|CORPORATION|ORG)\b\.?', '', 'g'), '\s*\(.*?\)\s*', ' ', 'g')")} AS cleaned, regexp_replace({SQUEEZE.format('m')}, '^THE\s+', '') AS matched,
      coalesce(array_to_string(list_transform(string_split({SQUEEZE.format(r"regexp_replace(upper(raw), '[^A-Z0-9_\s]', ' ', 'g')")}, ' '), lambda w: CASE w WHEN 'ST' THEN 'STREET' WHEN 'MT' THEN 'MOUNT' WHEN 'N' THEN 'NORTH' WHEN 'CH' THEN 'CHURCH' ELSE w END), ' '), '') AS linked FROM s""",
)
def name_keys(spark: SparkSession, d: str) -> DataFrame:
    n = F.expr(RAW_NAMES)
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), text.clean_name(n).alias("cleaned"), text.match_name(n).alias("matched"), text.linkage_name(n).alias("linked"))


RAW_EMAILS = shapes(
    "c_custkey", "mailto:<A{k}@B.org>.", "a{k}@b.org (office)", "<Info@Grace{k}.org>", "info@grace{k}.org", "pastor@gmail.com", "john.smith@a.b.c{k}.org", "JOHN@x{k}.org", "jo@x{k}.org", "noreply@x{k}.org", "Secretary@X{k}.ORG.", "two@at@x{k}.org", "no address {k}", "", None
)


@query(
    "email_rules",
    rf"""WITH r AS (SELECT c_custkey AS id, {RAW_EMAILS} AS raw FROM customer), s AS (SELECT *, trim(raw) AS whole, lower(trim(split_part(trim(raw), '@', 1))) AS local, lower(split_part(trim(raw), '@', -1)) AS domain FROM r),
    t AS (SELECT *, CASE local WHEN 'info' THEN 0.6 WHEN 'pastor' THEN 1.0 WHEN 'noreply' THEN 0.0 WHEN 'secretary' THEN 0.8 ELSE CASE WHEN regexp_full_match(local, '[a-z]+(\.[a-z]+)?') AND length(local) > 2 THEN 0.8 ELSE 0.3 END END AS a,
      CASE WHEN domain = 'gmail.com' THEN 0.4 WHEN length(domain) - length(replace(domain, '.', '')) > 2 THEN 0.5 ELSE 0.9 END AS b FROM s)
    SELECT id, regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(raw)), '^mailto:', ''), '^<(.*)>$', '\1'), '\s*\(.*?\)\s*', '', 'g')), '\.+$', '') AS cleaned,
      CASE WHEN regexp_full_match(whole, '[^@]+@[^@]+') THEN round(a * 0.6 + b * 0.4, 2) ELSE 0 END::DOUBLE AS score FROM t""",
)
def email_rules(spark: SparkSession, d: str) -> DataFrame:
    raw = F.expr(RAW_EMAILS)
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), text.clean_email(raw).alias("cleaned"), text.email_score(raw).alias("score"))


RAW_BOXES = shapes("c_custkey", "BOX {k}, Odgen, IL, 62863", "PO BOX {k}, Springfield, MO 65801", "POB {k} , Rural Route,  Gary, IN, 46401", "Hall, p.o.box {k}, Town, IL, 60000", "Boxwood {k}, Elm, IL, 60001", "{k} North Mill Street, Colfax, WA 99111", "PO BOX {k}", None)


@query(
    "post_boxes",
    rf"""WITH r AS (SELECT c_custkey AS id, {RAW_BOXES} AS raw FROM customer), p AS (SELECT *, list_transform(string_split(raw, ','), lambda x: trim(x)) AS p FROM r)
    SELECT id, CASE WHEN regexp_matches(upper(raw), '\b(PO BOX|P\.?O\.?\s*BOX|POB|BOX)\b') AND len(p) >= 3 THEN array_to_string(p[-3:], ', ') ELSE raw END AS kept FROM p""",
)
def post_boxes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), text.without_po_box(F.expr(RAW_BOXES)).alias("kept"))


_TEN = "2000000000 + (c_custkey * 7919) % 1000000000"
RAW_PHONES = f"CASE c_custkey % 7 WHEN 0 THEN concat('1-', {_TEN}) WHEN 1 THEN concat('(', substr(concat({_TEN}), 1, 3), ') ', substr(concat({_TEN}), 4)) WHEN 2 THEN concat(' ', c_custkey % 1000, '-0199 ') WHEN 3 THEN concat('2', {_TEN}) WHEN 4 THEN '' WHEN 5 THEN ' ' END"


@query(
    "phone_shapes",
    rf"""WITH r AS (SELECT c_custkey AS id, {RAW_PHONES} AS raw FROM customer), s AS (SELECT *, regexp_replace(raw, '\D', '', 'g') AS g FROM r), t AS (SELECT *, CASE WHEN length(g) = 10 THEN g WHEN length(g) = 11 AND g[1] = '1' THEN substr(g, 2) END AS ten FROM s)
    SELECT id, CASE WHEN ten IS NOT NULL THEN '(' || substr(ten, 1, 3) || ') ' || substr(ten, 4, 3) || '-' || substr(ten, 7, 4) ELSE trim(raw) END AS phone,
      CASE WHEN ten IS NOT NULL THEN '+1' || ten WHEN trim(raw) <> '' THEN trim(raw) END AS e164, CASE WHEN ten IS NOT NULL THEN 1.0 WHEN trim(raw) <> '' THEN 0.3 END::DOUBLE AS confidence, nullif(substr(g, 1, 5), '') AS zip FROM t""",
)
def phone_shapes(spark: SparkSession, d: str) -> DataFrame:
    raw = F.expr(RAW_PHONES)
    e = text.phone_e164(raw)
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), text.clean_phone(raw).alias("phone"), e["phone"].alias("e164"), e["confidence"].alias("confidence"), text.clean_zip(raw).alias("zip"))


ALIKE = WINKLER.format(a="a", b="b")


@query(
    "name_similarity",
    f"""WITH p AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE p_name END AS a, lead(p_name) OVER (ORDER BY p_partkey) AS b FROM part) SELECT id, round({ALIKE}, 6)::DOUBLE AS score FROM p""",
)
def name_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Each part's name against the next one's."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("n"))
    pairs = p.join(p.select((F.col("id") - 1).alias("id"), F.col("n").alias("b")), "id", "left")
    return pairs.select("id", F.round(similarity.jaro_winkler(F.when(F.col("id") % 9 == 0, "").otherwise(F.col("n")), F.col("b")), 6).alias("score"))


_TITLE = shapes("c_custkey", "Grace Church {k} Inc.", "Welcome to Grace Chapel {k} - Home", "Grace Bible Fellowship {k} of Gary", "Grace {k}", "zzz", "", None, "Hope")
_NAME = shapes("c_custkey", "grace {k}", "Grace Chapel {k}", "Grace Bible Fellowship {k} Center", "Grace {k} Chapel Home", "Hope", "Hope", "Hope", None)
TITLE_SCORE = r"""CASE WHEN coalesce(title, '') = '' OR coalesce(name, '') = '' THEN 0.0 WHEN trim(regexp_replace(regexp_replace(t, '\b(inc|llc|church|ministries|org|corporation)\b\.?', '', 'g'), '\s+', ' ', 'g')) = trim(regexp_replace(regexp_replace(n, '\b(inc|llc|church|ministries|org|corporation)\b\.?', '', 'g'), '\s+', ' ', 'g')) THEN 1.0
      WHEN contains(t, n) THEN 0.9 WHEN len(list_intersect(wn, wt)) >= 0.7 * len(wn) THEN 0.8 WHEN len(list_intersect(wn, wt)) >= 0.5 * len(wn) THEN 0.6 ELSE 0.0 END"""
TITLE_WORDS = "SELECT *, lower(trim(title)) AS t, lower(trim(name)) AS n, list_distinct(regexp_extract_all(lower(trim(title)), '[a-z0-9]+')) AS wt, list_distinct(regexp_extract_all(lower(trim(name)), '[a-z0-9]+')) AS wn FROM r"


@query("title_scores", f"""WITH r AS (SELECT c_custkey AS id, {_TITLE} AS title, {_NAME} AS name FROM customer), s AS ({TITLE_WORDS}) SELECT id, ({TITLE_SCORE})::DOUBLE AS score FROM s""")
def title_scores(spark: SparkSession, d: str) -> DataFrame:
    """Titles that equal a name but for empty words, hold it, share words with it, or have not a letter in common."""
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), similarity.title_score(F.expr(_TITLE), F.expr(_NAME)).alias("score"))


_CITY = shapes("c_custkey", "Gary", "Lima", None, "", "Ohio City")
_BODY = shapes("c_custkey", "Sunday worship at our church in Gary {k}", "", None, "church ministry worship sunday service pastor congregation chapel gospel", "a chapel IN Lima", "{k}")


@query(
    "page_matches",
    f"""WITH r AS (SELECT c_custkey AS id, {_TITLE} AS title, {_NAME} AS name, {_CITY} AS city, CASE WHEN c_custkey % 2 = 0 THEN 'in' END AS state, {_BODY} AS body FROM customer), s AS ({TITLE_WORDS}),
    p AS (SELECT *, CASE WHEN coalesce(title, '') <> '' THEN lower(concat_ws(' ', title, '', coalesce(body, ''))) ELSE '' END AS page, len(list_filter(['church', 'ministry', 'worship', 'sunday', 'service', 'pastor', 'congregation', 'chapel', 'gospel'], lambda w: contains(lower(coalesce(body, '')), w))) AS told FROM s),
    q AS (SELECT id, ({TITLE_SCORE}) * 0.5 + CASE WHEN coalesce(city, '') <> '' AND contains(page, lower(city)) THEN 0.15 ELSE 0 END + CASE WHEN coalesce(state, '') <> '' AND contains(page, state) THEN 0.1 ELSE 0 END + least(told * 0.05, 0.25) AS total FROM p)
    SELECT id, round(least(total, 1.0), 2)::DOUBLE AS score, round(total, 9) >= 0.5 AS is_match FROM q""",
)
def page_matches(spark: SparkSession, d: str) -> DataFrame:
    m = similarity.match_score(F.expr(_NAME), F.expr(_CITY), F.when(F.col("c_custkey") % 2 == 0, "in"), F.expr(_TITLE), F.lit(""), F.expr(_BODY))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), m["score"].alias("score"), m["is_match"].alias("is_match"))


_STATUS = "CASE {k} % 8 WHEN 1 THEN '' WHEN 2 THEN 'pending' WHEN 3 THEN 'found' WHEN 4 THEN 'not_found' WHEN 5 THEN 'verified' WHEN 6 THEN 'error' WHEN 7 THEN 'archived' END"


@query(
    "status_rules",
    f"""WITH s AS (SELECT c_custkey AS id, {_STATUS.format(k='c_custkey')} AS a, {_STATUS.format(k='(c_custkey // 8)')} AS b FROM customer)
    SELECT id, CASE WHEN b IS NULL THEN false WHEN coalesce(a, '') = '' THEN b = 'pending' WHEN a = 'pending' THEN b IN ('found', 'not_found', 'error') WHEN a = 'found' THEN b IN ('verified', 'not_found', 'error')
      WHEN a = 'not_found' THEN b IN ('found', 'error') WHEN a = 'verified' THEN b = 'error' WHEN a = 'error' THEN b IN ('pending', 'found', 'not_found') ELSE b IN ('found', 'not_found', 'verified', 'error') END AS allowed,
      coalesce(a, '') IN ('', 'pending', 'error') AS open, coalesce(a, '') IN ('found', 'not_found', 'verified') AS done FROM s""",
)
def status_rules(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of eight statuses, nulls, blanks and an unlisted one among them."""
    old, new = F.expr(_STATUS.format(k="c_custkey")), F.expr(_STATUS.format(k="(c_custkey div 8)"))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), rules.transition_allowed(old, new).alias("allowed"), rules.needs_check(old).alias("open"), rules.is_done(old).alias("done"))


@query(
    "link_tiers",
    """WITH t AS (SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS one, CASE WHEN c_custkey % 8 < 7 THEN 0.86 + c_custkey % 8 * 0.02 END AS alike, CASE WHEN c_custkey % 5 < 4 THEN c_custkey % 5 * 0.9 END AS km,
      CASE c_custkey % 7 % 3 WHEN 0 THEN true WHEN 1 THEN false END AS stem, CASE c_custkey % 11 % 3 WHEN 0 THEN true WHEN 1 THEN false END AS fits FROM customer)
    SELECT id, CASE WHEN one AND alike >= 0.9 THEN 1 WHEN one THEN CASE WHEN fits IS NOT false THEN 2 END WHEN alike >= 0.95 AND CASE WHEN km IS NULL THEN coalesce(stem, false) ELSE km <= 2 END AND fits IS NOT false THEN 3 END AS tier FROM t""",
)
def link_tiers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    three = lambda x: F.when(x % 3 == 0, True).when(x % 3 == 1, False)
    tier = linkage.tier_of(three(k), F.when(k % 8 < 7, 0.86 + k % 8 * 0.02), F.when(k % 5 < 4, k % 5 * 0.9), three(k % 7), three(k % 11))
    return table(spark, d, "customer").select(k.alias("id"), tier.alias("tier"))


RAW_NODES = shapes("p_partkey", "misc", "Misc house {k}", "node {k}", "{k}", "Room {k}", "Contest {k}", "What {k}?", "", None, "house {k} misc", "UNKNOWN {k}")


@query("suspicious_names", rf"""WITH r AS (SELECT p_partkey AS id, {RAW_NODES} AS name FROM part) SELECT id, coalesce(regexp_matches(lower(name), '\?|unknown|n/a|tbd|xxx|test|temp|delete|misc$|^node |^\d+$'), false) AS suspicious FROM r""")
def suspicious_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), labels.suspicious_name(F.expr(RAW_NODES)).alias("suspicious"))


RULES = [(("LUTHERAN", "ELCA"), "lutheran"), (("BAPTIST",), "baptist"), (("CHURCH OF GOD", "C.O.G."), "church of god")]
_RULE_SQL = "CASE WHEN contains(upper({0}), 'LUTHERAN') OR contains(upper({0}), 'ELCA') THEN 'lutheran' WHEN contains(upper({0}), 'BAPTIST') THEN 'baptist' WHEN contains(upper({0}), 'CHURCH OF GOD') OR contains(upper({0}), 'C.O.G.') THEN 'church of god' END"
_LD = '<script type="application/ld+json">{}</script>'
_HTML = shapes(
    "page_id", _LD.format('{"a": [{"affiliation": "ab"}, {"x": {"denomination": "Reformed {k}"}}]}') + " baptist", _LD.format("{broken") + _LD.format('{"affiliation": "Quaker {k}"}'),
    _LD.format('{"a": {"b": {"c": {"d": {"e": {"f": {"denomination": "deep"}}}}}}}') + "<p>none</p>", "<p>First Baptist {k}, an elca house</p>", "<p>c.o.g. but not cxoxgx</p>", "<p>cxoxgx {k}</p>", "", None,
)


@query(
    "webpage_labels",
    f"""WITH r AS (SELECT page_id AS id, {_HTML} AS html, CASE WHEN page_id % 3 > 0 THEN 'Baptist home' END AS title FROM pages),
    j AS (SELECT *, CASE id % 8 WHEN 0 THEN regexp_extract(html, '"denomination": "([^"]*)"', 1) WHEN 1 THEN regexp_extract(html, '"affiliation": "([^"]*)"', 1) END AS told, {_RULE_SQL.format('html')} AS body, {_RULE_SQL.format('title')} AS head FROM r)
    SELECT id, CASE WHEN coalesce(html, '') = '' THEN 'unknown' ELSE coalesce(told, body, head, 'unknown') END AS label, CASE WHEN coalesce(html, '') = '' THEN 'no_content' WHEN told IS NOT NULL THEN 'jsonld' WHEN body IS NOT NULL THEN 'body_keyword' WHEN head IS NOT NULL THEN 'title_keyword' ELSE 'no_match' END AS method FROM j""",
)
def webpage_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of pages: nested and broken JSON-LD, one too deep, keywords of the body, then of the title."""
    x = labels.webpage_label(F.expr(_HTML), F.when(F.col("page_id") % 3 > 0, "Baptist home"), RULES)
    return table(spark, d, "pages").select(F.col("page_id").alias("id"), x["label"].alias("label"), x["method"].alias("method"))


KINDS = {"mosque": "muslim", "synagogue": "jewish", "religious_organization": "unknown"}


@query(
    "graph_labels",
    f"""WITH r AS (SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'A Lutheran parish' WHEN 1 THEN 'A house' END AS t, CASE c_custkey % 4 WHEN 0 THEN 'Mosque' WHEN 1 THEN 'Religious_Organization' WHEN 2 THEN 'Thing' END AS n, CASE c_custkey % 5 WHEN 0 THEN 'SYNAGOGUE' WHEN 1 THEN 'y' END AS i FROM customer),
    f AS (SELECT *, CASE lower(n) WHEN 'mosque' THEN 'muslim' END AS a, CASE lower(i) WHEN 'synagogue' THEN 'jewish' END AS b FROM r) SELECT id, coalesce({_RULE_SQL.format('t')}, a, b, CASE WHEN id % 7 = 0 THEN 'muslim' END) AS label FROM f""",
)
def graph_labels(spark: SparkSession, d: str) -> DataFrame:
    """By words of the description, else by the first category whose name, or else id, says something."""
    k = F.col("c_custkey")
    kind = lambda n, i: F.struct(n.alias("name"), i.alias("id"))
    first = kind(F.when(k % 4 == 0, "Mosque").when(k % 4 == 1, "Religious_Organization").when(k % 4 == 2, "Thing"), F.when(k % 5 == 0, "SYNAGOGUE").when(k % 5 == 1, "y"))
    more = F.when(k % 7 == 0, F.array(first, kind(F.lit("mosque"), F.lit("z")))).otherwise(F.array(first))
    label = labels.graph_label(F.when(k % 3 == 0, "A Lutheran parish").when(k % 3 == 1, "A house"), more, [(label, w) for w, label in RULES], KINDS)
    return table(spark, d, "customer").select(k.alias("id"), label.alias("label"))


#: A tree of parts, four to a node, with orphans, a node that is its own parent, pairs that are each other's, and names of both cases.
TREE = """SELECT p_partkey AS id, CASE WHEN p_partkey = 0 THEN NULL WHEN p_partkey % 50 = 27 THEN 9000000 + p_partkey WHEN p_partkey % 60 = 31 THEN p_partkey WHEN p_partkey % 40 = 34 THEN p_partkey + 1 WHEN p_partkey % 40 = 35 THEN p_partkey - 1 ELSE p_partkey // 4 END AS parent,
    CASE p_partkey % 9 WHEN 0 THEN 'same' WHEN 1 THEN ' Same ' WHEN 2 THEN NULL ELSE 'n' || p_partkey END AS name FROM part"""
WALK = f"""t AS ({TREE}), down AS (SELECT id, id AS root, 0 AS depth, coalesce(name, '') AS path, name IS NOT NULL AS has FROM t WHERE parent IS NULL
    UNION ALL SELECT t.id, d.root, d.depth + 1, CASE WHEN t.name IS NULL THEN d.path WHEN d.has THEN d.path || ' > ' || t.name ELSE t.name END, d.has OR t.name IS NOT NULL FROM down d JOIN t ON t.parent = d.id AND t.id <> t.parent)"""


def _tree(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    parent = F.when(k == 0, F.lit(None)).when(k % 50 == 27, 9_000_000 + k).when(k % 60 == 31, k).when(k % 40 == 34, k + 1).when(k % 40 == 35, k - 1).otherwise(F.floor(k / 4))
    name = F.when(k % 9 == 0, "same").when(k % 9 == 1, " Same ").when(k % 9 == 2, F.lit(None)).otherwise(F.concat(F.lit("n"), k.cast("string")))
    return table(spark, d, "part").select(k.alias("id"), parent.cast("long").alias("parent"), name.alias("name"))


@query(
    "tree_issues",
    f"""WITH RECURSIVE {WALK}, m AS (SELECT id, parent, lower(trim(name)) AS name FROM t), j AS (SELECT c.*, p.id AS pid, p.name AS pname FROM m c LEFT JOIN m p ON p.id = c.parent)
    SELECT 'orphan' AS issue, id FROM j WHERE parent IS NOT NULL AND pid IS NULL UNION ALL SELECT 'self_parent', id FROM m WHERE parent = id UNION ALL SELECT 'same_as_parent', id FROM j WHERE parent <> id AND name = pname
    UNION ALL SELECT 'duplicate_sibling', id FROM (SELECT id, name, count(*) OVER (PARTITION BY parent, name) AS n FROM m) WHERE name IS NOT NULL AND n > 1
    UNION ALL SELECT 'name_elsewhere', id FROM m WHERE name IN (SELECT name FROM m GROUP BY 1 HAVING count(DISTINCT coalesce(parent, -1)) > 1) UNION ALL SELECT 'unreachable', id FROM m WHERE id NOT IN (SELECT id FROM down)
    UNION ALL SELECT 'empty', id FROM m WHERE id NOT IN (SELECT parent FROM m WHERE parent IS NOT NULL) AND id NOT IN (SELECT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL)""",
)
def tree_issues(spark: SparkSession, d: str) -> DataFrame:
    return graph.audit_tree(_tree(spark, d), "id", "parent", "name", members=table(spark, d, "lineitem").select(F.col("l_partkey").alias("id")))


@query(
    "tree_paths",
    f"""WITH RECURSIVE {WALK} SELECT id, path AS expected_path, root AS expected_root FROM down WHERE id % 5 = 3 OR id % 7 = 2""",
)
def tree_paths(spark: SparkSession, d: str) -> DataFrame:
    """Stored paths and roots that are wrong for some nodes; nodes without a name add nothing to a path."""
    tree, k = _tree(spark, d), F.col("id")
    right = graph.paths(tree, "id", "parent", "name").withColumnRenamed("path", "stored")
    stored = tree.join(right, "id", "left").withColumns({"stored": F.when(k % 5 == 3, F.concat("stored", F.lit("x"))).otherwise(F.col("stored")), "root": F.when(k % 7 == 2, F.lit(None)).otherwise(F.lit(0)).cast("long")})
    return graph.path_mismatches(settle(stored), "id", "parent", "name", "stored", "root")  # it is read twice


@query(
    "cycle_states",
    f"""WITH RECURSIVE t AS ({TREE}), up AS (SELECT id, parent AS cur, 1 AS hops FROM t WHERE parent IS NOT NULL AND parent <> id UNION ALL SELECT u.id, t.parent, hops + 1 FROM up u JOIN t ON t.id = u.cur AND t.parent IS NOT NULL AND t.parent <> t.id WHERE hops < 40),
    e AS (SELECT id, max(hops) AS hops, arg_max(cur, hops) AS terminal FROM up GROUP BY 1)
    SELECT e.id, CASE WHEN hops < 40 THEN terminal END AS terminal, CASE WHEN hops < 40 THEN hops END AS hops, CASE WHEN hops = 40 THEN 'cycle' WHEN k.id IS NULL THEN 'dangling' ELSE 'ok' END AS state FROM e LEFT JOIN t k ON k.id = terminal
    UNION ALL SELECT id, id, 0, 'self' FROM t WHERE parent = id""",
)
def cycle_states(spark: SparkSession, d: str) -> DataFrame:
    return graph.flatten_pointers(_tree(spark, d), "id", "parent")


@query("two_cycles", f"""WITH t AS (SELECT *, id % 3 AS rich FROM ({TREE})) SELECT a.id, CASE WHEN b.id IS NOT NULL AND b.id <> a.id AND (a.rich > b.rich OR a.rich = b.rich AND a.id < b.id) THEN NULL ELSE a.parent END AS parent FROM t a LEFT JOIN t b ON b.id = a.parent AND b.parent = a.id""")
def two_cycles(spark: SparkSession, d: str) -> DataFrame:
    return graph.break_two_cycles(_tree(spark, d).withColumn("rich", F.col("id") % 3), "id", "parent", "rich").select("id", "parent")


@query("merged_nodes", f"""WITH t AS ({TREE}) SELECT id, CASE WHEN parent % 6 = 5 AND parent < 9000000 THEN parent - 1 ELSE parent END AS parent FROM t WHERE id % 6 <> 5""")
def merged_nodes(spark: SparkSession, d: str) -> DataFrame:
    tree = _tree(spark, d)
    merges = tree.where("id % 6 = 5").select(F.col("id").alias("loser"), (F.col("id") - 1).alias("winner"))
    return graph.merge_nodes(tree, merges, "id", "parent").select("id", "parent")


@query("renamed_subtree", f"""WITH RECURSIVE {WALK} SELECT id, CASE WHEN path = 'same >  Same ' OR path LIKE 'same >  Same  > %' THEN 'same > other' || substr(path, 14) ELSE path END AS path FROM down""")
def renamed_subtree(spark: SparkSession, d: str) -> DataFrame:
    tree = _tree(spark, d)
    return graph.rename_subtree(graph.rooted_paths(tree, "id", "parent", "name"), "path", "same >  Same ", "same > other").select("id", "path")


@query("three_levels", f"""WITH t AS ({TREE}) SELECT c.id, coalesce(g.name, '(none)') AS level1, coalesce(p.name, '(none)') AS level2, coalesce(c.name, '(none)') AS level3 FROM t c LEFT JOIN t p ON p.id = c.parent LEFT JOIN t g ON g.id = p.parent""")
def three_levels(spark: SparkSession, d: str) -> DataFrame:
    return graph.three_levels(_tree(spark, d), "id", "parent", "name")


@query(
    "source_registry",
    """WITH f AS (SELECT CASE WHEN p_partkey % 7 > 0 THEN p_brand END AS source, p_type AS kind, p_size AS rank FROM part), k AS (SELECT DISTINCT p_brand AS source, 'known' AS kind, 0 AS rank FROM part WHERE p_brand < 'Brand#2')
    SELECT * FROM k UNION ALL SELECT source, kind, rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY kind, rank) AS nth FROM f WHERE source IS NOT NULL AND source NOT IN (SELECT source FROM k)) WHERE nth = 1""",
)
def source_registry(spark: SparkSession, d: str) -> DataFrame:
    """Known keys stay as they are, null keys are left out, and a second run adds nothing."""
    part = table(spark, d, "part")
    found = part.select(F.when(F.col("p_partkey") % 7 > 0, F.col("p_brand")).alias("source"), F.col("p_type").alias("kind"), F.col("p_size").alias("rank"))
    known = part.where("p_brand < 'Brand#2'").select(F.col("p_brand").alias("source"), F.lit("known").alias("kind"), F.lit(0).alias("rank")).distinct()
    once = provenance.register_sources(known, found, "source")
    return provenance.register_sources(once, found, "source")


@query(
    "held_links",
    """WITH l AS (SELECT o_custkey % 50 AS record, year(o_orderdate)::BIGINT AS era, (o_orderkey % 3 + 1)::INT AS tier FROM orders WHERE o_orderkey % 17 = 0)
    SELECT *, count(*) OVER w > 1 AND NOT (tier = 1 AND count(*) FILTER (tier = 1) OVER w = 1) AS held FROM l WINDOW w AS (PARTITION BY record, era)""",
)
def held_links(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").where("o_orderkey % 17 = 0").select((F.col("o_custkey") % 50).alias("record"), F.year("o_orderdate").cast("long").alias("era"), (F.col("o_orderkey") % 3 + 1).cast("int").alias("tier"))
    return linkage.hold_ambiguous(o, "record", "era", "tier")


# Places, contacts and files.


def _features(d_nation: DataFrame) -> DataFrame:
    """The square of 20 degrees around each nation's place, as a ring."""
    k = F.col("n_nationkey")
    corner = lambda a, b: F.struct(((k * 101) % 320 - 160 + a).cast("double").alias("x"), ((k * 37) % 100 - 50 + b).cast("double").alias("y"))
    return d_nation.select(k.cast("long").alias("nation"), F.array(corner(-10, -10), corner(10, -10), corner(10, 10), corner(-10, 10)).alias("ring"))


@query(
    "polygon_areas",
    """SELECT 'square' AS kind, n_nationkey::BIGINT AS id, 400.0::DOUBLE AS area, true AS inside, true AS touching FROM nation
    UNION ALL SELECT 'triangle', n_nationkey, n_nationkey + 1.0, false, n_nationkey >= 0 FROM nation UNION ALL SELECT 'line', n_nationkey, 0.0, false, false FROM nation""",
)
def polygon_areas(spark: SparkSession, d: str) -> DataFrame:
    """A point in a square, on the slope of a triangle, and on a line of two corners, which holds nothing."""
    k = F.col("n_nationkey")
    at = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    n, zero = table(spark, d, "nation"), F.lit(0)
    squares = _features(n).select(F.lit("square").alias("kind"), F.col("nation").alias("id"), "ring", F.get("ring", F.lit(0))["x"].alias("px"), (F.get("ring", F.lit(0))["y"] + 5).alias("py")).withColumn("px", F.col("px") + 3)
    triangles = n.select(F.lit("triangle").alias("kind"), k.cast("long").alias("id"), F.array(at(zero, zero), at(k + 1, zero), at(zero, F.lit(2))).alias("ring"), ((k + 1) / 2).alias("px"), F.lit(1.0).alias("py"))
    lines = n.select(F.lit("line").alias("kind"), k.cast("long").alias("id"), F.array(at(zero, zero), at(F.lit(2), F.lit(2))).alias("ring"), F.lit(1.0).alias("px"), F.lit(1.0).alias("py"))
    held = lambda edges: geo.ring_holds(F.col("ring"), F.col("px"), F.col("py"), edges)
    return squares.unionByName(triangles).unionByName(lines).select("kind", "id", geo.ring_area(F.col("ring")).alias("area"), held(False).alias("inside"), held(True).alias("touching"))


@query(
    "declared_polygons",
    """WITH p AS (SELECT c_custkey AS id, c_nationkey AS n, CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE (c_custkey % 29 - 14) * 0.75 END AS dx, (c_custkey % 23 - 11) * 0.91 AS dy FROM customer),
    g AS (SELECT *, sqrt(greatest(abs(dx) - 10, 0)^2 + greatest(abs(dy) - 10, 0)^2) AS gap FROM p)
    SELECT id, CASE WHEN n % 5 = 4 THEN 'no polygon' WHEN dx IS NULL THEN NULL WHEN abs(dx) < 10 AND abs(dy) < 10 THEN 'inside' WHEN gap <= 0.26 THEN 'near' ELSE 'outside' END AS placed FROM g""",
)
def declared_polygons(spark: SparkSession, d: str) -> DataFrame:
    """Customers inside, near or outside the square that their nation declares; some nations have none."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    lat, lon = (n * 37) % 100 - 50 + (k % 23 - 11) * 0.91, (n * 101) % 320 - 160 + F.when(k % 19 != 0, (k % 29 - 14) * 0.75)
    points = table(spark, d, "customer").select(k.alias("id"), n.cast("long").alias("nation"), lon.alias("lon"), lat.alias("lat"))
    return matching.outside_polygon(points, _features(table(spark, d, "nation").where("n_nationkey % 5 <> 4")), "nation", tolerance=0.26).select("id", "placed")


@query(
    "density_clusters",
    """WITH p AS (SELECT c_custkey AS id, c_custkey // 10 AS g, c_custkey % 10 AS j, CASE WHEN c_custkey % 10 < 5 THEN c_custkey % 10 * 0.001 ELSE 0.1 * (c_custkey % 10) END AS up FROM customer),
    c AS (SELECT a.id, a.g FROM p a JOIN p b ON a.g = b.g AND abs(a.up - b.up) * 111.19 <= 0.2 GROUP BY a.id, a.g HAVING count(*) >= 3), m AS (SELECT g, min(id) AS cluster FROM c GROUP BY g),
    r AS (SELECT p.id, bool_or(c.id IS NOT NULL) AS near FROM p LEFT JOIN (SELECT c.id, c.g, p.up FROM c JOIN p USING (id)) c ON c.g = p.g AND abs(c.up - p.up) * 111.19 <= 0.2 GROUP BY p.id)
    SELECT p.id, CASE WHEN r.near THEN m.cluster ELSE -1 END AS cluster, p.id IN (SELECT id FROM c) AS core FROM p JOIN r USING (id) LEFT JOIN m USING (g)""",
)
def density_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Chains of five customers and five that stand alone, in every ten: ends of chains are borders."""
    k = F.col("c_custkey")
    up = F.when(k % 10 < 5, k % 10 * 0.001).otherwise(0.1 * (k % 10))
    g = F.floor(k / 10)
    # columns of tens are 0.5 km apart at least, and don't come round the globe before 28 million customers
    points = table(spark, d, "customer").select(k.alias("id"), (g % 80 * 1.5 - 60 + up).alias("lat"), (F.floor(g / 80) * 0.01 - 170).alias("lon"))
    return spatial.dbscan(points, "id", 0.2, 3, graph.connected_components).select("id", F.col("cluster").cast("long").alias("cluster"), "core")


@query(
    "group_hubs",
    """WITH p AS (SELECT c_nationkey AS nation, c_custkey AS id, CASE WHEN c_nationkey % 6 = 5 OR c_custkey % 4 = 0 THEN NULL ELSE 30 + (c_custkey * 37 % 100) / 10.0::DOUBLE END AS lat, CASE WHEN c_nationkey % 6 = 5 OR c_custkey % 4 = 0 THEN NULL ELSE (c_custkey * 53 % 100) / 10.0::DOUBLE END AS lon FROM customer),
    m AS (SELECT nation, avg(lat) AS la, avg(lon) AS lo, count(*) AS members FROM p GROUP BY 1),
    a AS (SELECT p.nation, id, members, coalesce(round(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(la - lat) / 2), 2) + cos(radians(lat)) * cos(radians(la)) * pow(sin(radians(lo - lon) / 2), 2)))), 6), 'inf'::DOUBLE) AS km FROM p JOIN m USING (nation))
    SELECT nation, arg_min(id, (km, id)) AS hub, any_value(members) AS members FROM a GROUP BY 1""",
)
def group_hubs(spark: SparkSession, d: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    known = (n % 6 != 5) & (k % 4 != 0)
    rows = table(spark, d, "customer").select(n.alias("nation"), k.alias("id"), F.when(known, F.lit(30) + k * 37 % 100 / F.lit(10.0)).alias("lat"), F.when(known, k * 53 % 100 / F.lit(10.0)).alias("lon"))
    return graph.hubs(rows, "id", "nation")


@query(
    "geocode_precedence",
    """WITH r AS (SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN lpad((c_nationkey * 7 + 3)::VARCHAR, 5, '0') || '-1234' WHEN 1 THEN (c_nationkey * 7 + 3)::VARCHAR WHEN 2 THEN '99999' WHEN 3 THEN NULL ELSE lpad((c_nationkey * 7 + 3)::VARCHAR, 5, '0') END AS zip, c_nationkey AS n FROM customer),
    s AS (SELECT id, CASE WHEN id % 3 = 0 AND id % 6 <> 0 THEN id * 0.001 END::DOUBLE AS la FROM r)
    SELECT id, CASE WHEN la IS NOT NULL THEN la WHEN id % 5 IN (0, 1, 4) THEN n * 1.0 END::DOUBLE AS lat, CASE WHEN la IS NOT NULL THEN 'census_street' WHEN id % 5 IN (0, 1, 4) THEN 'zip_centroid' END AS source FROM r JOIN s USING (id)""",
)
def geocode_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Street matches before the centres of ZIP codes with and without +4 and leading zeros; unknown codes have nothing."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    code = (n * 7 + 3).cast("string")
    zips = F.when(k % 5 == 0, F.concat(F.lpad(code, 5, "0"), F.lit("-1234"))).when(k % 5 == 1, code).when(k % 5 == 2, "99999").when(k % 5 == 4, F.lpad(code, 5, "0"))
    c = table(spark, d, "customer")
    streets = c.where("c_custkey % 3 = 0").select(k.alias("id"), F.when(k % 6 != 0, k * 0.001).alias("lat"), F.when(k % 6 != 0, k * 0.002).alias("lon"))
    key = F.col("n_nationkey")
    centres = table(spark, d, "nation").select(F.lpad((key * 7 + 3).cast("string"), 5, "0").alias("zip"), key.cast("double").alias("lat"), (-key).cast("double").alias("lon"))
    return geocode.geocoded(c.select(k.alias("id"), zips.alias("zip")), streets, centres, "id", "zip").select("id", "lat", "source")


@query(
    "wrong_places",
    """WITH h AS (SELECT c_custkey AS id, unnest(range(c_custkey % 5)) AS i FROM customer), g AS (SELECT id, CASE WHEN id % 7 = 0 AND i = 0 THEN 0.1 WHEN id % 2 = 0 THEN 4 + i * 0.1 ELSE 4 + i * 3.0 END AS up FROM h WHERE NOT (id % 11 = 0)),
    t AS (SELECT id, count(*) AS hits, min(up) * 111.19 AS nearest, (max(up) - min(up)) * 111.19 AS apart FROM g GROUP BY 1)
    SELECT c_custkey AS id, coalesce(hits, 0) AS hits, coalesce(nearest > 50 AND NOT (hits >= 3 AND apart > 300), false) AS wrong FROM customer LEFT JOIN t ON id = c_custkey""",
)
def wrong_places(spark: SparkSession, d: str) -> DataFrame:
    """Near hits clear a place; far ones accuse it, unless three or more lie scattered; hits without coordinates are none."""
    k = F.col("c_custkey")
    c = table(spark, d, "customer")
    hits = c.where(k % 5 > 0).select(k.alias("id"), F.explode(F.sequence(F.lit(0).cast("long"), k % 5 - 1)).alias("i"))
    up = F.when((F.col("id") % 7 == 0) & (F.col("i") == 0), 0.1).when(F.col("id") % 2 == 0, 4 + F.col("i") * 0.1).otherwise(4 + F.col("i") * 3.0)
    hits = hits.select("id", F.when(F.col("id") % 11 != 0, F.lit(30.0) + up).alias("lat"), F.lit(-87.0).alias("lon"))
    return geocode.wrong_places(c.select(k.alias("id"), F.lit(30.0).alias("lat"), F.lit(-87.0).alias("lon")), hits, "id")


_FIELDS = {
    "own_street": shapes("c_custkey", "Oak Ave {k}", "{k} Elm", None, " "), "found_street": shapes("c_custkey", "{k} Oak Ave", None, "Elm {k}"), "own_city": shapes("c_custkey", "", "Ohio {k}", None),
    "found_city": shapes("c_custkey", "Gary", None), "own_state": shapes("c_custkey", None, "OH"), "found_state": shapes("c_custkey", " IN ", "", "IL"), "own_zip": shapes("c_custkey", "60614", "", None, None, " "), "found_zip": shapes("c_custkey", "46401", None, ""),
}
_FIRST = "CASE WHEN trim({0}) <> '' THEN trim({0}) WHEN trim({1}) <> '' THEN trim({1}) END"


@query(
    "merged_addresses",
    f"""WITH r AS (SELECT c_custkey AS id, {", ".join(f"{v} AS {k}" for k, v in _FIELDS.items())} FROM customer)
    SELECT id, CASE WHEN regexp_matches(trim(own_street), '^\\d') THEN trim(own_street) WHEN regexp_matches(trim(found_street), '^\\d') THEN trim(found_street) ELSE {_FIRST.format('own_street', 'found_street')} END AS street,
      {", ".join(f"{_FIRST.format('own_' + f, 'found_' + f)} AS {f}" for f in ("city", "state", "zip"))} FROM r""",
)
def merged_addresses(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), *[F.expr(v).alias(k) for k, v in _FIELDS.items()])
    return geocode.merged_address(df, ["own", "found"]).select("id", "street", "city", "state", "zip")


_MAIN = shapes("c_custkey", "info@h{k}.org", "pastor.jo@h{k}.org", "z@a{k}.org", None, "b@both{k}.org")
_OTHER = shapes("c_custkey", "office@a{k}.org", "info@h{k}.org", "treasurer@g{k}.org", "x(guess)@g{k}.org (guess)", "b@both{k}.org")


@query(
    "best_contacts",
    f"""WITH e AS (SELECT 'n' || c_custkey // 3 AS name, {_MAIN} AS email, 0 AS o FROM customer UNION ALL SELECT 'm' || c_custkey // 4, {_OTHER}, 1 FROM customer),
    u AS (SELECT email, arg_min(name, (o, name)) AS name FROM e WHERE email IS NOT NULL GROUP BY 1), r AS (SELECT *, lower(split_part(email, '@', 1)) AS local FROM u),
    k AS (SELECT *, CASE WHEN regexp_matches(local, 'pastor|rector|vicar|minister') THEN 10 WHEN regexp_matches(local, 'office|admin|administrator') THEN 9 WHEN regexp_matches(local, 'secretary|treasurer') THEN 7 WHEN regexp_matches(local, 'info|contact|hello') THEN 5 WHEN contains(email, '(guess)') THEN 3 ELSE 4 END AS rank FROM r)
    SELECT name, arg_min(email, (-rank, email)) AS email, max(rank)::BIGINT AS rank, count(*) AS addresses FROM k GROUP BY 1""",
)
def best_contacts(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    side = lambda letter, n, raw: c.select(F.expr(f"concat('{letter}', c_custkey div {n})").alias("name"), F.expr(raw).alias("email"))
    return matching.best_contacts(side("n", 3, _MAIN), side("m", 4, _OTHER), "name", "email")


_WORDS_L = shapes("c_custkey", "First-Church {k} of Gary", "Old Mount Zion {k}", "Hope", None, "Zion Hill Mission House {k} very long")
_WORDS_R = shapes("s_suppkey", "church first home", "Mount Zion Old", "New Hope Hope", "the zion hill mission house 4 very", "Zion")


@query(
    "first_words",
    f"""WITH l AS (SELECT c_custkey AS id, c_nationkey AS n, {_WORDS_L} AS name FROM customer), r AS (SELECT s_suppkey AS partner, s_nationkey AS n, {_WORDS_R} AS name FROM supplier),
    a AS (SELECT *, list_distinct(string_split(replace(lower(name), '-', ' '), ' ')[:3]) AS w FROM l WHERE name IS NOT NULL), b AS (SELECT *, list_distinct(string_split(replace(lower(name), '-', ' '), ' ')[:3]) AS w FROM r),
    p AS (SELECT id, partner, len(list_intersect(a.w, b.w))::DOUBLE AS score, contains(lower(b.name), substr(lower(a.name), 1, 20)) AS held FROM a JOIN b USING (n))
    SELECT id, arg_min(partner, (-score, partner)) AS partner, max(score) AS score FROM p WHERE score >= 1 AND (score >= 2 OR held) GROUP BY 1""",
)
def first_words(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.expr(_WORDS_L).alias("name"), F.concat(F.lit("N"), "c_nationkey").alias("state"))
    right = table(spark, d, "supplier").select(F.col("s_suppkey").alias("partner"), F.expr(_WORDS_R).alias("name"), F.concat(F.lit("n"), "s_nationkey").alias("state"))
    return matching.first_words_match(left, right, "id", "partner", "name", "state")


_AT = "(({k} * 37) % 1200) / 10.0 - 60 AS lat, (({k} * 101) % 3600) / 10.0 - 180 AS lon"


@query(
    "scored_neighbours",
    f"""WITH l AS (SELECT s_suppkey AS id, repeat(chr((97 + s_suppkey % 4)::INT), 5) AS name, 'old n' || s_nationkey AS city, {_AT.format(k="s_suppkey")} FROM supplier), r AS (SELECT c_custkey AS partner, repeat(chr((97 + c_custkey % 4)::INT), 5) AS name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'n' || c_nationkey END AS city, {_AT.format(k="c_custkey")} FROM customer),
    d AS (SELECT l.id, r.partner, l.name AS a, r.name AS b, l.city AS ca, r.city AS cb, 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(r.lat - l.lat) / 2), 2) + cos(radians(l.lat)) * cos(radians(r.lat)) * pow(sin(radians(r.lon - l.lon) / 2), 2)))) AS km FROM l CROSS JOIN r),
    n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(km, 7), partner) <= 10),
    s AS (SELECT *, round(CASE WHEN a = b THEN 0.7 ELSE 0 END + greatest(0, 1 - km / 400) * 0.3 + CASE WHEN cb <> '' AND contains(ca, cb) THEN 0.15 ELSE 0 END, 9) AS score FROM n)
    SELECT id, arg_min(partner, (-score, partner)) AS partner, round(max(score), 6) AS score FROM s WHERE score > 0 GROUP BY 1""",
)
def scored_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest customers of every supplier, of which the best by name, distance and city is chosen."""
    at = lambda k: [((k * 37) % 1200 / F.lit(10.0) - 60).alias("lat"), ((k * 101) % 3600 / F.lit(10.0) - 180).alias("lon")]
    name = lambda k: F.repeat(F.chr(97 + k % 4), F.lit(5)).alias("name")
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    left = table(spark, d, "supplier").select(s.alias("id"), name(s), F.concat(F.lit("old n"), "s_nationkey").alias("city"), *at(s))
    right = table(spark, d, "customer").select(c.alias("partner"), name(c).alias("other"), F.when(c % 3 == 0, "").otherwise(F.concat(F.lit("n"), "c_nationkey")).alias("town"), *at(c))
    near = pyramid.nearest(left, right, "id", "partner", k=10).drop("rank")
    pairs = near.join(left.select("id", "name", "city"), "id").join(right.select("partner", "other", "town"), "partner")
    return matching.scored_neighbours(pairs, "id", "partner", ("name", "other"), ("city", "town"), reach=400.0).select("id", "partner", F.round("score", 6).alias("score"))


_PAGE = shapes("page_id", "<p>Write a{k}@b.org, A{k}@B.org</p> or <b>c.d@e.co.uk</b><script>no@no.org</script> call 312-555-0199", "x &lt; y &amp; z{k}", "1 (800) 555-0100 or +1 800 555 0100, logo@2x.png", "", None)


@query(
    "page_contacts",
    rf"""WITH r AS (SELECT page_id AS id, {_PAGE} AS html FROM pages), s AS (SELECT *, trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(html, '<script>.*</script>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&amp;', '&'), '\s+', ' ', 'g')) AS plain FROM r)
    SELECT id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(plain), '[a-z0-9._%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{{2,}}'), lambda e: NOT regexp_matches(e, '\.(png|jpg)$')))), ';') AS emails,
      array_to_string(list_sort(list_distinct(list_transform(list_transform(regexp_extract_all(plain, '(?:\+?1[ .-]?)?\(?\d{{3}}\)?[ .-]\d{{3}}[ .-]\d{{4}}\b'), lambda p: right(regexp_replace(p, '\D', '', 'g'), 10)), lambda g: '(' || g[1:3] || ') ' || g[4:6] || '-' || g[7:10]))), ';') AS phones, plain FROM s""",
)
def page_contacts(spark: SparkSession, d: str) -> DataFrame:
    plain = text.strip_tags(F.expr(_PAGE))
    return table(spark, d, "pages").select(F.col("page_id").alias("id"), F.array_join(text.emails_in(plain), ";").alias("emails"), F.array_join(text.phones_in(plain), ";").alias("phones"), plain.alias("plain"))


@query(
    "html_rows",
    """SELECT n_nationkey::BIGINT AS id, 0::BIGINT AS row, 'Name|Region' AS cells FROM nation WHERE n_nationkey % 3 < 2 UNION ALL SELECT n_nationkey, 1, n_name || ' & Co|' || n_regionkey FROM nation WHERE n_nationkey % 3 < 2 UNION ALL SELECT n_nationkey, 2, '' FROM nation WHERE n_nationkey % 3 = 1""",
)
def html_rows(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    html = F.when(k % 3 < 2, F.concat(F.lit("<table class='x'><tr><th>Name</th><TH>Region</TH></tr>\n<tr><td> "), "n_name", F.lit(" <b>&</b>\n Co</td><td>"), F.col("n_regionkey").cast("string"), F.lit("</td></tr>"), F.when(k % 3 == 1, "<tr></tr></table>").otherwise("</table>")))
    rows = files.html_tables(table(spark, d, "nation").select(k.cast("long").alias("id"), html.alias("html")), "id", "html")
    return rows.select("id", F.col("row").cast("long").alias("row"), F.array_join("cells", "|").alias("cells"))


@query(
    "geojson_rings",
    """SELECT n_nationkey::BIGINT AS id, 0::BIGINT AS part, 0::BIGINT AS ring_no, 5::BIGINT AS corners, 400.0::DOUBLE AS area FROM nation UNION ALL SELECT n_nationkey, 0, 1, 4, (n_nationkey + 1) / 100.0 FROM nation WHERE n_nationkey % 2 = 0
    UNION ALL SELECT n_nationkey, 1, 0, 4, (n_nationkey + 1) / 100.0 FROM nation WHERE n_nationkey % 2 = 1""",
)
def geojson_rings(spark: SparkSession, d: str) -> DataFrame:
    """Polygons with a hole and polygons of two parts, one FeatureCollection a file."""
    k = F.col("n_nationkey")
    pair = lambda x, y: F.concat(F.lit("["), x.cast("string"), F.lit(","), y.cast("string"), F.lit("]"))
    ring = lambda *corners: F.concat(F.lit("["), F.concat_ws(",", *[pair(F.lit(x) if not hasattr(x, "cast") else x, F.lit(y)) for x, y in corners]), F.lit("]"))
    square, small = ring((0, 0), (20, 0), (20, 20), (0, 20), (0, 0)), ring((1, 1), (1 + (k + 1) / 50, 1), (1, 2), (1, 1))
    shape = F.when(k % 2 == 0, F.concat(F.lit('"Polygon","coordinates":['), square, F.lit(","), small, F.lit("]"))).otherwise(F.concat(F.lit('"MultiPolygon","coordinates":[['), square, F.lit("],["), small, F.lit("]]")))
    feature = F.concat(F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"id":'), k.cast("string"), F.lit('},"geometry":{"type":'), shape, F.lit("}}]}"))
    path = f"{shared_dir(spark)}/shapes-{uuid.uuid4().hex}"
    table(spark, d, "nation").select(feature.alias("value")).repartition(25, "value").write.option("maxRecordsPerFile", 1).text(path)
    rings = files.read_geojson_polygons(spark, path, "id: long")
    return rings.select("id", F.col("part").cast("long").alias("part"), F.col("ring_no").cast("long").alias("ring_no"), F.size("ring").cast("long").alias("corners"), F.round(F.abs(geo.ring_area(F.col("ring"))), 9).alias("area"))


@query(
    "csv_dialects",
    """SELECT 'bom' AS kind, n_nationkey::BIGINT AS id, CASE WHEN n_nationkey % 4 > 0 THEN 'Zoë ' || n_nationkey END AS name FROM nation UNION ALL SELECT 'latin', n_nationkey, 'Zoë, "' || n_nationkey || '"' FROM nation
    UNION ALL SELECT 'tabs', CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey END, 'a, b ' || n_nationkey FROM nation""",
)
def csv_dialects(spark: SparkSession, d: str) -> DataFrame:
    """A byte-order mark with padded headers, Latin-1 with quotes, tabs with values that are no numbers."""
    k, n, out = F.col("n_nationkey"), table(spark, d, "nation"), None
    folder = lambda name: f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    lines = lambda head, line: n.groupBy((F.col("n_regionkey") % 2).alias("g")).agg(F.concat(F.lit(head), F.array_join(F.array_sort(F.collect_list(line)), "\n")).alias("value")).select("value")
    bom, latin, tabs = folder("bom"), folder("latin"), folder("tabs")
    lines("﻿id, name \n", F.concat(k.cast("string"), F.lit(","), F.when(k % 4 > 0, F.concat(F.lit("Zoë "), k.cast("string"))).otherwise(""))).repartition(2, "value").write.option("maxRecordsPerFile", 1).text(bom)
    n.select(k.alias("id"), F.concat(F.lit('Zoë, "'), k.cast("string"), F.lit('"')).alias("name")).write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(latin)
    lines(" id\tname\n", F.concat(F.when(k % 3 > 0, k.cast("string")).otherwise("none"), F.lit("\ta, b "), k.cast("string"))).repartition(2, "value").write.option("maxRecordsPerFile", 1).text(tabs)
    for kind, path, options in (("bom", bom, {}), ("latin", latin, {"encoding": "ISO-8859-1"}), ("tabs", tabs, {"sep": "\t"})):
        part = files.read_delimited(spark, path, "id long, name string", **options).select(F.lit(kind).alias("kind"), "id", "name")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "small_rules",
    r"""WITH r AS (SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN ' x' || c_custkey || '.org ' WHEN 1 THEN 'HTTP://x.org' WHEN 2 THEN '' END AS site, 'Hope ' || c_custkey || CASE c_custkey % 3 WHEN 0 THEN ', Inc. LLC ' WHEN 1 THEN ' llc' ELSE '' END AS name,
      CASE c_custkey % 5 WHEN 0 THEN 'a, ,b ,' || c_custkey WHEN 1 THEN '' WHEN 2 THEN ',' ELSE 'x' END AS list, (c_custkey * 37 % 1200) / 10.0::DOUBLE - 60 AS lat, (c_custkey * 101 % 3600) / 10.0::DOUBLE - 180 AS lon FROM customer)
    SELECT k AS id, CASE WHEN trim(site) = '' THEN NULL WHEN regexp_matches(lower(trim(site)), '^https?://') THEN trim(site) ELSE 'https://' || trim(site) END AS url, regexp_replace(name, '(?i)(?:[\s,]+(?:INC|LLC)\.?)+\s*$', '') AS bare,
      array_to_string(list_filter(list_transform(string_split(list, ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS items,
      round(cos(radians(lat)) * cos(radians(lon)), 9) AS x, round(cos(radians(lat)) * sin(radians(lon)), 9) AS y, round(sin(radians(lat)), 9) AS z, round(2 * 6371.0 * asin(0.25 + k % 7 / 20.0), 6) AS chord_km,
      round(lat - 50 / (pi() * 6371.0 / 180), 9) AS south, round(lat + 50 / (pi() * 6371.0 / 180), 9) AS north, round(radians(lon) * 6378137.0, 3) AS mx, round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0, 3) AS my, 49::BIGINT AS corners,
      CASE WHEN k % 6 = 0 THEN NULL ELSE round(k * 1000.0 / ((k % 6) * 300), 6) END AS saturation, round(least(100, least(40, (k % 50) * 1.5) + CASE WHEN k % 2 = 0 THEN least(70, k % 90) ELSE 0 END), 1)::DOUBLE AS need,
      k % 2 = 0 OR k % 3 = 0 AS flagged, nullif(concat_ws(',', CASE WHEN k % 2 = 0 THEN 'even' END, CASE WHEN k % 3 = 0 THEN 'third' END), '') AS signals, CASE WHEN k % 4 = 1 THEN 'b' WHEN k % 4 = 2 THEN 'c' ELSE 'unknown' END AS chosen, CASE WHEN k % 4 = 1 THEN 'first' WHEN k % 4 = 2 THEN 'second' ELSE 'none' END AS chosen_by FROM r""",
)
def small_rules(spark: SparkSession, d: str) -> DataFrame:
    """Links, suffixes, lists, sphere and map coordinates, scores, signals and the cascade, each on every customer."""
    k = F.col("c_custkey")
    site, raw = F.expr(shapes("c_custkey", " x{k}.org ", "HTTP://x.org", "", None)), F.expr(shapes("c_custkey", "a, ,b ,{k}", "", ",", "x", "x"))
    name = F.concat(F.lit("Hope "), k.cast("string"), F.when(k % 3 == 0, ", Inc. LLC ").when(k % 3 == 1, " llc").otherwise(""))
    lat, lon = k * 37 % 1200 / F.lit(10.0) - 60, k * 101 % 3600 / F.lit(10.0) - 180
    u, box, m = geo.unit_xyz(lat, lon), geo.bbox(lat, lon, 50.0), geo.mercator(lat, lon)
    flagged, signals = rules.collect_signals([("even", k % 2 == 0), ("third", k % 3 == 0)])
    chosen = rules.cascade([("first", F.when(k % 4 == 1, "b").when(k % 4 == 0, " ")), ("second", F.when(k % 4 == 2, "c").otherwise("Unknown"))])
    r = lambda c, n: F.round(c, n)
    return table(spark, d, "customer").select(
        k.alias("id"), text.ensure_url(site).alias("url"), text.without_suffixes(name, ("INC", "LLC")).alias("bare"), F.array_join(text.list_items(raw), "|").alias("items"), r(u["x"], 9).alias("x"), r(u["y"], 9).alias("y"), r(u["z"], 9).alias("z"),
        r(geo.chord_to_km(F.lit(0.5) + k % 7 / F.lit(10.0)), 6).alias("chord_km"), r(box["south"], 9).alias("south"), r(box["north"], 9).alias("north"), r(m["x"], 3).alias("mx"), r(m["y"], 3).alias("my"), F.size(geo.circle(lat, lon, 5.0)).cast("long").alias("corners"),
        r(rules.saturation(k * 1000, k % 6), 6).alias("saturation"), rules.capped_score([(k % 50, 1.5, 40.0), (F.when(k % 2 == 0, k % 90), 1.0, 70.0)]).alias("need"), flagged.alias("flagged"), signals.alias("signals"), chosen["value"].alias("chosen"), chosen["source"].alias("chosen_by"),
    )
