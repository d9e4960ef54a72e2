"""Queries over records with names, addresses, e-mails, heights and lines, all derived from the keys of the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import directories, geo, similarity, text
from ..operators import checks, linkage, matching, raster
from ..operators.settled import shared_dir
from .registry import query, table


def _town(key: Column, upper: bool = True) -> Column:
    return F.concat(F.chr(F.lit(65) + key % 25), F.lit("VILLE" if upper else "ville"))


def _pick(key: Column, *cases: Column) -> Column:
    """The case of the key's remainder; null beyond them."""
    out = F.when(key % (len(cases)) == 0, cases[0])
    for i, c in enumerate(cases[1:], 1):
        out = out.when(key % len(cases) == i, c)
    return out


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query(
    "spelled_names",
    """WITH t AS (SELECT c_custkey AS k, chr(65 + c_nationkey % 25) || 'VILLE' AS a, c_nationkey % 25 % 3 = 0 AS ka, chr(65 + (c_nationkey + 7) % 25) || 'VILLE' AS b, (c_nationkey + 7) % 25 % 3 = 0 AS kb FROM customer)
    SELECT k AS id, CASE k % 6 WHEN 0 THEN CASE WHEN ka THEN 'St. ' ELSE 'SAINT ' END || a || ' Church' WHEN 1 THEN CASE WHEN ka THEN 'St. ' ELSE 'SAINT ' END || a || ' AND ' || CASE WHEN kb THEN 'st.  ' ELSE 'SAINT ' END || b
        WHEN 2 THEN 'First A.M.E. ZION AND MOUNT ' || a WHEN 3 THEN 'SAINT ' || a || ' at NORTH ' || b WHEN 4 THEN NULL ELSE 'FORT ' || a || ' - A.M.E. Church' END AS spelled FROM t""",
)
def spelled_names(spark: SparkSession, d: str) -> DataFrame:
    """St. stays before the words that official names of places have, two of them in one name included."""
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    a, b = _town(F.col("c_nationkey")), _town(F.col("c_nationkey") + 7)
    name = _pick(F.col("c_custkey"), _cat("The St. ", a, " Church"), _cat("St. ", a, " & st.  ", b), _cat("First AMEZ & Mt. ", a), _cat("St ", a, " at N. ", b), F.lit(None), _cat("FT. ", a, " — A M E Church"))
    places = directories.saint_places(n.where("n_nationkey % 3 = 0").select(_cat("Port St. ", _town(F.col("n_nationkey"), upper=False)).alias("place")), "place")
    rows = directories.spelled_out(c.select(F.col("c_custkey").alias("id"), name.alias("name")), "id", "name", places, "spelled")
    # two blanks before an exception are squeezed at the end, as in every name
    return rows.select("id", F.when((F.col("id") % 6 == 1) & F.col("spelled").contains("AND st. "), F.replace("spelled", F.lit("AND st. "), F.lit("AND st.  "))).otherwise(F.col("spelled")).alias("spelled"))


@query(
    "directory_listing",
    """WITH s AS (SELECT s_nationkey AS nation, s_suppkey AS k, chr(65 + s_nationkey % 25) AS t FROM supplier), e AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY k) AS entry_no FROM s WHERE k % 5 <> 3)
    SELECT nation, entry_no, CASE k % 5 WHEN 0 THEN 'Grace Chapel Of ' || t || 'ville' WHEN 1 THEN 'Hope Chapel' WHEN 2 THEN 'Zion Mission no street' ELSE 'Faith Fellowship' END AS name,
        CASE k % 5 WHEN 0 THEN k || ' N Oak St.' WHEN 1 THEN k || ' Elm Blvd' WHEN 2 THEN '' ELSE k || ' Pine Rd' END AS address FROM e""",
)
def directory_listing(spark: SparkSession, d: str) -> DataFrame:
    """Scanned pages, one for each nation, whose entries are its suppliers: page numbers, heads, notes, telephones and other trades between them."""
    k = F.col("s_suppkey")
    entry = _pick(
        k, _cat("GRACE CHAPEL OF ", _town(F.col("s_nationkey")), "\n", k, " N Oak St.\nCHURCHES CONTD"), _cat("Hope Chapel,\n", k, " Elm Blvd (A, B) Tel 555-1234"),
        F.lit("  Zion Mission\n no street\n12\n"), _cat("Hotel Church\n", k, " Oak St"), _cat("IV\nFaith Fellowship\n", k, " Pine Rd\n"),
    )
    pages = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), entry.alias("e")))).alias("all"))
    body = _cat("A church of 1 Oak St before the section\n\nChurches  and\nSynagogues\n \n", F.array_join(F.transform("all", lambda e: e["e"]), "\n \n"))
    return directories.directory_entries(pages.select("nation", body.alias("text")), "nation", "text")


CITIES = "SELECT lower(chr(65 + n_nationkey % 25)) || 'ville' AS city, 'S' || n_regionkey AS state FROM nation UNION ALL SELECT lower(chr(65 + n_nationkey % 25)) || 'ville', 'S9' FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT 'old' || lower(chr(65 + n_nationkey % 25)) || 'ville', 'S1' FROM nation WHERE n_nationkey % 4 = 0"


@query(
    "email_conflicts",
    f"""WITH cities AS ({CITIES}), c AS (SELECT c_custkey AS id, 'S' || CASE WHEN c_custkey % 11 = 0 THEN 9 ELSE c_custkey % 5 END AS state, lower(chr(65 + c_nationkey % 25)) || 'ville' AS town FROM customer),
    m AS (SELECT id, state, CASE id % 4 WHEN 0 THEN 'info@first' || town || 'church.org' WHEN 1 THEN 'a@OLD' || town || '.com' WHEN 2 THEN 'none at all' ELSE 'x@plain.org' END AS email FROM c),
    g AS (SELECT city, list_sort(list(DISTINCT state)) AS states FROM cities GROUP BY 1),
    h AS (SELECT id, email, city, states, row_number() OVER (PARTITION BY id ORDER BY length(city) DESC, city) AS nth FROM m JOIN g ON contains(lower(split_part(email, '@', 2)), city) WHERE NOT list_contains(states, state))
    SELECT 'log' AS kind, id, email AS old_value, 'sanity_clean_' || city || '_' || array_to_string(states, '|') AS source FROM h WHERE nth = 1
    UNION ALL SELECT 'kept', m.id, CASE WHEN h.id IS NULL THEN m.email ELSE '' END, NULL FROM m LEFT JOIN h ON h.id = m.id AND nth = 1""",
)
def email_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Domains that name a city of another state are emptied and logged; cities of two states, and a city within another's name."""
    n, key = table(spark, d, "nation"), F.col("n_nationkey")
    town = lambda k: F.lower(_town(k))
    cities = n.select(town(key).alias("city"), _cat("S", F.col("n_regionkey")).alias("state"))
    cities = cities.unionByName(n.where("n_nationkey % 5 = 0").select(town(key).alias("city"), F.lit("S9").alias("state")))
    cities = cities.unionByName(n.where("n_nationkey % 4 = 0").select(_cat("old", town(key)).alias("city"), F.lit("S1").alias("state")))
    k, t = F.col("c_custkey"), town(F.col("c_nationkey"))
    email = _pick(k, _cat("info@first", t, "church.org"), _cat("a@OLD", t, ".com"), F.lit("none at all"), F.lit("x@plain.org"))
    rows = table(spark, d, "customer").select(k.alias("id"), _cat("S", F.when(k % 11 == 0, 9).otherwise(k % 5)).alias("state"), email.alias("email"))
    found = checks.domain_conflicts(rows, cities, "id", "email", "state")
    log = checks.conflict_log(found, "id", "email").select(F.lit("log").alias("kind"), "id", "old_value", "source")
    kept = checks.without_conflicts(rows, found, "id", "email").select(F.lit("kept").alias("kind"), "id", F.col("email").alias("old_value"), F.lit(None).cast("string").alias("source"))
    return log.unionByName(kept)


@query(
    "tile_heights",
    """WITH p AS (SELECT c_custkey AS id, c_nationkey AS n, (c_nationkey * 3) % 60 - 30 AS south, (c_nationkey * 7) % 170 - 85 AS west, (c_custkey * 37 % 1000) / 1000.0::DOUBLE + 0.0003 AS up, (c_custkey * 53 % 1000) / 1000.0::DOUBLE AS over FROM customer),
    q AS (SELECT *, CASE WHEN id % 13 = 0 THEN NULL ELSE south + up END AS lat, west + over AS lon FROM p), r AS (SELECT *, round_even((south + 1 - lat) * 30, 0)::INT AS y, round_even((lon - west) * 30, 0)::INT AS x FROM q)
    SELECT id, CASE WHEN lat IS NULL OR n % 6 = 5 OR (x + y) % 11 = 0 THEN NULL ELSE (y * 100 + x - n * 150)::DOUBLE END AS height FROM r""",
)
def tile_heights(spark: SparkSession, d: str) -> DataFrame:
    """A tile of 31 x 31 signed samples for most nations, voids among them; points without a place or a tile have no height."""
    side, n = 31, F.col("n_nationkey")
    value = lambda i: F.when((F.floor(i / side) + i % side) % 11 == 0, F.lit(raster.VOID).cast("long")).otherwise(F.floor(i / side) * 100 + i % side - n * 150)
    content = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(side * side - 1).cast("long")), lambda i: F.lpad(F.hex(value(i).bitwiseAND(F.lit(65535))), 4, "0")), ""))
    south, west = lambda k: (k * 3) % 60 - 30, lambda k: (k * 7) % 170 - 85
    tiles = table(spark, d, "nation").where("n_nationkey % 6 <> 5").select(geo.raster_cell(south(n).cast("double"), west(n).cast("double"))["tile"].alias("tile"), content.alias("content"))
    path = f"{shared_dir(spark)}/tiles-{uuid.uuid4().hex}"
    tiles.write.parquet(path)
    k, own = F.col("c_custkey"), F.col("c_nationkey")
    lat, lon = south(own) + (k * 37 % 1000 / F.lit(1000.0) + 0.0003), west(own) + k * 53 % 1000 / F.lit(1000.0)
    points = table(spark, d, "customer").select(k.alias("id"), F.when(k % 13 != 0, lat).alias("lat"), lon.alias("lon"))
    return raster.with_heights(points, spark.read.schema("tile string, content binary").parquet(path), side=side).select("id", "height")


@query(
    "simplified_lines",
    """WITH l AS (SELECT c_custkey AS id, (c_custkey % 7) * 0.05::DOUBLE AS e FROM customer), m AS (SELECT id, e, e > 0.11 AS one, e > 0.11 AND (2 * e / 3) / sqrt(1 + e * e / 9) > 0.11 AS two FROM l)
    SELECT id, 3 + one::BIGINT + two::BIGINT AS corners, CASE WHEN one THEN 1.0::DOUBLE ELSE 0 END + CASE WHEN two THEN 2.0 ELSE 0 END + 8.0 AS sum_x, 5::BIGINT AS ring FROM m""",
)
def simplified_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines whose two bumps stay or go by the distance that the simpler line leaves, and a closed square with a corner too many."""
    e, at = (F.col("c_custkey") % 7) * 0.05, lambda x, y: F.struct(F.lit(x).cast("double").alias("x"), (y if isinstance(y, Column) else F.lit(float(y))).alias("y"))
    line = geo.simplify(F.array(at(0, 0), at(1, e), at(2, 0), at(4, 0), at(4, 3)), 0.11)
    ring = geo.simplify(F.array(at(0, 0), at(4, 0), at(4, 4), at(2, 4), at(0, 4), at(0, 0)), 0.11)
    done = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), line.alias("line"), ring.alias("ring"))
    return done.select("id", F.size("line").cast("long").alias("corners"), F.aggregate("line", F.lit(0.0), lambda s, p: s + p["x"]).alias("sum_x"), F.size("ring").cast("long").alias("ring"))


@query(
    "moved_children",
    """WITH p AS (SELECT c_custkey AS id, min(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment) AS s FROM customer), o AS (SELECT id, s, CASE WHEN id % 3 > 0 THEN id * 10 END AS a, CASE WHEN id % 5 > 1 THEN id * 100 END AS b FROM p WHERE id % 4 <> 1)
    SELECT 'one' AS kind, s AS id, arg_min(a, (id <> s, id)) FILTER (a IS NOT NULL) AS x, arg_min(b, (id <> s, id)) FILTER (b IS NOT NULL) AS y FROM o GROUP BY s
    UNION ALL SELECT 'many', p.s, count(*), NULL FROM orders JOIN p ON p.id = o_custkey GROUP BY p.s UNION ALL SELECT DISTINCT 'list', s, id % 4, NULL FROM p
    UNION ALL SELECT CASE WHEN id = s THEN 'own' ELSE 'merged' END, id, CASE WHEN id <> s THEN s END, NULL FROM p""",
)
def moved_children(spark: SparkSession, d: str) -> DataFrame:
    """Children of merged customers: one a parent (collisions filled), many a parent, members of lists; the losers' status and pointer."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey", "c_mktsegment")
    best = c.groupBy("c_nationkey", "c_mktsegment").agg(F.min("id").alias("s"))
    moves = c.join(best, ["c_nationkey", "c_mktsegment"]).where("id <> s").select(F.col("id").alias("old"), F.col("s").alias("new"))
    k = F.col("id")
    row = lambda kind, df, x, y=None: df.select(kind if isinstance(kind, Column) else F.lit(kind).alias("kind"), "id", F.col(x).cast("long").alias("x"), (F.col(y) if y else F.lit(None)).cast("long").alias("y"))
    ones = c.where("id % 4 <> 1").select("id", F.when(k % 3 > 0, k * 10).alias("a"), F.when(k % 5 > 1, k * 100).alias("b"))
    out = row("one", linkage.move_one_to_one(ones, "id", moves, "old", "new"), "a", "b")
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("id")).join(c.select("id"), "id", "left_semi")
    out = out.unionByName(row("many", linkage.repoint(orders, "id", moves, "old", "new").groupBy("id").agg(F.count(F.lit(1)).alias("n")), "n"))
    out = out.unionByName(row("list", linkage.move_list(c.select("id", (k % 4).alias("tag")), "id", moves, "old", "new"), "tag"))
    marked = linkage.mark_merged(c.select("id", F.lit("own").alias("status"), F.lit(None).cast("long").alias("canonical_id")), moves, "id", "old", "new")
    return out.unionByName(row(F.col("status").alias("kind"), marked, "canonical_id"))


#: Addresses of customers: numbers, directions, abbreviations, and words that look like some.
_RAW = "CASE c_custkey % 6 WHEN 0 THEN c_custkey || ' N. Oak ' || t || ' St.' WHEN 1 THEN c_custkey || 'b west Mt ' || t || ' Ave' WHEN 2 THEN t || ' Broadway' WHEN 3 THEN c_custkey || ' NE ' || t || ' Rd' WHEN 4 THEN 'E. Street' ELSE '' END"


@query(
    "address_parts",
    f"""WITH t AS (SELECT *, chr(65 + c_nationkey % 25) || 'ville' AS t FROM customer), r AS (SELECT c_custkey AS id, {_RAW} AS raw FROM t),
    w AS (SELECT id, raw, list_transform(list_filter(string_split(regexp_replace(upper(raw), '[^A-Z0-9_\\s]', ' ', 'g'), ' '), lambda x: x <> ''),
        lambda x: CASE x WHEN 'ST' THEN 'STREET' WHEN 'MT' THEN 'MOUNT' WHEN 'AVE' THEN 'AVENUE' WHEN 'N' THEN 'NORTH' WHEN 'E' THEN 'EAST' ELSE x END) AS w FROM r),
    n AS (SELECT *, CASE WHEN regexp_full_match(w[1], '\\d+[A-Z]?') THEN w[1] END AS number, CASE WHEN regexp_full_match(w[1], '\\d+[A-Z]?') THEN w[2:] ELSE w END AS v FROM w),
    o AS (SELECT *, CASE WHEN v[1] IN ('NORTH', 'SOUTH', 'EAST', 'WEST') THEN v[1] END AS direction, CASE WHEN v[1] IN ('NORTH', 'SOUTH', 'EAST', 'WEST') THEN v[2:] ELSE v END AS u FROM n),
    q AS (SELECT *, CASE WHEN u[-1] IN ('STREET', 'AVENUE', 'ROAD') THEN u[-1] END AS suffix, CASE WHEN u[-1] IN ('STREET', 'AVENUE', 'ROAD') THEN u[:-2] ELSE u END AS s FROM o)
    SELECT id, coalesce(number, '') || '|' || coalesce(direction, '') || '|' || array_to_string(s, ' ') || '|' || coalesce(suffix, '') AS key, number IS NOT NULL AND len(s) > 0 AS same FROM q""",
)
def address_parts(spark: SparkSession, d: str) -> DataFrame:
    """The key of an address, and whether it is the same as itself written out: not without a number or a street."""
    k, t = F.col("c_custkey"), _cat(_town(F.col("c_nationkey"), upper=False))
    raw = _pick(k, _cat(k, " N. Oak ", t, " St."), _cat(k, "b west Mt ", t, " Ave"), _cat(t, " Broadway"), _cat(k, " NE ", t, " Rd"), F.lit("E. Street"), F.lit(""))
    full = _pick(k, _cat(k, " north oak ", t, " street"), _cat(k, "B W Mount ", t, " Av."), _cat(t, " Broadway"), _cat(k, " ne ", t, " rd"), F.lit("East Street"), F.lit(""))
    a, b = text.parse_address(raw), text.parse_address(full)
    return table(spark, d, "customer").select(k.alias("id"), text.address_key(a).alias("key"), text.same_address(a, b).alias("same"))


_CODE = "CASE WHEN x IN ('B','F','P','V') THEN '1' WHEN x IN ('C','G','J','K','Q','S','X','Z') THEN '2' WHEN x IN ('D','T') THEN '3' WHEN x = 'L' THEN '4' WHEN x IN ('M','N') THEN '5' WHEN x = 'R' THEN '6' END"
_SOUND = f"""list_transform(w, lambda v: rpad(substr(v, 1, 1) || array_to_string(list_filter(list_transform(string_split(substr(v, 2), ''), lambda x: {_CODE}), lambda c, i: c IS NOT NULL), ''), 40, '.'))"""


@query(
    "phonetic_blocks",
    f"""WITH n AS (SELECT p_partkey AS k, p_name || CASE p_partkey % 3 WHEN 0 THEN ', St. Mark' WHEN 1 THEN ' of Mt' ELSE '' END AS name FROM part),
    w AS (SELECT k, list_filter(list_transform(string_split(regexp_replace(upper(name), '[^A-Z0-9_]+', ' ', 'g'), ' '), lambda x: CASE x WHEN 'ST' THEN 'STREET' WHEN 'MT' THEN 'MOUNT' ELSE x END), lambda x: length(x) > 2) AS w FROM n),
    u AS (SELECT k, unnest(w[:2]) AS v, unnest(range(len(w[:2]))) AS i FROM w), l AS (SELECT k, i, substr(v, 1, 1) AS f, list_filter(list_transform(string_split(substr(v, 2), ''), lambda x: {_CODE}), lambda c: c IS NOT NULL) AS cs FROM u),
    z AS (SELECT k, i, f || rpad(array_to_string(list_transform(list_filter(list_zip(cs, range(1, len(cs) + 1)), lambda p: p[2] = 1 OR p[1] <> cs[p[2] - 1]), lambda p: p[1])[:3], ''), 3, '0') AS s FROM l)
    SELECT block, count(*) AS n FROM (SELECT k, string_agg(s, '|' ORDER BY i) AS block FROM z GROUP BY k) GROUP BY 1""",
)
def phonetic_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Block keys of part names, some with abbreviations that are spelled out first, and how many names share each."""
    k = F.col("p_partkey")
    name = F.concat("p_name", _pick(k, F.lit(", St. Mark"), F.lit(" of Mt"), F.lit("")))
    return table(spark, d, "part").groupBy(similarity.block_keys(name).alias("block")).agg(F.count(F.lit(1)).alias("n"))


#: A character of each script, in the order of the list, and two of Japanese.
LETTERS = "ЯΩعא教ひカ교ไதਗবहქհကខລසཀአ"


@query(
    "scripts",
    f"""WITH l AS (SELECT i, substr('{LETTERS}', i::INT, 1) AS c, (['Cyrillic','Greek','Arabic','Hebrew','CJK','Hiragana','Katakana','Hangul','Thai','Tamil','Gurmukhi','Bengali','Devanagari','Georgian','Armenian','Myanmar','Khmer','Lao','Sinhala','Tibetan','Ethiopic'])[i] AS s FROM (SELECT unnest(range(1, 22)) AS i)),
    r AS (SELECT p_partkey AS id, p_name || CASE WHEN p_partkey % 4 > 0 THEN substr('{LETTERS}', (p_partkey % 21 + 1)::INT, 1) ELSE '' END || CASE WHEN p_partkey % 3 = 0 THEN substr('{LETTERS}', (p_partkey * 5 % 21 + 1)::INT, 1) ELSE '' END AS t FROM part)
    SELECT id, coalesce(string_agg(s, ',' ORDER BY i), '') AS scripts FROM r LEFT JOIN l ON contains(t, c) GROUP BY id""",
)
def scripts(spark: SparkSession, d: str) -> DataFrame:
    """Part names with up to two letters of other scripts: every script that a name holds."""
    k = F.col("p_partkey")
    letter = lambda at: F.substring(F.lit(LETTERS), (at % 21 + 1).cast("int"), F.lit(1))
    name = F.concat("p_name", F.when(k % 4 > 0, letter(k)).otherwise(""), F.when(k % 3 == 0, letter(k * 5)).otherwise(""))
    return table(spark, d, "part").select(k.alias("id"), F.array_join(text.scripts_in(name), ",").alias("scripts"))


@query(
    "address_lines",
    """WITH r AS (SELECT c_custkey AS k, chr(65 + c_nationkey % 25) || 'VILLE' AS t FROM customer)
    SELECT k AS id, CASE WHEN k % 6 = 5 THEN NULL ELSE k || ' OAK' END AS street, CASE k % 6 WHEN 0 THEN t WHEN 1 THEN 'FLAT 3' WHEN 2 THEN NULL WHEN 3 THEN t || ' il' END AS city,
        CASE WHEN k % 6 < 3 THEN 'IL' END AS state, CASE WHEN k % 6 IN (0, 2, 3) THEN lpad((k % 90000)::VARCHAR, 5, '0') END AS zip FROM r""",
)
def address_lines(spark: SparkSession, d: str) -> DataFrame:
    """The city is the second part, whatever it says; a state is two capitals alone; a ZIP is a part of its own."""
    k, t = F.col("c_custkey"), _town(F.col("c_nationkey"))
    code = F.lpad((k % 90000).cast("string"), 5, "0")
    raw = _pick(k, _cat(k, " OAK, ", t, ", IL, ", code), _cat(k, " OAK, FLAT 3, ", t, ", IL"), _cat(k, " OAK,, IL ,", code, "-1234"), _cat(k, " OAK, ", t, " il, ", code), _cat(k, " OAK"), F.lit(None))
    x = text.split_address_line(raw)
    return table(spark, d, "customer").select(k.alias("id"), *[x[c].alias(c) for c in ("street", "city", "state", "zip")])


@query(
    "exact_then_alike",
    """WITH p AS (SELECT p_partkey AS k, md5(p_name) AS n FROM part), r AS (SELECT 'c' || k % 3 AS city, n, min(k) AS b FROM p WHERE k % 2 = 0 GROUP BY 1, 2),
    l AS (SELECT k, 'c' || k % 3 AS city, n, k % 4 AS kind FROM p WHERE k % 4 <> 3)
    SELECT l.k AS id, b AS partner, CASE kind WHEN 0 THEN 1.0 ELSE round(64.0 / (64 + kind), 6) END AS score FROM l JOIN r USING (city, n)""",
)
def exact_then_alike(spark: SparkSession, d: str) -> DataFrame:
    """Names of one word with a letter or two too many, so that no word is shared, against those of the same city."""
    k, n = F.col("p_partkey"), F.md5(F.col("p_name").cast("binary"))
    city = _cat("c", k % 3)
    part = table(spark, d, "part")
    left = part.select(k.alias("id"), _pick(k, F.upper(n), _cat(n, "~"), _cat(n, "~~"), F.md5(k.cast("string").cast("binary"))).alias("name"), city.alias("city"))
    right = part.where("p_partkey % 2 = 0").select(k.alias("partner"), _cat(" ", n, " ").alias("name"), F.upper(city).alias("city"))
    return matching.exact_then_alike(left, right, "id", "partner", "name", "city").withColumn("score", F.round("score", 6))


@query(
    "best_by_words",
    """WITH p AS (SELECT p_partkey AS k, list_sort(list_distinct(string_split(p_name || ' ' || lower(p_type), ' '))) AS w, p_size % 5 AS g FROM part),
    j AS (SELECT l.k AS id, r.k AS partner, len(list_intersect(l.w, r.w)) AS shared, len(list_distinct(list_concat(l.w, r.w))) AS every FROM p l JOIN p r ON l.g = r.g AND r.k % 3 = 0 AND l.k % 3 > 0)
    SELECT id, arg_min(partner, (-shared / every::DOUBLE, partner)) AS partner, round(max(shared / every::DOUBLE), 6) AS score FROM j WHERE shared >= 2 AND shared / every::DOUBLE >= 0.5 GROUP BY id""",
)
def best_by_words(spark: SparkSession, d: str) -> DataFrame:
    """The part of the same size class that shares most words, two at least."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.split(F.concat_ws(" ", "p_name", F.lower("p_type")), " ").alias("w"), (F.col("p_size") % 5).alias("g"))
    right = part.where("id % 3 = 0").withColumnRenamed("id", "partner")
    return linkage.best_in_block(part.where("id % 3 > 0"), right, "id", "partner", (F.col("g"), F.col("g")), (F.col("w"), F.col("w")), 0.5, 2).withColumn("score", F.round("score", 6))
