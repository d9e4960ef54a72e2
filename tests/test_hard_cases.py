"""Hard cases of the rules with results worked out by hand; the queries of the same names run on cases made from the tables."""

import uuid

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import geo, labels, rules, similarity, text
from rollcall.operators import geocode, graph, linkage, matching, provenance, spatial
from rollcall.operators.settled import shared_dir
from rollcall.plans.exchange import _folder, _write_bytes
from rollcall.sources import files
from tests.compare import rows

CASES = {}


def given(spark, schema, data):
    return spark.createDataFrame(list(data), schema)


def stated(names, data):
    return list(names), list(data)


def query(name, expected):
    """Registers a case: a function of a session, and the rows that it must give."""

    def add(f):
        CASES[name] = (f, expected)
        return f

    return add


TREE = [
    (1, None, "root", 0, "root", 1), (2, 1, "a", 1, "root > a", 1), (3, 1, "a", 1, "root > a", 1), (4, 2, "b", 5, "root > b", 2),
    (5, 4, "b", 3, "root > a > b > b", 1), (6, 99, "lost", None, None, None), (7, 7, "self", None, None, None), (8, 9, "x", None, None, None), (9, 8, "y", None, None, None), (10, 3, None, 2, None, 1),
]


ISSUES = [
    ("orphan", 6), ("self_parent", 7), ("same_as_parent", 5), ("duplicate_sibling", 2), ("duplicate_sibling", 3), ("name_elsewhere", 4), ("name_elsewhere", 5),
    ("unreachable", 6), ("unreachable", 7), ("unreachable", 8), ("unreachable", 9), ("depth_mismatch", 4), ("depth_mismatch", 6), ("empty", 6), ("empty", 10),
]


def _tree(spark: SparkSession) -> DataFrame:
    return given(spark, "id long, parent long, name string, depth long, path string, root long", TREE)


@query("tree_issues", stated(["issue", "id"], ISSUES))
def tree_issues(spark: SparkSession, d: str) -> DataFrame:
    return graph.audit_tree(_tree(spark), "id", "parent", "name", depth="depth", members=given(spark, "id long", [(5,), (5,), (None,)]))


@query("tree_paths", stated(["id", "expected_path", "expected_root"], [(4, "root > a > b", 1), (10, "root > a", 1)]))
def tree_paths(spark: SparkSession, d: str) -> DataFrame:
    """Nodes without a name add nothing to a path."""
    return graph.path_mismatches(_tree(spark), "id", "parent", "name", "path", "root")


@query("cycle_states", stated(["id", "terminal", "hops", "state"], [(2, 1, 1, "ok"), (3, 1, 1, "ok"), (4, 1, 2, "ok"), (5, 1, 3, "ok"), (6, 99, 1, "dangling"), (7, 7, 0, "self"), (8, None, None, "cycle"), (9, None, None, "cycle"), (10, 1, 2, "ok")]))
def cycle_states(spark: SparkSession, d: str) -> DataFrame:
    return graph.flatten_pointers(_tree(spark), "id", "parent")


@query("two_cycles", stated(["id", "parent"], [(r[0], None if r[0] == 8 else r[1]) for r in TREE]))
def two_cycles(spark: SparkSession, d: str) -> DataFrame:
    return graph.break_two_cycles(_tree(spark).withColumn("rich", F.lit(1)), "id", "parent", "rich").select("id", "parent")


@query("merged_nodes", stated(["id", "parent"], [(r[0], 3 if r[1] == 2 else r[1]) for r in TREE if r[0] != 2]))
def merged_nodes(spark: SparkSession, d: str) -> DataFrame:
    return graph.merge_nodes(_tree(spark), given(spark, "loser long, winner long", [(2, 3)]), "id", "parent").select("id", "parent")


@query("renamed_subtree", stated(["id", "path"], [(1, "root"), (2, "root > c"), (3, "root > c"), (4, "root > b"), (5, "root > c > b > b"), (6, None)]))
def renamed_subtree(spark: SparkSession, d: str) -> DataFrame:
    return graph.rename_subtree(_tree(spark).where("id < 7"), "path", "root > a", "root > c").select("id", "path")


@query("three_levels", stated(["id", "level1", "level2", "level3"], [(1, "(none)", "(none)", "root"), (2, "(none)", "root", "a"), (4, "root", "a", "b"), (5, "a", "b", "b"), (6, "(none)", "(none)", "lost"), (10, "root", "a", "(none)")]))
def three_levels(spark: SparkSession, d: str) -> DataFrame:
    return graph.three_levels(_tree(spark), "id", "parent", "name").where("id IN (1, 2, 4, 5, 6, 10)")


SOURCES = [("osm", "map", 1), ("irs", "list", 2)]


@query("source_registry", stated(["source", "kind", "rank"], [("osm", "map", 1), ("irs", "list", 2), ("wiki", "a", 5)]))
def source_registry(spark: SparkSession, d: str) -> DataFrame:
    """Known keys stay as they are, null keys are left out, and a second run adds nothing."""
    shape = "source string, kind string, rank int"
    found = given(spark, shape, [("osm", "other", 9), ("wiki", "b", 4), ("wiki", "a", 5), (None, "x", 1)])
    once = provenance.register_sources(given(spark, shape, SOURCES), found, "source")
    return provenance.register_sources(once, found, "source")


NAMES = [
    ("Grace (North) Chapel, Inc. LLC", "Grace Chapel,", "GRACE (NORTH) CHAPEL, .", "GRACE NORTH CHAPEL INC LLC"),
    ("  The  Hope Corp of  St. Mark ", "The Hope of St. Mark", "HOPE OF ST. MARK", "THE HOPE CORP OF STREET MARK"),
    ("Org of Faith and an Ark", "of Faith and an Ark", "ORG OF FAITH AND ARK", "ORG OF FAITH AND AN ARK"),
    ("Mt Olive Ch N Side PC", "Mt Olive Ch N Side PC", "MT OLIVE CH N SIDE", "MOUNT OLIVE CHURCH NORTH SIDE PC"),
    ("Corporation Street Mission;", "Street Mission", "CORPORATION STREET MISSION;", "CORPORATION STREET MISSION"),
    ("", "", "", ""),
    (None, None, None, ""),
]


@query("name_keys", stated(["raw", "cleaned", "matched", "linked"], NAMES))
def name_keys(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("raw")
    return given(spark, "raw string", [(r[0],) for r in NAMES]).select("raw", text.clean_name(n).alias("cleaned"), text.match_name(n).alias("matched"), text.linkage_name(n).alias("linked"))


EMAILS = [
    ("mailto:<A@B.org>.", "<a@b.org>", 0.54),
    ("a@b.org (office)", "a@b.org", 0.54),
    ("<Info@Grace.org>", "info@grace.org", 0.54),
    ("info@grace.org", "info@grace.org", 0.72),
    ("pastor@gmail.com", "pastor@gmail.com", 0.76),
    ("john.smith@a.b.c.org", "john.smith@a.b.c.org", 0.68),
    ("JOHN@x.org", "john@x.org", 0.84),
    ("jo@x.org", "jo@x.org", 0.54),
    ("noreply@x.org", "noreply@x.org", 0.36),
    ("Secretary@X.ORG.", "secretary@x.org", 0.84),
    ("two@at@x.org", "two@at@x.org", 0.0),
    ("no address", "no address", 0.0),
    ("", "", 0.0),
    (None, None, 0.0),
]


@query("email_rules", stated(["raw", "cleaned", "score"], EMAILS))
def email_rules(spark: SparkSession, d: str) -> DataFrame:
    return given(spark, "raw string", [(r[0],) for r in EMAILS]).select("raw", text.clean_email(F.col("raw")).alias("cleaned"), text.email_score(F.col("raw")).alias("score"))


ADDRESSES = [
    ("BOX 1336, Odgen, IL, 62863", "Odgen, IL, 62863"),
    ("PO BOX 1234, Springfield, MO 65801", "PO BOX 1234, Springfield, MO 65801"),
    ("P.O. BOX 567, Houston, TX 77001", "P.O. BOX 567, Houston, TX 77001"),
    ("POB 12 , Rural Route,  Gary, IN, 46401", "Gary, IN, 46401"),
    ("Hall, p.o.box 9, Town, IL, 60000", "Town, IL, 60000"),
    ("Boxwood 5, Elm, IL, 60001", "Boxwood 5, Elm, IL, 60001"),
    ("109 North Mill Street, Colfax, WA 99111", "109 North Mill Street, Colfax, WA 99111"),
    ("PO BOX 7", "PO BOX 7"),
    (None, None),
]


@query("post_boxes", stated(["raw", "kept"], ADDRESSES))
def post_boxes(spark: SparkSession, d: str) -> DataFrame:
    return given(spark, "raw string", [(r[0],) for r in ADDRESSES]).select("raw", text.without_po_box(F.col("raw")).alias("kept"))


TITLES = [
    ("Grace Church Inc.", "grace", 1.0),
    ("Welcome to Grace Chapel - Home", "Grace Chapel", 0.9),
    ("Grace Bible Fellowship of Gary", "Grace Bible Fellowship Center", 0.8),
    ("Grace Home", "Grace Chapel", 0.6),
    ("abcd", "bcde", 0.52),
    ("xyz", "Hope", 0.0),
    ("", "Hope", 0.0),
    (None, "Hope", 0.0),
    ("Hope", None, 0.0),
]


@query("title_scores", stated(["title", "name", "score"], TITLES))
def title_scores(spark: SparkSession, d: str) -> DataFrame:
    return given(spark, "title string, name string", [r[:2] for r in TITLES]).select("title", "name", similarity.title_score(F.col("title"), F.col("name")).alias("score"))


PAGES = [
    ("Grace Chapel", "Gary", "IN", "Grace Chapel", None, "Sunday worship at our church in Gary", 0.9, True),
    ("Grace Chapel", "Gary", "IN", "", None, "Sunday worship at our church in Gary", 0.15, False),
    ("Grace Chapel", "Gary", "in", "Zyx", "Gary, IN", "", 0.25, False),
    ("Grace", None, None, "Grace", "", "church ministry worship sunday service pastor congregation chapel gospel", 0.75, True),
    (None, None, None, None, None, None, 0.0, False),
]


@query("page_matches", stated(["name", "city", "state", "title", "description", "body", "score", "is_match"], PAGES))
def page_matches(spark: SparkSession, d: str) -> DataFrame:
    df = given(spark, "name string, city string, state string, title string, description string, body string", [r[:6] for r in PAGES])
    m = similarity.match_score(*[F.col(c) for c in df.columns])
    return df.select("*", m["score"].alias("score"), m["is_match"].alias("is_match"))


STATES = [None, "", "pending", "found", "not_found", "verified", "error", "archived"]


@query(
    "status_rules",
    """WITH s AS (SELECT * FROM (VALUES (NULL), (''), ('pending'), ('found'), ('not_found'), ('verified'), ('error'), ('archived')) AS t(v))
    SELECT a.v AS old, b.v AS new, CASE WHEN b.v IS NULL THEN false WHEN coalesce(a.v, '') = '' THEN b.v = 'pending'
      WHEN a.v = 'pending' THEN b.v IN ('found', 'not_found', 'error') WHEN a.v = 'found' THEN b.v IN ('verified', 'not_found', 'error')
      WHEN a.v = 'not_found' THEN b.v IN ('found', 'error') WHEN a.v = 'verified' THEN b.v = 'error'
      WHEN a.v = 'error' THEN b.v IN ('pending', 'found', 'not_found') ELSE b.v IN ('found', 'not_found', 'verified', 'error') END AS allowed,
      coalesce(a.v, '') IN ('', 'pending', 'error') AS open, coalesce(a.v, '') IN ('found', 'not_found', 'verified') AS done
    FROM s a CROSS JOIN s b""",
)
def status_rules(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of eight statuses, nulls, blanks and an unlisted one among them."""
    df = given(spark, "old string, new string", [(a, b) for a in STATES for b in STATES])
    old, new = F.col("old"), F.col("new")
    return df.select("old", "new", rules.transition_allowed(old, new).alias("allowed"), rules.needs_check(old).alias("open"), rules.is_done(old).alias("done"))


TIERS = [
    (True, 0.95, None, None, False, 1),
    (True, 0.5, None, None, True, 2),
    (True, 0.5, None, None, None, 2),
    (True, 0.5, 0.1, True, False, None),
    (False, 0.96, 1.5, False, True, 3),
    (False, 0.96, 3.0, True, True, None),
    (False, 0.96, None, True, True, 3),
    (None, 0.96, None, True, False, None),
    (False, 0.94, 0.1, True, True, None),
    (None, None, None, None, None, None),
]


@query("link_tiers", stated(["one", "alike", "km", "stem", "fits", "tier"], TIERS))
def link_tiers(spark: SparkSession, d: str) -> DataFrame:
    df = given(spark, "one boolean, alike double, km double, stem boolean, fits boolean", [r[:5] for r in TIERS])
    return df.select("*", linkage.tier_of(*[F.col(c) for c in df.columns]).alias("tier"))


RULES = [(("LUTHERAN", "ELCA"), "lutheran"), (("BAPTIST",), "baptist"), (("CHURCH OF GOD", "C.O.G."), "church of god")]


LD = '<script type="application/ld+json">{}</script>'


SITES = [
    (LD.format('{"a": [{"affiliation": "ab"}, {"x": {"denomination": "Reformed"}}]}') + " baptist", "t", "Reformed", "jsonld"),
    (LD.format("{broken") + LD.format('{"affiliation": "Quaker"}'), None, "Quaker", "jsonld"),
    (LD.format('{"a": {"b": {"c": {"d": {"e": {"f": {"denomination": "deep"}}}}}}}') + "<p>none</p>", None, "unknown", "no_match"),
    ("<p>First Baptist, an elca house</p>", None, "lutheran", "body_keyword"),
    ("<p>c.o.g. but not cxoxgx</p>", "x", "church of god", "body_keyword"),
    ("<p>cxoxgx</p>", "Baptist home", "baptist", "title_keyword"),
    ("<p>nothing</p>", None, "unknown", "no_match"),
    ("", "Baptist home", "unknown", "no_content"),
    (None, None, "unknown", "no_content"),
]


@query("webpage_labels", stated(["html", "title", "label", "method"], SITES))
def webpage_labels(spark: SparkSession, d: str) -> DataFrame:
    x = labels.webpage_label(F.col("html"), F.col("title"), RULES)
    return given(spark, "html string, title string", [r[:2] for r in SITES]).select("html", "title", x["label"].alias("label"), x["method"].alias("method"))


KINDS = {"mosque": "muslim", "synagogue": "jewish", "religious_organization": "unknown"}


GRAPH = [
    (1, "A Lutheran parish", [("Mosque", "x")], "lutheran"),
    (2, "A house", [("Religious_Organization", "y"), ("Thing", "SYNAGOGUE"), ("mosque", "z")], "jewish"),
    (3, None, [(None, None), ("mosque", None)], "muslim"),
    (4, "A house", [], None),
    (5, None, None, None),
]


@query("graph_labels", stated(["k", "label"], [(r[0], r[3]) for r in GRAPH]))
def graph_labels(spark: SparkSession, d: str) -> DataFrame:
    df = given(spark, "k int, description string, categories array<struct<name: string, id: string>>", [r[:3] for r in GRAPH])
    return df.select("k", labels.graph_label(F.col("description"), F.col("categories"), [(label, w) for w, label in RULES], KINDS).alias("label"))


NODES = [("misc", True), ("Misc house", False), ("node 7", True), ("12", True), ("Room 12", False), ("Contest", True), ("What?", True), ("", False), (None, False)]


@query("suspicious_names", stated(["name", "suspicious"], NODES))
def suspicious_names(spark: SparkSession, d: str) -> DataFrame:
    return given(spark, "name string", [(r[0],) for r in NODES]).select("name", labels.suspicious_name(F.col("name")).alias("suspicious"))


TEXTS = [
    ("1-312-555-0199", "(312) 555-0199", "+13125550199", 1.0), ("(312) 555 0199", "(312) 555-0199", "+13125550199", 1.0), (" 555-0199 ", "555-0199", "555-0199", 0.3),
    ("23125550199", "23125550199", "23125550199", 0.3), ("", "", None, None), (None, None, None, None),
]


@query("phone_shapes", stated(["raw", "phone", "e164", "confidence"], TEXTS))
def phone_shapes(spark: SparkSession, d: str) -> DataFrame:
    e = text.phone_e164(F.col("raw"))
    return given(spark, "raw string", [(r[0],) for r in TEXTS]).select("raw", text.clean_phone(F.col("raw")).alias("phone"), e["phone"].alias("e164"), e["confidence"].alias("confidence"))


SCORES = [
    ("MARTHA", "MARHTA", 0.961111), ("DWAYNE", "DUANE", 0.84), ("DIXON", "DICKSONX", 0.813333), ("ABCD", "DCBA", 0.5), ("JELLYFISH", "SMELLYFISH", 0.896296),
    ("A", "A", 1.0), ("", "A", 0.0), ("ABC", "XYZ", 0.0), (None, "A", None),
]


@query("name_similarity", stated(["a", "b", "score"], SCORES))
def name_similarity(spark: SparkSession, d: str) -> DataFrame:
    return given(spark, "a string, b string", [r[:2] for r in SCORES]).select("a", "b", F.round(similarity.jaro_winkler(F.col("a"), F.col("b")), 6).alias("score"))


LINKS = [(1, 1951, 1), (1, 1951, 3), (2, 1951, 1), (2, 1951, 1), (3, 1951, 2), (4, 1951, 2), (4, 1963, 3), (5, 1951, 2), (5, 1951, 3)]


@query("held_links", stated(["record", "era", "tier", "held"], [(*r, h) for r, h in zip(LINKS, [False, True, True, True, False, False, False, True, True], strict=True)]))
def held_links(spark: SparkSession, d: str) -> DataFrame:
    return linkage.hold_ambiguous(given(spark, "record long, era long, tier int", LINKS), "record", "era", "tier")


HUBS = [("IL", 1, 40.0, -88.0), ("IL", 2, 41.0, -88.0), ("IL", 3, 42.0, -88.0), ("IL", 4, None, None), ("IN", 6, None, None), ("IN", 5, None, None), ("OH", 8, 40.0, -82.0), ("OH", 7, 41.0, -82.0)]


@query("group_hubs", stated(["state", "hub", "members"], [("IL", 2, 4), ("IN", 5, 2), ("OH", 7, 2)]))
def group_hubs(spark: SparkSession, d: str) -> DataFrame:
    return graph.hubs(given(spark, "state string, id long, lat double, lon double", HUBS), "id", "state")


WORDS = [
    (1, "First Baptist-Church of Gary", "IN", 11, 3.0),
    (2, "Mount Zion", "IN", 14, 2.0),
    (3, "Hope", "IN", 13, 1.0),
    (4, "First Baptist Church", "OH", None, None),
    (5, "Zion Hill Mission House", "in", None, None),
    (6, None, "IN", None, None),
]


HELD = [(11, "first baptist church", "in"), (12, "First Baptist Home", "IN"), (13, "New Hope Hope", "IN"), (14, "Mount Zion Temple", "IN"), (15, "Zion", "IN")]


@query("first_words", stated(["id", "partner", "score"], [(r[0], r[3], r[4]) for r in WORDS if r[3]]))
def first_words(spark: SparkSession, d: str) -> DataFrame:
    left = given(spark, "id long, name string, state string", [r[:3] for r in WORDS])
    return matching.first_words_match(left, given(spark, "partner long, name string, state string", HELD), "id", "partner", "name", "state")


SCORED = [("a", 1, "grace chapel", "grace chapel", 1.0, "gary", "gary"), ("a", 2, "grace chapel", "chapel grace", 0.0, "gary", ""), ("b", 3, "x", "y", 9.0, "gary", "ohio"), ("c", 4, "abc", "abc", 2.5, "old gary", "gary"), ("c", 5, "abc", "abc", 2.5, "old gary", "gary")]


@query("scored_neighbours", stated(["id", "partner", "score", "km"], [("a", 1, 1.09, 1.0), ("c", 4, 1.0, 2.5)]))
def scored_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Of pairs within reach: 0.7 + 0.24 + 0.15 beats 0.7 + 0.3; nothing in common is no match; ties go to the smaller id."""
    pairs = given(spark, "id string, partner long, n1 string, n2 string, km double, c1 string, c2 string", SCORED)
    return matching.scored_neighbours(pairs, "id", "partner", ("n1", "n2"), ("c1", "c2"))


LISTED = [(1, "Grace Chapel ", "Gary"), (2, "Grace Chapels", "gary"), (3, "St Mary Abbey", "Gary"), (4, "Grace Chapel", "Ohio"), (5, None, "Gary")]


FOUND = [(21, "grace chapel", "GARY"), (22, "Grace Chapel", "Gary"), (23, "Grace Chapelle", "Gary"), (24, "St Mary Abbot", "Gary"), (25, "Grace Tower", "Ohio")]


@query("exact_then_alike", stated(["id", "partner", "score"], [(1, 21, 1.0), (2, 21, 0.96), (3, 24, 0.846)]))
def exact_then_alike(spark: SparkSession, d: str) -> DataFrame:
    left, right = given(spark, "id long, name string, city string", LISTED), given(spark, "partner long, name string, city string", FOUND)
    return matching.exact_then_alike(left, right, "id", "partner", "name", "city").withColumn("score", F.round("score", 3))


MAIN = [("Hope", "info@h.org"), ("Hope", "pastor.jo@h.org"), ("Ark", "z@a.org"), ("Ark", "b@a.org"), ("Zion", None)]


OTHER = [("Other", "info@h.org"), ("Ark", "office@a.org"), ("Gem", "treasurer@g.org"), ("Gem", "x(guess)@g.org (guess)")]


@query("best_contacts", stated(["name", "email", "rank", "addresses"], [("Hope", "pastor.jo@h.org", 10, 2), ("Ark", "office@a.org", 9, 3), ("Gem", "treasurer@g.org", 7, 2)]))
def best_contacts(spark: SparkSession, d: str) -> DataFrame:
    return matching.best_contacts(given(spark, "name string, email string", MAIN), given(spark, "name string, email string", OTHER), "name", "email")


RING = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]


AROUND = [(1, "a", 2.0, 2.0, "inside"), (2, "a", 4.05, 2.0, "near"), (3, "a", 4.2, 2.0, "outside"), (4, "b", 2.0, 2.0, "no polygon"), (5, "a", None, 2.0, None), (6, None, 2.0, 2.0, "no polygon"), (7, "a", 4.08, 4.08, "outside"), (8, "a", 4.06, 4.06, "near")]


@query("declared_polygons", stated(["id", "placed"], [(r[0], r[4]) for r in AROUND]))
def declared_polygons(spark: SparkSession, d: str) -> DataFrame:
    points = given(spark, "id long, country string, lon double, lat double", [r[:4] for r in AROUND])
    shapes = given(spark, "country string, ring array<struct<x: double, y: double>>", [("a", RING)])
    return matching.outside_polygon(points, shapes, "country").select("id", "placed")


ZIPS = [("00501", 40.81, -73.04), ("60614", 41.92, -87.65)]


@query("geocode_precedence", stated(["id", "lat", "lon", "source"], [(1, 41.92, -87.65, "zip_centroid"), (2, 10.0, 20.0, "census_street"), (3, 40.81, -73.04, "zip_centroid"), (4, None, None, None), (5, None, None, None)]))
def geocode_precedence(spark: SparkSession, d: str) -> DataFrame:
    rows = given(spark, "id long, zip string", [(1, "60614-1234"), (2, "60614"), (3, "501"), (4, "99999"), (5, None)])
    streets = given(spark, "id long, lat double, lon double", [(2, 10.0, 20.0), (3, None, None)])
    return geocode.geocoded(rows, streets, given(spark, "zip string, lat double, lon double", ZIPS), "id", "zip").select("id", "lat", "lon", "source")


HITS = [(1, 40.1, -87.0), (1, 44.0, -87.0), (2, 44.0, -87.0), (3, 44.0, -87.0), (3, 30.0, -87.0), (3, 45.0, -80.0), (4, 44.0, -87.0), (4, 44.1, -87.0), (4, 44.2, -87.0), (5, None, None)]


@query("wrong_places", stated(["id", "hits", "wrong"], [(1, 2, False), (2, 1, True), (3, 3, False), (4, 3, True), (5, 0, False), (6, 0, False)]))
def wrong_places(spark: SparkSession, d: str) -> DataFrame:
    """Near hits clear a place; far ones accuse it, unless three or more lie scattered."""
    return geocode.wrong_places(given(spark, "id long, lat double, lon double", [(k, 40.0, -87.0) for k in range(1, 7)]), given(spark, "id long, lat double, lon double", HITS), "id")


FILLED = [(1, "Oak Ave", "", None, "60614", "12 Oak Ave", "Gary", " IN ", "46401", "12 Oak Ave", "Gary", "IN", "60614"), (2, "7 Elm", "Ohio", "OH", "", "9 Elm", "Gary", "IN", None, "7 Elm", "Ohio", "OH", None), (3, None, None, None, None, "Elm", None, "", "", "Elm", None, None, None)]


@query("merged_addresses", stated(["id", "street", "city", "state", "zip"], [(r[0], *r[9:]) for r in FILLED]))
def merged_addresses(spark: SparkSession, d: str) -> DataFrame:
    names = [f"{s}_{f}" for s in ("own", "found") for f in ("street", "city", "state", "zip")]
    df = given(spark, "id long, " + ", ".join(f"{n} string" for n in names), [r[:9] for r in FILLED])
    return geocode.merged_address(df, ["own", "found"]).select("id", "street", "city", "state", "zip")


@query("csv_dialects", stated(["kind", "id", "name"], [("bom", 1, "Zoë"), ("bom", 2, None), ("latin", 1, "Zoë"), ("tabs", 3, "a, b"), ("tabs", None, "x")]))
def csv_dialects(spark: SparkSession, d: str) -> DataFrame:
    """A byte-order mark, padded headers, Latin-1, tabs, and a value that is no number."""
    out = None
    for kind, body, options in (
        ("bom", "﻿id, name \n1,Zoë\n2,\n", {}),
        ("latin", "id,name\n1,Zoë\n", {"encoding": "ISO-8859-1"}),
        ("tabs", " id\tname\n3\ta, b\nfour\tx\n", {"sep": "\t"}),
    ):
        path = _folder(spark, kind)
        writer = given(spark, "value string", [(body.rstrip("\n"),)]).coalesce(1).write.option("encoding", options.get("encoding", "UTF-8"))
        writer.text(path) if kind != "latin" else _write_bytes(spark, path, body.encode("latin-1"))
        part = files.read_delimited(spark, path, "id long, name string", **options).select(F.lit(kind).alias("kind"), "id", "name")
        out = part if out is None else out.unionByName(part)
    return out


SHAPES = '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"id":1},"geometry":{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,0]],[[1,0.5],[2,0.5],[2,1],[1,0.5]]]}},{"type":"Feature","properties":{"id":2},"geometry":{"type":"MultiPolygon","coordinates":[[[[9,9],[9.5,9],[9,9.5],[9,9]]],[[[7,7],[8,7],[7,8],[7,7]]]]}},{"type":"Feature","properties":{"id":3},"geometry":{"type":"Point","coordinates":[1,2]}},{"type":"Feature","properties":{"id":4},"geometry":null}]}'


@query("geojson_rings", stated(["id", "part", "ring_no", "corners", "area"], [(1, 0, 0, 4, 8.0), (1, 0, 1, 4, 0.25), (2, 0, 0, 4, 0.125), (2, 1, 0, 4, 0.5)]))
def geojson_rings(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "shapes")
    given(spark, "value string", [(SHAPES,)]).coalesce(1).write.text(path)
    rings = files.read_geojson_polygons(spark, path, "id: long")
    return rings.select("id", F.col("part").cast("long").alias("part"), F.col("ring_no").cast("long").alias("ring_no"), F.size("ring").cast("long").alias("corners"), F.abs(geo.ring_area(F.col("ring"))).alias("area"))


@query("html_rows", stated(["id", "row", "cells"], [(1, 0, "Name|Year"), (1, 1, "Grace & Co|1901"), (2, 0, "only")]))
def html_rows(spark: SparkSession, d: str) -> DataFrame:
    pages = given(spark, "id long, html string", [(1, "<table><tr><th>Name</th><TH>Year</TH></tr><tr><td> Grace <b>&amp;</b>\n Co</td><td>1901</td></tr></table>"), (2, "<tr><td>only</td></tr>"), (3, "none"), (4, None)])
    rows = files.html_tables(pages, "id", "html").select("id", F.col("row").cast("long").alias("row"), F.array_join("cells", "|").alias("cells"))
    return rows.withColumn("cells", F.replace("cells", F.lit("&amp;"), F.lit("&")))


@query("polygon_areas", stated(["id", "area", "inside", "touching"], [(1, 16.0, True, True), (2, 0.5, False, True), (3, 0.0, False, False)]))
def polygon_areas(spark: SparkSession, d: str) -> DataFrame:
    """The point (1, 1) lies in a square, on the slope of a triangle, and in nothing of two corners."""
    rings = [(1, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]), (2, [(0.0, 2.0), (2.0, 0.0), (1.5, 1.0)]), (3, [(0.0, 0.0), (2.0, 2.0)])]
    df = given(spark, "id long, ring array<struct<x: double, y: double>>", rings)
    at = lambda edges: geo.ring_holds(F.col("ring"), F.lit(1.0), F.lit(1.0), edges)
    return df.select("id", F.abs(geo.ring_area(F.col("ring"))).alias("area"), at(False).alias("inside"), at(True).alias("touching"))


CLUSTERED = [(1, 40.0, -87.0), (2, 40.001, -87.0), (3, 40.002, -87.0), (4, 40.003, -87.0), (5, 41.0, -87.0), (6, 41.001, -87.0), (7, 41.002, -87.0), (8, 45.0, -87.0), (9, 40.0045, -87.0), (10, None, None)]


@query("density_clusters", stated(["id", "cluster", "core"], [(1, 2, False), (2, 2, True), (3, 2, True), (4, 2, True), (5, 6, False), (6, 6, True), (7, 6, False), (8, -1, False), (9, 2, False), (10, -1, False)]))
def density_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Core points have three within 0.2 km; border points join the nearest core, even from 0.17 km."""
    points = given(spark, "id long, lat double, lon double", CLUSTERED)
    return spatial.dbscan(points, "id", 0.2, 3, graph.connected_components).select("id", F.col("cluster").cast("long").alias("cluster"), "core")


@query("page_contacts", stated(["id", "emails", "phones", "plain"], [(1, "a@b.org;c.d@e.co.uk", "(312) 555-0199;(800) 555-0100", "Write a@b.org, A@B.org or c.d@e.co.uk"), (2, "", "", "x < y & z"), (3, None, None, None)]))
def page_contacts(spark: SparkSession, d: str) -> DataFrame:
    pages = given(spark, "id long, html string, loose string", [(1, "<p>Write a@b.org, A@B.org</p> or <b>c.d@e.co.uk</b><script>no@no.org</script>", "312-555-0199 or 1 (800) 555-0100, logo@2x.png"), (2, "x &lt; y &amp; z", ""), (3, None, None)])
    plain = text.strip_tags(F.col("html"))
    return pages.select("id", F.array_join(text.emails_in(plain), ";").alias("emails"), F.array_join(text.phones_in(F.col("loose")), ";").alias("phones"), plain.alias("plain"))


@pytest.mark.parametrize("name", sorted(CASES))
def test_case(spark, name):
    case, expected = CASES[name]
    if isinstance(expected, str):
        pytest.skip("its SQL needs no table, and is run as a query")
    df = case(spark, "")
    assert sorted(df.columns) == sorted(expected[0])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(*expected)
