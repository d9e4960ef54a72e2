"""Queries of what pages tell about organisations, and of search results, on sentences put into the given pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import page_facts as P
from ..functions import similarity
from .derived import TITLE_SCORE, TITLE_WORDS
from .registry import query, table
from .shapes import shapes

_SAID = shapes(
    "page_id",
    "<p>Worship 9:00 AM - 10:15 am, 11:30 pm to 11:45 pm and Sunday 9am. Pastor John Smith, Rev. Mary Ann Lee.</p> Attendance: 1{k} at the Choir",
    "We have over {k} people; budget of $12,500 and raised $1,250,000 yearly. Annual report and Form 990. Lead Pastor: Ada Byron Hill",
    "<a href=\"https://www.facebook.com/grace{k}\">f</a> <a href=\"http://youtube.com/{k}\">y</a> servicio en español, 한국어. Southern <b>Baptist</b> vbs",
    "Goal: $5,{k}00.50, goal: $5,123 and 9 members, members of 45. Our budget. Audited financial. Financial transparency. Form 990. church plant",
    "<a href=\"/donate/{k}\">x</a> Reverend Dr. Paul Fox, Vicar - Eve Stone; Weekends at 7 pm. Sundays 10:30 AM. Men of faith, 12 step; PCA",
    None,
)
_CALLED = shapes("page_id", "Grace Baptist Convention {k}", "SBC Hall", "Southern Baptist Hall {k}", None, "Grace", "Old Orthodox {k}")


def _words(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '" + w.replace("'", "''") + "')" for w in words) + ")"


def _labels(text: str, found) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {_words(text, words)} THEN '{label}' END" for label, words in found.items()) + "], lambda x: x IS NOT NULL)"


def _numbers(patterns) -> str:
    parts = ", ".join(f"regexp_extract_all(t, '{p}', 1)" for p in patterns)
    return f"flatten([{parts}])"


_COUNTS = ", ".join(f"CASE WHEN TRY_CAST(regexp_extract(t, '{p}', 1) AS INT) BETWEEN 10 AND 50000 THEN TRY_CAST(regexp_extract(t, '{p}', 1) AS INT) END" for p in P.HEADCOUNTS)
_SIGNS = ", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN '{name}' END" for name, p in P.FINANCES.items())
_FIRST = r"""regexp_extract(h, '(?i)(?:href|src)=["'']https?://(?:www\.)?{0}\.(?:com|org)[^"'']*["'']')"""
_LINK = lambda p: rf"""coalesce(regexp_replace({_FIRST.format(p)}, '^[a-zA-Z]+=["'']|["'']$', '', 'g'), '')"""


@query(
    "page_tells",
    f"""WITH s AS (SELECT page_id AS id, html || ({_SAID}) AS h, {_CALLED} AS name FROM pages),
    r AS (SELECT *, lower(h) AS t, lower(regexp_replace(h, '<[^>]+>', '', 'g')) AS bare FROM s),
    c AS (SELECT *, {_labels("t", P.ACTIVITIES)} AS act, {_labels("t", P.LANGUAGES)} AS lang, {_labels("concat_ws(' ', bare, t)", P.AFFILIATIONS)} AS told, {_labels("lower(name)", P.AFFILIATIONS)} AS named FROM r)
    SELECT id, array_to_string(act, ',') AS activities, array_to_string(lang, ',') AS languages,
      array_to_string(told || list_transform(list_filter(named, lambda x: NOT list_contains(told, x)), lambda x: x || ' (from name)'), ' | ') AS affiliations,
      coalesce({_COUNTS}, 0) AS headcount, coalesce(array_to_string(list_filter([{_SIGNS}], lambda x: x IS NOT NULL)[1:3], ' | '), '') AS signs,
      coalesce(list_max(list_filter(list_transform(list_filter({_numbers(P.AMOUNTS)}, lambda a: NOT contains(a, '.')), lambda a: replace(a, ',', '')::BIGINT), lambda n: n > 1000)), 0) AS amount,
      coalesce({_words("t", P.GIVING)} OR regexp_matches(t, 'href=["''][^"'']*(?:give|donate|giving)[^"'']*["'']'), false) AS giving, coalesce({_words("t", P.NEW_PLANT)}, false) AS planted,
      {_LINK("facebook")} AS facebook, {_LINK("youtube")} AS youtube FROM c""",
)
def page_tells(spark: SparkSession, d: str) -> DataFrame:
    """Activities, languages, affiliations, headcounts, money and profiles of all pages, each with one more sentence."""
    said, name = F.expr(_SAID), F.expr(_CALLED)
    p = table(spark, d, "pages").select(F.col("page_id").alias("id"), F.concat("html", said).alias("h"), name.alias("name"))
    h = F.col("h")
    money, links = F.col("money"), F.col("links")
    return p.withColumns({"money": P.finances(h), "links": P.profiles(h)}).select(
        "id", F.array_join(P.activities(h), ",").alias("activities"), F.array_join(P.languages(h), ",").alias("languages"),
        F.array_join(P.affiliations(h, F.regexp_replace(h, "<[^>]+>", ""), F.col("name")), " | ").alias("affiliations"),
        P.headcount(h).alias("headcount"), F.array_join(money["signs"], " | ").alias("signs"), money["amount"].alias("amount"),
        P.online_giving(h).alias("giving"), P.new_plant(h).alias("planted"), links["facebook"].alias("facebook"), links["youtube"].alias("youtube"),
    )


@query(
    "page_people",
    rf"""WITH s AS (SELECT page_id AS id, html || ({_SAID}) AS h FROM pages),
    n AS (SELECT id, unnest(f) AS who, generate_subscripts(f, 1) AS pos FROM (SELECT id, flatten([{", ".join(f"regexp_extract_all(h, '{p}', 1)" for p in P.CLERGY)}]) AS f FROM s)),
    names AS (SELECT id, list(who ORDER BY pos)[1:5] AS names FROM (SELECT id, who, min(pos) AS pos FROM n GROUP BY ALL) GROUP BY id),
    found AS (SELECT id, regexp_extract_all(replace(h, chr(10), ' '), '{P.SPANS}') AS spans, regexp_extract_all(replace(h, chr(10), ' '), '{P.SUNDAYS}', 1) AS sundays FROM s),
    parts AS (SELECT id, generate_subscripts(spans, 1) AS pos, unnest(spans) AS m FROM found),
    clock AS (SELECT id, pos, array_to_string(regexp_extract_all(m, '\d{{1,2}}:\d{{2}}\s*(?:am|pm|AM|PM)'), ' - ') AS t FROM parts
      UNION ALL SELECT id, 100000 + generate_subscripts(sundays, 1), unnest(sundays) FROM found),
    fit AS (SELECT id, t, min(pos) AS pos FROM clock WHERE length(t) > 3 AND list_bool_or(list_transform(regexp_extract_all(lower(t), '{P.HOURS}', 1), lambda x: x::INT BETWEEN 6 AND 21)) GROUP BY ALL),
    times AS (SELECT id, list(t ORDER BY pos)[1:5] AS times FROM fit GROUP BY id)
    SELECT s.id, coalesce(array_to_string(names, '|'), '') AS clergy, coalesce(array_to_string(times, '|'), '') AS times FROM s LEFT JOIN names USING (id) LEFT JOIN times USING (id)""",
)
def page_people(spark: SparkSession, d: str) -> DataFrame:
    """Names of clergy and times of services of all pages, each with one more sentence."""
    h = F.concat("html", F.expr(_SAID))
    return table(spark, d, "pages").select(F.col("page_id").alias("id"), F.array_join(P.clergy(h), "|").alias("clergy"), F.array_join(P.meeting_times(h), "|").alias("times"))


_TITLE = shapes("c_custkey", "Grace Church {k} Inc.", "zzz", "QQQ", None, "", "zzzz")
_NAME = shapes("c_custkey", "grace {k}", "Grace Chapel of Hope {k}", "Bethel {k}", "Grace Hall {k}", "Zion of old", None)
_URL = shapes("c_custkey", "http://x.org", "HTTPS://GRACEHOPE{k}.org", "http://{k}.com/bethel", "http://gracehall{k}.org", None, "http://z.org")


@query(
    "result_scores",
    f"""WITH r AS (SELECT c_custkey AS id, {_TITLE} AS title, {_NAME} AS name, {_URL} AS url FROM customer), s AS ({TITLE_WORDS}), t AS (SELECT *, ({TITLE_SCORE})::DOUBLE AS ts, regexp_extract_all(lower(coalesce(name, '')), '[a-z]+') AS p FROM s)
    SELECT id, CASE WHEN ts > 0.5 THEN ts ELSE round(greatest(ts, 0.6 * len(list_filter(p, lambda w: length(w) > 3 AND contains(lower(coalesce(url, '')), w))) / greatest(len(p), 1)), 2) END AS score FROM t""",
)
def result_scores(spark: SparkSession, d: str) -> DataFrame:
    """Search results by their titles, else by the pieces of the name in their URLs."""
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("id"), similarity.result_score(F.expr(_NAME), F.expr(_URL), F.expr(_TITLE)).alias("score"))
