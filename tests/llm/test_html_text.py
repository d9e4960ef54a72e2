"""Main text by differencing neighbours, against an alignment by brute force and on sites without any telling tag."""

import random
import time

import pytest

from rollcall.llm import html_text
from rollcall.llm._lcs import common_length, common_places


def texts_of(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
    return {r["page_id"]: r["text"] for r in html_text.extract_main_text(df).collect()}


def test_a_site_without_articles_loses_what_its_pages_share(spark):
    menu, foot = "".join(f"<div><p>menu entry {k}</p></div>" for k in range(6)), "<div>all rights with us</div>"
    rows = [(k, f"http://a.org/{k:03d}", f"<body>{menu}<div><p>story {k} begins</p><p>and story {k} ends</p></div>{foot}</body>") for k in range(40)]
    assert texts_of(spark, rows) == {k: f"story {k} begins and story {k} ends" for k in range(40)}


def test_repeated_rows_keep_their_text(spark):
    page = "<body><p>one page</p><p>of one text</p></body>"
    rows = [(k, "http://a.org/same", page) for k in range(4)] + [(9, "http://b.org/x", page)]
    assert set(texts_of(spark, rows).values()) == {"one page of one text"}


def test_neighbours_are_found_across_partitions(spark):
    """Every page of many is aligned with both its neighbours, wherever the borders of partitions fall."""
    rows = [(k, f"http://h{k // 50}.org/p{k % 50:02d}", f"<body><p>top {k // 50}</p><p>own {k}</p><p>pair {k // 2}</p></body>") for k in range(200)]
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        got = texts_of(spark, rows, 13)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == {k: f"own {k}" for k in range(200)}


def longest(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def test_alignments_are_longest_common_subsequences():
    r = random.Random(7)
    for n in range(60):
        a, b = ([r.randrange(5) for _ in range(r.randint(0, 40))] for _ in range(2))
        places = common_places(a, b)
        picked = [a[i] for i in places]
        assert places == sorted(set(places)) and len(places) == longest(a, b) == common_length(a, b)
        rest = iter(b)
        assert all(x in rest for x in picked)  # in order in b as well


def test_edges(spark):
    long = "<body>" + "".join(f"<p>line {k}</p>" for k in range(50_000)) + "</body>"
    df = spark.createDataFrame([(1, "http://a.org/1", long, "x", 1), (None, None, None, "y", 2), (2, "http://a.org/1", "", None, 3)], "page_id long, url string, html string, text string, rid long")
    out = {r["page_id"]: r["n_chars"] for r in html_text.extract_main_text(df).collect()}
    assert out == {1: len(" ".join(f"line {k}" for k in range(50_000))), None: 0, 2: 0}


def text_of(page):
    lines, inside = html_text.parse(page)
    return " ".join(x for x, k in zip(lines, html_text.kept_lines(lines, inside, [0] * len(lines), 0), strict=True) if k)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<p>one</p><a href="x>two</a><p>three</p>', "one two three"),
        ("<p>a < b and c > d</p>", "a < b and c > d"),
        ('<p title="a > b">one</p><p title=\'<p>\'>two</p>', "one two"),
        ("<p>one</p><p two", "one <p two"),
        ("<p>one<!-- two </p><p>three", "one"),
        ("<p>one<!-- two --></p><!DOCTYPE x><?php y ?><p>three<![CDATA[ four ]]></p>", "one three"),
        ("<script>if (a < b) { '</p>' }</script  ><p>one</p><style>p > a {}", "one"),
        ('<a \'"><p>one</p><b "x\'>two</b>', "two"),
        ("<div></div></div></p></x><p>one</p></html><p>two", "one two"),
        ("<><p>one</p></><p>two</p><3", "<> one </> two <3"),
    ],
)
def test_broken_markup(html, text):
    assert text_of(html) == text


@pytest.mark.parametrize("unit", ['<a "', "<a '\">", "<!", "<?x", '<a "x>" <b', "</div", "<script", "<a href='\"", "<div>", '<p class="', "<a '<b \">\" '>", "<!-- ", '<b"><i\'>', "<p", "<div></x>"])
def test_broken_pages_take_time_in_proportion(unit):
    """A third of a megabyte of the worst pieces, on which patterns that go back and forth take hours."""
    start = time.process_time()
    html_text.parse(unit * (300_000 // len(unit)) + "'")
    assert time.process_time() - start < 20
