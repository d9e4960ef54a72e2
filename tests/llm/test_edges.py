"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from rollcall.llm import decontaminate, embedding_dedup, html_text, language_id, lm_score, minhash_dedup, mixture, suffix_dedup, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, id long, rejected boolean"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
ROWS = [
    (1, "the cat sat on the mat and looked at the dog for a while", "en", "src1", 56, None, 9, None),
    (1, "the cat sat on the mat and looked at the dog for a while", "en", "src1", 56, "x", 9, True),
    (2, "der hund und die katze sind im garten und spielen mit dem ball", "de", "src2", None, None, None, None),
    (3, None, None, None, None, None, None, None),
    (4, "", "en", "src1", 0, None, None, None),
    (None, "a row without an id that has words", "en", None, 34, None, None, None),
    (5, LONG, "en", "src1", len(LONG), None, None, None),
    (6, "the cat sat on the mat and looked at the dog for a while", "en", "src3", 56, None, None, None),
]
TABLES = ["rows", "empty"]


@pytest.fixture(scope="module")
def tables(spark):
    return {"rows": spark.createDataFrame(ROWS, SCHEMA), "empty": spark.createDataFrame([], SCHEMA)}


@pytest.fixture(scope="module")
def bench(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(1, "what is the height of the old tower by the sea ? it is ninety metres high"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.mark.parametrize("name", TABLES)
def test_row_operators_keep_every_row(tables, name):
    docs = tables[name]
    n = docs.count()
    known = language_id.fit_dictionaries(docs)
    assert language_id.identify_language(docs, known).count() == n
    labels = docs.sparkSession.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert toxicity.score_toxicity(docs, model).where("score BETWEEN 0 AND 1").count() == n
    counts = {(r["doc_id"], r["n_bytes"]) for r in token_counts.count_tokens(docs).collect()}
    assert counts == ({(1, 56), (2, 62), (3, 0), (4, 0), (None, 34), (5, len(LONG)), (6, 56)} if n else set())


@pytest.mark.parametrize("name", TABLES)
def test_language_model_scores_every_row(tables, name):
    docs = tables[name]
    out = lm_score.score_texts(docs, F.col("doc_id") != 2).collect()
    assert len(out) == docs.count()
    assert all(r["score"] < 0 and r["n_tokens"] >= 1 for r in out)


@pytest.mark.parametrize("name", TABLES)
def test_duplicate_operators(tables, name):
    docs = tables[name]
    classes = {(r["doc_id"], r["class_id"]) for r in minhash_dedup.near_duplicate_classes(docs).collect()}
    assert classes == ({(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 1)} if name == "rows" else set())
    left = [r["doc_id"] for r in minhash_dedup.drop_near_duplicates(docs).collect()]
    assert sorted(left, key=str) == (sorted([1, 2, 3, 4, 5, None], key=str) if name == "rows" else [])
    cut = {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert cut == ({(1, 56, 0), (2, 62, 0), (3, 0, 0), (4, 0, 0), (None, 34, 0), (5, len(LONG), 0), (6, 56, 56)} if name == "rows" else set())
    whole = suffix_dedup.without_repeats(docs)
    assert whole.columns == docs.columns
    kept = {r["doc_id"]: r for r in whole.collect()}
    if name == "rows":
        assert kept[6]["text"] == "" and kept[6]["n_chars"] == 0 and kept[3]["text"] is None and kept[5]["text"] == LONG


def test_vectors_that_link_with_nothing(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, []), (8, [-1.0, 0.0]), (None, [1.0, 0.0]), (9, [2.0, 0.0])]
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.link_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert out == {1: (2, 1), 2: (2, 1), 9: (2, 1), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8), None: (0, None)}
    assert embedding_dedup.link_embeddings(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_vectors_of_two_lengths_and_clashing_names(spark):
    """Each length has its own links and components; ties, repeats and long chains; other columns are not read."""
    rng = np.random.default_rng(3)
    rows, unit = [], lambda v: (np.array(v) / np.linalg.norm(v)).tolist()
    for d, first in ((6, 0), (10, 1000)):
        for g in range(12):
            base = rng.standard_normal(d)
            rows += [(first + g * 10 + k, unit(base + 0.08 * k * rng.standard_normal(d)), g, "x") for k in range(5)]
    rows += [(5000, rows[0][1], 1, "copy"), (5001, rows[0][1], 1, "copy"), (5002, [1.0] * 2000, 0, "long"), (5003, [2.0] * 2000, 0, "long")]
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.link_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long, key string")).collect()}
    links = {i: set() for i, *_ in rows}
    for i, x, *_ in rows:
        for j, y, *_ in rows:
            if i != j and len(x) == len(y) and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                links[i].add(j)
    least = {}
    for i in sorted(links):
        if i not in least:
            open_ids = [i]
            while open_ids:
                k = open_ids.pop()
                if k not in least:
                    least[k] = i
                    open_ids += links[k]
    assert out == {i: (len(links[i]), least[i], least[i] == i) for i in links}


def test_pages(spark):
    rows = [(1, "http://a.org/x", "<html><body><nav>menu</nav><article><p>One &amp; two</p><p>three</p></article></body></html>"), (2, None, None), (None, "http://a.org/y", ""), (3, "no host", "<p>alone   here</p>"), (3, "no host", "<p>alone   here</p>")]
    out = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert out == [("1", "One & two three", 15), ("2", "", 0), ("3", "alone here", 10), ("3", "alone here", 10), ("None", "", 0)]
    assert html_text.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_neighbours_decide_inside_the_article(spark):
    """Unnamed furniture that the neighbours have goes, wherever it lies; a passage quoted by one neighbour and a second version stay."""
    page = lambda *lines: "<html><body><article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article></body></html>"
    cookie, letter, quote = "We use cookies here", "Get our letter", "To be or not to be"
    rows = [(k, f"http://a.org/{k}", page(cookie, f"first words of page {k} about a thing of its own", letter, *([quote] if k in (2, 3) else []), f"last words of {k}", *(["Part one"] if k < 3 else []))) for k in (1, 2, 3, 4)]
    rows += [(k, f"http://b.org/{k}", page("one and the same", "text")) for k in (5, 6)]
    found = {r["page_id"]: r["text"] for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    quoted = {k: f"first words of page {k} about a thing of its own {quote} last words of {k}" if k in (2, 3) else f"first words of page {k} about a thing of its own last words of {k}" for k in (1, 2, 3, 4)}
    assert found == quoted | {5: "one and the same text", 6: "one and the same text"}


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<body><article class="post comments-open"><p>all of it</p></article></body>', "all of it"),
        ('<body><div class="content has-sidebar"><article><p>all of it</p></article><div class="sidebar">links</div></div></body>', "all of it"),
        ('<div id="page-with-header"><div class="site-footer">us</div><p>a page of old kind without any article</p></div>', "a page of old kind without any article"),
        ('<article><div class="entry-header"><h1>Title</h1></div><p class="form">a form of words</p><div class="ad">buy</div></article>', "Title a form of words"),
        ("<article><p>first story</p></article><article><p>second</p></article>", "first story second"),
        ('<div class="related"><article>a teaser that is longer</article></div><article>story</article>', "story"),
        ('<form id="all"><article>story</article></form><form><p>your name</p></form>', "story"),
        ('<div class="sidebar"><p>links</p></div><div class="main-text"><p>story</p></div>', "story"),
        ("<div class='promo'><main><p>story</p></main></div>", "story"),
    ],
)
def test_names_never_drop_an_article(html, text):
    lines, inside = html_text.parse(html)
    assert " ".join(x for x, k in zip(lines, html_text.kept_lines(lines, inside, [0] * len(lines), 0), strict=True) if k) == text


def test_neighbours_decide_about_parts_of_names():
    lines, inside = html_text.parse('<article><p>a story of some length</p><div class="share-box">send it</div><div class="form-of-words">kept</div><p>the end of it</p></article>')
    assert html_text.kept_lines(lines, inside, [0, 1, 0, 0], 3) == [True, False, True, True]


@pytest.mark.parametrize("name", TABLES)
def test_mixture(tables, name):
    out = mixture.mix_sources(tables[name], mixture.MixturePlan(budget_share=1.0, max_epochs=1)).collect()
    assert sum(r["taken_tokens"] for r in out) == (sum(len((r[1] or "").split()) for r in ROWS) if name == "rows" else 0)


@pytest.mark.parametrize("name", TABLES)
def test_stages_return_the_columns_of_documents(spark, tables, bench, name):
    docs = tables[name]
    for _, stage in P.STAGES[:-1]:
        docs = P.materialize(stage(spark, docs, bench), "test-stage")
        assert docs.columns == tables[name].columns
    taken = P.STAGES[-1][1](spark, docs, bench).collect()
    assert {r["doc_id"] for r in taken} <= {r[0] for r in ROWS} and bool(taken) == (name == "rows")


def test_leaks_are_found_and_dropped(spark, bench):
    item = "what is the height of the old tower by the sea ? it is ninety metres high"
    docs = spark.createDataFrame([(1, "before " * 40 + item + " after" * 40), (2, "clean words about another thing entirely " * 20), (3, None), (4, "")], "doc_id long, text string")
    b = spark.read.parquet(f"{bench}/benchmark.parquet")
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, b).collect()] == [(1, 1)]
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(docs, b).collect()) == [2, 3, 4]
    assert decontaminate.find_leaks(docs, b.limit(0)).count() == 0
