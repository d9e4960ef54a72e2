"""Decontamination against the longest common subsequence of every item with every text."""

import random

import pytest
from pyspark.sql import functions as F

from rollcall.llm import decontaminate
from rollcall.llm._lcs import common_length

VOCABULARY = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in ("", "ra", "ti", "so", "nen")]


def made(seed=4, items=50, docs=240):
    """(items, documents, planted): a third of the documents hold a paraphrased item: words dropped, swapped and put in."""
    r = random.Random(seed)
    sentence = lambda n: " ".join(r.choices(VOCABULARY, k=n))
    bench = [(k, f"{sentence(r.randint(12, 40))}? {sentence(5)}.") for k in range(items)]
    rows, planted = [], set()
    for d in range(docs):
        text = sentence(r.randint(50, 400))
        if d % 3 == 0:
            k = r.randrange(items)
            words = [w for w in bench[k][1].split() if r.random() > 0.1]
            words = [x for w in words for x in ([w, r.choice(VOCABULARY)] if r.random() < 0.1 else [w])]
            cut = r.randrange(len(text))
            text = f"{text[:cut]} {' '.join(words)} {text[cut:]}"
            planted.add((d, k))
        rows.append((d, text))
    return bench, rows, planted


@pytest.mark.parametrize(("block_items", "max_share"), [(2000, 0.5), (25, 0.5), (2000, 0.02)])
def test_paraphrased_items_are_found(spark, block_items, max_share):
    """max_share 0.02 is what the query runs with."""
    bench, rows, planted = made()
    found = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"), block_items=block_items, max_share=max_share)
    got = {(r["doc_id"], r["item_id"]): r for r in found.collect()}
    # brute force: every item against every stretch of words as long as the operator's
    want = set()
    for k, item in bench:
        words = decontaminate.words_of(item)
        for d, text in rows:
            body = decontaminate.words_of(text)
            n = 3 * len(words)
            if any(common_length(words, body[at : at + 2 * len(words)]) >= 0.7 * len(words) for at in range(0, max(1, len(body) - len(words)), max(1, n // 6))):
                want.add((d, k))
    assert len(want) > 60
    assert len(want & set(got)) >= 0.9 * len(want)
    assert len(planted & set(got)) >= 0.9 * len(planted)
    assert all(r["common"] >= 0.55 for r in got.values())


def test_answers_count_where_half_of_an_item_is_left(spark):
    """With a third of its words gone an item is reported only for its answer, the last sentence.

    The search among passages finds 35 of these 40, as their terms are hardly those of the item; what is found is never wrong.
    """
    r = random.Random(11)
    sentence = lambda n: " ".join(r.choices(VOCABULARY, k=n))
    bench = [(k, f"{sentence(30)}? {sentence(6)}.") for k in range(40)]
    rows, with_answer = [], set()
    for k, item in bench:
        words = item.split()
        rest = [w for i, w in enumerate(words[:30]) if i % 2 == 0 or i % 10 == 1]
        for d, last in ((2 * k, words[30:]), (2 * k + 1, [])):
            rows.append((d, f"{sentence(60)} {' '.join(rest + last)} {sentence(60)}"))
        with_answer.add((2 * k, k))
    found = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    got = {(x["doc_id"], x["item_id"]) for x in found}
    assert len(got & with_answer) >= 35
    assert all(x["common"] >= 0.7 or x["common"] >= 0.55 and x["answer"] >= 0.9 for x in found)
    assert not {(d, k) for d, k in got if d % 2}


def test_repeats_nulls_and_clashing_names(spark):
    item = "the old tower by the sea was built of grey stone in nine years"
    rows = [(None, item, 1, "x"), (1, item, 2, "y"), (1, item, 2, "y"), (2, "nothing of the kind", 3, None), (3, None, 4, None), (4, "", 5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id long, codes string")
    bench = spark.createDataFrame([(7, item, "a"), (7, "another item that nobody has in a text", "b"), (None, None, "c"), (8, "", "d")], "item_id long, text string, id string")
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()) == [("1", 7), ("1", 7), ("None", 7)]
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4]
    assert decontaminate.decontaminate(docs, bench.where(F.lit(False))).count() == len(rows)
    long = spark.createDataFrame([(1, "word " * 200_000 + item), (2, "word " * 200_000)], "doc_id long, text string")
    assert [r["doc_id"] for r in decontaminate.find_leaks(long, bench).collect()] == [1]
