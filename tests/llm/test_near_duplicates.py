"""Near-duplicate classes against all pairs, on groups that hold few links, all links, and links on the border."""

import random

import numpy as np
import pytest

from rollcall.llm import minhash_dedup as M
from rollcall.llm.shingles import WordHashes, prob_minhash, similarities, weighted


def edited(base, edits, r):
    words = list(base)
    for k in r.sample(range(len(words)), edits):
        words[k] = f"x{r.randrange(10**9)}"
    return " ".join(words)


def group(n, edits, seed):
    r = random.Random(seed)
    base = [f"w{r.randrange(5000)}" for _ in range(200)]
    return [edited(base, edits(r), r) for _ in range(n)]


def all_links(texts, threshold=0.8):
    hashes = WordHashes()
    sets = [weighted(t, 5, hashes, "log") for t in texts]
    every = np.unique(np.concatenate([s for s, _ in sets]))
    x = np.zeros((len(sets), len(every)), np.float32)
    for i, (s, _) in enumerate(sets):
        x[i, np.searchsorted(every, s)] = 1
    common, n = x @ x.T, x.sum(1)
    plain = common / (n[:, None] + n[None, :] - common)
    close = np.argwhere(np.triu(plain >= threshold - 0.05, 1))
    return [(i, j) for i, j in close.tolist() if max(similarities(sets[i], sets[j])) >= threshold]


def classes_of(n, links):
    top = list(range(n))

    def find(i):
        while top[i] != i:
            top[i] = i = top[top[i]]
        return i

    for i, j in links:
        a, b = sorted((find(i), find(j)))
        top[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize(
    ("n", "edits"),
    [(800, lambda r: 3), (300, lambda r: r.choice((1, 2, 3, 3, 4)))],
)
def test_groups_of_near_copies(spark, monkeypatch, n, edits):
    """Hardly any linked, and links on the border."""
    texts = group(n, edits, seed=n)
    asked = []
    verified = M._verified

    def counting(pairs, *rest):
        asked.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(M, "_verified", counting)
    got = {r["doc_id"]: r["class_id"] for r in M.near_duplicate_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = classes_of(len(texts), all_links(texts))
    assert [got[i] for i in range(len(texts))] == want
    assert sum(asked) <= 36 * len(texts)  # with the members, not with their square


def test_one_id_with_two_texts_links_to_both(spark):
    r = random.Random(3)
    a, b = ([f"{k}{r.randrange(5000)}" for _ in range(100)] for k in "ab")
    rows = [(5, " ".join(a)), (5, " ".join(b)), (1, edited(a, 1, r)), (2, edited(b, 1, r)), (9, " ".join(b)), (3, "something else entirely")]
    out = M.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in out) == [(1, 1), (2, 1), (3, 3), (5, 1), (5, 1), (9, 1)]


def test_copies_of_one_text_by_thousands(spark, monkeypatch):
    monkeypatch.setattr(M, "HOT_ROWS", 50)
    rows = [(i, "the same few words in every row") for i in range(300)] + [(1000 + i, f"row {i} of its own with words {i * 7}") for i in range(100)]
    out = {r["doc_id"]: r["class_id"] for r in M.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {v for k, v in out.items() if k < 300} == {0} and all(out[1000 + i] == 1000 + i for i in range(100))


def test_signatures_estimate_the_weighted_similarity():
    r, hashes = random.Random(1), WordHashes()
    base = [f"w{r.randrange(40)}" for _ in range(300)]
    pairs = [(weighted(" ".join(base), 1, hashes, "count"), weighted(edited(base, k, r), 1, hashes, "count")) for k in (5, 40, 120)]
    for a, b in pairs:
        signature = prob_minhash([a, b], 4000)
        assert abs((signature[0] == signature[1]).mean() - similarities(a, b)[1]) < 0.04
    one = (np.array([1, 2, 3], np.uint64), np.array([1.0, 2.0, 1.0]))
    two = (np.array([2, 3, 4], np.uint64), np.array([1.0, 1.0, 2.0]))
    plain, _ = similarities(one, two)
    # by hand, sum over common i of 1 / sum_j max(x_j / x_i, y_j / y_i): (1/2 + 2 + ... ) per element
    by_hand = sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in range(4)) for x, y in [([1, 2, 1, 0], [0, 1, 1, 2])] for i in (1, 2))
    assert plain == 0.5 and abs(similarities(one, two)[1] - by_hand) < 1e-12


def test_python_gets_few_texts_at_once(spark, monkeypatch):
    """A batch lies in JVM and worker, with copies: ten thousand texts at once take much of an executor's memory."""
    key, signer = "spark.sql.execution.arrow.maxRecordsPerBatch", M._signer

    def watched(*args):
        sign = signer(*args)

        def held(batches):
            for batch in batches:
                if len(batch) > 1_000:
                    raise ValueError(f"{len(batch)} rows at once")
                yield batch

        return lambda batches: sign(held(batches))

    monkeypatch.setattr(M, "_signer", watched)
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(i, f"a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(1_500)], "doc_id long, text string").coalesce(1)
    assert M.near_duplicate_classes(docs).where("kept").count() == 1_500
    assert spark.conf.get(key) == before
