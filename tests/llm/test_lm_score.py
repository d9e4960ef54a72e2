"""The language model: exact base figures are in test_brute_force; here that the code is complete, learns, and beats the base."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import lm_score as L
from tests.compare import DATA


def model_of(words, counts):
    n = np.array([*counts, 40], np.int64)
    masses = np.zeros(L.SIZES)
    np.add.at(masses, L.size_of(n), n.astype(float))
    return L.CodeModel(1024, masses, 16.0), n, np.array([zlib.crc32(w) for w in [*words, L.END]], np.uint32)


@pytest.mark.parametrize("prefix", [[], [0], [3, 3, 1, 0], [5, 4, 3, 2, 1, 0, 0, 0]])
def test_what_may_follow_adds_up_to_one(prefix):
    """Over all known words, the end, and the way to an unknown word, whatever the text was and whatever was learned."""
    words = [b"a", b"bb", b"cc", b"ddd", b"eee", b"fff", b"zzz"]
    counts = [900, 40, 37, 5, 5, 4, 0]
    model, n, hashes = model_of(words, counts)
    free = np.zeros(len(n))  # an unknown word at no cost stands for all unknown words
    texts = [np.array(t, np.int64) for t in ([0, 1, 0, 3], [6, 0, 0, 2], [1, 2, 0, 4, 5, 0])]
    for _ in range(3):
        learned = L.Reading(texts, n, hashes, free, model)
        learned.bits(learned.inputs(model.stretched()), model.mixer, adapt=False)
        learned.learn(model)
    total = 0.0
    for follow in range(len(words) + 1):
        text = [*prefix, follow] if follow < len(words) else prefix
        r = L.Reading([np.array(text, np.int64)], n, hashes, free, model)
        cost = L._mixed_in_blocks(r.inputs(model.stretched()), r.node, r.bit, r.of_doc, 1, r.block, L.Mixer(model.mixer.weights.copy(), model.mixer.hits.copy()))
        at = len(prefix)
        total += 2.0 ** (cost[r.token == at].sum() + r.chosen[at])
    assert math.isclose(total, 1.0, rel_tol=1e-5)


def test_spelling_adds_up_to_one():
    """Over the first byte of a word."""
    model = L.SpellingModel()
    model.read([b"hello", b"help", b"yes"] * 20, learn=True)
    total = 0.0
    for b in range(256):
        s = L.Spelling([bytes([b])])
        still = L.Mixer(model.mixer.weights.copy(), model.mixer.hits.copy())
        p = 0.0
        for gate, bit, slots in s.events():
            x = np.array([[math.log((t[k[0], 1] + 0.3) / (t[k[0], 0] + 0.3))] for t, k in zip(model.counts, slots, strict=True)] + [[0.3]], np.float32)
            p += L._mixed_in_blocks(x, gate[:1], bit[:1], None, 0, np.zeros(1, np.int8), L.Mixer(still.weights.copy(), still.hits.copy()))[0]
        total += 2.0**p
    assert math.isclose(total, 1.0, rel_tol=1e-5)


def test_training_works_out_no_probabilities(monkeypatch):
    """What it learns is the same; the refined probabilities and their logarithms took a third of its time."""
    words = [f"w{i}".encode() for i in range(64)]
    rng = random.Random(3)
    texts = [np.array([rng.randrange(64) for _ in range(300)], np.int64) for _ in range(20)]
    learned = []
    for teach in (False, True):
        model, n, hashes = model_of(words, [1 + i * 3 for i in range(64)])
        for some in (texts[:10], texts[10:]):
            r = L.Reading(some, n, hashes, None if teach else np.zeros(len(n)), model)
            x = r.inputs(model.counts)
            if teach:
                with monkeypatch.context() as m:
                    m.setattr(np, "log2", None)
                    r.teach(x, model.mixer)
            else:
                r.bits(x, model.mixer, adapt=False)
            r.learn(model)
        learned.append(model)
    one, two = learned
    assert (one.mixer.weights == two.mixer.weights).all() and (one.mixer.hits == two.mixer.hits).all()
    assert all((a == b).all() for a, b in zip(one.counts, two.counts, strict=True))


def test_a_text_teaches_its_own_weights():
    words = [f"w{i}".encode() for i in range(64)]
    model, n, hashes = model_of(words, [1 + i * 3 for i in range(64)])
    rng = random.Random(1)
    text = np.array([rng.choice((1, 60)) for _ in range(900)], np.int64)
    read = lambda adapt: float(
        (r := L.Reading([text], n, hashes, np.zeros(len(n)), model)).bits(r.inputs(model.stretched()), L.Mixer(model.mixer.weights.copy(), model.mixer.hits.copy()), adapt)[0]
    )
    assert read(True) > L.Reading([text], n, hashes, np.zeros(len(n)), model).chosen.sum() - 900 * 1.6


def test_held_out_texts_beat_the_base(spark):
    """Sentences from a small grammar: what may follow depends on the word before, which the base can't know."""
    rng = random.Random(5)
    nouns, verbs, tail = [f"n{i}" for i in range(40)], [f"v{i}" for i in range(400)], [f"t{i}" for i in range(3000)]
    line = lambda: " ".join(x for _ in range(30) for x in ("the", rng.choice(nouns), rng.choice(verbs), "of", rng.choice(tail)))
    docs = spark.createDataFrame([(i, line()) for i in range(600)], "doc_id long, text string").repartition(4)
    rows = L.score_texts(docs, F.col("doc_id") % 10 != 0).where("NOT training").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
    assert all(r["score"] < 0 for r in rows)


def test_small_table_scores_lie_near_the_base(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    rows = L.score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0).collect()
    for part in (True, False):
        held = [r for r in rows if r["training"] == part]
        score, base = (sum(r[k] for r in held) for k in ("score", "base_score"))
        assert score > (1.25 if part is False else 1.1) * base, (part, score, base)


@pytest.mark.parametrize("training", [True, False])
def test_edges(spark, training):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = [(1, "a b a", 1), (1, "A B a", 1), (None, "a", 2), (2, None, 3), (3, "", 4), (4, long, 5), (5, "é ü  x", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    out = L.score_texts(docs, F.lit(training)).collect()
    assert sorted(r["n_tokens"] for r in out) == [1, 1, 2, 4, 4, 4, 200_001]
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in out)
    same = [r["score"] for r in out if r["doc_id"] == 1]
    assert len(same) == 2 and math.isclose(*same, rel_tol=1e-6)
    assert L.score_texts(docs.limit(0), F.lit(training)).count() == 0
