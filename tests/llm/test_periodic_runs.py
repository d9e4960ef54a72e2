"""Runs against a search at every place and period, and the query against the contract's wording."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as entry
from rollcall.llm import periodic_runs
from tests.compare import DATA, views


def brute_runs(words, min_length=24, min_periods=3):
    """(start, length, period): every stretch of equal neighbours a period apart, with the smallest period that gives it."""
    found = {}
    for q in range(1, len(words) // min_periods + 1):
        start = None
        for i in range(len(words) - q + 1):
            same = i + q < len(words) and words[i] == words[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                found.setdefault((start, i + q - start), q)
                start = None
    return sorted(((s, n, q) for (s, n), q in found.items() if n >= max(min_length, min_periods * q)), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def random_texts():
    rng = np.random.default_rng(5)
    out = []
    for k in range(150):
        letters = rng.choice(["a", "b", "cc", "ä"], size=rng.integers(0, 120), p=None if k % 2 else [0.85, 0.13, 0.01, 0.01])
        words = list(letters)
        for _ in range(rng.integers(0, 4)):
            unit = list(rng.choice(["a", "b", "x", "yy", "z"], size=rng.integers(1, 15)))
            at = rng.integers(0, len(words) + 1)
            words[at:at] = (unit * 12)[: rng.integers(20, 90)]
        out.append(words)
    return out


def test_runs_are_those_of_every_place_and_period(spark):
    texts = random_texts()
    docs = spark.createDataFrame([(i, "\t ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic_runs.find_runs(docs, carry=("doc_id",)).collect()}
    assert sum(bool(r["runs"]) for r in got.values()) > 50
    for i, words in enumerate(texts):
        runs = brute_runs(words)
        assert [tuple(r) for r in got[i]["runs"]] == runs, i
        assert got[i]["collapsed"].encode() == collapsed([w.encode() for w in words], runs) and got[i]["n_words"] == len(words)


def test_runs_of_numbers():
    """The array itself, with short runs too, as the theorem gives them; texts one after the other in one array."""
    rng = np.random.default_rng(9)
    for _ in range(200):
        text = np.r_[rng.integers(0, rng.integers(1, 4), size=rng.integers(1, 60)), 99]
        want = [(s, s + n, q) for s, n, q in brute_runs(text.tolist(), 1, 2)]
        assert sorted(map(tuple, periodic_runs.periodic_runs(text, 1, 2).tolist())) == sorted(want)


def test_very_long_and_odd_texts(spark):
    unit = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, unit + " " + unit + " " + unit + " end"), (2, "a\x0b" * 50_000), (3, None), (4, ""), (5, " \t\n "), (5, " \t\n "), (None, "x " * 30), (6, "é é " * 24 + "tail")]
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], "doc_id long, text string, runs string, n_words int")
    got = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], len(r["collapsed"])) for r in periodic_runs.find_runs(docs, carry=("doc_id",)).collect()))
    assert got == [(0, 30, [(0, 30, 1)], 1), (1, 120_001, [(0, 120_000, 40_000)], len(unit) + 4), (2, 50_000, [(0, 50_000, 1)], 1), (3, 0, [], 0), (4, 0, [], 0), (5, 0, [], 0), (5, 0, [], 0), (6, 25, [(0, 24, 1)], 8)]
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="not searched"):
        periodic_runs.find_runs(docs, min_length=10)


def test_query_follows_the_contract(spark):
    docs = views(f"{DATA}/sf0.001").execute("SELECT doc_id, text FROM documents").fetchall()
    got = {r["doc_id"]: r.asDict() for r in entry.queries()["op11_periodic_runs"](spark, f"{DATA}/sf0.001").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert len(got) == len(docs)
    planted = 0
    for i, text in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        h, n = zlib.crc32(str(i).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(words)
        planted += bool(runs)
        s, m, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        want = dict(doc_id=i, n_runs=len(runs), start=s, length=m, period=q, exponent_milli=1000 * m // q if runs else None)
        want |= dict(runs_sha256=sha("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()), collapsed_sha256=sha(collapsed(words, runs)))
        assert got[i] == want, i
    assert planted > 5
