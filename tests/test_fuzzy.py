"""Similarity joins against all pairs: names without a shared word, short ones, several thresholds, crowded items."""

import random
from difflib import SequenceMatcher

import pytest

from rollcall.operators import fuzzy, linkage, matching


def names(rng, n):
    """Random names and edited copies of them, of all lengths, in few cities."""
    out = []
    for i in range(n):
        if out and rng.random() < 0.6:
            base = list(rng.choice(out)[1])
            for _ in range(rng.randint(1, 1 + len(base) // 4)):
                at = rng.randrange(len(base) + 1)
                base[at : at + rng.randint(0, 2)] = rng.choice(["", "x", "ab", " ", "é"])
            name = "".join(base)
        else:
            name = "".join(rng.choice("abcde fg") for _ in range(rng.choice([1, 2, 3, 5, 8, 12, 20, 33])))
        out.append((i, name.strip() or "z", rng.choice(["gary", "ohio"])))
    return out


@pytest.mark.parametrize("least", [0.6, 0.75, 0.9])
def test_ratio_pairs_are_those_of_all_pairs(spark, monkeypatch, least):
    monkeypatch.setattr(fuzzy, "CROWD", 7)
    monkeypatch.setattr(fuzzy, "MOST_ITEMS", 0 if least == 0.9 else 200_000)
    rng = random.Random(int(least * 100))
    left, right = {(n, c) for _, n, c in names(rng, 160)}, {(n, c) for _, n, c in names(rng, 160)} | {("ab", "gary"), ("ba", "gary")}
    right |= {x for x in left if rng.random() < 0.2}
    want = {(c, a, b) for a, c in left for b, d in right if c == d and SequenceMatcher(None, a, b).ratio() >= least}
    df = lambda rows: spark.createDataFrame([*rows, ("", "gary"), (None, "gary"), ("abc", None)], "t string, city string")
    got = [(r["city"], r["a"], r["b"]) for r in fuzzy.ratio_pairs(df(left), df(right), ["city"], "t", least).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_exact_then_alike_finds_the_best_of_all(spark):
    rng = random.Random(8)
    left, right = names(rng, 120), [(1000 + i, n, c) for i, n, c in names(rng, 120)]
    right += [(2000 + i, n, c) for i, n, c in left if i % 6 == 0]
    want = {}
    for i, a, c in left:
        best = min((( -1.0 if a == b else -SequenceMatcher(None, a, b).ratio()), j) for j, b, d in right if c == d)
        if -best[0] >= 0.75:
            want[i] = (best[1], -best[0])
    schema = "{} long, name string, city string"
    l, r = spark.createDataFrame([*left, (5000, None, "gary"), (5001, "abc", None)], schema.format("id")), spark.createDataFrame([*right, (5002, None, "gary")], schema.format("partner"))
    got = {x["id"]: (x["partner"], x["score"]) for x in matching.exact_then_alike(l, r, "id", "partner", "name", "city").collect()}
    assert got == want and len(want) > 30


def test_jaccard_pairs_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "CROWD", 5)
    rng = random.Random(2)
    word = lambda: rng.choice(["first"] * 6 + ["church"] * 4 + [f"w{k}" for k in range(25)])
    row = lambda i: (i, sorted({word() for _ in range(rng.randint(1, 6))}), rng.choice(["IN", "OH"]))
    left, right = [row(i) for i in range(150)], [row(i) for i in range(150)]
    df = lambda rows: spark.createDataFrame(rows, "id long, w array<string>, k string")
    from pyspark.sql import functions as F

    for least, shared in ((0.5, 1), (0.34, 2), (1.0, 1)):
        score = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
        good = [(i, j, score(a, b)) for i, a, c in left for j, b, d in right if c == d and score(a, b) >= least and len(set(a) & set(b)) >= shared]  # noqa: B023
        got = {(r["l"]["id"], r["r"]["id"], round(r["score"], 9)) for r in fuzzy.jaccard_pairs(df(left), df(right), ["k"], "w", least, shared).collect()}
        assert got == {(i, j, round(s, 9)) for i, j, s in good}
        best = {i: min(((-s, j) for a, j, s in good if a == i)) for i in {x[0] for x in good}}
        found = linkage.best_in_block(df(left), df(right).withColumnRenamed("id", "b"), "id", "b", (F.col("k"), F.col("k")), (F.col("w"), F.col("w")), least, shared)
        assert {r["id"]: (-r["score"], r["b"]) for r in found.collect()} == best


def test_few_pairs_reach_the_ratio(spark, monkeypatch):
    """Random digests share letters and pairs of letters, but are too many edits apart."""
    from hashlib import md5

    from pyspark.sql import functions as F

    text = lambda k: md5(str(k).encode()).hexdigest()
    df = lambda rows: spark.createDataFrame(rows, "t string, city string")
    left, right = df([(text(k), "gary") for k in range(60)]), df([(text(k), "gary") for k in range(1000, 1060)] + [(text(7) + "~", "gary")])
    monkeypatch.setattr(fuzzy, "sequence_ratio", lambda a, b: F.lit(1.0))
    assert [(r["a"], r["b"]) for r in fuzzy.ratio_pairs(left, right, ["city"], "t", 0.75).collect()] == [(text(7), text(7) + "~")]
