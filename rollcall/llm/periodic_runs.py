"""Runs of repeated words in whole texts, by the runs theorem.

A run is a maximal periodic stretch. By the runs theorem each one holds the longest Lyndon word of one of its places, under
the order of words or the reverse order, as its root; so two candidates a place are enough. With one suffix array the
longest Lyndon word from a place ends before the next smaller value of the inverse suffix array, and under the reverse
order before the next larger one, as the text ends with a word of its own. A root is then extended to both sides
by longest common extensions: a range minimum over the common prefixes of neighbouring suffixes, of the text and of the
text read backwards.

Only stretches covered by strings of GRAM words that occur twice in their text enter the suffix array: in a run of at
least 3 * GRAM words and three periods every such string occurs again a period away, so that no run reaches beyond its
stretch, and none is lost. Equal hashes only let too much through; words are compared as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 8
#: Words of the stretches of several texts that share one suffix array; a longer text has its own.
BLOCK_WORDS = 1 << 17
OUT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def find_runs(docs: DataFrame, *, text_col: str = "text", min_length: int = 24, min_periods: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """(*carry, n_words, runs, collapsed) for every row of docs; columns that are not named are not read, runs may be named alike.

    Words are what ASCII white space parts. runs: start (word number from 0), length and period of every maximal stretch
    of a smallest period that is at least max(min_length, min_periods * period) words long, by start, then period;
    empty if there is none. collapsed: the words outside of runs and in the first period of a run that no other run drops,
    joined by one space. Null and empty texts have no words, no runs and an empty collapsed text. A text is handled in one
    task, with some 200 bytes for each of its words; repeated rows and ids are rows like any other.
    """
    if min_periods < 3 or min_length < 3 * GRAM:
        raise ValueError(f"runs shorter than {3 * GRAM} words or three periods are not searched")
    source = docs.select(F.struct(*carry).alias("carried") if carry else F.lit(None).alias("carried"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["carried"].dataType.simpleString() if carry else "string"
    if not carry:
        source = source.withColumn("carried", F.lit(None).cast("string"))
    done = source.mapInArrow(_finder(min_length, min_periods), f"carried {kind}, {OUT}")
    return done.select(*(F.col("carried")[c].alias(c) for c in carry), "n_words", "runs", "collapsed")


def repeat_tail(text: Column, h: Column) -> Column:
    """text, whose words from number a on repeat those from a to a + p if h % 10 = 0, with a and p drawn from h.

    a = g % n and p = 1 + floor((n - a) / (3 + g % 8)) for g = floor(h / 10) and n words. Null h and texts without words stay.
    """
    g = F.floor(h / 10)

    def again(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.concat(F.slice(words, F.lit(1), a), F.transform(F.slice(words, a + 1, n - a), lambda _, i: F.get(words, a + i % p)))

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    one = F.filter(F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, F.array_join(again(ws), " "))), lambda t: t.isNotNull())  # words are split once
    return F.when(h % 10 == 0, F.coalesce(F.get(one, F.lit(0)), text)).otherwise(text)


def runs_digest() -> list[Column]:
    """n_runs, the run with the greatest length / period (ties: smallest start, then period), and digests of runs and collapsed text.

    The quotients are compared as doubles, which tells all of them apart for texts under 2^26 words.
    """
    best = F.array_max(F.transform("runs", lambda r: F.struct((r["length"] / r["period"]).alias("q"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["length"].alias("n"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return [
        F.size("runs").cast("long").alias("n_runs"), (-best["s"]).alias("start"), best["n"].alias("length"), (-best["p"]).alias("period"),
        F.floor(1000 * best["n"] / -best["p"]).cast("long").alias("exponent_milli"),
        sha(lines).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"),
    ]


def _finder(min_length: int, min_periods: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(b or b"").split() for b in batch.column("text").cast(pa.binary()).to_pylist()]  # bytes part at ASCII white space only
            runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            block, held = [], 0
            for k, words in enumerate(texts):
                for start, end in _stretches(words, min_length):
                    block.append((k, start, end))
                    held += end - start
                if held >= BLOCK_WORDS:
                    _search(texts, block, runs, min_length, min_periods)
                    block, held = [], 0
            _search(texts, block, runs, min_length, min_periods)
            kept = [_collapse(words, r) for words, r in zip(texts, runs, strict=True)]
            shape = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
            tuples = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs]
            columns = [batch.column("carried"), pa.array([len(w) for w in texts], pa.int64()), pa.array(tuples, shape), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["carried", "n_words", "runs", "collapsed"])

    return run


def _stretches(words: list[bytes], min_length: int) -> list[tuple[int, int]]:
    """Maximal stretches of min_length words at least that are covered by strings of GRAM words that occur twice in words."""
    n = len(words)
    if n < min_length:
        return []
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    for step in (1, 2, 4):  # hashes of 2, 4, then 8 words
        h = h[:-step] * np.uint64(0x9E3779B97F4A7C15) + (h[step:] ^ (h[step:] >> np.uint64(29)))
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return []
    change = np.zeros(n + 1, np.int64)
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    np.add.at(change, at, 1)
    np.add.at(change, at + GRAM, -1)
    edges = np.flatnonzero(np.diff(np.r_[0, (np.cumsum(change[:n]) > 0).astype(np.int8), 0]))
    # stretches that touch without a string across are one here, which joins but never cuts a run
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a >= min_length]


def _search(texts: list[list[bytes]], block: list[tuple[int, int, int]], runs: list[list[tuple[int, int, int]]], min_length: int, min_periods: int) -> None:
    """Appends the runs of the block's stretches to those of their texts."""
    if not block:
        return
    number: dict[bytes, int] = {}
    codes, starts, at = [], [], 0
    for k, a, b in block:
        starts.append(at)
        codes.append(np.fromiter((number.setdefault(w, len(number)) for w in texts[k][a:b]), np.int64, b - a))
        at += b - a + 1
    walls = len(number) + np.arange(len(block))  # a word of its own after each stretch: no run crosses it
    text = np.concatenate([np.append(c, wall) for c, wall in zip(codes, walls, strict=True)])
    found = periodic_runs(text, min_length, min_periods)
    owner = np.searchsorted(np.array(starts), found[:, 0], "right") - 1
    for (start, end, period), j in zip(found.tolist(), owner.tolist(), strict=True):
        k, a, _ = block[j]
        runs[k].append((start - starts[j] + a, end - start, period))
    for k in {k for k, _, _ in block}:
        runs[k].sort(key=lambda r: (r[0], r[2]))


def periodic_runs(text: np.ndarray, min_length: int, min_periods: int) -> np.ndarray:
    """(start, end, period) of the runs of text with at least max(min_length, min_periods * period) symbols; its last symbol occurs once."""
    rank, order = suffix_ranks(text)
    i = np.arange(len(text))
    smaller, larger = _next_smaller(rank), _next_smaller(-rank)
    at, period = np.r_[i, i], np.r_[smaller - i, larger - i]
    fits = at + (min_periods - 1) * period < len(text)
    fits[fits] &= text[at[fits]] == text[at[fits] + period[fits]]
    at, period = at[fits], period[fits]
    end = at + period + _common(rank, order, text, at, at + period)
    # from the first of a run's roots, which starts within its first period, all but a period less one lies to the right
    long = (end - at > (min_periods - 1) * period) & (end - at > min_length - period)
    at, period, end = at[long], period[long], end[long]
    n = len(text)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    back = text[::-1]
    rank, order = suffix_ranks(np.r_[back, back.max() + 1])
    left = _common(rank, order, np.r_[back, back.max() + 1], n - at, n - at - period)
    start = at - left
    whole = (end - start >= np.maximum(min_length, min_periods * period)) & (left < period)
    return np.unique(np.c_[start, end, period][whole], axis=0)


def suffix_ranks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inverse suffix array and the suffix array, by doubling; only suffixes that are still tied are sorted again."""
    n = len(text)
    order = np.argsort(text)
    first = np.r_[True, text[order[1:]] != text[order[:-1]]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))  # the first place of the group
    step = 1
    while True:
        alone = first & np.r_[first[1:], True]
        open_places = np.flatnonzero(~alone)
        if not len(open_places):
            return rank, order
        rows = order[open_places]
        ahead = np.where(rows + step < n, rank[np.minimum(rows + step, n - 1)] + 1, 0)
        key = rank[rows] * (n + 2) + ahead
        again = np.argsort(key)
        rows, key = rows[again], key[again]
        order[open_places] = rows
        new = np.r_[True, key[1:] != key[:-1]]
        first[open_places] = new
        rank[rows] = np.maximum.accumulate(np.where(new, open_places, 0))
        step *= 2


def _next_smaller(values: np.ndarray) -> np.ndarray:
    """The next place with a smaller value, or the end."""
    out, stack, held = np.full(len(values), len(values), np.int64), [], values.tolist()
    for i, v in enumerate(held):
        while stack and held[stack[-1]] > v:
            out[stack.pop()] = i
        stack.append(i)
    return out


def _neighbours(rank: np.ndarray, order: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Common prefixes of every suffix in order and the one before it, in one walk over the text."""
    n, held, lcp = len(text), 0, [0] * len(text)
    symbols, places, before = text.tolist(), rank.tolist(), order.tolist()
    for i in range(n):
        if places[i] == 0:
            held = 0
            continue
        j = before[places[i] - 1]
        while i + held < n and j + held < n and symbols[i + held] == symbols[j + held]:
            held += 1
        lcp[places[i]] = held
        if held:
            held -= 1
    return np.array(lcp, np.int64)


def _common(rank: np.ndarray, order: np.ndarray, text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefixes of the suffixes from a and from b, which differ, as range minima; the sparse table is kept a level at a time."""
    level = _neighbours(rank, order, text)
    low, high = np.minimum(rank[a], rank[b]) + 1, np.maximum(rank[a], rank[b])
    size = high - low + 1
    depth = np.frexp(size.astype(float))[1] - 1
    out, last = np.zeros(len(a), np.int64), int(depth.max(initial=-1))
    for d in range(last + 1):
        now = np.flatnonzero(depth == d)
        out[now] = np.minimum(level[low[now]], level[high[now] - (1 << d) + 1])
        if d < last:
            level = np.minimum(level[: -1 << d], level[1 << d :])
    return out


def _collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join(w for w, gone in zip(words, (np.cumsum(change[:-1]) > 0).tolist(), strict=True) if not gone)
