"""Benchmark decontamination by latent semantic retrieval.

Documents are cut in overlapping passages, passages are TF-IDF vectors over the rarer words of the benchmark, and a
randomised SVD over all passages of the corpus, with the benchmark's own added, gives the latent space. Passages whose
cosine with a benchmark item in that space is high enough are candidates; longest common subsequences of words, and of
the words of the item's last sentence (its answer), decide. The corpus is tokenised once, into codes of the benchmark's
words; spaces are fitted for blocks of items, so that a space has a bounded size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import discard, materialize
from ._lcs import common_length

WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Item:
    item_id: object
    words: list[str]
    answer: list[str]


@dataclass(frozen=True)
class LatentSpace:
    recode: np.ndarray  # from the numbers of terms to features, -1 for none
    idf: np.ndarray
    basis: np.ndarray  # features x rank
    width: int
    pieces: np.ndarray  # unit vectors of the items' passages
    owner: np.ndarray  # the item of each


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def read_item(item_id: object, text: str | None) -> Item:
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text or "") if WORD.search(s)]
    return Item(item_id, words_of(text), words_of(sentences[-1]) if sentences else [])


class _Codes(dict):
    """The number of each word of a vocabulary, -1 for all others."""

    def __missing__(self, word: str) -> int:
        return -1

    def read(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def _passages(texts: list[np.ndarray], n_features: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(passage, feature, count) of each distinct feature of each passage, in order, and the number of passages.

    texts: the features of each text's words, -1 for none. Passages are `width` words and begin every width / 2 words, so
    each run of width / 2 words lies whole in one.
    """
    step, base, at, found = width // 2, 0, [], []
    for codes in texts:
        place = np.flatnonzero(codes >= 0)
        slot, ids = place // step, codes[place]
        last = max(0, math.ceil(len(codes) / step) - 2)  # the final passage takes what is left
        for shift in (0, 1):
            passage = slot - shift
            fine = (passage >= 0) & (passage <= last)
            at.append(base + passage[fine])
            found.append(ids[fine])
        base += last + 1
    at, found = np.concatenate(at or [np.zeros(0, np.int64)]), np.concatenate(found or [np.zeros(0, np.int64)])
    key, count = np.unique(at * max(1, n_features) + found, return_counts=True)
    return key // max(1, n_features), key % max(1, n_features), count, base


def _vectors(passage: np.ndarray, feature: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights of unit TF-IDF vectors, entry by entry."""
    w = (1 + np.log(count)) * idf[feature]
    starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]]) if len(passage) else np.zeros(0, np.int64)
    norm = np.sqrt(np.add.reduceat(w * w, starts)) if len(starts) else np.zeros(0)
    return w / np.repeat(norm, np.diff(np.r_[starts, len(w)]))


def _blocks(passage: np.ndarray, feature: np.ndarray, w: np.ndarray, rows: int = 256) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """The passages that have entries, `rows` at a time, as (which of them, features, dense matrix passages x features)."""
    starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]]) if len(passage) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(passage)]
    row = np.repeat(np.arange(len(starts)), ends - starts)
    for lo in range(0, len(starts), rows):
        hi = min(lo + rows, len(starts))
        of = slice(starts[lo], ends[hi - 1])
        features, column = np.unique(feature[of], return_inverse=True)
        dense = np.zeros((hi - lo, len(features)), np.float32)
        dense[row[of] - lo, column] = w[of]
        yield slice(lo, hi), features, dense


def _project(passage: np.ndarray, feature: np.ndarray, w: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The passages that have entries, and their vectors times basis."""
    seen = passage[np.r_[True, passage[1:] != passage[:-1]]] if len(passage) else passage
    out = np.zeros((len(seen), basis.shape[1]), np.float32)
    for rows, features, dense in _blocks(passage, feature, w):
        out[rows] = dense @ basis[features]
    return seen, out


def _slices(batches: Iterator[pa.RecordBatch], most_words: int = 400_000) -> Iterator[tuple[int, list[np.ndarray], pa.RecordBatch]]:
    """The codes of rows in groups of about most_words words, so that long texts don't add up."""
    for batch in batches:
        at, held, n = 0, [], 0
        for i, value in enumerate(batch.column("codes")):
            held.append(np.frombuffer(value.as_py(), np.int32))
            n += len(held[-1])
            if n >= most_words or i + 1 == len(batch):
                yield at, held, batch
                at, held, n = i + 1, [], 0


def code_texts(rows: DataFrame, terms: list[str]) -> DataFrame:
    """(id, codes) of rows (id, text): for each word of the text its number in terms or -1, as int32, without the text.

    Written once and read by all passes over all blocks of items.
    """
    numbers = _Codes((w, k) for k, w in enumerate(terms))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                codes = [numbers.read(words_of(t.as_py())).tobytes() for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], names=["id", "codes"])

    schema = T.StructType([rows.schema["id"], T.StructField("codes", T.BinaryType())])
    return materialize(rows.where("text IS NOT NULL").mapInArrow(code, schema), "coded-texts")


def fit_space(coded: DataFrame, terms: list[str], items: list[Item], *, rank: int, max_share: float, least_words: int, item_weight: float, seed: int, most_tasks: int) -> LatentSpace:
    """The latent space of one block of items, from all passages of the coded texts.

    Each task tells up to rank floats for every vocabulary word, so at most most_tasks tasks read the texts, one after the other.
    """
    width = 2 * max(16, min(256, max((len(i.words) for i in items), default=16)))
    texts, n_terms = coded.select("codes").coalesce(most_tasks), len(terms)
    number = {w: k for k, w in enumerate(terms)}

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(n_terms + 1, np.int64), 0
        for _, rows, _ in _slices(batches):
            _, feature, _, more = _passages(rows, n_terms, width)
            df[:-1] += np.bincount(feature, minlength=n_terms)
            n += more
        df[-1] = n
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["feature", "n"])

    df = np.zeros(len(terms) + 1)
    for r in texts.mapInArrow(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():  # one row a vocabulary word
        df[r["feature"]] = r["n"]
    total = max(1.0, df[-1])
    rare = set(np.flatnonzero(df[:-1] <= max_share * total))
    for i in items:  # an item of frequent words only keeps its rarest
        rare |= set(sorted({number[w] for w in i.words}, key=lambda k: (df[k], k))[:least_words])
    kept = sorted(rare)
    vocabulary = _Codes((terms[k], n) for n, k in enumerate(kept))
    recode = np.full(n_terms + 1, -1, np.int32)  # the last entry stands for code -1
    recode[kept] = np.arange(len(kept), dtype=np.int32)
    idf = np.log((1 + total) / (1 + df[kept])) + 1
    rng = np.random.default_rng(seed)
    rank = min(rank, len(vocabulary))
    probe = rng.standard_normal((len(vocabulary), rank))
    n_features, small_probe = len(vocabulary), probe.astype(np.float32)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((n_features, rank))
        for _, rows, _ in _slices(batches):
            passage, feature, count, _ = _passages([recode[r] for r in rows], n_features, width)
            for _, features, dense in _blocks(passage, feature, _vectors(passage, feature, count, idf)):
                out[features] += dense.T @ (dense @ small_probe[features])
        some = np.flatnonzero(np.abs(out).any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some // 64), pa.array(some), pa.array([x.astype(np.float32).tobytes() for x in out[some]], pa.binary())], names=["part", "feature", "row"])

    def add_up(t: pa.Table) -> pa.Table:
        f = t["feature"].to_numpy()
        x = np.stack([np.frombuffer(v.as_py(), np.float32) for v in t["row"]]).astype(float)
        order = np.argsort(f, kind="stable")
        starts = np.flatnonzero(np.r_[True, f[order][1:] != f[order][:-1]])
        x = np.add.reduceat(x[order], starts, axis=0)
        return pa.table({"part": f[order][starts] // 64, "feature": f[order][starts], "row": pa.array([v.astype(np.float32).tobytes() for v in x], pa.binary())})

    shape = "part long, feature long, row binary"
    partial = texts.mapInArrow(sketch, shape).withColumn("salt", F.spark_partition_id() % 64)
    # 64 words a group, first within 64 groups of map tasks, then over those: no group holds a row from every task
    once = partial.groupBy("part", "salt").applyInArrow(lambda t: add_up(t.select(["part", "feature", "row"])), shape)
    g = np.zeros((len(vocabulary), rank))
    for r in once.groupBy("part").applyInArrow(add_up, shape).collect():  # rank floats for each vocabulary word
        g[r["feature"]] = np.frombuffer(r["row"], np.float32)
    passage, feature, count, n = _passages([vocabulary.read(i.words) for i in items], n_features, width)
    w = _vectors(passage, feature, count, idf)
    own = np.zeros((n, len(vocabulary)))
    own[passage, feature] = w
    scale = item_weight * max(1.0, float(np.abs(g).max())) / max(1e-9, float(np.abs(own.T @ (own @ probe)).max()) if n else 1.0)
    g += scale * (own.T @ (own @ probe))
    basis = np.linalg.svd(g, full_matrices=False)[0]
    pieces = own @ basis
    norm = np.linalg.norm(pieces, axis=1)
    owner = np.concatenate([np.full(max(0, math.ceil(len(i.words) / (width // 2)) - 2) + 1, k) for k, i in enumerate(items)])
    return LatentSpace(recode, idf, basis, width, pieces[norm > 0] / norm[norm > 0, None], owner[norm > 0])


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_items: int = 2000,
    rank: int = 256,
    max_share: float = 0.02,
    least_words: int = 8,
    item_weight: float = 1.0,
    min_cosine: float = 0.4,
    min_common: float = 0.7,
    min_common_answered: float = 0.55,
    min_answer: float = 0.9,
    seed: int = 5,
    most_tasks: int = 4096,
) -> DataFrame:
    """(id, item, cosine, common, answer) for every row of docs and benchmark item that it holds; other columns are not read.

    cosine: the highest of the row's passages with the item in the latent space; common: the share of the item's words in
    a longest common subsequence with a passage; answer: the same for the item's last sentence. A pair is reported if its
    cosine is at least min_cosine, and common is at least min_common, or at least min_common_answered with answer at least
    min_answer. Words are runs of letters and digits, lower-cased. Null and empty texts and items hold nothing. Rows that
    repeat are reported each, null ids with their null; items that repeat an id are told apart only by their figures.
    An empty table on either side gives no rows. Documents are read whole and once: their words are coded by the
    benchmark's vocabulary, which the driver and the tasks hold, as they hold the items; the codes are read three times
    for every block_items items, twice of these by most_tasks tasks at most, whose sums are what is shuffled.
    """
    item_type = benchmark.select(F.col(item_col).alias("item")).schema["item"].dataType
    ids = docs.select(F.col(id_col).alias("id")).schema["id"]
    schema = T.StructType([ids, T.StructField("item", item_type), *[T.StructField(n, T.DoubleType()) for n in ("cosine", "common", "answer")]])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = benchmark.where(F.col(item_text_col).isNotNull()).select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    items = [item for r in asked.orderBy("item", "text").toLocalIterator() if (item := read_item(r["item"], r["text"])).words]
    found = docs.sparkSession.createDataFrame([], schema)
    if items:
        terms = sorted({w for i in items for w in i.words})
        number = {w: k for k, w in enumerate(terms)}
        coded = code_texts(rows, terms)
        for at in range(0, len(items), block_items):
            block = items[at : at + block_items]
            space = fit_space(coded, terms, block, rank=rank, max_share=max_share, least_words=least_words, item_weight=item_weight, seed=seed, most_tasks=most_tasks)
            search = _searcher(space, block, number, schema, min_cosine, min_common, min_common_answered, min_answer)
            found = found.unionByName(materialize(coded.mapInArrow(search, schema), "leaks"))
        discard(coded)
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "cosine", "common", "answer")


def _searcher(space: LatentSpace, items: list[Item], number: dict[str, int], schema: T.StructType, min_cosine: float, min_common: float, min_common_answered: float, min_answer: float):
    from pyspark.sql.pandas.types import to_arrow_type

    out_item = to_arrow_type(schema["item"].dataType)
    basis, pieces = space.basis.astype(np.float32), space.pieces.astype(np.float32)
    wanted = [([number[w] for w in i.words], [number[w] for w in i.answer]) for i in items]
    names = [i.item_id for i in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, codes, batch in _slices(batches):
            step = space.width // 2
            counts = np.array([max(0, math.ceil(len(c) / step) - 2) + 1 for c in codes], np.int64)
            first = np.r_[0, np.cumsum(counts)]
            passage, feature, count, _ = _passages([space.recode[c] for c in codes], len(space.idf), space.width)
            seen, z = _project(passage, feature, _vectors(passage, feature, count, space.idf), basis)
            z = z / np.maximum(np.linalg.norm(z, axis=1), 1e-12)[:, None]
            best: dict[tuple[int, int], list[float]] = {}
            some = max(1, 8_000_000 // max(1, len(pieces)))
            for lo in range(0, len(z), some):
                cosine = z[lo : lo + some] @ pieces.T
                for p, piece in zip(*np.nonzero(cosine >= min_cosine), strict=True):
                    doc = int(np.searchsorted(first, seen[lo + p], side="right") - 1)
                    start = int(seen[lo + p] - first[doc]) * step
                    k = int(space.owner[piece])
                    words, last = wanted[k]
                    span = codes[doc][start : start + max(space.width, 2 * len(words))].tolist()
                    common = common_length(words, span) / len(words)
                    answer = common_length(last, span) / max(1, len(last))
                    if common >= min_common or common >= min_common_answered and answer >= min_answer:
                        old = best.setdefault((doc, k), [0.0, 0.0, 0.0])
                        best[doc, k] = [max(a, b) for a, b in zip(old, (float(cosine[p, piece]), common, answer), strict=True)]
            if best:
                keys = sorted(best)
                figures = [pa.array([best[k][j] for k in keys], pa.float64()) for j in range(3)]
                ids = batch.column("id").take(pa.array([at + d for d, _ in keys], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([names[k] for _, k in keys], out_item), *figures], names=schema.names)

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs, all columns, that hold no benchmark item.

    Rows with null or empty texts stay; rows that repeat stay or go together. Rows with a null id are kept only if no row
    with a null id leaks. An empty table, or an empty benchmark, leaves docs as it is.
    """
    own = "__rollcall_id"
    leaks = find_leaks(docs, benchmark, id_col=id_col, **options).select(F.col(id_col).alias(own)).distinct()
    return docs.join(leaks, F.col(id_col).eqNullSafe(F.col(own)), "left_anti")
