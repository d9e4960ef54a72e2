"""Toxicity by compression distance: which of two zstandard dictionaries makes the windows of a text shorter.

Both dictionaries begin with the words that toxic and ordinary texts share; one ends with the words that set toxic texts
apart, the other with as many bytes of plain ordinary words. The gain of a window is how many bytes fewer it takes under
the toxic dictionary. The largest gain, the sum of clear gains and the mean gain of a text go through thresholds that are
calibrated by logistic regression on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import joined_sample, label_counts

PAD = b" " * 64


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    window: int
    level: int
    min_match: int
    clear_gain: int


def fold(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "replace") + b" "


def words(text: str) -> set[bytes]:
    import re

    return set(re.findall(rb"[a-z\x80-\xff]+", fold(text)))


def gains(text: str, model: ToxicityModel, coders: tuple) -> np.ndarray:
    """Bytes saved by the toxic dictionary in every window; windows overlap by a quarter, so no word is cut in all."""
    data, step = fold(text), model.window - model.window // 4
    parts = [PAD + data[i : i + model.window] for i in range(0, max(1, len(data) - model.window // 4), step)]
    toxic, ordinary = coders
    return np.array([len(ordinary.compress(p)) - len(toxic.compress(p)) for p in parts], float)


def features(g: np.ndarray, clear: int) -> tuple[float, ...]:
    top = np.sort(g)[::-1]
    return (1.0, top[0], top[:3].sum() / 3, float(np.log1p(np.maximum(g - clear + 1, 0).sum())), float(np.tanh(g.mean())))


def coders_of(model: ToxicityModel) -> tuple:
    import zstandard

    out = []
    for raw in (model.toxic, model.ordinary):
        params = zstandard.ZstdCompressionParameters.from_level(model.level, source_size=model.window + len(PAD), dict_size=len(raw), min_match=model.min_match, write_content_size=0, write_checksum=0, write_dict_id=0)
        data = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=params)
        out.append(zstandard.ZstdCompressor(compression_params=params, dict_data=data))
    return tuple(out)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_docs: int = 2400, max_chars: int = 20_000, distinct_words: tuple[int, ...] = (25, 50, 80, 120, 200), shared_words: tuple[int, ...] = (1500, 3000), window: int = 64, level: int = 4, min_match: int = 5, clear_gain: int = 4
) -> ToxicityModel | None:
    """Dictionaries and thresholds from at most sample_docs texts of each label (0 and 1), none over max_chars characters.

    Two thirds of the sample give the dictionaries, one third the thresholds and, by its log loss, the numbers of words in
    the dictionaries. None if a label has no text. The share of toxic texts among all labelled rows is the prior of the
    calibration.
    """
    rows = labels.where(F.col(label_col).isin(0, 1))
    sample = joined_sample(docs, rows, id_col, label_col, text_col, sample_docs, max_chars)
    if not sample.get(0) or not sample.get(1):
        return None
    n = label_counts(rows, label_col)
    cut = {k: v[: max(1, 2 * len(v) // 3)] for k, v in sample.items()}
    rest = {k: v[2 * len(v) // 3 :] or v for k, v in sample.items()}
    df = {k: Counter(w for t in v for w in words(t)) for k, v in cut.items()}
    n1, n0 = len(cut[1]), len(cut[0])
    least = max(2, n1 // 150)
    odds = {w: math.log((c + 0.5) / (n1 + 1) * (n0 + 1) / (df[0][w] + 0.5)) for w, c in df[1].items() if c >= least}
    apart = sorted((w for w, x in odds.items() if x > 1.5), key=lambda w: (-odds[w] * math.sqrt(df[1][w]), w))
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    prior = np.where(y == 1, n[1] / len(rest[1]), n[0] / len(rest[0])) / (n[0] + n[1]) * len(y)
    best: tuple[float, ToxicityModel] | None = None
    for n_apart in distinct_words:
        own = apart[:n_apart]
        common = sorted((w for w in df[0] if w not in set(own)), key=lambda w: (-df[0][w], w))
        toxic_end = b" ".join(reversed(own)) + b" "  # the last bytes are nearest and cheapest to point at
        for n_shared in shared_words:
            head = b" ".join(reversed(common[:n_shared])) + b" "
            plain_end = (b" ".join(common[n_shared : n_shared + 4 * n_apart]) + b" ")[: len(toxic_end)]
            model = ToxicityModel(head + toxic_end, head + plain_end, (), window, level, min_match, clear_gain)
            coders = coders_of(model)
            x = np.array([features(gains(t, model, coders), clear_gain) for k in (0, 1) for t in rest[k]])
            w = logistic(x, y, prior)
            p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-9, 1 - 1e-9)
            loss = float(-(prior * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())
            if best is None or loss < best[0]:
                best = (loss, ToxicityModel(model.toxic, model.ordinary, tuple(w), window, level, min_match, clear_gain))
    return best[1]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weighted logistic regression by damped Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step / max(1.0, float(np.abs(step).max()) / 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted, max_gain, n_windows) for every row of docs; other columns are not read.

    Null and empty texts are scored as one window of blanks, so they get the score of a text without any gain. Without a
    model (no labelled text) the score is 0. Whole texts count, whatever their length; repeated rows get a row each, a
    null id stays null, an empty table gives none.
    """
    out_schema = docs.select(id_col).schema.add("score", "double").add("predicted", "integer").add("max_gain", "double").add("n_windows", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = coders_of(model) if model else None
        for batch in batches:
            scores, most, n = [], [], []
            for value in batch.column(1):
                g = gains(value.as_py() or "", model, coders) if model else np.zeros(1)
                z = float(np.dot(features(g, model.clear_gain), model.weights)) if model else -math.inf
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) if model else 0.0)
                most.append(float(g.max()))
                n.append(len(g))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(most, pa.float64()), pa.array(n, pa.int64())], names=out_schema.names
            )

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, out_schema)
