"""Language identification by compression: the language whose dictionary makes a text shortest.

Each language has a zstandard raw-content dictionary, cut from a bounded sample of labelled texts. A text is lower-cased,
split into windows, and every window is compressed under every dictionary; the sums decide. A narrow margin between the
two shortest sums is a rejection.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import labelled_sample

UNDETERMINED = "und"
#: Put before short windows: blanks compress to one match, so that zstandard never stores the window raw.
PAD = b" " * 96


def fit_dictionaries(
    docs: DataFrame, *, text_col: str = "text", label_col: str = "lang", sample_docs: int = 256, dict_bytes: int = 32768, slice_chars: int = 600, max_chars: int = 60_000
) -> dict[str, bytes]:
    """One raw-content dictionary of at most dict_bytes for each non-null label, from at most sample_docs texts of it.

    Texts over max_chars and labels beyond the thousand commonest are left out of the fit. Each text gives slice_chars
    characters, so that many texts have a part. Null labels and texts teach nothing; an empty table gives no dictionary.
    """
    out = {}
    for label, texts in labelled_sample(docs, label_col, text_col, sample_docs, max_chars, slice_chars).items():
        raw = b" ".join(t.lower().encode("utf-8", "replace") for t in texts)[:dict_bytes]
        if len(raw) >= 8:
            out[str(label)] = raw
    return out


def compressors(dictionaries: dict[str, bytes], window: int, level: int, min_match: int) -> dict[str, object]:
    import zstandard

    out = {}
    for name, raw in sorted(dictionaries.items()):
        params = zstandard.ZstdCompressionParameters.from_level(level, source_size=window + len(PAD), dict_size=len(raw), min_match=min_match, write_content_size=0, write_checksum=0, write_dict_id=0)
        data = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=params)
        out[name] = zstandard.ZstdCompressor(compression_params=params, dict_data=data)
    return out


def code_lengths(text: bytes, coders: dict[str, object], window: int) -> dict[str, int]:
    """Compressed bytes of the whole text under each dictionary, window by window."""
    parts = [text[i : i + window] for i in range(0, len(text), window)] or [b""]
    if len(parts) > 1 and len(parts[-1]) < window // 4:
        parts[-2:] = [parts[-2] + parts[-1]]
    if len(parts[-1]) < 512:
        parts[-1] = PAD + parts[-1]
    return {name: sum(len(c.compress(p)) for p in parts) for name, c in coders.items()}


def identify_language(
    docs: DataFrame, dictionaries: dict[str, bytes], *, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, level: int = 6, min_match: int = 3, min_margin: float = 0.005, sharpness: float = 60.0
) -> DataFrame:
    """(id, lang_pred, score, margin, rejected) for every row of docs; other columns are not read.

    lang_pred: a key of dictionaries, `und` for null texts and texts without a letter (or with no dictionary learned).
    margin: by how much the second-shortest code is longer, as a share of it. score: the normalised exponential of the
    relative excess lengths, 0 for `und`. rejected: `und`, or a margin under min_margin. Equal code lengths go to the
    first language by name and are rejected. Repeated rows and repeated ids each get their own row; an empty table gives
    none; a null id stays null. With one dictionary only, the margin is 1.
    """
    out_schema = docs.select(id_col).schema.add("lang_pred", "string").add("score", "double").add("margin", "double").add("rejected", "boolean")
    decide = _decider(dictionaries, window, level, min_match, min_margin, sharpness)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = decide()
        for batch in batches:
            found = [judge(value.as_py()) for value in batch.column(1)]
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds))], names=out_schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(classify, out_schema)


def keep_identified(
    docs: DataFrame, dictionaries: dict[str, bytes], *, text_col: str = "text", window: int = 1024, level: int = 6, min_match: int = 3, min_margin: float = 0.005, sharpness: float = 60.0
) -> DataFrame:
    """The rows of docs, all columns, that identify_language doesn't reject.

    Null and empty texts and those without a letter go, repeated rows stay or go together, an empty table stays empty.
    """
    decide = _decider(dictionaries, window, level, min_match, min_margin, sharpness)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = decide()
        for whole in batches:
            for at in range(0, len(whole), 512):  # whole rows go back, so in small batches
                batch = whole.slice(at, 512)
                yield batch.filter(pa.array([not judge(value.as_py())[3] for value in batch.column(text_col)], pa.bool_()))

    return docs.mapInArrow(sift, docs.schema)


def _decider(dictionaries: dict[str, bytes], window: int, level: int, min_match: int, min_margin: float, sharpness: float):
    """Makes, in a task, the function from a text to (lang_pred, score, margin, rejected)."""

    def start():
        import math

        import regex

        letter = regex.compile(r"\p{L}")
        coders = compressors(dictionaries, window, level, min_match)

        def judge(text: str | None) -> tuple[str, float, float, bool]:
            if text is None or not coders or not letter.search(text):
                return UNDETERMINED, 0.0, 0.0, True
            lengths = code_lengths(text.lower().encode("utf-8", "replace"), coders, window)
            order = sorted(lengths.items(), key=lambda kv: (kv[1], kv[0]))
            pred, best = order[0]
            margin = (order[1][1] - best) / order[1][1] if len(order) > 1 else 1.0
            score = 1.0 / sum(math.exp(-sharpness * (n - best) / max(best, 1)) for n in lengths.values())
            return pred, score, margin, margin < min_margin

        return judge

    return start
