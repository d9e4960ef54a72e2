"""Exact token counts at every prefix, by dynamic programming over prefixes.

The vocabulary is a byte-pair encoding with word ends. A sequence of tokens is what the encoder gives exactly if each
token stays whole and each neighbouring pair is what the encoder gives for its own joined text. So the last token of
every prefix of a word follows from the last tokens of its shorter prefixes, one table look-up each, and the number of
tokens at every prefix comes with it. Words are encoded apart from each other, so counts over a text are running sums.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

END = "</w>"
#: White space as the tokenizer's own regular expressions have it.
SPACE = r"\t\n\v\f\r \x85   -     　"


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PrefixCounter:
    """Counts tokens of words, texts and all their prefixes for one tokenizer file; holds at most cache_words words."""

    def __init__(self, path: str, cache_words: int = 400_000):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        assert model["type"] == "BPE" and model["end_of_word_suffix"] == END, "a BPE with word ends is needed"
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.vocab = set(model["vocab"])
        self.parts = {a + b: (a, b) for a, b in self.ranks}
        self.made = {t: -1 for t in self.vocab} | {a + b: i for (a, b), i in self.ranks.items()}
        self.reach: dict[str, int] = {}  # by the last three characters (and the end mark): the longest token that ends so
        for token in self.vocab:
            body, mark = (token[: -len(END)], END) if token.endswith(END) and token != END else (token, "")
            if len(body) >= 3 and self.reach.get(key := body[-3:] + mark, 0) < len(body):
                self.reach[key] = len(body)
        self.table = byte_alphabet()
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
        self.cache = _Memo(lambda w: self.prefix_counts(self.stand_in(w), every=False)[-1], cache_words)
        self.inner = _Memo(self.inner_counts, cache_words // 10)
        self.fits = _Memo(lambda pair: self.fit(*pair), cache_words)

    def fit(self, left: str, right: str) -> bool:
        """Whether left, right stay as they are when their joined text is encoded.

        They would be joined across their border by the earliest merge that finds its two sides there. So undo the later
        of the two tokens' own merges, step by step, and look whether the pieces then at the border have a merge that
        comes before all that were undone.
        """
        made, parts, ranks = self.made, self.parts, self.ranks
        before, a, b = 1 << 30, made[left], made[right]
        while True:
            if ranks.get((left, right), 1 << 30) < before:
                return False
            if a < 0 and b < 0:
                return True
            if a > b:
                before, left = a, parts[left][1]
                a = made[left]
            else:
                before, right = b + 1, parts[right][0]
                b = made[right]

    def prefix_counts(self, word: str, every: bool = True) -> list[int]:
        """Tokens of word[:i] for i = 1.., in stand-in characters (bytes), each as a whole word; every=False: the last only.

        Each loop ends, as exactly one last token fits a prefix, and every single byte is a token, with and without END.
        """
        n, vocab, fit, reach = len(word), self.vocab, self.fits, self.reach
        last, count, out = [""] * (n + 1), [0] * (n + 1), []
        for i in range(1, n + 1):
            tail = word[i - 3 : i] if i > 3 else word[:i]
            if every or i == n:
                j = max(0, i - reach.get(tail + END, 2))
                while (token := word[j:i] + END) not in vocab or j and not fit[last[j], token]:
                    j += 1
                out.append(count[j] + 1)
            if i < n:
                j = max(0, i - reach.get(tail, 2))
                while (token := word[j:i]) not in vocab or j and not fit[last[j], token]:
                    j += 1
                last[i], count[i] = token, count[j] + 1
        return out

    def normal(self, text: str) -> str:
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pieces(self, text: str) -> Iterator[str | None]:
        """The text between special strings, normalised; None stands for a special string, which is one token."""
        for piece in self.raw_pieces(text):
            yield None if piece in self.specials else self.normal(piece)

    def raw_pieces(self, text: str) -> Iterator[str]:
        """The text cut before and after every special string, as it stands."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield text[at : m.start()]
            yield m.group()
            at = m.end()
        yield text[at:]

    def stand_in(self, word: str) -> str:
        return word.encode("utf-8", "replace").decode("latin-1").translate(self.table)

    def count(self, text: str) -> int:
        """Tokens of the whole text: the last entry of its running sums."""
        get = self.cache.__getitem__
        return sum(1 if p is None else sum(map(get, self.words.findall(p))) for p in self.pieces(text))

    def inner_counts(self, word: str) -> list[int]:
        """Tokens of the prefixes of a word, by characters, the whole word last."""
        if word[0] == "'" and len(word) == 3 and word[1:].isalpha():  # 're, 've and 'll are one word, their prefixes are two
            return [self.cache["'"], self.cache["'"] + self.cache[word[1]], self.cache[word]]
        counts, at, out = self.prefix_counts(self.stand_in(word)), 0, []
        for c in word:
            at += len(c.encode("utf-8", "replace"))
            out.append(counts[at - 1])
        return out

    def running(self, text: str) -> list[int | None]:
        """Exact tokens of text[:i] for i = 1.. to its length, in characters of the text itself.

        None where a prefix would cut what belongs together: a special string, or a letter and its combining marks.
        """
        import regex

        out: list[int | None] = []
        total = 0
        for piece in self.raw_pieces(text):
            if piece in self.specials:
                total += 1
                out += [None] * (len(piece) - 1) + [total]
                continue
            plain = self.normal(piece)
            counts = []  # of the prefixes of the normalised piece
            for m in self.words.finditer(plain):
                counts += [total] * (m.start() - len(counts))
                counts += [total + k for k in self.inner[m.group()]]
                total = counts[-1]
            counts += [total] * (len(plain) - len(counts))
            if piece.isascii():
                out += counts
                continue
            at = 0
            for cluster in regex.findall(r"\X", piece):
                at += len(self.normal(cluster))
                out += [None] * (len(cluster) - 1) + [counts[at - 1]]
        return out


class _Memo(dict):
    """Remembers at most `most` results of a function, then starts anew."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


_COUNTERS: dict[tuple[str, str], PrefixCounter] = {}


def counter(tokenizer: str) -> PrefixCounter:
    """The counter of a public tokenizer file, by name or by path, kept for the life of the Python worker."""
    import os

    path = tokenizer
    if not os.path.isabs(tokenizer):
        import public_tokenizers

        path = public_tokenizers.path(tokenizer)
    if (path, tokenizer) not in _COUNTERS:
        _COUNTERS[path, tokenizer] = PrefixCounter(path)
    return _COUNTERS[path, tokenizer]


def count_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json", limit: int = 2048, keep_prefixes: bool = False) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit[, prefix_tokens]) for every row of docs; other columns are not read.

    prefix_tokens: for each prefix of the text, by its characters, the tokens that it has by itself; null for prefixes that
    end within a special string or between a letter and its marks. `truncate_at` reads budgets off it. Null and empty
    texts have 0 bytes, 0 tokens and an empty array. Rows that repeat are counted each; a null id stays null; an empty
    table gives no rows. Texts of any length are counted whole.
    """
    out_schema = docs.select(id_col).schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")
    if keep_prefixes:
        out_schema = out_schema.add("prefix_tokens", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        own = counter(tokenizer)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            if keep_prefixes:
                runs = [own.running(t.as_py()) for t in texts]
                tokens = [counts[-1] if counts else 0 for counts in runs]
                more = [pa.array(runs, pa.list_(pa.int32()))]
            else:
                tokens, more = [own.count(t.as_py()) for t in texts], []
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_()), *more], names=out_schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, out_schema)


def truncate_at(counted: DataFrame, budget: int) -> DataFrame:
    """Adds kept_chars, kept_tokens: the longest prefix of the text within budget tokens, from the stored counts alone.

    counted: what count_tokens(keep_prefixes=True) gives. A budget under the first character's tokens keeps nothing (0, 0).
    Within a word counts can fall as the prefix grows, so the last prefix that fits is taken, not the first that doesn't.
    """
    last = F.coalesce(F.array_max(F.transform("prefix_tokens", lambda n, i: F.when(n <= F.lit(budget), i + 1))), F.lit(0))
    tokens = F.when(last > 0, F.element_at("prefix_tokens", F.greatest(last, F.lit(1)))).otherwise(F.lit(0))
    return counted.withColumns({"kept_chars": last, "kept_tokens": tokens})
