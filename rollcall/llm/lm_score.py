"""Language-model scores by online logistic context mixing.

A text is a sequence of words and one end, and every word is a code of bits. The first bits walk a Huffman tree to the
word's size, the power of two of its count among training words, and one more says whether the text has had the word
before. Then its count in the text so far picks it among those of its size that the text has had, or its training count
among the others; a word that no training text has is spelled, byte by byte and bit by bit. So the code is complete: the
probabilities of what may follow add up to one.

Each bit is predicted in several hashed contexts that reach across words: the two codes before, the word before, the two
words before, the place in the text, and what this text has shown so far. A gate, the node of the code, chooses the weights
that mix the predictors in the logistic domain, and an adaptive map refines the mix. Weights and map are learned while
reading: a training task reads its texts in order and predicts each group of them from those before; its counts are added
up over the tasks, its weights averaged. A text that is scored starts from these and goes on learning, block by block.

Texts are read once into chunks of word numbers with a dictionary each. Words are counted once for the whole corpus, by a
shuffle, however many there are, and their counts go back to the dictionaries of the chunks.
"""

from __future__ import annotations

import heapq
import itertools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import discard, materialize
from ._sums import SHAPE, add_up, batch_of

U = np.uint64
BLANK, END = b" ", b"\n"
SIZES = 32  # 0: a word that no training text has
NODES = 64  # of the code: the inner nodes of the tree of sizes, then for each size whether the text has had the word
START = 64  # the symbol of a text's start; those of words are twice the size, plus one if the text had the word before
INPUTS = 6  # predictors of a code bit, with a constant
ORDERS = 3  # predictors of a byte's bit: hashes of the last two and three bytes, and of all the word so far
STEPS = 33  # of the refining maps, by the mixed prediction in the logistic domain
BLOCKS = np.unique(np.r_[0, 32 << np.arange(6), np.arange(1024, 1 << 24, 1024)])  # where a text's weights are brought up to date
SPELL_BITS = (18, 20, 20)
SURE = np.log((np.arange(64)[None, :] + 0.4) / (np.arange(64)[:, None] + 0.4)).astype(np.float32)  # by zeros and ones seen


@dataclass
class Mixer:
    """Weights of each gate, and hits[bit, gate, step] of the map that refines what they give."""

    weights: np.ndarray
    hits: np.ndarray

    @staticmethod
    def new(gates: int, inputs: int) -> Mixer:
        return Mixer(np.full((gates, inputs), 0.3, np.float32), np.zeros((2, gates, STEPS)))

    def map(self) -> np.ndarray:
        at_rest = 1 / (1 + np.exp(-np.linspace(-8, 8, STEPS)))
        return ((self.hits[1] + 8 * at_rest) / (self.hits.sum(0) + 8)).astype(np.float32)


@dataclass
class CodeModel:
    """What is known of code bits: counts [slot, bit] in each corpus context, and the mixer. classes: of words, by hash."""

    classes: int
    masses: np.ndarray  # training tokens of each size
    prior: float  # training counts of words that the text has had weigh as so many occurrences in the text
    mixer: Mixer = field(default_factory=lambda: Mixer.new(NODES, INPUTS))
    counts: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self):
        if not self.counts:
            self.counts = [np.zeros((n * NODES, 2), np.float32) for n in (65 * 65, self.classes, self.classes, SIZES * 16)]
        self.asked, self.nodes, self.turns = _size_tree(self.masses)

    def stretched(self) -> list[np.ndarray]:
        return [np.log((c[:, 1] + 0.4) / (c[:, 0] + 0.4)) for c in self.counts]


def _size_tree(masses: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A Huffman tree over the sizes that occur, and 0: for each size and level whether there is a turn, at which node, and which.

    There is a last level more than the tree has, for whether a text has had the word.
    The weight of size 0 is that of the words seen once, as is the share of unseen words.
    """
    heap = [(max(float(masses[1]), 1.0), 0, (0,))] + [(float(masses[k]), k, (k,)) for k in range(1, SIZES) if masses[k] > 0]
    heapq.heapify(heap)
    paths: dict[int, list[tuple[int, int]]] = {k: [] for _, k, _ in heap}
    node = len(heap) - 1
    while len(heap) > 1:
        node -= 1  # the root is 0
        (w0, t, low), (w1, _, high) = heapq.heappop(heap), heapq.heappop(heap)
        for turn, leaves in enumerate((low, high)):
            for k in leaves:
                paths[k].append((node, turn))
        heapq.heappush(heap, (w0 + w1, t, low + high))
    levels = max(map(len, paths.values())) + 1
    asked, nodes, turns = np.zeros((SIZES, levels), bool), np.zeros((SIZES, levels), np.uint8), np.zeros((SIZES, levels), bool)
    for k, path in paths.items():
        for level, (at, turn) in enumerate(path[::-1]):
            asked[k, level], nodes[k, level], turns[k, level] = True, at, turn
    return asked, nodes, turns


def size_of(n: np.ndarray) -> np.ndarray:
    """0 for no occurrence, else one more than the power of two of the count, 31 at most."""
    return np.where(n > 0, np.minimum(31, np.frexp(n.astype(float))[1]), 0).astype(np.int64)


def _order(keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """The stable order by some keys, the most important last, sorted by 16 bits at a time."""
    order = None
    for key in keys:
        for shift in range(0, max(1, int(key.max(initial=0)).bit_length()), 16):
            digit = (key >> shift).astype(np.uint16)
            order = np.argsort(digit, kind="stable") if order is None else order[np.argsort(digit[order], kind="stable")]
    return order


def _pairs(table: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """table[slot] of a table of two float32 columns: both come as one number of eight bytes, which is quicker than rows."""
    return np.take(table.view(np.int64).ravel(), slot).view(np.float32).reshape(-1, 2)


def _cells(table: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """table[row, column], by one index."""
    return np.take(table.ravel(), row * table.shape[1] + column)


def _running(keys: tuple[np.ndarray, ...], value: np.ndarray | None = None, given: tuple[np.ndarray, ...] = ()) -> tuple[np.ndarray, np.ndarray | None]:
    """For each row, in order: the number of rows before with its keys, and the sum of their values.

    given: keys that ascend with the rows, so that nothing need be sorted by them.
    """
    order = _order(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in (*keys, *given):
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    start = np.flatnonzero(new)
    first = np.repeat(start, np.diff(np.r_[start, len(order)]))
    n = np.empty(len(order), np.int64)
    n[order] = np.arange(len(order)) - first
    if value is None:
        return n, None
    v = value[order]
    total = np.cumsum(v) - v
    s = np.empty(len(order), total.dtype)
    s[order] = total - total[first]
    return n, s


class Reading:
    """Some texts of a chunk, token by token: their code bits, and what the contexts of each bit are."""

    def __init__(self, texts: list[np.ndarray], n: np.ndarray, hashes: np.ndarray, spelled: np.ndarray | None, model: CodeModel, sizes_of_words: np.ndarray | None = None):
        """texts: word numbers, the end left out; n, hashes, spelled: of each word number, the end last; spelled: log2, or None for a reading that only learns.

        sizes_of_words: size_of(n), where it is known already.
        """
        end, sizes_of_words = len(n) - 1, size_of(n) if sizes_of_words is None else sizes_of_words
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        first = np.cumsum(sizes) - sizes
        w = np.full(int(sizes.sum()), end, np.int64)
        self.doc = np.repeat(np.arange(len(texts)), sizes)
        self.t = np.arange(len(w)) - first[self.doc]
        w[np.flatnonzero(self.t < (sizes - 1)[self.doc])] = np.concatenate([*texts, np.zeros(0, np.int64)])
        times, _ = _running((w,), given=(self.doc,))
        size, count, had = sizes_of_words[w], n[w].astype(float), times > 0
        # of the words of this size: tokens in the text so far, and training tokens of the words among them
        shown, taken = _running((size,), np.where(had, 0.0, count), (self.doc,))
        mass = model.masses[size]
        if spelled is not None:
            with np.errstate(divide="ignore", invalid="ignore"):
                share = model.prior / np.maximum(mass, 1.0)
                again = np.log2((times + share * count) / (shown + share * taken))
                new = np.where(size > 0, np.log2(count / np.maximum(mass - taken, count)), spelled[w])
            self.chosen = np.where(had, again, new)
        symbol = size * 2 + had
        before = lambda x, k, at_start: np.where(self.t >= k, np.r_[np.full(k, at_start, x.dtype), x[:-k]][: len(x)], at_start)
        s1, s2 = before(symbol, 1, START), before(symbol, 2, START)
        h = hashes[w].astype(np.int64)
        h1, h2 = before(h, 1, 0), before(h, 2, 1)
        place = np.minimum(np.frexp(self.t + 1.0)[1], 15)
        contexts = (s1 * 65 + s2, h1 % model.classes, ((h1 * 0x9E3779B1 ^ h2) >> 3) % model.classes, size * 16 + place)
        # the bits: the way to the size, then, where both are possible, whether the text had the word
        asked, node, bit = (np.take(x, size, axis=0) for x in (model.asked, model.nodes, model.turns))
        asked[:, -1] = (shown > 0) & ((size == 0) | (mass - taken > 0.5))
        node[:, -1], bit[:, -1] = SIZES + size, had
        block = np.searchsorted(BLOCKS, self.t, side="right").astype(np.uint16)
        order = np.argsort(block, kind="stable")
        row, level = np.divmod(np.flatnonzero(np.take(asked, order, axis=0)), asked.shape[1])
        self.token = order[row]
        self.node, self.bit = _cells(node, self.token, level).astype(np.int64), _cells(bit, self.token, level)
        self.block, self.of_doc = block[self.token], self.doc[self.token]
        self.slots = [c[self.token] * NODES + self.node for c in contexts]
        self.slots[3] = np.where(self.node < SIZES, place[self.token], self.slots[3] // NODES) * NODES + self.node  # the size is not known on the way to it
        k, ones = _running((self.of_doc * NODES + self.node,), self.bit.astype(np.int64))
        self.shown = _cells(SURE, np.minimum(k - ones, 63), np.minimum(ones, 63))

    def inputs(self, tables: list[np.ndarray]) -> np.ndarray:
        """What the predictors say. tables: the model's counts, or what it makes of them once they are all gathered."""
        x = np.empty((INPUTS, len(self.token)), np.float32)
        for f, (table, slot) in enumerate(zip(tables, self.slots, strict=True)):
            found = np.take(table, slot) if table.ndim == 1 else _pairs(table, slot)
            x[f] = found if found.ndim == 1 else np.log((found[:, 1] + 0.4) / (found[:, 0] + 0.4))
        x[4], x[5] = self.shown, 0.3
        return x

    def teach(self, x: np.ndarray, mixer: Mixer) -> None:
        """What bits does to the mixer if no text adapts it, without the probabilities."""
        _mixed_in_blocks(x, self.node, self.bit, None, 0, self.block, mixer, told=False)

    def learn(self, model: CodeModel) -> None:
        for table, slot in zip(model.counts, self.slots, strict=True):
            np.add.at(table.reshape(-1), slot * 2 + self.bit, np.float32(1))

    def bits(self, x: np.ndarray, mixer: Mixer, adapt: bool) -> np.ndarray:
        """log2 of the probability of every text. adapt: each text has weights and a map of its own, which start from the mixer's."""
        texts = int(self.doc[-1]) + 1 if len(self.doc) else 0
        cost = _mixed_in_blocks(x, self.node, self.bit, self.of_doc if adapt else None, texts, self.block, mixer)
        return np.bincount(self.of_doc, cost, texts) + np.bincount(self.doc, self.chosen, texts)


def _mixed_in_blocks(x: np.ndarray, gate: np.ndarray, bit: np.ndarray, lane: np.ndarray | None, lanes: int, block: np.ndarray, mixer: Mixer, rate: float = 0.02, told: bool = True) -> np.ndarray:
    """log2 of the probability of each bit. After each block the weights follow its errors, and so does the map.

    lane: the text of each bit, with weights and a map of its own for the time of the call; None: the mixer's own learn.
    told: whether the probabilities are asked for; if not, zeros come back, and the mixer learns the same.
    """
    gates = len(mixer.weights)
    out = np.zeros(len(bit))
    refined = mixer.map()
    if lane is None:
        weights = mixer.weights
    else:
        weights = np.tile(mixer.weights, (lanes, 1))
        shift = np.zeros((lanes, STEPS), np.float32)
    cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(block) else np.zeros(0, np.int64)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        g, y, xs = gate[a:b], bit[a:b].astype(np.float32), x[:, a:b]
        at = g if lane is None else lane[a:b] * gates + g
        z = np.einsum("fi,if->i", xs, np.take(weights, at, axis=0))
        p = 1 / (1 + np.exp(-np.clip(z, -20, 20)))
        step = (np.clip(z, -8, 8) + 8) * ((STEPS - 1) / 16)
        near = np.rint(step).astype(np.int64)
        if told or lane is not None:
            low = np.minimum(step.astype(np.int64), STEPS - 2)
            part = step - low
            fine = (1 - part) * _cells(refined, g, low) + part * _cells(refined, g, low + 1)
            if lane is not None:
                fine = fine + _cells(shift, lane[a:b], near)
            q = np.clip(0.5 * p + 0.5 * np.clip(fine, 1e-4, 1 - 1e-4), 1e-5, 1 - 1e-5)
            out[a:b] = np.log2(np.where(y > 0, q, 1 - q))
        error = y - p
        n = np.bincount(at, minlength=len(weights))
        pace = (rate if lane is not None else 5 * rate) / np.sqrt(np.maximum(n, 1))
        for f in range(len(xs)):
            weights[:, f] += pace * np.bincount(at, error * xs[f], len(weights))
        if lane is None:
            mixer.hits += np.bincount((y.astype(np.int64) * gates + g) * STEPS + near, minlength=2 * gates * STEPS).reshape(mixer.hits.shape)
        else:
            cell = lane[a:b] * STEPS + near
            n = np.bincount(cell, minlength=shift.size)
            shift += (np.bincount(cell, y - fine, shift.size) / (n + 30)).astype(np.float32).reshape(shift.shape)
    return out


class Spelling:
    """The bits of the bytes of many words, each ended by a blank, with the hashed contexts of each byte."""

    def __init__(self, words: list[bytes]):
        lengths = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        body = np.frombuffer(b"".join(w + BLANK for w in words), np.uint8).astype(U)
        self.word = np.repeat(np.arange(len(words)), lengths)
        first = (np.cumsum(lengths) - lengths)[self.word] if len(words) else np.zeros(0, np.int64)
        place = np.arange(len(body)) - first
        self.place, self.body = np.minimum(place, 7), body.astype(np.int64)
        with np.errstate(over="ignore"):
            h, self.contexts = np.full(len(body), 1, U), []
            for k in range(1, ORDERS + 1):
                last = np.where(place >= k, np.r_[np.zeros(k, U), body[:-k]][: len(body)] + U(1), U(0))
                h = _scramble(h * U(0xBF58476D1CE4E5B9) + last)
                if k > 1:
                    self.contexts.append(h)
            power = np.cumprod(np.full(int(lengths.max(initial=1)) + 1, 0xD6E8FEB86659FD93, U))
            run = np.cumsum((body + U(1)) * power[place], dtype=U) - (body + U(1)) * power[place]
            self.contexts.append(_scramble(run - run[first] if len(run) else run))

    def events(self) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
        """For each of the eight bits of every byte: its gate, the bit, and a slot in each table."""
        node = np.ones(len(self.body), np.int64)
        for k in range(7, -1, -1):
            with np.errstate(over="ignore"):
                salt = node.astype(U) * U(0x9E3779B97F4A7C15)
                at = [(((c ^ salt) * U(0xD6E8FEB86659FD93)) >> U(64 - b)).astype(np.int64) for c, b in zip(self.contexts, SPELL_BITS, strict=True)]
            bit = self.body >> k & 1
            yield self.place * 8 + k, bit.astype(bool), at
            node = node * 2 + bit


def _scramble(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(31))) * U(0x9E3779B97F4A7C15)
        return x ^ (x >> U(29))


@dataclass
class SpellingModel:
    mixer: Mixer = field(default_factory=lambda: Mixer.new(64, ORDERS + 1))
    counts: list[np.ndarray] = field(default_factory=lambda: [np.zeros((1 << b, 2), np.float32) for b in SPELL_BITS])

    def read(self, words: list[bytes], learn: bool) -> np.ndarray:
        """log2 of the probability of each word; learn: weights and counts follow instead, each from what was known before the call, and zeros come back."""
        cost = np.zeros(len(words))
        if not words:
            return cost
        spelling = Spelling(words)
        seen = []
        for gate, bit, slots in spelling.events():
            x = np.empty((ORDERS + 1, len(bit)), np.float32)
            for f, (table, slot) in enumerate(zip(self.counts, slots, strict=True)):
                n = _pairs(table, slot)
                x[f] = np.log((n[:, 1] + 0.3) / (n[:, 0] + 0.3))
            x[ORDERS] = 0.3
            if learn:
                _mixed_in_blocks(x, gate, bit, None, 0, np.zeros(len(bit), np.int8), self.mixer, told=False)
                seen.append((slots, bit))
            else:
                still = Mixer(self.mixer.weights.copy(), self.mixer.hits.copy())
                bits = _mixed_in_blocks(x, gate, bit, None, 0, np.zeros(len(bit), np.int8), still)
                cost += np.bincount(spelling.word, bits, len(words))
        for slots, bit in seen:
            for table, slot in zip(self.counts, slots, strict=True):
                np.add.at(table.reshape(-1), slot * 2 + bit, np.float32(1))
        return cost


def score_texts(docs: DataFrame, training: Column, *, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 8 << 20, group_tokens: int = 50_000, prior: float = 16.0) -> DataFrame:
    """(id, training, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for every row of docs.

    training: a condition on docs' columns; null counts as false. Text is lower-cased in A-Z; tokens are runs other than
    ASCII white space, and one end. base_score: sum of log10((c + 0.1) / (N + 0.1 (V + 1))) with the token's count c among
    training tokens, their number N and their distinct number V. score: log10 of the model's probability of the tokens;
    bits_per_byte: the same in bits for each byte of them (with a blank after each). Null and empty texts are the end
    alone. Ids may be null or repeat, each row is scored. Without training rows N = V = 0, and the model predicts from
    nothing. An empty table gives no rows. All training words are counted, whole texts are read, and all training texts
    teach the contexts, the weights and the map. The context tables have a slot for V^0.65 classes of words, 1,024 at
    least; with the byte tables they are what is broadcast (tens of MB for 10^8 words). Counts of words are joined, never
    broadcast. A text adapts the weights in blocks of 32 words, which grow to 1,024.
    """
    ids = docs.select(F.col(id_col).alias("id")).schema["id"].dataType
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(training, F.lit(False)).alias("training"), F.col(text_col).cast("string").alias("text"))
    packed = f"chunk long, ids array<{ids.simpleString()}>, training array<boolean>, tokens binary, starts binary, words binary"
    chunks = materialize(source.mapInArrow(_packer(chunk_bytes, ids), packed), "token-chunks")
    dictionary = chunks.select("training", "tokens", "starts", "words").mapInArrow(_counter, "word binary, n long")
    words = materialize(dictionary.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    size = F.least(F.floor(F.log2("n") + F.lit(1e-9)) + 1, F.lit(31))
    known = words.where("n > 0").groupBy(size.alias("size")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
    masses, n_train, v_train = np.zeros(SIZES), 0, 0
    for r in known.collect():  # 31 rows at most
        masses[r["size"]] = r["n"]
        n_train, v_train = n_train + r["n"], v_train + r["v"]
    asked = chunks.select("chunk", "words").mapInArrow(_asker, "chunk long, number int, word binary")
    answers = asked.join(words, "word").groupBy("chunk").agg(F.collect_list(F.struct("number", "n")).alias("answers"))
    coded_shape = f"ids array<{ids.simpleString()}>, training array<boolean>, tokens binary, starts binary, counts binary, hashes binary, sizes binary, unknown binary"
    coded = materialize(chunks.join(answers, "chunk").mapInArrow(_coder, coded_shape), "coded-chunks")
    discard(chunks)
    spelling = _spelling_from(words)
    discard(words)
    classes = max(1 << 10, 1 << round(0.65 * np.log2(v_train + 1)))
    model = _code_from(coded.select("training", "tokens", "starts", "counts", "hashes"), CodeModel(classes, masses, prior), group_tokens)
    session = docs.sparkSession.sparkContext
    held = session.broadcast((spelling, CodeModel(classes, masses, prior, model.mixer, [np.zeros((1, 2))]), model.stretched()))
    shape = f"id {ids.simpleString()}, training boolean, n_tokens long, n_known long, base_score double, score double, bits_per_byte double"
    done = coded.mapInArrow(_text_scorer(held, n_train, v_train, ids, group_tokens), shape)
    return done.select(F.col("id").alias(id_col), "training", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte")


def _numbers() -> defaultdict[bytes, int]:
    """Numbers words as they come."""
    return defaultdict(itertools.count().__next__)


def _packer(chunk_bytes: int, ids):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(ids)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 30
        own_ids: list = []
        flags: list = []
        numbers = _numbers()
        tokens: list[np.ndarray] = []
        held = 0

        def out() -> pa.RecordBatch:
            starts = np.r_[0, np.cumsum([len(t) for t in tokens])].astype(np.int64)
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
            cols = [pa.array([number], pa.int64()), pa.array([own_ids], pa.list_(kind)), pa.array([flags], pa.list_(pa.bool_()))]
            cols += [pa.array([x], pa.binary()) for x in (_squeezed(flat), _squeezed(starts), _squeezed(BLANK.join(numbers)))]
            return pa.RecordBatch.from_arrays(cols, names=["chunk", "ids", "training", "tokens", "starts", "words"])

        for batch in batches:
            for key, flag, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = (value.as_py() or "").encode("utf-8", "replace").lower().split()
                tokens.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                own_ids.append(key)
                flags.append(flag)
                held += sum(map(len, words)) + 16
                if held >= chunk_bytes:
                    yield out()
                    number, own_ids, flags, numbers, tokens, held = number + 1, [], [], _numbers(), [], 0
        if own_ids:
            yield out()

    return pack


def _squeezed(x: np.ndarray | bytes) -> bytes:
    """zstd; of numbers the bytes of one weight together, which packs better."""
    import zstandard

    raw = x if isinstance(x, bytes) else np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _opened(x: bytes, kind) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8) if x else np.zeros(0, np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _words_of(x: bytes) -> list[bytes]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(x) if x else b""
    return raw.split(BLANK) if raw else []


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield {name: batch.column(name)[i] if name == "answers" else batch.column(name)[i].as_py() for name in batch.schema.names}


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts among training rows of the words and of the end."""
    for row in _rows(batches):
        tokens, starts, words = _opened(row["tokens"], np.int32), _opened(row["starts"], np.int64), _words_of(row["words"])
        train = np.array(row["training"], bool)
        counts = np.bincount(tokens[np.repeat(train, np.diff(starts))], minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array([*words, END], pa.binary()), pa.array(np.r_[counts, train.sum()].astype(np.int64))], names=["word", "n"])


def _asker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        words = [*_words_of(row["words"]), END]  # the end comes last
        yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]] * len(words), pa.int64()), pa.array(range(len(words)), pa.int32()), pa.array(words, pa.binary())], names=["chunk", "number", "word"])


def _coder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunk with count, hash and length of each word in place of the words; only unknown ones keep their letters."""
    import zlib

    kept = ["ids", "training", "tokens", "starts"]
    for batch in batches:
        for i in range(len(batch)):
            words = [*_words_of(batch.column("words")[i].as_py()), END]
            n = np.zeros(len(words), np.int64)
            got = batch.column("answers")[i].values
            n[got.field(0).to_numpy()] = got.field(1).to_numpy()
            hashes = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
            sizes = np.fromiter(map(len, words), np.int32, len(words)) + 1
            sizes[-1] = 1
            new = (_squeezed(n), _squeezed(hashes), _squeezed(sizes.astype(np.int32)), _squeezed(BLANK.join(words[k] for k in np.flatnonzero(n == 0))))
            one = batch.slice(i, 1)
            yield pa.RecordBatch.from_arrays([*(one.column(k) for k in kept), *(pa.array([x], pa.binary()) for x in new)], names=[*kept, "counts", "hashes", "sizes", "unknown"])


def _alike(starts: np.ndarray, which: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """The texts `which` in groups of like length, of about `most` tokens each."""
    order = which[np.argsort(np.diff(starts)[which], kind="stable")]
    held = np.cumsum(np.diff(starts)[order] + 1)
    yield from np.split(order, np.flatnonzero(np.diff(held // most)) + 1) if len(order) else ()


def _growing(starts: np.ndarray, which: np.ndarray, most: int, read: int) -> Iterator[np.ndarray]:
    """The texts `which` in their order, in groups of a quarter of what has been read before, up to `most` tokens."""
    group, held = [], 0
    for k in which:
        group.append(k)
        held += int(starts[k + 1] - starts[k]) + 1
        if held >= min(most, max(2000, read // 4)):
            yield np.array(group)
            group, held, read = [], 0, read + held
    if group:
        yield np.array(group)


def _batches_of(words: list[bytes], most_bytes: int = 40_000) -> Iterator[slice]:
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
    cuts = [0, *(np.flatnonzero(np.diff(ends // most_bytes)) + 1).tolist(), len(words)]
    yield from (slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a)


def _told(counts: list[np.ndarray], mixer: Mixer, seen: int, block: int = 8192) -> Iterator[pa.RecordBatch]:
    """What a task has learned, as vectors that add up: blocks of counts, weights times the bits they were learned on, hits."""
    if not seen:
        return
    for f, table in enumerate(counts):
        flat = np.append(table.reshape(-1), np.zeros(-table.size % block, np.float32)).reshape(-1, block)
        for i in np.flatnonzero(flat.any(1)):
            yield batch_of({(f << 32) + int(i): flat[i]})
    yield batch_of({-1: np.r_[mixer.weights.ravel() * float(seen), seen], -2: mixer.hits.ravel()})


def _heard(rows: DataFrame, counts: list[np.ndarray], mixer: Mixer, block: int = 8192) -> None:
    """Adds up what the tasks have told, into counts and mixer; as many rows as the tables have blocks come to the driver."""
    for name, vector in add_up(rows):
        if name == -1:
            mixer.weights = (vector[:-1] / vector[-1]).reshape(mixer.weights.shape).astype(np.float32)
        elif name == -2:
            mixer.hits = vector.reshape(mixer.hits.shape)
        else:
            f, i = name >> 32, name & 0xFFFFFFFF
            flat = counts[f].reshape(-1)
            piece = flat[i * block : (i + 1) * block]
            piece[:] = vector[: len(piece)]


def _code_from(coded: DataFrame, model: CodeModel, group_tokens: int) -> CodeModel:
    """The model after all training texts."""
    classes, masses, prior = model.classes, model.masses, model.prior

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = CodeModel(classes, masses, prior), 0
        for row in _rows(batches):
            tokens, starts = _opened(row["tokens"], np.int32), _opened(row["starts"], np.int64)
            n, hashes = _opened(row["counts"], np.int64), _opened(row["hashes"], np.uint32)
            size = size_of(n)
            for group in _growing(starts, np.flatnonzero(np.array(row["training"], bool)), group_tokens, seen):
                reading = Reading([tokens[starts[k] : starts[k + 1]] for k in group], n, hashes, None, own, size)
                reading.teach(reading.inputs(own.counts), own.mixer)
                reading.learn(own)
                seen += len(reading.token)
        yield from _told(own.counts, own.mixer, seen)

    _heard(coded.mapInArrow(learn, SHAPE), model.counts, model.mixer)
    return model


def _spelling_from(words: DataFrame) -> SpellingModel:
    """The spelling of all training words, each once."""
    model = SpellingModel()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = SpellingModel(), 0
        for batch in batches:
            found = batch.column(0).to_pylist()
            for at in _batches_of(found):
                own.read(found[at], learn=True)
                seen += 8 * sum(map(len, found[at]))
        yield from _told(own.counts, own.mixer, seen)

    _heard(words.where("n > 0").select("word").mapInArrow(learn, SHAPE), model.counts, model.mixer)
    return model


def _text_scorer(held, n_train: int, v_train: int, ids, group_tokens: int):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling, model, stretched = held.value
        for row in _rows(batches):
            tokens, starts = _opened(row["tokens"], np.int32), _opened(row["starts"], np.int64)
            n, hashes = _opened(row["counts"], np.int64), _opened(row["hashes"], np.uint32)
            sizes = _opened(row["sizes"], np.int32)
            unknown, spelled = _words_of(row["unknown"]), np.zeros(len(n))
            if unknown:
                spelled[n == 0] = np.concatenate([spelling.read(unknown[at], learn=False) for at in _batches_of(unknown)])
            bits, size = np.zeros(len(starts) - 1), size_of(n)
            for group in _alike(starts, np.arange(len(bits)), group_tokens):
                reading = Reading([tokens[starts[k] : starts[k + 1]] for k in group], n, hashes, spelled, model, size)
                bits[group] = reading.bits(reading.inputs(stretched), model.mixer, adapt=True)
            base = np.log10((n + 0.1) / (n_train + 0.1 * (v_train + 1)))
            of_text = np.repeat(np.arange(len(bits)), np.diff(starts))
            add = lambda x: np.bincount(of_text, x[tokens], len(bits)) + x[-1]
            cols = [
                pa.array(row["ids"], kind), pa.array(row["training"], pa.bool_()), pa.array(np.diff(starts) + 1), pa.array(add((n > 0).astype(float)).astype(np.int64)),
                pa.array(add(base)), pa.array(bits * np.log10(2)), pa.array(-bits / add(sizes.astype(float))),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "training", "n_tokens", "n_known", "base_score", "score", "bits_per_byte"])

    return run
