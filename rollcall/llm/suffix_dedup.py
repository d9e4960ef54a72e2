"""Removal of repeated byte strings by a sparse suffix array that is sorted across the cluster.

Suffixes begin at anchors: in every string of `length` bytes, the place of the smallest hash of GRAM bytes. Equal strings
have equal anchors at equal places, so all repeats of `length` bytes meet at anchors, and one byte in about eighteen is
one. Anchors whose gram occurs in one document only are set aside by an exchange of short hashes. The suffixes of the
others are sorted within their chunk, front-coded and sent, and the runs of a part of the gram space are merged by a loser
tree that carries common prefixes: bytes known to be equal are never compared again. The merge gives the array and its
longest common prefixes, and from these and the bytes left of the anchors it follows which strings a smaller document has.
A suffix carries no more bytes, to the right and to the left, than the strings of its anchor reach.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import discard, materialize

U = np.uint64
GRAM = 16
#: Side tables up to this size are broadcast to the chunks; larger ones are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
NO_ID = np.iinfo(np.int64).max
#: Rows of chunks that are written, and read again, together.
CHUNKS_AT_ONCE = 8


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 50, chunk_bytes: int = 2 << 20, part_bytes: int = 16 << 20, keep_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept][, carried]) for every row of docs.

    carried: a struct of the row's columns named in carry; other columns are not read.

    Removes each byte covered by a string of `length` bytes that also starts in a row with a smaller id; strings are
    those of the input, and matches stay within a row. n_spans: maximal removed runs; kept: the remaining bytes as text
    (invalid pieces of a cut character become U+FFFD). Null and empty texts have no bytes. Rows with equal ids don't
    remove from each other; rows with a null id count as the largest. An empty table gives no rows. A text lies in one
    chunk, whatever its length, and a task holds about forty bytes for each byte of its chunk.
    """
    assert length > GRAM and length - GRAM < 64, "a string must be longer than a gram by less than 64 bytes"
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *([F.struct(*carry).alias("carried")] if carry else []))
    more = [T.StructField("carried", T.ArrayType(source.schema["carried"].dataType))] if carry else []
    packed = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("size", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("body", T.BinaryType()), *more])
    chunks = materialize(source.mapInArrow(_packer(chunk_bytes), packed), "chunks", CHUNKS_AT_ONCE)
    total = chunks.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-total // part_bytes))
    sent = chunks.select("chunk", "lengths", "body").mapInArrow(_hash_sender(length, parts), "part int, chunk long, hashes binary")
    repeated = sent.groupBy("part").applyInArrow(_find_repeated, "part int, chunk long, bits binary")
    bits = materialize(repeated.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias("found")), "repeated-grams")
    # a struct takes forty bytes beside its bits
    open_chunks = _beside(chunks.select("chunk", "ids", "lengths", "body"), bits, F.expr("aggregate(found, 0L, (s, x) -> s + length(x.bits) + 40)"))
    runs = materialize(open_chunks.mapInArrow(_run_builder(length, parts), "chunk long, places binary, runs array<struct<part: int, data: binary>>"), "suffix-runs", CHUNKS_AT_ONCE)
    merged = runs.select("chunk", F.explode("runs").alias("r")).select("chunk", "r.part", "r.data").groupBy("part").applyInArrow(_merger(length), "part int, chunk long, masks binary")
    answers = merged.groupBy("chunk").agg(F.collect_list(F.struct("part", "masks")).alias("answers"))
    spans = materialize(runs.select("chunk", "places").join(answers, "chunk").mapInArrow(_span_finder(length), "chunk long, spans binary"), "spans")
    discard(runs, bits)
    shape = T.StructType([*(T.StructField(n, T.LongType()) for n in ("id", "n_bytes", "n_removed", "n_spans")), *(T.StructField(n, T.StringType()) for n in ("kept_sha256", "kept")[: 1 + keep_text])])
    if carry:
        shape = shape.add("carried", source.schema["carried"].dataType)
    done = _beside(chunks.drop("size"), spans, F.length("spans"), "left").mapInArrow(_finisher(length, keep_text), shape)
    return done.withColumnRenamed("id", id_col)


def _beside(chunks: DataFrame, side: DataFrame, size, how: str = "inner") -> DataFrame:
    held = side.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    return chunks.join(F.broadcast(side) if held <= BROADCAST_BYTES else side, "chunk", how)


def _packer(chunk_bytes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        squeeze = zstandard.ZstdCompressor(level=3).compress
        number = TaskContext.get().partitionId() << 30
        ids, texts, carried, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            lengths = [len(t) for t in texts]
            cols = [pa.array([number], pa.int64()), pa.array([held], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())), pa.array([squeeze(b"".join(texts))], pa.binary())]
            if carried:
                cols.append(pa.ListArray.from_arrays(pa.array([0, len(carried)], pa.int32()), pa.concat_arrays(carried)))
            return pa.RecordBatch.from_arrays(cols, names=["chunk", "size", "ids", "lengths", "body", "carried"][: len(cols)])

        for batch in batches:
            for i, (key, value) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                text = (value.as_py() or "").encode("utf-8", "surrogatepass")
                if texts and held + len(text) > chunk_bytes:
                    yield out()
                    number, ids, texts, carried, held = number + 1, [], [], [], 0
                ids.append(key)
                texts.append(text)
                if batch.num_columns > 2:
                    carried.append(batch.column(2).slice(i, 1))
                held += len(text)
        if texts:
            yield out()

    return pack


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's bytes and the first place of each of its rows, with the end."""
    import zstandard

    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["body"]), np.uint8) if row["body"] else np.zeros(0, np.uint8)
    return body, np.r_[0, np.cumsum(np.array(row["lengths"], np.int64))]


def gram_hashes(body: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on, by doubling."""
    table = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.int64).view(U) | U(1)
    h, factor, span = table[body], U(0x9E3779B97F4A7C15), 1
    with np.errstate(over="ignore"):
        while span < GRAM:
            h = h[:-span] * factor + h[span:]
            factor, span = factor * factor, span * 2
        h ^= h >> U(29)
        h *= U(0xBF58476D1CE4E5B9)
        h ^= h >> U(32)
    return h


def anchors(body: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, first string, last string) of each anchor: it is the leftmost smallest gram of those strings."""
    empty = np.zeros(0, np.int64)
    n = len(body) - length + 1
    if n <= 0:
        return empty, empty.view(U), empty, empty
    h = gram_hashes(body)
    low = (h & U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=U)  # hash above place: one minimum finds both
    reach, span = length - GRAM + 1, 1
    while span * 2 <= reach:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < reach:
        low = np.minimum(low[: n], low[reach - span : reach - span + n])
    low = (low[:n] & U(0xFFFFFFFF)).astype(np.int64)
    whole = np.zeros(n + 1, bool)  # strings that lie within one row
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= length:
            whole[a : b - length + 1] = True
    whole = whole[:n]
    new = whole & np.r_[True, (low[1:] != low[:-1]) | ~whole[:-1]]
    end = whole & np.r_[(low[1:] != low[:-1]) | ~whole[1:], True]
    first, last = np.flatnonzero(new), np.flatnonzero(end)
    place = low[first]
    return place, h[place], first, last


def _part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> U(32)) % U(parts)).astype(np.int64)


def _short(h: np.ndarray) -> np.ndarray:
    """31 bits of a hash that its part doesn't hold, and room for a flag."""
    return (h & U(0x7FFFFFFF)).astype(np.uint32) << np.uint32(1)


def _distinct(body: np.ndarray, bounds: np.ndarray, length: int, parts: int) -> tuple:
    """A chunk's anchors, and its distinct (part, short hash) in order, flagged where two rows of the chunk have them."""
    place, h, first, last = anchors(body, bounds, length)
    key = (_part_of(h, parts).astype(U) << U(32)) | _short(h).astype(U)
    keys, back = np.unique(key, return_inverse=True)
    row = np.searchsorted(bounds, place, side="right") - 1
    least, most = np.full(len(keys), NO_ID), np.full(len(keys), -1)
    np.minimum.at(least, back, row)
    np.maximum.at(most, back, row)
    return place, first, last, row, back, keys | (least != most).astype(U)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield {name: batch.column(name)[i] if name == "carried" else batch.column(name)[i].as_py() for name in batch.schema.names}


def _hash_sender(length: int, parts: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            body, bounds = _unpack(row)
            keys = _distinct(body, bounds, length, parts)[-1]
            part = (keys >> U(32)).astype(np.int64)
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
            pieces = np.split((keys & U(0xFFFFFFFF)).astype(np.uint32), cuts[1:]) if len(cuts) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cuts], pa.int32()), pa.array([row["chunk"]] * len(cuts), pa.int64()), pa.array([p.tobytes() for p in pieces], pa.binary())], names=["part", "chunk", "hashes"]
            )

    return send


def _find_repeated(t: pa.Table) -> pa.Table:
    """For each chunk's hashes of one part: a bit each, set if another chunk, or another row of the chunk, has the hash."""
    pieces = [np.frombuffer(x.as_py(), np.uint32) for x in t["hashes"]]
    every = np.concatenate(pieces)
    _, back, count = np.unique(every >> np.uint32(1), return_inverse=True, return_counts=True)
    found = (count[back] > 1) | (every & np.uint32(1)).astype(bool)
    bits = np.split(found, np.cumsum([len(p) for p in pieces])[:-1])
    keep = [i for i, b in enumerate(bits) if b.any()]
    rows = pa.array(keep, pa.int64())
    return pa.table({"part": t["part"].take(rows), "chunk": t["chunk"].take(rows), "bits": pa.array([np.packbits(bits[i]).tobytes() for i in keep], pa.binary())})


def _run_builder(length: int, parts: int):
    left = length - GRAM

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for row in _rows(batches):
            body, bounds = _unpack(row)
            place, first, last, at_row, back, keys = _distinct(body, bounds, length, parts)
            part = (keys >> U(32)).astype(np.int64)
            good = np.zeros(len(keys), bool)
            begins = np.searchsorted(part, np.arange(parts + 1))
            for f in row["found"]:
                a, b = begins[f["part"]], begins[f["part"] + 1]
                good[a:b] = np.unpackbits(np.frombuffer(f["bits"], np.uint8), count=b - a).astype(bool)
            use = good[back]
            place, first, last, at_row, of_part = place[use], first[use], last[use], at_row[use], part[back[use]]
            ids = np.array([NO_ID if x is None else x for x in row["ids"]], np.int64)[at_row]
            around = np.zeros(len(body) + 2 * length, np.uint8)
            around[length : length + len(body)] = body
            # the suffix, then the bytes to its left from right to left: as many as the anchor's own strings reach, which
            # lie within the row; what lies beyond is blanked
            low, high = place - last, place - first
            context = np.empty((len(place), length + left + 2), np.uint8)
            step = np.arange(length)
            context[:, :length] = around[place[:, None] + length + step] * (step < (length - low)[:, None])
            step = np.arange(left)
            context[:, length : length + left] = around[place[:, None] + length - 1 - step] * (step < high[:, None])
            context[:, -2], context[:, -1] = low, high

            order = np.lexsort((ids, _ranks(context), of_part))
            same = np.r_[False, (context[order[1:]] == context[order[:-1]]).all(1)] if len(order) else np.zeros(0, bool)
            leader = np.cumsum(~same) - 1
            rep = order[~same]  # the smallest id of each distinct context
            which = np.empty(len(order), np.int64)
            which[order] = leader
            later = ids > ids[rep][which]  # the chunk itself has the context in a smaller row
            places = [place.astype(np.int32), first.astype(np.int32), last.astype(np.int32), which.astype(np.int32), later.astype(np.uint8)]
            runs, rep_part = [], of_part[rep]
            cuts = np.flatnonzero(np.r_[True, rep_part[1:] != rep_part[:-1]]) if len(rep) else np.zeros(0, np.int64)
            for a, b in zip(cuts, np.r_[cuts[1:], len(rep)], strict=True):
                mine = rep[a:b]
                c = context[mine]
                lcp = np.r_[0, _common_prefix(c[1:, :length], c[:-1, :length])].astype(np.uint8)
                step = np.arange(length)
                tails = c[:, :length][(step >= lcp[:, None]) & (step < length - c[:, -2:-1].astype(np.int64))]
                lefts = c[:, length : length + left][np.arange(left) < c[:, -1:]]
                data = b"".join(x.tobytes() for x in (lcp, c[:, -2], c[:, -1], ids[mine], lefts, tails))
                runs.append({"part": int(rep_part[a]), "data": len(mine).to_bytes(4, "little") + squeeze(data)})
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["chunk"]], pa.int64()), pa.array([len(place).to_bytes(4, "little") + squeeze(b"".join(x.tobytes() for x in places))], pa.binary()), pa.array([runs], pa.list_(pa.struct([("part", pa.int32()), ("data", pa.binary())])))],
                names=["chunk", "places", "runs"],
            )

    return build


def _ranks(context: np.ndarray) -> np.ndarray:
    """The rank of each row of bytes in the order of all."""
    rank = np.empty(len(context), np.int64)
    if len(context):
        wide = np.zeros((len(context), -(-context.shape[1] // 8) * 8), np.uint8)
        wide[:, : context.shape[1]] = context
        words = wide.view(">u8").astype(U)
        order = np.lexsort(words.T[::-1])
        new = np.r_[0, (words[order[1:]] != words[order[:-1]]).any(1)]
        rank[order] = np.cumsum(new)
    return rank


def _common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differ = a != b
    return np.where(differ.any(1), differ.argmax(1), a.shape[1]) if len(a) else np.zeros(0, np.int64)


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Merges sorted runs of (strings, common prefix of each with the one before): the run of each output, and its common
    prefix with the output before.

    A loser tree. Every loser keeps its common prefix with the string it lost to, which is the last output for all nodes
    on the way up from the run that gave it. So of two contenders the one with the longer prefix is smaller, unseen; only
    if the prefixes are equally long are bytes compared, and only those after them.
    """
    k = max(1, len(runs))
    size = 1 << (k - 1).bit_length()
    strings = [r[0] for r in runs]
    prefix = [r[1] for r in runs]
    ends = [len(s) for s in strings]
    at = [0] * k
    loser, held = [-1] * size, [0] * size  # loser and its common prefix with the winner that passed

    def play(node: int) -> tuple[int, int]:
        """The winner below node, with common prefix 0 (nothing is out yet)."""
        if node >= size:
            run = node - size
            return (run, 0) if run < k and ends[run] else (-1, 0)
        (a, ha), (b, hb) = play(2 * node), play(2 * node + 1)
        if a < 0 or b < 0:
            loser[node] = -1
            return (b, hb) if a < 0 else (a, ha)
        x, y = strings[a][0], strings[b][0]
        common = _prefix_from(x, y, 0)
        if x <= y:
            loser[node], held[node] = b, common
            return a, ha
        loser[node], held[node] = a, common
        return b, hb

    run, h = play(1)
    out, common_with_last = [], []
    while run >= 0:
        out.append(run)
        common_with_last.append(h)
        node = (run + size) >> 1
        at[run] += 1
        if at[run] < ends[run]:
            now, h = run, prefix[run][at[run]]
        else:
            now, h = -1, -1
        while node:
            other = loser[node]
            if other >= 0:
                ho = held[node]
                if now < 0 or ho > h:
                    loser[node], held[node], now, h = now, h, other, ho
                elif ho == h:
                    x, y = strings[now][at[now]], strings[other][at[other]]
                    common = _prefix_from(x, y, h)
                    if x[common : common + 1] <= y[common : common + 1]:
                        held[node] = common
                    else:
                        loser[node], held[node], now = now, common, other
            node >>= 1
        run = now
    return out, common_with_last


def _prefix_from(x: bytes, y: bytes, start: int) -> int:
    """The common prefix of two strings of one length that agree up to start."""
    a, b = x[start:], y[start:]
    if a == b:
        return len(x)
    differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return start + len(a) - (differ.bit_length() + 7) // 8


def _merger(length: int):
    left = length - GRAM

    def read(data: bytes) -> tuple:
        import zstandard

        n = int.from_bytes(data[:4], "little")
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[4:]), np.uint8)
        lcp, low, high = raw[:n], raw[n : 2 * n], raw[2 * n : 3 * n]
        ids = raw[3 * n : 11 * n].view(np.int64) if raw[3 * n : 11 * n].flags.aligned else np.frombuffer(raw[3 * n : 11 * n].tobytes(), np.int64)
        lefts = np.zeros((n, left), np.uint8)
        held = np.arange(left) < high[:, None]
        lefts[held] = raw[11 * n : 11 * n + held.sum()]
        tails = raw[11 * n + held.sum() :].tobytes()
        strings, s, at = [], b"", 0
        for h, blank in zip(lcp.tolist(), low.tolist(), strict=True):
            more = max(0, length - blank - h)
            s = (s[:h] + tails[at : at + more]).ljust(length, b"\0")
            at += more
            strings.append(s)
        return strings, lcp.tolist(), low, high, ids, lefts

    def merge(t: pa.Table) -> pa.Table:
        runs = [read(x.as_py()) for x in t["data"]]
        sizes = [len(r[0]) for r in runs]
        which, common = merge_runs([(r[0], r[1]) for r in runs])
        which, common = np.array(which, np.int64), np.array(common, np.int64)
        where = np.empty(len(which), np.int64)  # of each output: its place in the runs one after another
        where[np.argsort(which, kind="stable")] = np.arange(len(which))
        low, high, ids, lefts = (np.concatenate([r[i] for r in runs])[where] for i in (2, 3, 4, 5))
        masks = match_masks(common, low, high, ids, lefts, length)
        out = np.empty(len(masks), U)
        out[where] = masks
        pieces = np.split(out, np.cumsum(sizes)[:-1])
        return pa.table({"part": t["part"], "chunk": t["chunk"], "masks": pa.array([p.tobytes() for p in pieces], pa.binary())})

    return merge


def match_masks(common: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray, lefts: np.ndarray, length: int) -> np.ndarray:
    """Bit l of a suffix: the string that begins l bytes before it occurs in a smaller row.

    Such strings are equal if length - l bytes from the anchor on are, which the common prefixes tell exactly, and the l
    bytes before it: a 64-bit hash brings them together among suffixes of one class, and the bytes decide.
    """
    out, h = np.zeros(len(ids), U), np.zeros(len(ids), U)
    for l in range(length - GRAM + 1):
        if l:
            with np.errstate(over="ignore"):
                h = (h ^ (lefts[:, l - 1].astype(U) + U(1))) * U(0x9E3779B97F4A7C15)
                h ^= h >> U(32)
        rows = np.flatnonzero((low <= l) & (l <= high))
        if not len(rows):
            continue
        # classes over all suffixes, so that a common prefix is the least of those passed on the way
        group = np.cumsum(common < length - l)[rows]
        order = np.lexsort((h[rows], group))
        g, hh, d, own = group[order], h[rows][order], ids[rows][order], lefts[rows[order], :l]
        new = (g[1:] != g[:-1]) | (hh[1:] != hh[:-1])
        if (~new & (own[1:] != own[:-1]).any(1)).any():  # one hash, other bytes: sort by the bytes themselves
            order = np.lexsort((*lefts[rows, :l].T, group))
            g, d, own = group[order], ids[rows][order], lefts[rows[order], :l]
            new = (g[1:] != g[:-1]) | (own[1:] != own[:-1]).any(1)
        starts = np.flatnonzero(np.r_[True, new])
        least = np.repeat(np.minimum.reduceat(d, starts), np.diff(np.r_[starts, len(d)]))
        out[rows[order[d > least]]] |= U(1) << U(l)
    return out


def _span_finder(length: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for row in _rows(batches):
            n = int.from_bytes(row["places"][:4], "little")
            raw = zstandard.ZstdDecompressor().decompress(row["places"][4:])
            place, first, last, which = (np.frombuffer(raw[4 * n * i : 4 * n * (i + 1)], np.int32).astype(np.int64) for i in range(4))
            later = np.frombuffer(raw[16 * n :], np.uint8).astype(bool)
            masks = np.concatenate([np.frombuffer(a["masks"], U) for a in sorted(row["answers"], key=lambda a: a["part"])])[which]
            every = np.where(later, ~U(0), masks)
            starts = []
            for l in range(length - GRAM + 1):
                at = place - l
                starts.append(at[((every >> U(l)) & U(1)).astype(bool) & (first <= at) & (at <= last)])
            starts = np.sort(np.concatenate(starts))
            if len(starts):
                cut = np.flatnonzero(np.diff(starts) > 1)
                spans = np.stack([starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]] + length], 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]], pa.int64()), pa.array([spans.tobytes()], pa.binary())], names=["chunk", "spans"])

    return find


def _finisher(length: int, keep_text: bool):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            body, bounds = _unpack(row)
            gone = np.zeros(len(body) + 1, np.int32)
            spans = np.frombuffer(row["spans"] or b"", np.int32).reshape(-1, 2)
            np.add.at(gone, spans[:, 0], 1)
            np.add.at(gone, spans[:, 1], -1)
            gone = np.cumsum(gone)[:-1] > 0
            out = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                cut = gone[a:b]
                kept = body[a:b][~cut].tobytes()
                out.append((b - a, int(cut.sum()), int(cut[:1].sum() + (cut[1:] & ~cut[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept))
            cols = [pa.array(row["ids"], pa.int64()), *(pa.array([o[i] for o in out], pa.int64()) for i in range(3)), pa.array([o[3] for o in out], pa.string())]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                cols.append(pa.array([o[4].decode("utf-8", "replace") for o in out], pa.string()))
                names.append("kept")
            if "carried" in row:
                cols.append(row["carried"].values)
                names.append("carried")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return finish


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """docs, all columns and rows, with the repeated strings taken out of text_col; length_col, if docs has it, follows.

    A text that was nothing but repeats becomes empty, a null text stays null.
    """
    done = remove_repeats(docs, id_col=id_col, text_col=text_col, keep_text=True, carry=tuple(docs.columns), **options)
    text = F.when(F.col("carried")[text_col].isNotNull(), F.col("kept"))
    new = {text_col: text, **({length_col: F.length(text).cast(docs.schema[length_col].dataType)} if length_col in docs.columns else {})}
    return done.select(*(F.coalesce(new[c], F.col("carried")[c]).alias(c) if c == length_col and c in new else new.get(c, F.col("carried")[c]).alias(c) for c in docs.columns))
