"""Near-duplicate documents: ProbMinHash over weighted word shingles, banding, exact verification, components.

Documents with equal shingle sets fold into one representative first. Every representative is verified against one other,
the bucket leader with which it shares the most bands. Then, in two rounds, the components that meet in a bucket send a
pair each: the number of pairs grows with the members, not with their square. What is left, members of one bucket in
different components, is compared in blocks of signatures; pairs whose estimate can reach the threshold are verified
inside the block by their exact shingles, and only a spanning forest of links leaves it. So no link that would join two
classes is lost to the rounds before, and no group writes out its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import arrow_rows, discard, materialize
from ..operators.graph import connected_components as components
from .shingles import WordHashes, band_keys, prob_minhash, similarities, weighted

#: Ids up to this number are broadcast to a scan of the texts (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Rows of one key from which a join deals the key's rows out to several tasks.
HOT_ROWS = 1_000
#: Rows that Python gets at once: of texts, and of pairs of blocks, which may hold a megabyte each.
TEXT_ROWS, BLOCK_ROWS = 512, 8


def near_duplicate_classes(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    threshold: float = 0.8,
    bands: int = 34,
    rows: int = 7,
    weighting: str = "log",
    slack: float = 0.1,
    block_rows: int = 128,
    rounds: int = 2,
) -> DataFrame:
    """(id, class_id, kept, n_shingles) for every row of docs with a non-null id; other columns are not read.

    class_id: the smallest id within reach of links; kept: the row has that id. Two texts are linked if the
    probability Jaccard of their weighted shingles is at least threshold. A pair that the bands bring together is also
    linked if only the plain Jaccard of its shingle sets is, but such pairs are not all looked for: one that repeats much
    of its text has a lower weighted similarity, and may be missed. Words are lower-cased
    and parted by white space; texts under `width` words are one shingle. Texts without a word (null, empty, blank) link
    with nothing. Rows that repeat an id stay rows, in one class, and each of their texts links. An empty table gives no
    rows. Whole texts count.
    A pair whose weighted similarity is the threshold shares a band with probability 1 - (1 - threshold^rows)^bands (0.9997 by default).
    """
    source = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = _in_batches(source.mapInArrow(_signer(width, bands, rows, weighting), "id long, digest binary, n int, keys array<long>, signature binary"), "signatures", TEXT_ROWS)
    light = signed.select("id", "digest", "n")
    classes = materialize(light.where("n > 0").groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("members")), "text-classes")
    belongs = materialize(_representatives(light, classes), "belongs")
    # the digest's own rows with its smallest id: dealt by both columns, so that no text's copies meet in one task
    reps = signed.join(classes.select("digest", F.col("rep").alias("id")), ["digest", "id"], "left_semi").dropDuplicates(["digest", "id"])
    entries = materialize(reps.select("id", "n", F.posexplode("keys").alias("band", "key")), "band-entries")
    leaders = entries.groupBy("key").agg(F.min(F.struct("id", "n")).alias("leader"), F.count(F.lit(1)).alias("size")).where("size > 1")
    full = materialize(entries.join(leaders, "key"), "full-buckets")
    discard(entries)
    fits = (F.col("n") >= threshold * 0.5 * F.col("leader.n")) & (F.col("leader.n") >= threshold * 0.5 * F.col("n")) & (F.col("id") != F.col("leader.id"))
    votes = full.where(fits).groupBy("id", F.col("leader.id").alias("other")).agg(F.count(F.lit(1)).alias("shared"))
    first = votes.groupBy("id").agg(F.max_by("other", F.struct("shared", -F.col("other"))).alias("other"))
    verify = lambda pairs: _verified(pairs, source, width, threshold, weighting)
    tried = materialize(first.select("id", "other"), "pairs")
    links = verify(tried)
    parts = components(links, "id", "other")
    member = _placed(full, parts)
    for turn in range(rounds):
        pairs = materialize(_between_components(member, threshold, every=turn > 0).join(tried, ["id", "other"], "left_anti"), "pairs")
        found = verify(pairs) if not pairs.isEmpty() else pairs
        tried = tried.unionByName(pairs)
        if not found.isEmpty():
            links = links.unionByName(found)
            parts = components(links, "id", "other")
            member = _placed(full, parts)
    more = _across(member, signed, source, width, threshold, weighting, slack, block_rows, rows)
    if not more.isEmpty():
        parts = components(links.unionByName(more), "id", "other")
    discard(signed, classes, full)
    out = belongs.join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
    class_id = F.coalesce("component", "rep")
    return out.select(F.col("id").alias(id_col), class_id.alias("class_id"), (class_id == F.col("id")).alias("kept"), F.col("n").cast("long").alias("n_shingles"))


def _in_batches(df: DataFrame, tag: str, rows: int) -> DataFrame:
    with arrow_rows(df.sparkSession, rows):
        return materialize(df, tag)


def _representatives(light: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, n, rep) for every row: rep is the smallest id with the row's digest. Digests of many rows are looked up, not shuffled."""
    hot = classes.where(F.col("members") > HOT_ROWS).select("digest", "rep")
    plain = light.join(classes.select("digest", "rep"), "digest", "left")
    if 0 < hot.count() <= BROADCAST_IDS:
        looked_up = light.join(F.broadcast(hot), "digest", "left").withColumnRenamed("rep", "known")
        rest = looked_up.where("known IS NULL").join(classes.where(F.col("members") <= HOT_ROWS).select("digest", "rep"), "digest", "left")
        plain = looked_up.where("known IS NOT NULL").withColumnRenamed("known", "rep").unionByName(rest.drop("known"))
    return plain.select("id", "n", F.coalesce("rep", "id").alias("rep"))


def _placed(full: DataFrame, parts: DataFrame) -> DataFrame:
    """The bucket entries with their components as they stand."""
    return full.join(parts.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))


def _between_components(member: DataFrame, threshold: float, every: bool) -> DataFrame:
    """(id, other), id > other: a pair for each two components of which one leads a bucket of the other; every: one in each such bucket."""
    of_bucket = member.groupBy("key", "component").agg(F.min(F.struct("id", "n")).alias("m"))
    head = of_bucket.groupBy("key").agg(F.min(F.struct("component", "m")).alias("head"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    met = of_bucket.join(head, "key").where(F.col("component") != F.col("head.component"))
    fits = (F.col("m.n") >= threshold * 0.5 * F.col("head.m.n")) & (F.col("head.m.n") >= threshold * 0.5 * F.col("m.n"))
    pair = F.struct(F.greatest("m.id", "head.m.id").alias("id"), F.least("m.id", "head.m.id").alias("other"))
    met = met.where(fits)
    if every:
        return met.select(pair.alias("pair")).select("pair.*").distinct()
    return met.groupBy("component", F.col("head.component").alias("leading")).agg(F.min(pair).alias("pair")).select("pair.*").distinct()


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs, all columns, of which one is left for each class of near_duplicate_classes.

    The row with the smallest id stays; of rows that share this id the first by all columns' text stays. Rows with a null
    id are in no class and stay.
    """
    own = "__rollcall_id"
    classes = materialize(near_duplicate_classes(docs, id_col=id_col, **options).select(F.col(id_col).alias(own), "kept"), "classes")
    twice = classes.where("kept").groupBy(own).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(own)
    gone = materialize(classes.where("NOT kept").select(own).unionByName(twice).distinct(), "dropped-ids")
    key = F.col(id_col).cast("long")
    out = docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, key == F.col(own), "left_anti")
    if twice.isEmpty():
        return out
    text = F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in docs.columns))
    again = docs.join(twice, key == F.col(own), "left_semi")
    first = again.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(text))).where(F.col("__rank") == 1)
    return out.unionByName(first.drop("__rank"))


def _signer(width: int, bands: int, rows: int, weighting: str):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        hashes = WordHashes()
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                sets = [weighted(t.as_py(), width, hashes, weighting) for t in batch.column(1)]
                signature = prob_minhash(sets, bands * rows)
                keys = band_keys(signature, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s, _ in sets], pa.binary()),
                        pa.array([len(s) for s, _ in sets], pa.int32()),
                        pa.array([k if len(s) else k[:0] for (s, _), k in zip(sets, keys, strict=True)], pa.list_(pa.int64())),
                        pa.array([x.tobytes() for x in signature.astype(np.uint16)], pa.binary()),
                    ],
                    names=["id", "digest", "n", "keys", "signature"],
                )

    return sign


def _verified(pairs: DataFrame, source: DataFrame, width: int, threshold: float, weighting: str) -> DataFrame:
    """The pairs (id, other) whose texts are at least threshold alike, by their exact shingles, as a written table, as pairs are."""
    ids = materialize(pairs.select("id").unionByName(pairs.select(F.col("other").alias("id"))).distinct(), "pair-ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = materialize(source.join(wanted, "id").withColumn("of_text", F.xxhash64("text")).dropDuplicates(["id", "of_text"]).select("id", "text"), "pair-texts")
    # a leader of many members is dealt out: its text once to each of as many tasks as it has thousands of members
    hot = pairs.groupBy("other").agg(F.ceil(F.count(F.lit(1)) / HOT_ROWS).cast("int").alias("fan")).where("fan > 1")
    few = hot.count()
    if few > BROADCAST_IDS:
        sides = pairs.join(texts, "id").join(texts.select(F.col("id").alias("other"), F.col("text").alias("other_text")), "other")
    else:
        fan = F.coalesce("fan", F.lit(1))
        dealt = pairs.join(F.broadcast(hot), "other", "left").select("id", "other", F.pmod(F.xxhash64("id"), fan).alias("salt"))
        again = texts.select(F.col("id").alias("other"), F.col("text").alias("other_text")).join(F.broadcast(hot), "other", "left")
        again = again.select("other", "other_text", F.explode(F.sequence(F.lit(0).cast("long"), (fan - 1).cast("long"))).alias("salt"))
        sides = dealt.join(texts, "id").join(again, ["other", "salt"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last: dict[int, tuple] = {}
        for batch in batches:
            keep = []
            for other, mine, theirs in zip(batch.column("other").to_pylist(), batch.column("text"), batch.column("other_text"), strict=True):
                known = last.get(other)  # pairs come sorted by `other`
                if known is None or known[0] != theirs:
                    last = {other: (theirs, weighted(theirs.as_py(), width, hashes, weighting))}
                keep.append(max(similarities(weighted(mine.as_py(), width, hashes, weighting), last[other][1])) >= threshold)
            yield batch.select(["id", "other"]).filter(pa.array(keep, pa.bool_()))

    links = _in_batches(sides.select("id", "other", "text", "other_text").mapInArrow(verify, "id long, other long").distinct(), "links", TEXT_ROWS)
    discard(ids, texts)
    return links


def _across(
    member: DataFrame, signed: DataFrame, source: DataFrame, width: int, threshold: float, weighting: str, slack: float, block_rows: int, band_rows: int
) -> DataFrame:
    """Links (id, other) between components that share a bucket, enough of them to join all that are linked there.

    A written table. In every bucket the largest component stands aside: its members meet all others, but not each other. Blocks travel
    with signatures and exact shingle sets, dealt by pair of blocks. A pair is looked at in the first band it shares.
    """
    of_bucket = member.groupBy("key", "component").agg(F.count(F.lit(1)).alias("held")).groupBy("key")
    mixed = of_bucket.agg(F.max_by("component", F.struct("held", -F.col("component"))).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("held").alias("held")).where("parts > 1")
    open_members = member.select("key", "band", "id", "component").join(mixed, "key").withColumn("aside", F.col("component") == F.col("main"))
    block = F.struct("aside", F.pmod(F.xxhash64("id"), F.ceil(F.col("held") / block_rows)).alias("number"))
    open_members = materialize(open_members.select("key", "band", "id", "component", block.alias("block")).distinct(), "open-members")
    ids = materialize(open_members.select("id").distinct(), "open-ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = [weighted(t.as_py(), width, hashes, weighting) for t in part.column(1)]
                packed = [pa.array([s.tobytes() for s, _ in sets], pa.binary()), pa.array([w.tobytes() if (w != 1).any() else b"" for _, w in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *packed], names=["id", "of_text", "shingles", "weights"])

    texts = source.join(wanted, "id").withColumn("of_text", F.xxhash64("text")).dropDuplicates(["id", "of_text"])
    sets = texts.mapInArrow(exact, "id long, of_text long, shingles binary, weights binary")
    signatures = signed.join(wanted, "id").where("n > 0").select("id", "digest", "signature").dropDuplicates(["id", "digest"])
    # a row for each text of an id; where an id has several, signatures and texts meet in all ways, which loses nothing
    known = _in_batches(sets.join(signatures.select("id", "signature"), "id").drop("of_text"), "open-sets", TEXT_ROWS)
    blocks = open_members.join(known, "id").groupBy("key", "block").agg(F.first("band").alias("band"), F.collect_list(F.struct("id", "component", "signature", "shingles", "weights")).alias("rows"))
    blocks = materialize(blocks, "blocks")
    listed = lambda aside: F.array_sort(F.collect_list(F.when(F.col("block.aside") == F.lit(aside), F.col("block"))))
    names = blocks.groupBy("key").agg(listed(True).alias("aside"), listed(False).alias("others"))
    left = names.select("key", "aside", "others", F.posexplode("others").alias("i", "x"))
    met = left.select("key", "x", F.explode(F.concat(F.slice("others", F.col("i") + 1, F.size("others")), "aside")).alias("y"))
    sides = met.join(blocks.select("key", F.col("block").alias("x"), F.col("rows").alias("a"), "band"), ["key", "x"])
    sides = sides.join(blocks.select("key", F.col("block").alias("y"), F.col("rows").alias("b")), ["key", "y"])
    links = _in_batches(sides.select("a", "b", "band").mapInArrow(_block_links(threshold, slack, band_rows), "id long, other long").distinct(), "block-links", BLOCK_ROWS)
    discard(open_members, ids, known, blocks)
    return links


def _block_links(threshold: float, slack: float, band_rows: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                (ids_a, part_a, sign_a, sets_a), (ids_b, part_b, sign_b, sets_b) = (_block(batch.column(j)[k].values) for j in (0, 1))
                band = batch.column(2)[k].as_py()
                near: list[tuple[float, int, int]] = []
                for i, row in enumerate(sign_a):
                    equal = sign_b == row
                    share = equal.mean(1)
                    good = (share >= threshold - slack) & (part_b != part_a[i])
                    good &= ~equal[:, : band * band_rows].reshape(len(equal), band, band_rows).all(2).any(1)
                    near += [(-share[j], i, int(j)) for j in np.flatnonzero(good)]
                root: dict[int, int] = {}

                def top(x: int) -> int:
                    while root.get(x, x) != x:
                        root[x] = x = root.get(root[x], root[x])
                    return x

                u, v = [], []
                for _, i, j in sorted(near):  # the likeliest first; what they join needs no other link
                    x, y = top(int(part_a[i])), top(int(part_b[j]))
                    if x != y and max(similarities(sets_a[i], sets_b[j])) >= threshold:
                        root[max(x, y)] = min(x, y)
                        u.append(max(ids_a[i], ids_b[j]))
                        v.append(min(ids_a[i], ids_b[j]))
                if u:
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["id", "other"])

    return compare


def _block(rows: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    signatures = [np.frombuffer(x.as_py(), np.uint16) for x in rows.field(2)]
    sets = [(np.frombuffer(s.as_py(), np.uint64), np.frombuffer(w.as_py(), float)) for s, w in zip(rows.field(3), rows.field(4), strict=True)]
    sets = [(s, w if len(w) else np.ones(len(s))) for s, w in sets]  # weights of one are not carried
    return rows.field(0).to_numpy(), rows.field(1).to_numpy(), np.stack(signatures), sets
