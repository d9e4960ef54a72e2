"""Complete similarity joins by prefix filters: no pair that reaches the threshold is lost, and few others are compared.

A threshold bounds how many items two texts must share: words for Jaccard, pairs of letters or letters for the ratio of
matching blocks. If they must share `need` of n items, they share one of the n - need + 1 rarest. So texts meet on their
rarest items only, by equality, at the first of those that they share; then lengths, then the number of shared items, then
the score. Crowded items are dealt over tasks.
"""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import sequence_ratio
from .settled import settle

#: Left rows of one item and block that one task compares with the right rows of it.
CROWD = 5_000
#: Counts of items are broadcast up to this number of items.
MOST_ITEMS = 200_000


def gram_sets(q: int):
    """A function of a column of texts: their strings of q letters as a set, every one with the number of equal ones before it."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        def numbered(text: str) -> list[str]:
            seen: Counter = Counter()
            out = []
            for at in range(len(text) - q + 1):
                gram = text[at : at + q]
                out.append(f"{gram}\x01{seen[gram]}")
                seen[gram] += 1
            return out

        return texts.map(numbered)

    return run.asNondeterministic()  # else filters run it once more, before names are dealt out


def letter_grams(text: Column, q: int) -> Column:
    """The strings of q letters in a text; none if it is shorter."""
    n = F.length(text)
    return F.when(n >= q, F.transform(F.sequence(F.lit(1), n - q + 1), lambda i: F.substring(text, i, F.lit(q)))).otherwise(F.array().cast("array<string>"))


def prefix_pairs(left: DataFrame, right: DataFrame, block: list[str], items: str, need: str, *, carry: bool = True) -> DataFrame:
    """(block, l, r, all_l, all_r): structs of the rows of left and right in one block that share as many items as both need,
    and the numbers that stand for their items; others that meet come too. Without carry the structs don't hold the items, which other columns must fix.

    items: an array of distinct strings; need: how many of them any partner must share, one at least. Every pair comes once.
    Rows with fewer items than they need, null blocks and null items meet nobody.
    """
    usable = lambda df: df.where((F.col(need) >= 1) & (F.size(items) >= F.col(need))).dropna(subset=block)
    l, r = settle(usable(left), "items"), settle(usable(right), "items")  # items are dear, and read three times
    every = l.select(F.explode(items).alias("g")).unionByName(r.select(F.explode(items).alias("g")))
    # rows that are dealt out for each of their rarest items hold numbers of items, not the items
    counts = settle(every.groupBy("g").agg(F.count(F.lit(1)).alias("f")).withColumn("i", F.monotonically_increasing_id()), "item-counts")
    counts = F.broadcast(counts) if counts.limit(MOST_ITEMS + 1).count() <= MOST_ITEMS else counts

    def prefix(side: str) -> Column:
        return F.slice(f"all_{side}", F.lit(1), F.size(f"all_{side}") - F.col(f"{side}.{need}") + 1)

    def rarest(df: DataFrame, side: str) -> DataFrame:
        held = [c for c in df.columns if carry or c != items]
        rows = df.select(*block, F.struct(*held).alias("row"), F.xxhash64(*block, *held).alias("h"), F.explode(items).alias("g"))
        ranked = rows.join(counts, "g").groupBy(*block, "row", "h").agg(F.array_sort(F.collect_list(F.struct("f", "i"))).alias("in_order"))
        ranked = ranked.select(*block, F.col("row").alias(side), F.transform("in_order", lambda e: e["i"]).alias(f"all_{side}"), "h")
        return settle(ranked, "ranked")

    a, b = rarest(l, "l"), rarest(r, "r")
    # where the rarest items are nearly all items, rows meet more often by items than each with each in its block, once
    by_item = [x.select(*block, F.explode(prefix(side)).alias("g")) for x, side in ((a, "l"), (b, "r"))]
    few = _meetings(a, b, block) <= _meetings(*by_item, [*block, "g"])
    a, b = [x.withColumn("g", F.lit(0).cast("long") if few else F.explode(prefix(side))) for x, side in ((a, "l"), (b, "r"))]
    # a crowded item of a block is dealt out by its left rows; there are at most a CROWD-th as many of them as rows
    key = [*block, "g"]
    crowded = F.broadcast(a.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / CROWD).cast("int").alias("parts")).where("parts > 1"))
    parts = F.coalesce("parts", F.lit(1))
    a = a.join(crowded, key, "left").withColumn("part", F.pmod("h", parts)).drop("parts", "h")
    b = b.join(crowded, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long")))).drop("parts", "h")
    # the order of items is the same on both sides, so the first shared one is one item of the pair
    met = a.join(b, [*key, "part"])
    met = met if few else met.where(F.col("g") == F.get(F.array_intersect(prefix("l"), prefix("r")), F.lit(0)))
    return met.select(*block, "l", "r", "all_l", "all_r")


def _meetings(left: DataFrame, right: DataFrame, key: list[str]) -> float:
    """How many pairs a join by key has."""
    counted = lambda df, n: df.groupBy(*key).agg(F.count(F.lit(1)).cast("double").alias(n))
    return counted(left, "p").join(counted(right, "q"), key).agg(F.coalesce(F.sum(F.col("p") * F.col("q")), F.lit(0.0))).first()[0]


def ratio_pairs(left: DataFrame, right: DataFrame, block: list[str], text: str, least: float) -> DataFrame:
    """(block, a, b, score): pairs of texts of left and right in one block with sequence_ratio(a, b) of at least `least`.

    Both tables should hold each text of a block once. The ratio is 2 * matched / (|a| + |b|). Matched letters are letters
    that both have; matching blocks are parted by letters that don't match, so that with S = |a| + |b| there are at most
    1 + S - 2 * matched blocks, and at least 3 * matched - S - 1 pairs of letters are shared. Where that says nothing, as for
    short texts, the letters themselves are counted. Texts that meet are S - 2 * matched edits apart at most, which is counted
    before the ratio, as that is dear. Empty texts match nothing.
    """
    if not 0 < least <= 1:
        raise ValueError("the least ratio lies between 0 and 1")
    slack = 1e-9
    matched = lambda s: F.ceil(s * (least / 2) - slack)
    # the least sum of lengths from which on pairs of letters always say something
    turn = next((s for s in range(2, 400) if all(3 * math.ceil(least * t / 2 - slack) - t - 1 >= 1 and (1.5 * least - 1) * t - 1 > slack for t in range(s, 400))), None)
    # names are short, and what is made of them is not: they go to as many tasks as there are, not to as few as hold them
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = lambda df: df.select(*block, F.col(text).alias("t")).where("t <> ''").repartition(parts, *block, "t").withColumn("len", F.length("t"))
    sides, out = [names(left), names(right)], None
    own = 2 * F.col("len") / (2 - least)  # the least sum of lengths with a partner
    for q in (1, 2):
        if q == 2 and turn is None:
            continue
        if q == 2:
            need = F.greatest(F.lit(1), F.ceil((1.5 * least - 1) * F.greatest(own, F.lit(float(turn))) - 1 - slack))
            some = sides
        else:
            need = F.greatest(F.lit(1), F.ceil(own * (least / 2) - slack))
            some = sides if turn is None else [s.where(F.col("len") < turn) for s in sides]
        gramed = [s.withColumn("items", gram_sets(q)("t")).withColumn("need", need.cast("int")) for s in some]
        pairs = prefix_pairs(*gramed, block, "items", "need", carry=False).select(*block, F.col("l.t").alias("a"), F.col("r.t").alias("b"), (F.col("l.len") + F.col("r.len")).alias("s"), F.least("l.len", "r.len").alias("short"), "all_l", "all_r")
        shared = F.size(F.array_intersect("all_l", "all_r"))
        fits = (F.col("short") >= matched(F.col("s"))) & (shared >= (matched(F.col("s")) if q == 1 else 3 * matched(F.col("s")) - F.col("s") - 1))
        if turn is not None:
            fits = fits & ((F.col("s") < turn) if q == 1 else (F.col("s") >= turn))
        # whoever deletes and inserts all but the matched letters turns one text into the other
        edits = F.call_function("levenshtein", F.col("a"), F.col("b"), (F.col("s") - 2 * matched(F.col("s"))).cast("int"))
        alike = pairs.where(edits >= 0).where(fits).select(*block, "a", "b")
        out = alike if out is None else out.unionByName(alike)
    return out.withColumn("score", sequence_ratio(F.col("a"), F.col("b"))).where(F.col("score") >= least)


def jaccard_pairs(left: DataFrame, right: DataFrame, block: list[str], words: str, least: float, shared: int = 1) -> DataFrame:
    """(block, l, r, both, score): rows in one block whose arrays of distinct words have a Jaccard of at least `least` and
    `shared` words in common; least and shared must be above 0."""
    if least <= 0 or shared < 1:
        raise ValueError("without a shared word everything would meet everything")
    need = F.greatest(F.lit(shared), F.ceil(F.size(words) * least - 1e-9).cast("int"))
    with_need = lambda df: df.withColumn("__need", need)
    pairs = prefix_pairs(with_need(left), with_need(right), block, words, "__need")
    pairs = pairs.select(*block, "l", "r", F.size(F.array_intersect("all_l", "all_r")).alias("both"))
    score = F.col("both").cast("double") / (F.size(f"l.{words}") + F.size(f"r.{words}") - F.col("both"))
    return pairs.withColumn("score", score).where((F.col("both") >= shared) & (F.col("score") >= least))
