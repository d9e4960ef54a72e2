"""The k nearest neighbours on the globe, found by counts in a pyramid of cells before any row meets a partner.

Points of the unit sphere lie in cubes; a cube of one level holds eight of the next. For both sides the pyramid knows how
many positions each cube has. The search goes down it with pairs of cubes: a cube of askers and the cubes of partners that
may matter to it. The counts alone bound how far the k-th partner can be, and partners' cubes farther than that go. A
cube of askers is done once few candidates are left and few askers share them. Distances between cubes of a level are whole
numbers of their edge, so bounds are exact; there are no poles and no date line.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_KM, haversine_km, unit_xyz
from .settled import discard, settle

#: Levels below the first cube; the cubes of the last have an edge of some 12 m.
LEVELS = 20
#: The search starts at the deepest level with so few pairs of cubes, all of which are looked at.
FIRST_PAIRS = 100_000
#: A cube of askers is done when its candidates are at most CROWD, or PER_WANTED for each one wanted, and its askers at most ASKERS.
CROWD, PER_WANTED, ASKERS = 256, 16, 20_000
#: Rows at one place beyond which their answers are broadcast to them, not joined: at most a row for each MANY rows of left.
MANY = 200_000
AXES = ("x", "y", "z")


def _positions(df: DataFrame, same: Sequence[str]) -> DataFrame:
    """df with its coordinates and groups as __lat, __lon, __g0..., and the cubes of the last level as cx, cy, cz; rows without them go."""
    out = df.select("*", F.col("lat").cast("double").alias("__lat"), F.col("lon").cast("double").alias("__lon"), *[F.col(c).alias(f"__g{i}") for i, c in enumerate(same)])
    out = out.dropna(subset=[c for c in out.columns if c.startswith("__")]).withColumn("__u", unit_xyz(F.col("__lat"), F.col("__lon")))
    cube = lambda a: F.least(F.greatest(F.floor((F.col(f"__u.{a}") + 1) * (1 << (LEVELS - 1))), F.lit(0)), F.lit((1 << LEVELS) - 1)).cast("long")
    return out.withColumns({f"c{a}": cube(a) for a in AXES}).drop("__u")


def _at_level(c: str) -> Column:
    """The cube of the row's own level that holds a cube of the last one."""
    return F.expr(f"shiftright({c}, {LEVELS} - level)")


def _pyramids(askers: DataFrame, partners: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, side, level, x, y, z, n) of every cube with something in it, of both sides in one pass: side is a or p."""
    cells = ["cx", "cy", "cz"]
    both = askers.select(*groups, F.lit("a").alias("side"), *cells, F.lit(1).alias("n")).unionByName(partners.select(*groups, F.lit("p").alias("side"), *cells, F.size("ids").alias("n")))
    last = both.groupBy(*groups, "side", *cells).agg(F.sum("n").alias("n"))
    every = last.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(LEVELS))))
    return settle(every.groupBy(*groups, "side", "level", *[_at_level(f"c{a}").alias(a) for a in AXES]).agg(F.sum("n").alias("n")), "cubes-of-all-levels")


def nearest(left: DataFrame, right: DataFrame, left_id: str, right_id: str, *, k: int = 1, exclude_equal_ids: bool = False, same: Sequence[str] = (), max_km: float | None = None) -> DataFrame:
    """(left_id, right_id, km, rank): the k nearest of right for each row of left, ties to the smaller id.

    same: columns that must be equal on both sides, nulls are equal to nothing. Coordinates are columns lat and lon; rows
    without them, and rows with fewer than k partners (within max_km), find what there is. left_id tells the rows of left
    apart; rows of right that repeat an id are candidates each. Rows at one place are searched once, and of partners at one
    place only those with the smallest ids are kept, so that a crowded place is no large group; places closer to each other
    than 12 m share their candidates whatever their number.
    """
    groups = [f"__g{i}" for i in range(len(same))]
    place = ["__lat", "__lon", *groups]
    wanted = k + 1 if exclude_equal_ids else k
    askers = _positions(left, same)
    spots = askers.groupBy(*place, "cx", "cy", "cz").agg(F.count(F.lit(1)).alias("rows"))
    near_ids = _positions(right, same).select(*place, "cx", "cy", "cz", F.col(right_id).alias("rid"))
    by_id = Window.partitionBy(*place, "cx", "cy", "cz").orderBy("rid")
    kept = near_ids.withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= wanted)
    partners = kept.groupBy(*place, "cx", "cy", "cz").agg(F.array_sort(F.collect_list("rid")).alias("ids"))

    cubes = _pyramids(spots, partners, groups)
    here, there = cubes.where("side = 'a'").drop("side"), cubes.where("side = 'p'").drop("side")
    found = _descend(here, there, groups, wanted, max_km)
    # every done cube of askers with the positions of its partners, then with its own
    cube = ["level", *AXES]
    levels = F.array(*[F.lit(r["level"]) for r in found.select("level").distinct().collect()] or [F.lit(1)])  # 20 at most
    spread = lambda df: df.withColumn("level", F.explode(levels)).withColumns({a: _at_level(f"c{a}") for a in AXES})
    theirs = spread(partners).select(*groups, *cube, F.col("__lat").alias("plat"), F.col("__lon").alias("plon"), "ids")
    candidates = found.select(*groups, "level", *[F.col(f"q{a}").alias(f"own_{a}") for a in AXES], *AXES, "reach").join(theirs, [*groups, *cube])
    candidates = candidates.select(*groups, "level", *[F.col(f"own_{a}").alias(a) for a in AXES], "reach", "plat", "plon", "ids")
    pairs = spread(spots).join(candidates, [*groups, *cube]).withColumn("km", haversine_km(F.col("__lat"), F.col("__lon"), F.col("plat"), F.col("plon")))
    edge = F.pow(F.lit(2.0), 1 - F.col("level"))
    farthest = F.lit(2 * EARTH_KM) * F.asin(F.least(edge * F.sqrt(F.col("reach").cast("double")) / 2, F.lit(1.0)))
    pairs = pairs.where((F.col("km") <= farthest * (1 + 1e-9) + 1e-6) & (F.lit(True) if max_km is None else F.col("km") <= max_km))
    # a bounded sort: Spark cuts each task's rows to the first `wanted` of an asker before and after the exchange
    rows = pairs.select(*groups, "__lat", "__lon", "level", *AXES, "rows", "km", F.explode("ids").alias("rid"))
    first = Window.partitionBy(*groups, "level", *AXES, "__lat", "__lon").orderBy("km", "rid")
    best = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= wanted)
    answers = settle(best.groupBy(*place).agg(F.first("rows").alias("rows"), F.array_sort(F.collect_list(F.struct("km", "rid"))).alias("answer")), "answers")
    discard(cubes)
    asked = askers.select(F.col(left_id).alias("__id"), *place)
    told = _told(asked, answers, place)
    answer = F.filter("answer", lambda e: F.col("__id") != e["rid"]) if exclude_equal_ids else F.col("answer")
    out = told.select("__id", F.posexplode(F.slice(answer, 1, k)).alias("nth", "e"))
    return out.select(F.col("__id").alias(left_id), F.col("e.rid").alias(right_id), F.col("e.km").alias("km"), (F.col("nth") + 1).alias("rank"))


def _told(asked: DataFrame, answers: DataFrame, place: list[str]) -> DataFrame:
    """The rows at a place with its answer; the answers of crowded places are broadcast, as their rows would meet in one task."""
    crowded = answers.where(F.col("rows") > MANY)
    if crowded.isEmpty():
        return asked.join(answers.select(*place, "answer"), place)
    some = F.broadcast(crowded.select(*place, "answer"))
    others = asked.join(some, place, "left_anti").join(answers.select(*place, "answer"), place)
    return asked.join(some, place).unionByName(others)


def _descend(here: DataFrame, there: DataFrame, groups: list[str], wanted: int, max_km: float | None) -> DataFrame:
    """(groups, level, qx, qy, qz, x, y, z, reach): the cubes of partners that a done cube of askers needs; reach: the square of
    the distance within which its askers have all they want, in edges of the level."""
    both = here.select("level", F.lit(1).alias("a"), F.lit(0).alias("p")).unionByName(there.select("level", F.lit(0).alias("a"), F.lit(1).alias("p")))
    sizes = both.groupBy("level").agg(F.sum("a").alias("a"), F.sum("p").alias("p")).collect()  # a row a level
    mine, theirs = {r["level"]: r["a"] for r in sizes}, {r["level"]: r["p"] for r in sizes}
    start = max([v for v in range(1, LEVELS + 1) if mine.get(v, 0) * theirs.get(v, 0) <= FIRST_PAIRS], default=1)
    askers = lambda v: here.where(F.col("level") == v).select(*groups, *[F.col(a).alias(f"q{a}") for a in AXES], F.col("n").alias("askers"))
    cubes = lambda v: there.where(F.col("level") == v).select(*groups, *AXES, "n")
    # at the first level every cube of askers meets every cube of partners: FIRST_PAIRS at most, or the eight cubes of level 1
    pairs = askers(start).withColumn("all", F.lit(0)).join(cubes(start).withColumn("all", F.lit(0)), [*groups, "all"]).drop("all").withColumn("reach", F.lit(12 << (2 * start)).cast("long"))
    done: DataFrame | None = None
    for level in range(start, LEVELS + 1):
        state = settle(_pruned(pairs, groups, wanted, level, max_km), "cubes")
        open_pairs = (F.col("candidates") > max(CROWD, PER_WANTED * wanted)) | (F.col("askers") > ASKERS) if level < LEVELS else F.lit(False)
        closed = state.where(~open_pairs).select(*groups, F.lit(level).alias("level"), "qx", "qy", "qz", *AXES, "reach")
        done = closed if done is None else done.unionByName(closed)
        rest = state.where(open_pairs)
        if level == LEVELS or rest.isEmpty():
            break
        up = lambda df, names: df.withColumns({f"up_{a}": F.shiftright(a, 1) for a in names})
        above = rest.select(*groups, *[F.col(f"q{a}").alias(f"up_q{a}") for a in AXES], *[F.col(a).alias(f"up_{a}") for a in AXES], (F.col("reach") * 4).alias("reach"))
        q_names, p_names = [f"q{a}" for a in AXES], list(AXES)
        below = above.join(up(askers(level + 1), q_names), [*groups, *[f"up_{a}" for a in q_names]])
        pairs = below.join(up(cubes(level + 1), p_names), [*groups, *[f"up_{a}" for a in p_names]]).drop(*[f"up_{a}" for a in [*q_names, *p_names]])
    return done


def _pruned(pairs: DataFrame, groups: list[str], wanted: int, level: int, max_km: float | None) -> DataFrame:
    """The pairs of cubes that may matter, with the number of candidates of each cube of askers."""
    apart = [F.abs(F.col(f"q{a}") - F.col(a)) for a in AXES]
    total = lambda parts: reduce(lambda s, x: s + x, parts)
    low = total([F.greatest(d - 1, F.lit(0)) * F.greatest(d - 1, F.lit(0)) for d in apart])
    high = total([(d + 1) * (d + 1) for d in apart])
    pairs = pairs.withColumns({"low": low, "high": high}).where("low <= reach")
    own = [*groups, "qx", "qy", "qz"]
    so_far = F.sum("n").over(Window.partitionBy(*own).orderBy("high"))  # all cubes up to the distance, equal ones included
    every = Window.partitionBy(*own)
    enough = F.min(F.when(F.col("so_far") >= wanted, F.col("high"))).over(every)
    reach = F.least(F.col("reach"), F.coalesce(enough, F.col("reach")))
    if max_km is not None:
        chord = 2 * math.sin(min(max_km / (2 * EARTH_KM), math.pi / 2)) * 2.0 ** (level - 1)
        reach = F.least(reach, F.lit(math.ceil(chord * chord * (1 + 1e-9) + 1e-6)).cast("long"))
    out = pairs.withColumn("so_far", so_far).withColumn("reach", reach.cast("long")).where("low <= reach")
    return out.withColumn("candidates", F.sum("n").over(every)).drop("so_far", "low", "high")
