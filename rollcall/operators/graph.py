"""Pointer graphs, clusters and trees: flattening, cycles, components, closures and audits, as iterated joins.

Every round is written to the shared folder and read back, so that neither plan nor lineage grows and a lost executor
costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .settled import discard, settle


def flatten_pointers(nodes: DataFrame, id_col: str, pointer: str) -> DataFrame:
    """(id, terminal, hops, state) for every node with a pointer.

    state: `ok`, `self` (points at itself), `dangling` (the chain ends at an id that no node has) or `cycle`; terminal and
    hops are null for cycles. Pointer jumping: every round doubles the steps, so a longest chain of n takes log2 n joins, also beside
    cycles. Only nodes that others point at take part, and of these only open chains are written again; all others look up
    the end of the node that they point at.
    """
    own = nodes.select(F.col(id_col).alias("id"), F.col(pointer).alias("to")).where("id IS NOT NULL")
    links = settle(own.where("to IS NOT NULL AND to <> id").select("id", "to"))
    aims = links.select(F.col("to").alias("id")).distinct()
    now, done, cyclic = settle(links.join(aims, "id", "left_semi").withColumn("hops", F.lit(1).cast("long"))), [], None
    while cyclic is None:
        ahead = _stacked([now, *done]).select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("hops").alias("more"))
        moved = settle(now.join(ahead, "to", "left").select("id", F.coalesce("next", "to").alias("to"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"), F.col("next").isNotNull().alias("open")))
        ended = moved.where("NOT open").drop("open")
        now = moved.where("open").drop("open")
        # a chain that ends has a node at each distance from its end, so if no chain ends in a round, those left are cycles
        if ended.isEmpty():
            cyclic = now
        done.append(ended)
    ends = _stacked([cyclic.withColumn("cyclic", F.lit(True)), *[part.withColumn("cyclic", F.lit(False)) for part in done]])
    ends = ends.select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("hops").alias("more"), "cyclic")
    ends = links.join(ends, "to", "left").select("id", F.coalesce("next", "to").alias("to"), (F.coalesce("more", F.lit(0)) + 1).alias("hops"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"))
    known = own.select(F.col("id").alias("to"), F.lit(True).alias("known")).distinct()
    ends = ends.join(known, "to", "left")
    state = F.when(F.col("cyclic"), "cycle").when(F.col("known").isNull(), "dangling").otherwise("ok")
    out = ends.select("id", F.when(~F.col("cyclic"), F.col("to")).alias("terminal"), F.when(~F.col("cyclic"), F.col("hops")).alias("hops"), state.alias("state"))
    loops = own.where("to = id").select("id", F.col("to").alias("terminal"), F.lit(0).cast("long").alias("hops"), F.lit("self").alias("state"))
    return out.unionByName(loops).withColumnRenamed("id", id_col)


def break_two_cycles(nodes: DataFrame, id_col: str, pointer: str, richness: str) -> DataFrame:
    """nodes with the pointer of the richer row of each two-cycle cleared, the smaller id on ties."""
    a = nodes.select(F.col(id_col).alias("a"), F.col(pointer).alias("b"), F.col(richness).alias("ra"))
    b = nodes.select(F.col(id_col).alias("b"), F.col(pointer).alias("a"), F.col(richness).alias("rb"))
    pairs = a.join(b, ["a", "b"]).where("a < b")
    clear = pairs.select(F.when(F.col("ra") >= F.col("rb"), F.col("a")).otherwise(F.col("b")).alias("__id"))
    out = nodes.join(clear, F.col(id_col) == F.col("__id"), "left")
    return out.withColumn(pointer, F.when(F.col("__id").isNull(), F.col(pointer))).drop("__id")


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has an edge to another; component is the smallest node within reach.

    Alternates stars: each node's larger neighbours move to its smallest one, then its smaller neighbours do. Every round
    is two aggregations and joins over the edges, none broadcast, written to the shared folder; only a count and a checksum come to the
    driver. Ends when a round changes nothing. Null ends, self-loops and repeated edges are ignored; no edges give no rows.
    """
    a, b = F.col(u), F.col(v)
    now = settle(edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = _mark(now)
    for _ in range(max_rounds):
        before, old = mark, now
        now = settle(_small_star(_large_star(now)), "edges")
        mark = _mark(now)
        discard(old)
        if mark == before:
            child = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return child.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    raise RuntimeError(f"not settled after {max_rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node that it knows of."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least.hint("merge"), "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def ancestors(tree: DataFrame, id_col: str, parent: str) -> DataFrame:
    """(descendant, ancestor, distance) for all pairs, each node at distance 0 from itself.

    By doubling: each round puts the jumps of 2^k steps before all pairs known so far, so a tree of depth n takes log2 n
    rounds. Nodes on a cycle of parents, and those below one, have no ancestor but themselves; `flatten_pointers` names them.
    """
    ids = tree.select(F.col(id_col).alias("descendant")).where("descendant IS NOT NULL").distinct()
    out = ids.select("descendant", F.col("descendant").alias("ancestor"), F.lit(0).alias("distance"))
    sound = flatten_pointers(tree, id_col, parent).where("state IN ('ok', 'dangling')").select(F.col(id_col).alias("id"))
    steps = tree.where(F.col(parent).isNotNull()).select(F.col(id_col).alias("id"), F.col(parent).alias("to"))
    jump, parts, size = settle(steps.join(sound, "id", "left_semi")), [out], 1
    while not jump.isEmpty():
        leap = jump.select(F.col("id").alias("descendant"), F.col("to").alias("middle"))
        # a parent that no row has is an ancestor all the same, at the end of its chain
        reach = _stacked(parts).select(F.col("descendant").alias("middle"), "ancestor", "distance")
        further = leap.join(reach, "middle", "left").select("descendant", F.coalesce("ancestor", "middle").alias("ancestor"), (F.coalesce("distance", F.lit(0)) + size).alias("distance"))
        parts.append(settle(further))  # pairs that are known are not written again
        after = settle(jump.join(jump.select(F.col("id").alias("to"), F.col("to").alias("next")), "to").select("id", F.col("next").alias("to")))
        discard(jump)
        jump, size = after, 2 * size
    return _stacked(parts)


def _stacked(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def depths(tree: DataFrame, id_col: str, parent: str) -> DataFrame:
    """(id, depth, root) of all nodes that a root (null parent) reaches, by pointer jumping: log2 of the depth rounds."""
    roots = tree.where(F.col(parent).isNull() & F.col(id_col).isNotNull()).select(F.col(id_col), F.lit(0).cast("long").alias("depth"), F.col(id_col).alias("root"))
    below = flatten_pointers(tree, id_col, parent).where("state = 'ok'").select(id_col, F.col("hops").alias("depth"), F.col("terminal").alias("root"))
    # the end of a chain that points at itself is no root
    return roots.unionByName(below.join(roots.select("root").distinct(), "root", "left_semi").select(id_col, "depth", "root"))


def _climbed(tree: DataFrame, id_col: str, parent: str, name: str, separator: str) -> DataFrame:
    """(id, path, depth, root, rooted) for every node; rooted: a root (null parent) is reached, else depth and root say nothing.

    A node's names begin at the top of its chain; those of nodes on or below a cycle are its own. Of rows that share an id
    the one with the smallest parent (null first) counts. Pointer jumping with the names met so far in place of pairs of
    nodes: so no more is shuffled than the paths themselves, in log2 of the depth rounds over the nodes that have children.
    """
    each = tree.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(F.struct(F.col(parent).alias("to"), F.col(name).cast("string").alias("path"))).alias("m"))
    nodes = settle(each.select("id", "m.to", "m.path"))
    states = flatten_pointers(nodes.select("id", "to"), "id", "to")
    climbs = F.col("state").isin("ok", "dangling")
    at = settle(
        nodes.join(states, "id", "left").select(
            "id", F.when(climbs, F.col("to")).alias("to"), "path", F.when(climbs, F.col("hops")).otherwise(F.lit(0)).cast("long").alias("depth"), F.when(climbs, F.col("terminal")).otherwise(F.col("id")).alias("root"), F.col("to").isNull().alias("rooted")
        )
    )
    joined = F.when(F.col("above").isNull(), F.col("path")).when(F.col("path").isNull(), F.col("above")).otherwise(F.concat("above", F.lit(separator), "path"))
    inner = at.join(at.where("to IS NOT NULL").select(F.col("to").alias("id")).distinct(), "id", "left_semi").select("id", "to", "path", "rooted")
    inner = settle(inner)
    now, done = inner.where("to IS NOT NULL"), [inner.where("to IS NULL")]
    look_up = lambda rows: rows.select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("path").alias("above"), F.col("rooted").alias("top"))
    while not now.isEmpty():
        moved = settle(now.join(look_up(_stacked([now, *done])), "to", "left").select("id", F.col("next").alias("to"), joined.alias("path"), F.coalesce("top", F.lit(False)).alias("rooted")))
        done.append(moved.where("to IS NULL"))
        now = moved.where("to IS NOT NULL")
    out = at.join(look_up(_stacked(done)), "to", "left")
    return out.select("id", F.coalesce(joined, F.lit("")).alias("path"), "depth", "root", F.when(F.col("to").isNull(), F.col("rooted")).otherwise(F.coalesce("top", F.lit(False))).alias("rooted"))


def paths(tree: DataFrame, id_col: str, parent: str, name: str, separator: str = " > ") -> DataFrame:
    """(id, path): the names from the top down to each node; nodes without a name add nothing. One row for each id."""
    return _climbed(tree, id_col, parent, name, separator).select(F.col("id").alias(id_col), "path")


def rooted_paths(tree: DataFrame, id_col: str, parent: str, name: str, separator: str = " > ") -> DataFrame:
    """(id, path, depth, root) of the nodes that a root (null parent) reaches, in one climb."""
    return _climbed(tree, id_col, parent, name, separator).where("rooted").select(F.col("id").alias(id_col), "path", "depth", "root")


def audit_tree(tree: DataFrame, id_col: str, parent: str, name: str, *, depth: str | None = None, members: DataFrame | None = None) -> DataFrame:
    """(issue, id): orphans, self-parents, siblings of one name, names that nodes under other parents have, names equal to the
    parent's, nodes no root reaches; with depth (a column) stored depths that differ from those of the tree, roots and orphans
    at 0; with members (a table with id_col) leaves that no member names. Names are compared trimmed and in lower case; null
    names are no issue."""
    t = tree.select(F.col(id_col).alias("id"), F.col(parent).alias("parent"), F.lower(F.trim(name)).alias("name"), *([F.col(depth).alias("depth")] if depth else []))
    p = t.select(F.col("id").alias("pid"), F.col("name").alias("pname"))
    joined = t.join(p, F.col("parent") == F.col("pid"), "left")
    issue = lambda text, df: df.select(F.lit(text).alias("issue"), "id")
    twins = t.where("name IS NOT NULL").groupBy("parent", "name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    spread = t.where("name IS NOT NULL").groupBy("name").agg(F.count_distinct(F.coalesce(F.col("parent").cast("string"), F.lit(""))).alias("n")).where("n > 1")
    found = issue("orphan", joined.where("parent IS NOT NULL AND pid IS NULL"))
    found = found.unionByName(issue("self_parent", t.where("parent = id")))
    found = found.unionByName(issue("same_as_parent", joined.where("parent <> id AND name = pname")))
    found = found.unionByName(issue("duplicate_sibling", t.join(twins, t["parent"].eqNullSafe(twins["parent"]) & (t["name"] == twins["name"]), "left_semi")))
    found = found.unionByName(issue("name_elsewhere", t.join(spread, "name", "left_semi")))
    reached = depths(tree, id_col, parent).select(F.col(id_col).alias("id"), F.col("depth").alias("real"))
    found = found.unionByName(issue("unreachable", t.join(reached, "id", "left_anti")))
    if depth:
        # an orphan begins a tree of its own
        rooted = joined.select(F.col("id").alias(id_col), F.when(F.col("pid").isNotNull(), F.col("parent")).alias(parent))
        real = depths(rooted, id_col, parent).select(F.col(id_col).alias("id"), F.col("depth").alias("real"))
        found = found.unionByName(issue("depth_mismatch", t.join(real, "id").where("NOT (depth <=> real)")))
    if members is not None:
        leaves = t.join(t.select(F.col("parent").alias("id")).where("id IS NOT NULL"), "id", "left_anti")
        found = found.unionByName(issue("empty", leaves.join(members.select(F.col(id_col).alias("id")).where("id IS NOT NULL"), "id", "left_anti")))
    return found


def path_mismatches(tree: DataFrame, id_col: str, parent: str, name: str, path: str, root: str, separator: str = " > ") -> DataFrame:
    """(id, expected_path, expected_root): nodes that a root reaches whose stored path or root is not that of the tree."""
    real = rooted_paths(tree, id_col, parent, name, separator).select(id_col, F.col("path").alias("expected_path"), F.col("root").alias("expected_root"))
    both = tree.select(id_col, F.col(path).alias("__p"), F.col(root).alias("__r")).join(real, id_col)
    return both.where(~F.col("__p").eqNullSafe(F.col("expected_path")) | ~F.col("__r").eqNullSafe(F.col("expected_root"))).select(id_col, "expected_path", "expected_root")


def rank_chain(nodes: DataFrame, id_col: str, ranks: dict[str, DataFrame]) -> DataFrame:
    """nodes with the foreign key of each rank set to null where the rank's table (with id_col) has no such row; `parent` is
    the lowest rank that is left, in the order of ranks, the highest first."""
    out = nodes
    for key, known in ranks.items():
        ids = known.select(F.col(id_col).alias("__k")).distinct().withColumn("__known", F.lit(True))
        out = out.join(ids, F.col(key) == F.col("__k"), "left").withColumn(key, F.when(F.col("__known"), F.col(key))).drop("__k", "__known")
    return out.withColumn("parent", F.coalesce(*[F.col(k) for k in reversed(list(ranks))]))


def hubs(nodes: DataFrame, id_col: str, group: str) -> DataFrame:
    """(group, hub, members): the member nearest to the mean lat and lon of its group; members without coordinates only if
    none has any, the smallest id on ties."""
    from ..functions.geo import haversine_km

    mean = nodes.groupBy(group).agg(F.avg("lat").alias("__la"), F.avg("lon").alias("__lo"), F.count(F.lit(1)).alias("members"))
    away = F.coalesce(haversine_km(F.col("lat"), F.col("lon"), F.col("__la"), F.col("__lo")), F.lit(float("inf")))
    near = nodes.join(mean, group).groupBy(group).agg(F.min(F.struct(F.round(away, 6), F.col(id_col).alias("id"))).alias("m"), F.first("members").alias("members"))
    return near.select(group, F.col("m.id").alias("hub"), "members")


def three_levels(tree: DataFrame, id_col: str, parent: str, name: str, top: str = "(none)") -> DataFrame:
    """(id, level1, level2, level3): the names of a node's grandparent, parent and itself; what is missing is `top`."""
    up = lambda k: tree.select(F.col(id_col).alias(f"id{k}"), F.col(parent).alias(f"up{k}"), F.col(name).alias(f"name{k}"))
    rows = up(3).join(up(2), F.col("up3") == F.col("id2"), "left").join(up(1), F.col("up2") == F.col("id1"), "left")
    return rows.select(F.col("id3").alias(id_col), *[F.coalesce(f"name{k}", F.lit(top)).alias(f"level{k}") for k in (1, 2, 3)])


def rename_subtree(tree: DataFrame, path: str, old: str, new: str, separator: str = " > ") -> DataFrame:
    """tree with the prefix old of the paths of a node and all below it swapped for new."""
    inside = (F.col(path) == old) | F.startswith(F.col(path), F.lit(old + separator))
    return tree.withColumn(path, F.when(inside, F.concat(F.lit(new), F.substring(F.col(path), len(old) + 1, 1 << 20))).otherwise(F.col(path)))


def merge_nodes(tree: DataFrame, merges: DataFrame, id_col: str, parent: str) -> DataFrame:
    """tree without the nodes merges.loser, whose children go to merges.winner (one winner a loser, no chains)."""
    moves = merges.select(F.col("loser").alias("__l"), F.col("winner").alias("__w"))
    kept = tree.join(moves.select(F.col("__l").alias(id_col)), id_col, "left_anti")
    out = kept.join(moves, F.col(parent) == F.col("__l"), "left")
    return out.withColumn(parent, F.coalesce("__w", parent)).drop("__l", "__w")
