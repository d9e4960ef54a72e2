"""Chains and paths against walks in Python: deep chains, cycles and what hangs below them, orphans, repeated rows, rounds."""

import random

from rollcall.operators import graph


def forest(rng, n):
    rows = [(0, None, "top")]
    for i in range(1, n):
        kind = rng.random()
        parent = None if kind < 0.03 else 10_000 + i if kind < 0.06 else i if kind < 0.09 else i - 1 if kind < 0.6 else rng.randrange(i)
        rows.append((i, parent, rng.choice([None, "", f"n{i}", "same"])))
    for a, b in ((20, 21), (50, 51)):  # each other's parents
        rows[a], rows[b] = (a, b, rows[a][2]), (b, a, rows[b][2])
    return rows


def walk(up, names, i):
    """(path, depth, root, rooted), the names of chains that don't end being the node's own."""
    chain = [i]
    while up.get(chain[-1]) is not None and up[chain[-1]] != chain[-1]:
        if up[chain[-1]] in chain:
            return names[i] or "", None, None, False
        chain.append(up[chain[-1]])
    rooted = chain[-1] in up and up[chain[-1]] is None
    return " > ".join(names[k] for k in reversed(chain) if names.get(k) is not None), len(chain) - 1, chain[-1], rooted


def test_paths_are_those_of_a_walk(spark):
    rows = forest(random.Random(3), 400)
    up, names = {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}
    tree = spark.createDataFrame(rows + rows[:30] + [(None, 1, "x")], "id long, parent long, name string")
    want = {i: walk(up, names, i) for i in up}
    got = [(r["id"], r["path"]) for r in graph.paths(tree, "id", "parent", "name").collect()]
    assert len(got) == len(up) and dict(got) == {i: w[0] for i, w in want.items()}
    rooted = {r["id"]: (r["path"], r["depth"], r["root"]) for r in graph.rooted_paths(tree, "id", "parent", "name").collect()}
    assert rooted == {i: w[:3] for i, w in want.items() if w[3]} and 100 < len(rooted) < 390


def test_cycles_cost_no_rounds(spark, monkeypatch):
    """Two nodes on a cycle beside many short chains: rounds go by the longest chain, not by the number of nodes."""
    written, settle = [], graph.settle
    monkeypatch.setattr(graph, "settle", lambda df, *a: written.append(1) or settle(df, *a))
    nodes = spark.range(2000).selectExpr("id", "CASE id WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN NULL ELSE 2 END AS parent")
    states = {r["state"]: r["n"] for r in graph.flatten_pointers(nodes, "id", "parent").groupBy("state").agg({"id": "count"}).toDF("state", "n").collect()}
    assert states == {"cycle": 2, "ok": 1997} and len(written) <= 5
