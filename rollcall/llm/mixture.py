"""Mixing sources to target weights: hierarchical token budgets, and the token prefix that fills each leaf's budget.

The tree is domain, language, source. A node's capacity is what its leaves can give in max_epochs passes. Budgets go down
the tree: a node's budget is shared among its children by weight, a child that cannot use its share is filled up and the
rest is shared again among its siblings (water filling); only what no sibling can take is missing at the parent, whose own
siblings got it in the same way one level up. A leaf's budget is whole epochs and a prefix of one more, in which the
documents stand in a seeded order of that epoch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialize

WORD = r"[^\x09-\x0D ]+"


@dataclass(frozen=True)
class MixturePlan:
    """Weights by level (those not named weigh 1), the budget as a share of all tokens, and how often a leaf may repeat."""

    budget_share: float = 0.6
    max_epochs: int = 2
    seed: int = 17
    domains: dict[str, float] = field(default_factory=dict)
    languages: dict[str, float] = field(default_factory=dict)
    sources: dict[str, float] = field(default_factory=dict)


#: Weights of the registered query and of the pipeline.
PRODUCTION = MixturePlan(domains={"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0}, languages={"en": 4.0, "de": 2.5, "fr": 2.0, "es": 1.5})


def source_domain(source: Column) -> Column:
    """The domain of a source in the synthetic tables: its number modulo 4, or `other`."""
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("d"), (number.try_cast("int") % 4).cast("string"))).otherwise(F.lit("other"))


def _weight(name: str, table: dict[str, float]) -> Column:
    out = F.lit(1.0)
    for key, value in table.items():
        out = F.when(F.col(name) == key, F.lit(float(value))).otherwise(out)
    return out


def fill(children: DataFrame, parent: list[str], capacity: str, weight: str, budget: str, out: str) -> DataFrame:
    """Adds `out`: the share of the parent's budget that each child gets, at most its capacity.

    A child is full if the level at which it fills up, given to all siblings, costs no more than the budget. Children
    without weight get nothing.
    """
    level = F.when(F.col(weight) > 0, F.col(capacity) / F.col(weight)).otherwise(F.lit(float("inf")))
    rows = children.withColumn("level", level)
    up_to = Window.partitionBy(*parent).orderBy("level").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(*parent)
    positive = F.when(F.col(weight) > 0, F.col(capacity)).otherwise(F.lit(0.0))
    rows = rows.withColumn("filled", F.sum(positive).over(up_to)).withColumn("open", F.sum(weight).over(every) - F.sum(weight).over(up_to))
    full = (F.col(weight) > 0) & (F.col("filled") + F.when(F.col("open") > 1e-9, F.col("level") * F.col("open")).otherwise(F.lit(0.0)) <= F.col(budget))
    rows = rows.withColumn("full", full)
    taken = F.sum(F.when(F.col("full"), positive).otherwise(F.lit(0.0))).over(every)
    left = F.sum(F.when(F.col("full"), F.lit(0.0)).otherwise(F.col(weight))).over(every)
    share = F.when(F.col("full"), F.col(capacity)).when(left > 1e-9, F.least(F.col(capacity), (F.col(budget) - taken) * F.col(weight) / left)).otherwise(F.lit(0.0))
    return rows.withColumn(out, share).drop("level", "filled", "open", "full")


def leaf_budgets(leaves: DataFrame, plan: MixturePlan) -> DataFrame:
    """leaves: domain, lang, source, tokens. Adds budget (long), epochs (whole passes) and rest (tokens of one more)."""
    rows = leaves.withColumn("capacity", F.col("tokens").cast("double") * plan.max_epochs)
    total = leaves.agg((F.coalesce(F.sum("tokens"), F.lit(0)).cast("double") * plan.budget_share).alias("budget0"))
    domains = rows.groupBy("domain").agg(F.sum("capacity").alias("cap")).withColumn("weight", _weight("domain", plan.domains)).crossJoin(total)
    domains = fill(domains.withColumn("root", F.lit(1)), ["root"], "cap", "weight", "budget0", "budget1").select("domain", "budget1")
    langs = rows.groupBy("domain", "lang").agg(F.sum("capacity").alias("cap")).withColumn("weight", _weight("lang", plan.languages)).join(domains, "domain")
    langs = fill(langs, ["domain"], "cap", "weight", "budget1", "budget2").select("domain", "lang", "budget2")
    out = rows.withColumn("weight", _weight("source", plan.sources)).join(langs, ["domain", "lang"])
    out = fill(out, ["domain", "lang"], "capacity", "weight", "budget2", "share")
    budget = F.floor(F.col("share") + 1e-6).cast("long")
    epochs = F.when(F.col("tokens") > 0, F.floor(budget / F.col("tokens"))).otherwise(F.lit(0)).cast("long")
    out = out.select("domain", "lang", "source", "tokens", budget.alias("budget"), epochs.alias("epochs"))
    return out.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))


def mix_sources(
    docs: DataFrame, plan: MixturePlan, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", domain: Column | None = None
) -> DataFrame:
    """(id, domain, lang, source, n_tokens, epochs, part_tokens, taken_tokens) for every row of docs of which tokens are taken.

    epochs: whole passes over the row's leaf; part_tokens: its tokens within the prefix of one more epoch, fewer than
    n_tokens for the one row that the budget ends in; taken_tokens: all in all. Tokens are parted by ASCII white space;
    null and empty texts have none and are never returned. Null languages and sources are leaves named `(none)`. The
    order of an epoch is that of md5(seed:epoch:id), then id, then the longer text; rows alike in all of these share
    one place by row. Other columns are not read. An empty table gives no rows.
    """
    domain = source_domain(F.coalesce(F.col(source_col).cast("string"), F.lit("(none)"))) if domain is None else domain
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(domain, F.lit("(none)")).alias("domain"), F.coalesce(F.col(lang_col).cast("string"), F.lit("(none)")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("(none)")).alias("source"), F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
    )
    rows = materialize(rows, "mix-rows")
    leaf = ["domain", "lang", "source"]
    budgets = materialize(leaf_budgets(rows.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens")), plan), "mix-budgets")
    place = F.md5(F.concat_ws(":", F.lit(str(plan.seed)), F.col("epochs").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"))
    placed = rows.where("n_tokens > 0").join(budgets.where("budget > 0"), leaf).withColumn("place", place).withColumn("slot", F.substring("place", 1, 3))
    # running sums over at most 4096 slots of a leaf find the slot in which the prefix ends; only that one is sorted
    slots = placed.groupBy(*leaf, "slot").agg(F.sum("n_tokens").alias("held"), F.first("rest").alias("rest"))
    so_far = Window.partitionBy(*leaf).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("before", F.coalesce(F.sum("held").over(so_far), F.lit(0))).select(*leaf, "slot", "before", "held")
    known = placed.join(slots, [*leaf, "slot"])
    inside = known.where(F.col("before") + F.col("held") <= F.col("rest")).withColumn("part", F.col("n_tokens"))
    beyond = known.where(F.col("before") >= F.col("rest")).withColumn("part", F.lit(0).cast("long"))
    edge = known.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("held") > F.col("rest")))
    in_slot = Window.partitionBy(*leaf, "slot").orderBy("place", "id", F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n_tokens").over(in_slot), F.lit(0))
    edge = edge.withColumn("start", start).withColumn("part", F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("rest") - F.col("start"))).cast("long")).drop("start")
    done = inside.unionByName(beyond).unionByName(edge)
    taken = F.col("epochs") * F.col("n_tokens") + F.col("part")
    return done.where(taken > 0).select(F.col("id").alias(id_col), *leaf, "n_tokens", "epochs", F.col("part").alias("part_tokens"), taken.alias("taken_tokens"))


def mixture_sql(plan: MixturePlan) -> str:
    """DuckDB SQL for mix_sources over the table documents."""

    def weight(name: str, table: dict[str, float]) -> str:
        return "CASE " + " ".join(f"WHEN {name} = '{k}' THEN {float(v)}" for k, v in table.items()) + " ELSE 1.0 END" if table else "1.0"

    def level(name: str, rows: str, parent: str, budget: str, out: str) -> str:
        return f"""{name}_a AS (SELECT *, CASE WHEN w > 0 THEN cap / w ELSE 'inf'::DOUBLE END AS lv, CASE WHEN w > 0 THEN cap ELSE 0.0 END AS pc FROM ({rows})),
        {name}_b AS (SELECT *, sum(pc) OVER (PARTITION BY {parent} ORDER BY lv RANGE UNBOUNDED PRECEDING) AS filled,
            sum(w) OVER (PARTITION BY {parent}) - sum(w) OVER (PARTITION BY {parent} ORDER BY lv RANGE UNBOUNDED PRECEDING) AS op FROM {name}_a),
        {name}_c AS (SELECT *, w > 0 AND filled + CASE WHEN op > 1e-9 THEN lv * op ELSE 0.0 END <= {budget} AS fl FROM {name}_b),
        {name}_d AS (SELECT *, sum(CASE WHEN fl THEN pc ELSE 0.0 END) OVER (PARTITION BY {parent}) AS tk, sum(CASE WHEN fl THEN 0.0 ELSE w END) OVER (PARTITION BY {parent}) AS lf FROM {name}_c),
        {name} AS (SELECT *, CASE WHEN fl THEN cap WHEN lf > 1e-9 THEN least(cap, ({budget} - tk) * w / lf) ELSE 0.0 END AS {out} FROM {name}_d)"""

    return f"""WITH docs AS (SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
            CASE WHEN regexp_extract(coalesce(source, '(none)'), '([0-9]{{1,9}})$', 1) <> '' THEN 'd' || (regexp_extract(source, '([0-9]{{1,9}})$', 1)::INT % 4)::VARCHAR ELSE 'other' END AS domain,
            coalesce(len(regexp_extract_all(text, '[^\\x09-\\x0D ]+')), 0)::BIGINT AS n_tokens FROM documents),
        leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::DOUBLE * {plan.max_epochs} AS cap FROM docs GROUP BY ALL),
        total AS (SELECT sum(tokens)::DOUBLE * {plan.budget_share} AS b0 FROM leaves),
        {level("l1", f"SELECT domain, 1 AS root, sum(cap) AS cap, {weight('domain', plan.domains)} AS w, any_value(b0) AS b0 FROM leaves, total GROUP BY domain", "root", "b0", "b1")},
        {level("l2", f"SELECT v.domain, v.lang, sum(v.cap) AS cap, {weight('v.lang', plan.languages)} AS w, any_value(l1.b1) AS b1 FROM leaves v JOIN l1 USING (domain) GROUP BY v.domain, v.lang", "domain", "b1", "b2")},
        {level("l3", f"SELECT v.domain, v.lang, v.source, v.tokens, v.cap, {weight('v.source', plan.sources)} AS w, l2.b2 FROM leaves v JOIN l2 USING (domain, lang)", "domain, lang", "b2", "share")},
        budgets AS (SELECT domain, lang, source, tokens, floor(share + 1e-6)::BIGINT AS budget, CASE WHEN tokens > 0 THEN floor(floor(share + 1e-6) / tokens) ELSE 0 END::BIGINT AS epochs FROM l3),
        placed AS (SELECT d.*, b.epochs, b.budget - b.epochs * b.tokens AS rest, md5('{plan.seed}:' || b.epochs::VARCHAR || ':' || coalesce(d.doc_id::VARCHAR, '')) AS place
            FROM docs d JOIN budgets b USING (domain, lang, source) WHERE d.n_tokens > 0 AND b.budget > 0),
        run AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, n_tokens DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM placed),
        part AS (SELECT *, greatest(0, least(n_tokens, rest - start))::BIGINT AS part_tokens FROM run)
        SELECT doc_id, domain, lang, source, n_tokens, epochs, part_tokens, (epochs * n_tokens + part_tokens)::BIGINT AS taken_tokens FROM part WHERE epochs * n_tokens + part_tokens > 0"""
