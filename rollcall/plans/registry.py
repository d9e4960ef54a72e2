"""All registered queries of the library, by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; sql is what DuckDB runs on the same tables."""

    def add(f: Query) -> Query:
        assert name not in _QUERIES, name
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def given(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A small table of stated rows."""
    return spark.createDataFrame(list(rows), schema)


def stated(names: Sequence[str], rows: Sequence[tuple]) -> str:
    """SQL for a small table of stated rows: inputs, and what must come out for them."""

    def plain(v: object) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).lower()
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{v!r}::DOUBLE" if isinstance(v, float) else repr(v)

    lines = ", ".join("(" + ", ".join(map(plain, r)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {lines}) AS t({', '.join(names)})"


def _load() -> None:
    from . import curation, derived, exchange, facts, history, places, records, relational, remaining, rules  # noqa: F401  (they register themselves)


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


@query(
    "flagship_breakdown",
    """SELECT c_mktsegment AS segment, n_name AS nation, count(*) AS customers, round(avg(c_acctbal), 4) AS mean_balance
       FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal IS NOT NULL AND trim(c_name) <> ''
       GROUP BY 1, 2 HAVING count(*) >= 2 ORDER BY customers DESC, segment, nation LIMIT 20""",
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, normalise, group, keep the larger groups, order, limit."""
    customer = table(spark, sf_dir, "customer").where(F.col("c_acctbal").isNotNull() & (F.trim("c_name") != ""))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    groups = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("c_mktsegment").alias("segment"), "nation")
    out = groups.agg(F.count(F.lit(1)).alias("customers"), F.round(F.avg("c_acctbal"), 4).alias("mean_balance"))
    return out.where("customers >= 2").orderBy(F.desc("customers"), "segment", "nation").limit(20)
