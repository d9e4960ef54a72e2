import pytest

import __spark_entry__ as entry
from tests.compare import DATA, both

SQL = {k: v for k, v in entry.oracle_sql().items() if not k.startswith(("op", "pipeline"))}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    columns, got, names, want = both(spark, entry.queries()[name], SQL[name], f"{DATA}/sf0.001")
    assert columns == names
    assert len(got) == len(want)
    assert got == want


def test_every_query_without_sql_has_rows(spark):
    for name, query in entry.queries().items():
        if name not in SQL and not name.startswith(("op", "pipeline")):
            assert query(spark, f"{DATA}/sf0.001").limit(1).count() == 1, name


def test_entry_is_registered(spark):
    assert entry.entry(spark).count() > 0
