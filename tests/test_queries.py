"""Every query against its SQL, on the smallest tables, and the entry contract."""

import pytest
from helpers import SMALL, duck, rows_of

from docflow.plans import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, name):
    assert rows_of(QUERIES[name](spark, SMALL).toPandas()) == rows_of(duck(SMALL).execute(ORACLES[name]).df())


def test_queries_without_sql_run(spark):
    for name in set(QUERIES) - set(ORACLES):
        assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {r["reason"] for r in entry.entry(spark).collect()} >= {"retracted", "quality"}
