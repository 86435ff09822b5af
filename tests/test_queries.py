"""Every query against its SQL on a second engine, and the shape of every plan."""

import pytest
from harness import connect, difference, spark_rows, sql_rows

from __spark_entry__ import entry
from faqspark.plans.oracles import ORACLES
from faqspark.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_sql_results_have_plain_types(duck):
    """Sums of counts come as 128-bit integers, which other readers turn into floats."""
    plain = {"VARCHAR", "BIGINT", "INTEGER", "DOUBLE", "BOOLEAN"}
    for name, text in ORACLES.items():
        types = {row[1] for row in duck.execute(f"DESCRIBE {text}").fetchall()}
        assert types <= plain, name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan, "no row-at-a-time Python"
    assert difference(spark_rows(df), sql_rows(duck, ORACLES[name])) == ""


def test_entry(spark):
    assert entry(spark).count() > 0
