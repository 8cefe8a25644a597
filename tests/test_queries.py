"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import compare
from tierlake.registry import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.duck(sf_dir)


@pytest.fixture(scope="module", autouse=True)
def generated_code(spark):
    """Queries run as they do outside of tests, with whole-stage code generation."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


# Physical operators that multiply rows, gather them in Python, or run row by row.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, sf_dir, name):
    df = catalog.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in plan]
    assert compare.difference(df, con, catalog.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["gates_panel", "gates_outbreak", "gates_capacity", "gate_summary", "rejects_per_table", "reconcile"])
def test_gate_plans(spark, sf_dir, name):
    """No interpreted lambda; counting queries build no snapshot."""
    plan = catalog.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    assert name.startswith("gates") or "snapshot" not in plan


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 25
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
