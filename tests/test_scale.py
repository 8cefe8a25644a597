"""What large tables need: narrow shuffles, rules looked at once, files of bounded size."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tierlake.contracts import outbreak_contract
from tierlake.operators import gates
from tierlake.registry import catalog

CONTRACT = outbreak_contract(order=("_ordinal",))
NAMES = [*CONTRACT.source_columns, "_ordinal"]
SCHEMA = ", ".join(f"`{n}` {'bigint' if n == '_ordinal' else 'string'}" for n in NAMES)


def bronze(spark) -> DataFrame:
    rows = [
        ("P", " A ", "1.5", "2", "2020-01-02", "5", "1", "", "x", "R"),
        ("P ", "A", "9", "9", "2020-01-02", "6", "1", None, "2", "R"),  # repeats the first
        ("P", "A", "9", "9", "2020-1-2", "7", "1", None, "2", "R"),  # another text of the same day is another key
        (None, "A", None, "", "2020-01-02", "many", "1", "3", "4", None),
        (" ", "A", "1", "1", "2020-01-02", "8", "2", "3", "4", " "),  # blank and NULL province are one key
        ("", "A", "1", "1", "2020-01-02", "9", "2", "3", "4", ""),
        ("P", "", "1", "1", "2020-01-02", "8", "2", "3", "4", "R"),
        ("P", "A", "1", "1", "02.01.2020", "8", "2", "3", "4", "R"),
    ]
    return spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], SCHEMA)



def above(df: DataFrame, operator: str) -> str:
    """The physical plan, from its top to the first operator of that name."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[: text.index(operator)]


def test_silver_is_cast_before_the_shuffle(spark):
    silver = gates.silver(bronze(spark), CONTRACT)
    assert "RLIKE" not in above(silver, "Exchange")
    found = sorted((r.province_state or "", r.report_date, r.confirmed, r.lat, r.active) for r in silver.collect())
    day = dt.date(2020, 1, 2)
    assert found == [("", day, 8, 1.0, 4), ("P", day, 5, 1.5, None), ("P", day, 7, 9.0, 2)]


def test_rules_are_looked_at_before_the_join(spark):
    gated = gates.evaluate(bronze(spark), CONTRACT)
    assert "RLIKE" not in above(gates.rejects(gated, CONTRACT), "Join")
    found = sorted((r._ordinal, r.reason_code) for r in gates.rejects(gated, CONTRACT, extra=("_ordinal",)).collect())
    assert found == [(1, "QG-003"), (3, "QG-005"), (4, "QG-003"), (5, "QG-003"), (6, "QG-001"), (7, "QG-002")]
    assert "_rules" not in gated.columns


def test_large_loads_have_more_files(spark, tmp_path, monkeypatch):
    days = [dt.datetime(1996, 1, 1 + i % 28) for i in range(70)]
    orders = [(i, 1, "O", 1.0, day, "1") for i, day in enumerate(days)]
    tables = {"orders": orders, "customer": [(1, "c", 1, 0.0, "m")], "nation": [(1, "n", 1)]}
    for name, rows in tables.items():
        spark.createDataFrame(rows, catalog.star.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 10, raising=False)
    frame = catalog.panel_files(spark, str(tmp_path))
    assert len(frame.inputFiles()) >= 7
    placed = sorted((int(r.o_orderkey), r._ordinal) for r in frame.select("o_orderkey", "_ordinal").collect())
    assert placed == [(i, i) for i in range(70)]
