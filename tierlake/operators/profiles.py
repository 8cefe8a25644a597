"""One-pass profiles: rows, distinct values, ranges, NULL counts, key checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.contracts import Contract
from tierlake.functions.casts import is_blank


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def distinct_counts(df: DataFrame, keys: Sequence[str], counted: dict[str, str]) -> DataFrame:
    """Distinct non-NULL values per group of several columns: name to column in ``counted``.

    Several distinct counts in one aggregate make Spark copy every row for each of them. Here each has an aggregate of its own
    (values of a group first, with map-side combine, then their number), and the groups are put side by side. All
    start from one aggregate over the columns together, which Spark computes once.
    """
    columns = list(dict.fromkeys(counted.values()))
    together = df.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("_rows"))
    parts = []
    for name, column in counted.items():
        per_value = together.groupBy(*keys, column).agg(F.sum("_rows").alias("_rows"))
        parts.append(per_value.groupBy(*keys).agg(F.count(column).alias(name)))
    return side_by_side(parts, keys)


def side_by_side(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Groups of several aggregates in one row each, by a union and a maximum: NULL keys meet, and no join is needed."""
    united = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
    return united.groupBy(*keys).agg(*[F.max(c).alias(c) for c in united.columns if c not in keys])


def bronze_profile(bronze: DataFrame, contract: Contract, rsd: float | None = None) -> DataFrame:
    """Rows, distinct entities and periods, and the text range of the period.

    ``rsd`` switches the distinct counts to estimates with that relative error.
    """
    entity, period = contract.entity, contract.period
    names = ["total_rows", "distinct_entities", "distinct_periods", "min_period", "max_period"]
    plain = bronze.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min(period).alias("min_period"),
        F.max(period).alias("max_period"),
        *([] if rsd is None else [F.approx_count_distinct(entity, rsd).alias("distinct_entities")]),
        *([] if rsd is None else [F.approx_count_distinct(period, rsd).alias("distinct_periods")]),
    )
    if rsd is None:
        counts = distinct_counts(bronze, [], {"distinct_entities": entity, "distinct_periods": period})
        plain = side_by_side([plain, counts], [])
    return plain.select(F.lit(contract.bronze_table).alias("table_name"), *names)


def issue_counts(df: DataFrame, issues: dict[str, Column]) -> DataFrame:
    """Rows per issue, all counted in one scan: (issue, cnt)."""
    counts = df.agg(*[F.count_if(test).alias(name) for name, test in issues.items()])
    return counts.unpivot([], list(issues), "issue", "cnt")


def repeated_groups(df: DataFrame, keys: Sequence[str], issue: str) -> DataFrame:
    """Number of key values (untrimmed, NULLs grouped) that occur more than once: (issue, cnt)."""
    groups = df.groupBy(*keys).count().filter(F.col("count") > 1)
    return groups.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(issue).alias("issue"), "cnt")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_count, total) per column, in one scan."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot(["total"], list(columns), "column_name", "null_count").select(
        "column_name", "null_count", "total"
    )


def bronze_key_checks(panel: DataFrame, outbreak: DataFrame, capacity: DataFrame, outbreak_contract: Contract) -> DataFrame:
    """Blank, unparseable and repeated keys of the three raw tables: (issue, cnt)."""
    # Labels of the issues.
    panel_issues = {"DS1 - empty Country": is_blank("Country"), "DS1 - empty Year": is_blank("Year")}
    outbreak_issues = {
        "DS2 - empty Country/Region": is_blank("Country/Region"),
        "DS2 - unparseable Date": F.expr(f"NOT {outbreak_contract.parses('Date')}"),
    }
    capacity_issues = {"DS3 - empty Code": is_blank("Code")}
    repeated = "DS1 - duplicate Country+Year"
    return stacked(
        [
            issue_counts(panel, panel_issues),
            issue_counts(outbreak, outbreak_issues),
            issue_counts(capacity, capacity_issues),
            repeated_groups(panel, ["Country", "Year"], repeated),
        ]
    )
