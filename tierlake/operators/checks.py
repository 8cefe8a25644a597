"""Key assertions and the reconciliation of raw, loaded and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


class KeyViolation(Exception):
    """A table has NULLs or repeats in its key."""


def key_violations(df: DataFrame, key: Sequence[str], required: Sequence[str] = (), table: str = "") -> DataFrame:
    """One row: rows, keys that occur more than once, rows beyond the first, rows with a NULL."""
    nulls = F.lit(False)
    for name in {*key, *required}:
        nulls = nulls | F.col(name).isNull()
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(nulls).alias("_nulls")
    )
    total = F.coalesce(F.sum("_rows"), F.lit(0))
    return per_key.agg(
        total.cast("bigint").alias("total_rows"),
        F.count_if(F.col("_rows") > 1).alias("repeated_keys"),
        (total - F.count(F.lit(1))).cast("bigint").alias("surplus_rows"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).cast("bigint").alias("null_rows"),
    ).select(F.lit(table).alias("table_name"), "*")


def assert_keys(df: DataFrame, key: Sequence[str], required: Sequence[str] = (), table: str = "") -> None:
    """Raise unless the key is unique and no key or required column holds a NULL."""
    found = key_violations(df, key, required, table).first()
    if found.repeated_keys or found.null_rows:
        raise KeyViolation(
            f"{table or 'table'}: {found.repeated_keys} repeated keys ({', '.join(key)}), "
            f"{found.null_rows} rows with a NULL in a required column"
        )


def reconcile(gated: DataFrame, table: str) -> DataFrame:
    """One row: raw = loaded + rejected - both + unaccounted, for an evaluated frame."""
    bad = F.size("_failed") > 0
    return gated.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if("_load").alias("silver_rows"),
        F.count_if(bad).alias("rejected_rows"),
        F.count_if(bad & F.col("_load")).alias("rejected_and_loaded"),
        F.count_if(~bad & ~F.col("_load")).alias("unaccounted_rows"),
    ).select(F.lit(table).alias("source_table"), "*")


def unaccounted(gated: DataFrame) -> DataFrame:
    """Raw rows that are neither loaded nor rejected."""
    return gated.filter((F.size("_failed") == 0) & ~F.col("_load")).drop("_failed", "_load")
