"""Keep-first de-duplication, duplicate flags and latest row per key.

One key may hold a third of all rows. None of these operators brings such a group into one task:
the first row of a key is found by an aggregate (partial results per map task) or by a rank filter
that Spark applies per map task before the shuffle, and flags come back by a join on
key + order columns, which differ from row to row and so spread evenly. Where they do not differ, rows are
stored once with a number of their own, which takes the last place in the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierlake import scratch


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by ``order``. The rank filter runs before and after the shuffle.

    A hash leads the key, so that the sort compares numbers rather than texts with equal beginnings.
    """
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], period: str, ties: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per key: the one with the highest period. ``ties`` decides between equal periods."""
    return keep_first(df, keys, [F.col(period).desc_nulls_last(), *ties])


def flag_first(
    df: DataFrame,
    keys: Sequence[Column],
    order: Sequence[str],
    subsets: dict[str, Column],
    unique: bool = True,
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """Add one boolean per subset: is this row the first of its key among the rows of the subset?

    NULLs come first in ``order``. Rows outside a subset get false. ``unique`` says that no two rows of a key share their place
    in the order; else a hash of the whole row tells them apart (see ``row_hash``), and of rows alike throughout
    one is taken, so that exactly one row per key and subset is first either way. ``carried`` adds columns that are computed
    before the rows are shuffled; they take no part in any order.
    """
    if not unique:
        # Stored, because the number must be the same where the first rows are found and where they are marked.
        numbered = df.withColumns({"_tie": row_hash(df), "_number": F.monotonically_increasing_id()})
        told_apart = scratch.stored(numbered, "numbered")
        return flag_first(told_apart, keys, [*order, "_tie", "_number"], subsets, carried=carried).drop("_tie", "_number")
    names = [f"_key{i}" for i in range(len(keys))]
    keyed = df.withColumns(dict(zip(names, keys)) | {f"_in_{s}": c for s, c in subsets.items()} | (carried or {}))
    keyed = keyed.withColumn("_at", F.struct(*order))
    # Leads the join, so that its sorts compare numbers and look at places and key texts only where these are equal.
    spot = F.xxhash64("_at", *names)
    hashed = F.xxhash64(*names).alias("_hash")
    inside = keyed.filter(" OR ".join(f"_in_{s}" for s in subsets)).groupBy(hashed, *names)
    if len(order) == 1:
        # A plain minimum aggregates by hash, one of structs by sorting; it passes over NULLs, so they are counted.
        column = F.col(order[0])
        firsts = inside.agg(
            *[F.min(F.when(F.col(f"_in_{s}"), column)).alias(f"_low_{s}") for s in subsets],
            *[F.count_if(F.col(f"_in_{s}") & column.isNull()).alias(f"_nulls_{s}") for s in subsets],
        )
        lowest = {s: F.when(F.col(f"_nulls_{s}") == 0, F.col(f"_low_{s}")).alias(order[0]) for s in subsets}
        exists = {s: (F.col(f"_nulls_{s}") > 0) | F.col(f"_low_{s}").isNotNull() for s in subsets}
        firsts = firsts.select(*names, *[F.when(exists[s], F.struct(lowest[s])).alias(f"_min_{s}") for s in subsets])
    else:
        firsts = inside.agg(*[F.min(F.when(F.col(f"_in_{s}"), F.col("_at"))).alias(f"_min_{s}") for s in subsets])
    # One row per distinct first position of a key, with the subsets it is the first of.
    marks = [
        F.struct(
            F.col(f"_min_{s}").alias("at"),
            *[F.coalesce(F.col(f"_min_{t}") == F.col(f"_min_{s}"), F.lit(False)).alias(t) for t in subsets],
        )
        for s in subsets
    ]
    spots = (
        firsts.select(*names, F.explode(F.array_distinct(F.array(*marks))).alias("_mark"))
        .filter("_mark.at IS NOT NULL")
        .select(*names, F.col("_mark.at").alias("_at"), *[F.col(f"_mark.{s}").alias(s) for s in subsets])
        .withColumn("_spot", spot)
    )
    # The place differs from row to row, so the join is even. Structs are equal where their fields are equal or both NULL.
    return (
        keyed.withColumn("_spot", spot)
        .join(spots, ["_spot", "_at", *names], "left")
        .withColumns({s: F.coalesce(F.col(s), F.lit(False)) & F.col(f"_in_{s}") for s in subsets})
        .drop(*names, "_at", "_spot")
    )


def row_hash(df: DataFrame) -> Column:
    """Decides between rows of a key with equal places in the order."""
    return F.xxhash64(*df.columns)
