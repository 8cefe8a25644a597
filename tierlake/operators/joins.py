"""Left joins on a key that may be hot, and the audit of keys without a partner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tierlake import scratch

SALTS = 32


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def fair_share(rows: int, df: DataFrame) -> int:
    """Rows of one shuffle partition if all were even. Fewer keys than partitions can hold more, however large the table."""
    return max(1, rows // shuffle_partitions(df))


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Sequence[str],
    heavy: DataFrame | None = None,
    heavy_rows: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Left join on ``key`` whose heavy keys are split over ``salts`` tasks; the result is exact.

    ``spread_by`` are left columns that differ among the rows of one key. ``heavy`` (one column,
    named as the key) lists the heavy keys where the caller knows them already; otherwise ``left`` is stored,
    and keys with more than a partition's fair share of its rows (or ``heavy_rows``) count as heavy. That list is
    shorter than the number of partitions, which bounds its broadcast.
    """
    if heavy is None:
        left = scratch.stored(left, "left")
        limit = heavy_rows or fair_share(left.count(), left)
        counts = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        heavy = scratch.stored(counts.filter(F.col("_rows") > limit).select(key), "hot")
    hot = F.broadcast(heavy.withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    # Rows without a key find no partner wherever they are, so they are spread as well.
    spreads = F.col("_hot") | F.col(key).isNull()
    salted_left = left.join(hot, key, "left").withColumn("_salt", F.when(spreads, spread).otherwise(0))
    last = F.when(F.col("_hot"), F.lit(salts - 1)).otherwise(0)
    salted_right = right.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    return salted_left.drop("_hot").join(salted_right.drop("_hot"), [key, "_salt"], "left").drop("_salt")


def join_coverage(base: DataFrame, others: dict[str, DataFrame], key: str) -> DataFrame:
    """Per joined source: distinct base keys, how many find a partner, how many do not.

    Every input has one column ``key``. Sources are reduced to their distinct keys before the join.
    """
    keys = base.select(key).distinct()
    for name, other in others.items():
        keys = keys.join(other.select(key).distinct().withColumn(name, F.lit(1)), key, "left")
    totals = keys.agg(F.count(F.lit(1)).alias("base_keys"), *[F.count(name).alias(name) for name in others])
    return totals.unpivot(["base_keys"], list(others), "source", "matched").select(
        "source", "base_keys", "matched", (F.col("base_keys") - F.col("matched")).alias("unmatched")
    )


def unmatched_keys(base: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Distinct base keys without a partner."""
    return base.select(key).distinct().join(other.select(key).distinct(), key, "left_anti")
