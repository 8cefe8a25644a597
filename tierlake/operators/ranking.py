"""Dense row numbers and ranks over a whole table, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierlake import scratch
from tierlake.operators.joins import fair_share, shuffle_partitions, spread_left_join

# monotonically_increasing_id() holds the row's position within its partition in the lower 33 bits.
POSITION_BITS = 33
POSITION_MASK = (1 << POSITION_BITS) - 1
ROWS_PER_PARTITION = 4_000_000


def _placed(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    """Range-partitioned and sorted rows with their partition and position, fixed by a checkpoint."""
    ranged = df.repartitionByRange(partitions or shuffle_partitions(df), *order).sortWithinPartitions(*order)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_MASK))
    return scratch.checkpointed(ranged.withColumns({"_part": F.spark_partition_id(), "_position": position}))


def _offsets(placed: DataFrame, amount: Column) -> DataFrame:
    """Sum of ``amount`` over all earlier partitions: one row per range partition, a bounded number."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    full = F.raise_error(F.lit("a range partition has more rows than positions; pass more partitions"))
    counted = F.when(F.count(F.lit(1)) > POSITION_MASK, full.cast("bigint")).otherwise(amount)
    sums = placed.groupBy("_part").agg(counted.alias("_sum"))
    return sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).cast("bigint").alias("_offset"))


def dense_index(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "id",
    partitions: int | None = None,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Number the rows 1..n by ``order``; end it with a unique column for a repeatable result.

    ``key`` names columns that identify a row, NULLs included, and hold all that ``order`` reads. Then only those are
    sorted and fixed, and the numbers come back by a join on them; without it whole rows are.
    """
    if key and partitions is None:
        # Counting reads the narrow columns once more; whole rows may be costly to compute twice.
        partitions = max(shuffle_partitions(df), -(-df.select(*key).count() // ROWS_PER_PARTITION))
    placed = _placed(df.select(*key) if key else df, order, partitions)
    offsets = F.broadcast(_offsets(placed, F.count(F.lit(1))))
    number = (F.col("_offset") + F.col("_position") + 1).alias(name)
    if not key or set(key) >= set(df.columns):
        return placed.join(offsets, "_part").select(*df.columns, number)
    numbered = placed.join(offsets, "_part").select(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate(key)], number)
    same = [F.col(c).eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate(key)]
    return df.join(numbered, reduce(and_, same)).select(*df.columns, name)


def score_ranks(df: DataFrame, score: str, name: str, partitions: int | None = None) -> DataFrame:
    """Rank of each distinct non-NULL score, highest first, and the number of rows that have it."""
    counts = df.filter(F.col(score).isNotNull()).groupBy(score).agg(F.count(F.lit(1)).alias("_rows"))
    placed = _placed(counts, [F.col(score).desc()], partitions)
    above = Window.partitionBy("_part").orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("_rows").over(above), F.lit(0))
    return placed.join(F.broadcast(_offsets(placed, F.sum("_rows"))), "_part").select(
        score, (F.col("_offset") + within + 1).alias(name), "_rows"
    )


def rank_by_score(
    df: DataFrame,
    score: str,
    name: str,
    spread_by: Sequence[str],
    partitions: int | None = None,
    heavy_rows: int | None = None,
) -> DataFrame:
    """Rows with a score and their rank (ties share one, gaps follow), highest score first.

    Only distinct scores are ranked; the ranks then join back. The rows are read twice, so pass a
    stored table when they are costly to compute. ``spread_by`` as in the spread join.
    """
    scored = df.filter(F.col(score).isNotNull())
    ranks = scratch.checkpointed(score_ranks(scored, score, name, partitions))
    limit = heavy_rows or fair_share(ranks.agg(F.sum("_rows")).first()[0] or 0, df)
    heavy = ranks.filter(F.col("_rows") > limit).select(score)
    return spread_left_join(scored, ranks.drop("_rows"), score, spread_by, heavy).select(name, *df.columns)
