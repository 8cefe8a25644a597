"""Where each row stands in its files: an ordinal that does not depend on how Spark splits them.

A frame that is read straight from files carries, for each row, its file, where the row's block of that file starts, and a
number that grows along the block. One narrow pass counts the rows of each block, and the malformed ones; running sums over
the blocks, in the order of files and of starts, then give every row its place in the whole load. Blocks are as many as
the scan has splits, so they, and not the rows, are what is summed up in one task.

The second pass must split the files as the first did. A scan does while the files, the sizes in the session's settings and the
number of cores are the same; a row that is found outside of its counted block stops the load instead of getting a wrong place.

Where the first lines of the files are read as rows, the same pass compares each with the header that it should be, and they
get no places. A file without any line has nothing to compare.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierlake import scratch

PATH, BLOCK, SLOT = "_path", "_block", "_slot"
ORDINAL, CELL = "_ordinal", "_cell"
# 32 bytes each; more splits than that are joined without a hint.
MAX_SENT_BLOCKS = 500_000


def located() -> list[Column]:
    """Columns to select from a file scan, before anything else touches its rows."""
    return [
        F.col("_metadata.file_path").alias(PATH),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(SLOT),
    ]


@dataclass(frozen=True)
class Survey:
    """Blocks with the place of their first row, and the totals."""

    blocks: DataFrame
    n_blocks: int
    rows: int
    malformed: int
    headless: tuple[str, ...] = ()
    headed: bool = False


def survey(frame: DataFrame, bad: Column, head: Column | None = None) -> Survey:
    """Count a located frame; nothing of its rows is kept.

    ``head`` tells, where first lines are among the rows, whether a row is a header; up to five files whose first
    line is none are named in ``headless``.
    """
    is_head = (F.col(BLOCK) == 0) & head if head is not None else F.lit(False)
    counted = frame.groupBy(PATH, BLOCK).agg(
        F.min(SLOT).alias("first"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bad & ~is_head).alias("malformed"),
        F.min(F.when(is_head, F.col(SLOT))).alias("head"),
        # Spark refuses to read nothing but the text of malformed rows.
        F.count(frame.columns[0]).alias("filled"),
    )
    earlier = Window.orderBy(PATH, BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    counted = scratch.stored(counted, "blocks")
    headless = ()
    if head is not None:
        wrong = counted.filter((F.col(BLOCK) == 0) & ~F.col("head").eqNullSafe(F.col("first")))
        headless = tuple(r[0] for r in wrong.select(PATH).orderBy(PATH).limit(5).collect())
        # The line after the header is the first with a place.
        headed = (F.col(BLOCK) == 0).cast("bigint")
        counted = counted.withColumns({"first": F.col("first") + headed, "rows": F.col("rows") - headed})
    blocks = counted.select(
        F.xxhash64(PATH).alias("_file"),
        F.col(BLOCK).alias("_start"),
        "first",
        (F.col("first") + F.col("rows")).alias("end"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        "rows",
        "malformed",
    )
    blocks = scratch.stored(blocks, "blocks")
    total = blocks.agg(F.count(F.lit(1)), F.sum("rows"), F.sum("malformed"), F.count_distinct("_file", "_start")).first()
    if total[0] != total[3]:
        raise RuntimeError("two files share a hash of their paths; load them one after the other")
    return Survey(blocks.drop("rows", "malformed"), total[0], total[1] or 0, total[2] or 0, headless, head is not None)


def with_ordinal(frame: DataFrame, found: Survey) -> DataFrame:
    """The rows with their place in the whole load, from 0, in the order of files and lines."""
    blocks = F.broadcast(found.blocks) if found.n_blocks <= MAX_SENT_BLOCKS else found.blocks
    kept = [frame[c] for c in frame.columns if c not in (PATH, BLOCK, SLOT)]
    same = (F.xxhash64(PATH) == F.col("_file")) & (F.col(BLOCK) == F.col("_start"))
    inside = F.coalesce((F.col(SLOT) >= F.col("first")) & (F.col(SLOT) < F.col("end")), F.lit(False))
    moved = F.raise_error(F.lit("the files were split in another way than when they were counted; load them again"))
    ordinal = F.when(inside, F.col("before") + F.col(SLOT) - F.col("first")).otherwise(moved.cast("bigint"))
    joined = frame.join(blocks, same, "left")
    if found.headed:
        joined = joined.filter(~F.coalesce((F.col(BLOCK) == 0) & (F.col(SLOT) == F.col("first") - 1), F.lit(False)))
    return joined.select(*kept, ordinal.alias(ORDINAL))
