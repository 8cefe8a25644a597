"""Delimited text files, landed as all-text columns with ingest metadata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierlake.contracts import WIDE_IDS, WIDE_YEARS, Contract
from tierlake.functions.casts import quoted
from tierlake.functions.keys import key_hash
from tierlake.operators.reshape import YEAR_HEADER, unpivot_wide
from tierlake.sources import positions

CORRUPT = "_corrupt_record"
TRAILING = "_trailing"
# Places kept for the cells of one wide row, more than a file has columns.
CELLS = 1 << 16


class TooManyBadRows(Exception):
    """A file has more malformed rows than its contract tolerates."""


class HeaderMismatch(Exception):
    """The first line of a file does not name the contract's columns in their order."""


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    separator: str = ",",
    header: bool = True,
    encoding: str = "UTF-8",
    trailing_separator: bool = False,
) -> DataFrame:
    """Text columns bound by position, so that stray blanks in header names do not matter.

    A row with too few or too many fields keeps its whole text in ``_corrupt_record``, which is
    NULL for a good row. An empty field is NULL. ``trailing_separator`` accepts files that end every
    row with one.
    """
    names = [*columns, TRAILING] if trailing_separator else list(columns)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    frame = (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", True)
        .option("sep", separator)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # With pruning, a query that leaves columns out would no longer notice malformed rows.
        .option("columnPruning", False)
        .csv(path)
    )
    return frame.select(*columns, CORRUPT, F.col("_metadata.file_name").alias("_src_file"), *positions.located())


def read_contract(spark: SparkSession, path: str | list[str], contract: Contract, **options) -> DataFrame:
    options.setdefault("separator", contract.separator)
    return read_delimited(spark, path, contract.source_columns, **options)


def read_wide(spark: SparkSession, path: str | list[str], years: Sequence[str] = WIDE_YEARS, **options) -> DataFrame:
    """Wide capacity file: id columns, then one column per year."""
    return read_delimited(spark, path, [*WIDE_IDS, *years], **options)


def header_years(spark: SparkSession, path: str | list[str], separator: str) -> list[str]:
    """The years that the first line of a wide file names; the default years where it names none."""
    first = spark.read.option("sep", separator).option("escape", '"').csv(path).first() or ()
    return [name.strip() for name in first if name and YEAR_HEADER.match(name.strip())] or list(WIDE_YEARS)


def wide_to_long(wide: DataFrame, contract: Contract, years: Sequence[str] | None = None) -> DataFrame:
    """The contract's long columns from a wide frame; blank cells are dropped."""
    entity, code, period, value = contract.source_columns
    kept = [name for name in wide.columns if name.startswith("_")]
    named = wide.withColumnsRenamed({WIDE_IDS[0]: entity, WIDE_IDS[1]: code})
    place = positions.CELL if positions.ORDINAL in kept else None
    return unpivot_wide(named, [entity, code, *kept], years, period, value, place)


def _bare(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))


def is_header(names: Sequence[str], separator: str = ",") -> Column:
    """Whether a row, read as data, repeats the names in their order; case and stray blanks do not matter.

    A name may hold the separator without quotes: such a line is malformed as a row, and compared as a whole.
    """
    fields = reduce(lambda same, n: same & (_bare(F.col(quoted(n))) == _bare(F.lit(n))), names, F.lit(True))
    whole = _bare(F.col(CORRUPT)) == _bare(F.lit(separator.join(names)))
    return F.when(F.col(CORRUPT).isNull(), fields).otherwise(whole)


def is_malformed(contract: Contract | None = None) -> Column:
    """Wrong number of fields, or longer than a declared column."""
    bad = F.col(CORRUPT).isNotNull()
    if contract is None:
        return bad
    return _longer(bad, {f.source: f.max_length for f in contract.fields if f.max_length})


def is_malformed_wide(contract: Contract, years: Sequence[str]) -> Column:
    """The same for a wide file: its names, codes and cells have the declared lengths of the long columns."""
    entity, code, _, value = contract.source_columns
    declared = {f.source: f.max_length for f in contract.fields if f.max_length}
    places = {entity: [WIDE_IDS[0]], code: [WIDE_IDS[1]], value: years}
    return _longer(is_malformed(), {c: declared[s] for s, columns in places.items() if s in declared for c in columns})


def _longer(bad: Column, lengths: dict[str, int]) -> Column:
    return reduce(lambda found, c: found | F.coalesce(F.length(c) > lengths[c], F.lit(False)), lengths, bad)


def well_formed(frame: DataFrame, bad: Column | None = None) -> DataFrame:
    return frame.filter(~(is_malformed() if bad is None else bad)).drop(CORRUPT)


def malformed(frame: DataFrame, bad: Column | None = None) -> DataFrame:
    return frame.filter(is_malformed() if bad is None else bad)


def add_metadata(frame: DataFrame, contract: Contract, charset: str = "UTF-16LE") -> DataFrame:
    """Ingest time, hash of the business key, and an ordinal that is stored to break ties later.

    The ordinal is the place in the load where the frame has it (``positions.with_ordinal``), cells of a wide row one after the
    other; else a number that only tells the rows apart.
    """
    ordinal = F.monotonically_increasing_id()
    if positions.ORDINAL in frame.columns:
        ordinal = F.col(positions.ORDINAL)
        if positions.CELL in frame.columns:
            ordinal = ordinal * CELLS + F.col(positions.CELL)
    return frame.select(
        *contract.source_columns,
        "_src_file",
        F.current_timestamp().alias("_ingested_at"),
        key_hash(list(contract.hash_key), charset).alias("_row_hash"),
        ordinal.alias(positions.ORDINAL),
    )
