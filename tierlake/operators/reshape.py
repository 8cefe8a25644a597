"""Wide to long."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tierlake.functions.casts import is_blank, literal, quoted

YEAR_HEADER = re.compile(r"^\d{4}$")


def year_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if YEAR_HEADER.match(name)]


def unpivot_wide(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | None = None,
    name: str = "Year",
    value: str = "value",
    place: str | None = None,
) -> DataFrame:
    """One row per id and non-blank cell. Without ``values``, every column headed by a year is melted.

    ``place`` adds the number of the cell within its row under that name.

    ``stack`` rather than ``DataFrame.unpivot``: code generated for casts on top of the latter's
    Expand can fail to compile, and the stage then runs without code generation.
    """
    cells = list(values) if values is not None else year_columns(df)
    number = [f"{k}L, " if place else "" for k in range(len(cells))]
    pairs = ", ".join(f"{k}{literal(cell)}, {quoted(cell)}" for k, cell in zip(number, cells, strict=True))
    names = [place] if place else []
    melted = f"stack({len(cells)}, {pairs}) AS ({', '.join(map(quoted, [*names, name, value]))})"
    return df.selectExpr(*[quoted(i) for i in ids], melted).filter(~is_blank(value))
