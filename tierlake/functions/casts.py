"""Blank handling and safe casts of raw text columns.

Text that is no plain number or date gives NULL and never an error. Spark alone would also read
``1.0d``, ``NaN`` or a bare year as a value, so a pattern guards each cast; it also spares the cost
of a failed cast per bad cell. The ``*_sql`` functions give Spark SQL text, which a contract with
many columns can hand over in one call.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INTEGER_TEXT = "^[+-]?[0-9]+$"
NUMBER_TEXT = "^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DATE_TEXT = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
ISO_DATE = "yyyy-M-d"

WHOLE_NUMBERS = ("smallint", "int", "bigint")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def trimmed_sql(name: str) -> str:
    return f"trim(coalesce({quoted(name)}, ''))"


def blank_sql(name: str) -> str:
    return f"({trimmed_sql(name)} = '')"


def present_sql(name: str) -> str:
    return f"({trimmed_sql(name)} <> '')"


def cast_sql(
    name: str,
    dtype: str,
    blank: str = "null",
    null_as_blank: bool = False,
    date_formats: tuple[str, ...] = (ISO_DATE,),
) -> str:
    """Cast of a text column to ``dtype``, NULL where the text is not a plain value of that type.

    ``blank="zero"`` turns blank numeric text into 0; ``null_as_blank`` makes that hold for NULL too.
    """
    if blank not in ("null", "zero"):
        raise ValueError(f"blank must be 'null' or 'zero', not {blank!r}")
    text = f"trim({quoted(name)})"
    if dtype == "string":
        return f"nullif({text}, '')"
    if dtype == "date":
        parsed = [
            _guarded(text, DATE_TEXT, "date") if pattern == ISO_DATE else f"try_to_date({text}, {literal(pattern)})"
            for pattern in date_formats
        ]
        return parsed[0] if len(parsed) == 1 else f"coalesce({', '.join(parsed)})"
    if dtype in WHOLE_NUMBERS:
        number = _guarded(text, INTEGER_TEXT, dtype)
    elif dtype == "double":
        # Beyond the range of a double the cast gives infinity, which no rule would stop.
        number = f"nullif(nullif({_guarded(text, NUMBER_TEXT, dtype)}, double('Infinity')), double('-Infinity'))"
    else:
        raise ValueError(f"no safe cast to {dtype!r}")
    if blank == "null":
        return number
    missing = blank_sql(name) if null_as_blank else f"{text} = ''"
    return f"CASE WHEN {missing} THEN CAST(0 AS {dtype}) ELSE {number} END"


def _guarded(text: str, pattern: str, dtype: str) -> str:
    return f"CASE WHEN {text} RLIKE '{pattern}' THEN try_cast({text} AS {dtype}) END"


def trimmed(name: str) -> Column:
    """Text without outer blanks, '' for NULL."""
    return F.expr(trimmed_sql(name))


def is_blank(name: str) -> Column:
    return F.expr(blank_sql(name))


def blank_to_null(name: str) -> Column:
    return F.expr(cast_sql(name, "string"))


def safe_cast(name: str, dtype: str, **options) -> Column:
    return F.expr(cast_sql(name, dtype, **options))
