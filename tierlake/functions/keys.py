"""Join keys, hash of the business key, and the text snapshot of a rejected row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tierlake.functions.casts import literal, quoted


def match_key(name: str) -> Column:
    """Key for joins on names: case and outer blanks do not matter."""
    return F.lower(F.trim(F.col(name)))


def key_hash(columns: list[str], charset: str = "UTF-16LE") -> Column:
    """Upper-case hex SHA-256 of the columns joined by ``|``, NULL as ''; the input is not trimmed."""
    parts = [F.coalesce(F.col(name), F.lit("")) for name in columns]
    return F.upper(F.sha2(F.encode(F.concat_ws("|", *parts), charset), 256))


def snapshot_sql(fields: tuple[tuple[str, str | None], ...]) -> str:
    """``Label=[value] | Label=[value]``; a field without a column, or with NULL, shows as NULL."""
    pieces: list[str] = []
    for position, (label, name) in enumerate(fields):
        pieces.append(literal(f"{label}=[" if position == 0 else f"] | {label}=["))
        pieces.append("'NULL'" if name is None else f"coalesce({quoted(name)}, 'NULL')")
    return f"concat({', '.join(pieces)}, ']')"


def snapshot(fields: tuple[tuple[str, str | None], ...]) -> Column:
    return F.expr(snapshot_sql(fields))
