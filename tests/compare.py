"""Run registered queries in Spark and their SQL in DuckDB and compare whole results.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import pathlib
import sys
import time

import duckdb
import pandas as pd

ROOT = pathlib.Path(__file__).resolve().parents[1]
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = pathlib.Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def normal(table) -> pd.DataFrame:
    """Columns by name and rows by value; exact, except that NaN and NULL are one."""
    frame = table.to_pandas(types_mapper=pd.ArrowDtype)
    frame = frame[sorted(frame.columns)]
    out = pd.DataFrame({c: frame[c].astype(object).where(frame[c].notna(), None).map(repr) for c in frame.columns})
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def kinds(table) -> dict[str, str]:
    names = {"large_string": "string", "timestamp[us, tz=UTC]": "timestamp[us]"}
    return {f.name: names.get(str(f.type), str(f.type)) for f in table.schema}


def difference(df, con, sql: str) -> str | None:
    """None when schema, rows and values agree, else a short account."""
    got = df.toArrow()
    want = con.sql(sql).to_arrow_table()
    if kinds(got) != kinds(want):
        return f"schema {sorted(set(kinds(got).items()) ^ set(kinds(want).items()))}"
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} != {want.num_rows}"
    a, b = normal(got), normal(want)
    if not a.equals(b):
        rows = (a != b).any(axis=1)
        return f"{int(rows.sum())} rows differ, e.g.\n{a[rows].head(3).to_string()}\n{b[rows].head(3).to_string()}"
    return None


def main() -> int:
    sys.path.insert(0, str(ROOT))
    from tierlake.registry import catalog
    from tierlake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, sql = catalog.queries(), catalog.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            found = difference(queries[name](spark, sf_dir), con, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__} {str(error)[:1500]}"
        failed += found is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {found or 'equal'}", flush=True)
    print(f"{failed} differ")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
