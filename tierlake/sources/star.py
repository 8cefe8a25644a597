"""Raw text tables in the shape of the contracts, derived from star-schema order tables.

The order tables are clean. Each function adds blanks, bad text, padding and repeats by rule, so
that every gate has rows to reject. Keys are nation names (few, heavily repeated keys) or, with
``grain="customer"``, customer names (many keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierlake.contracts import (
    BEDS,
    CAPACITY_FIELDS,
    WIDE_IDS,
    Contract,
    capacity_contract,
    outbreak_contract,
    panel_contract,
)
from tierlake.functions.casts import quoted
from tierlake.sources.delimited import wide_to_long

PANEL_ORDER = ("o_orderdate", "o_orderkey")
OUTBREAK_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
CAPACITY_ORDER = ("_id",)
ORDER_YEARS = tuple(range(1995, 2002))
GRAINS = ("nation", "customer")

# Declared, so that opening a table reads no file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def panel(**options) -> Contract:
    options = {"years": (1995, 2001), "order": PANEL_ORDER} | options
    return panel_contract(**options)


def outbreak(**options) -> Contract:
    return outbreak_contract(**({"order": OUTBREAK_ORDER} | options))


def capacity(**options) -> Contract:
    options = {"years": (1996, 2001), "order": CAPACITY_ORDER} | options
    return capacity_contract(**options)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(value: str) -> str:
    return f"CAST({value} AS STRING)"


def _decimal(whole: str, tenths: str) -> str:
    return f"concat({whole}, '.', {tenths})"


def _check(grain: str) -> None:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")


def _named(values: dict[str, str]) -> list[str]:
    return [f"{value} AS {quoted(name)}" for name, value in values.items()]


PRICE = "CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS STRING)"
PANEL_VALUES = {
    "Country": "CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN NULL "
    "WHEN o_orderkey % 5 = 0 THEN concat(' ', _name, ' ') ELSE _name END",
    "Year": "CASE WHEN o_orderkey % 83 = 0 THEN '9999' WHEN o_orderkey % 79 = 0 THEN 'n/a' "
    f"WHEN o_orderkey % 73 = 0 THEN '' ELSE {_text('year(o_orderdate)')} END",
    "Status": "CASE WHEN c_custkey % 4 = 0 THEN 'Developed' WHEN c_custkey % 7 = 0 THEN ' ' ELSE ' Developing ' END",
    "Life expectancy": "CASE WHEN o_orderkey % 71 = 0 THEN 'abc' WHEN o_orderkey % 67 = 0 THEN '' "
    f"ELSE {_decimal('40 + c_custkey % 45', 'o_orderkey % 10')} END",
    "Adult Mortality": _text("c_custkey % 400"),
    "infant deaths": f"CASE WHEN o_orderkey % 61 <> 0 THEN {_text('o_orderkey % 300')} END",
    "Alcohol": _decimal("o_orderkey % 15", "c_custkey % 10"),
    "percentage expenditure": PRICE,
    "Hepatitis B": f"CASE WHEN o_orderkey % 59 = 0 THEN '' ELSE {_text('o_orderkey % 100')} END",
    "Measles": _text("c_custkey"),
    "BMI": _decimal("15 + o_orderkey % 30", "o_orderkey % 7"),
    "under-five deaths": _text("o_orderkey % 350"),
    "Polio": _text("o_orderkey % 101"),
    "Total expenditure": _decimal("o_orderkey % 12", "o_orderkey % 10"),
    "Diphtheria": _text("(o_orderkey + c_custkey) % 100"),
    "HIV/AIDS": _decimal("o_orderkey % 13", "c_custkey % 10"),
    "GDP": f"CASE WHEN o_orderkey % 53 <> 0 THEN {PRICE} END",
    "Population": f"CASE WHEN o_orderkey % 47 = 0 THEN 'many' ELSE {_text('c_custkey * 100000 + o_orderkey')} END",
    "thinness 1-19 years": _decimal("o_orderkey % 28", "o_orderkey % 9"),
    "thinness 5-9 years": _decimal("o_orderkey % 29", "o_orderkey % 8"),
    "Income composition of resources": "concat('0.', 100 + o_orderkey % 900)",
    "Schooling": _decimal("o_orderkey % 18", "o_orderkey % 10"),
}
OUTBREAK_VALUES = {
    "Province/State": "CASE WHEN l_suppkey % 4 <> 0 THEN s_name END",
    "Country/Region": "CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_partkey % 103 = 0 THEN '  ' ELSE _name END",
    "Lat": _decimal("l_partkey % 90", "l_linenumber"),
    "Long": f"CASE WHEN l_partkey % 97 = 0 THEN 'east' ELSE {_decimal('l_partkey % 180', 'l_linenumber')} END",
    "Date": "CASE WHEN l_partkey % 107 = 0 THEN '13-45-2023' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END",
    "Confirmed": "CASE WHEN l_partkey % 109 = 0 THEN 'abc' WHEN l_partkey % 113 = 0 THEN '' "
    f"ELSE {_text('l_partkey')} END",
    "Deaths": f"CASE WHEN l_partkey % 113 <> 0 THEN {_text('CAST(floor(l_quantity) AS BIGINT)')} END",
    "Recovered": f"CASE WHEN l_partkey % 127 = 0 THEN '' ELSE {_text('l_partkey % 50 + l_linenumber')} END",
    "Active": f"CASE WHEN l_partkey % 131 = 0 THEN 'n/a' ELSE {_text('l_suppkey')} END",
    "WHO Region": "r_name",
}


def panel_bronze(spark: SparkSession, sf_dir: str, grain: str = "nation", with_file: bool = False) -> DataFrame:
    """One raw indicator row per order; ``with_file`` adds the name of the file it was read from."""
    _check(grain)
    orders = table(spark, sf_dir, "orders")
    source = ("_src_file",) if with_file else ()
    if with_file:
        orders = orders.select("*", F.col("_metadata.file_name").alias("_src_file"))
    orders = orders.withColumnRenamed("o_custkey", "c_custkey")
    rows = orders.join(table(spark, sf_dir, "customer"), "c_custkey")
    if grain == "nation":
        nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
        rows = rows.join(nations, "c_nationkey").withColumnRenamed("n_name", "_name")
    else:
        rows = rows.withColumnRenamed("c_name", "_name")
    return rows.selectExpr(*_named(PANEL_VALUES), *PANEL_ORDER, *source)


def outbreak_bronze(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """One raw count row per order line: by the supplier's nation, or by customer."""
    _check(grain)
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    rows = table(spark, sf_dir, "lineitem").join(suppliers, "l_suppkey")
    home, name = "s_nationkey", "n_name"
    if grain == "customer":
        orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey AS c_custkey")
        rows = rows.join(orders.join(table(spark, sf_dir, "customer"), "c_custkey"), "l_orderkey")
        home, name = "c_nationkey", "c_name"
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", home)
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    rows = rows.join(nations, home).join(regions, "n_regionkey").withColumnRenamed(name, "_name")
    return rows.selectExpr(*_named(OUTBREAK_VALUES), *OUTBREAK_ORDER)


def capacity_wide(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """One raw row per entity with its order count per year in a column of its own, plus ``_id``."""
    _check(grain)
    orders = table(spark, sf_dir, "orders").selectExpr("o_custkey AS c_custkey", "year(o_orderdate) AS _year")
    counts = [F.expr(f"count_if(_year = {year}) AS `{year}`") for year in ORDER_YEARS]
    rows = orders.groupBy("c_custkey").agg(*counts).join(table(spark, sf_dir, "customer"), "c_custkey")
    if grain == "customer":
        return _customer_capacity(rows)
    totals = [F.expr(f"sum(`{year}`) AS `{year}`") for year in ORDER_YEARS]
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return _nation_capacity(rows.groupBy("c_nationkey").agg(*totals).join(nations, "c_nationkey"))


def _customer_capacity(rows: DataFrame) -> DataFrame:
    code = (
        "CASE WHEN c_custkey % 37 = 0 THEN '' WHEN c_custkey % 31 = 0 THEN 'XX' "
        "ELSE concat('C', right(100 + c_custkey % 900, 2)) END"
    )
    cells = {str(year): _text(quoted(str(year))) for year in ORDER_YEARS}
    cells["1997"] = f"CASE WHEN c_custkey % 41 = 0 THEN 'n/a' ELSE {cells['1997']} END"
    cells["1998"] = (
        f"CASE WHEN c_custkey % 2 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN NULL ELSE {cells['1998']} END"
    )
    return _wide(rows, "c_name", code, cells, "c_custkey")


def _nation_capacity(rows: DataFrame) -> DataFrame:
    code = "concat(CASE WHEN c_nationkey % 5 = 0 THEN 'n' ELSE 'N' END, right(100 + c_nationkey, 2))"
    name = (
        "CASE WHEN c_nationkey % 11 = 0 THEN concat('Republic of ', n_name) "
        "WHEN c_nationkey % 3 = 0 THEN concat(' ', lower(n_name)) ELSE n_name END"
    )
    cells = {str(year): _decimal(f"`{year}` % 5", f"`{year}` % 10") for year in ORDER_YEARS}
    cells["2001"] = f"CASE WHEN c_nationkey % 4 = 0 THEN ' ' ELSE {cells['2001']} END"
    return _wide(rows, name, code, cells, "c_nationkey")


def _wide(rows: DataFrame, name: str, code: str, cells: dict[str, str], key: str) -> DataFrame:
    ids = dict(zip(WIDE_IDS, (name, code, f"'{BEDS}'", "'BEDS'")))
    return rows.selectExpr(*_named(ids | cells), f"CAST({key} AS BIGINT) AS _id")


def capacity_bronze(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """Long raw capacity rows."""
    long = wide_to_long(capacity_wide(spark, sf_dir, grain), capacity())
    return long.select(*[f[0] for f in CAPACITY_FIELDS], *CAPACITY_ORDER)
