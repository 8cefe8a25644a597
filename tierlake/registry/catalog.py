"""Name, Spark query and expected SQL of everything this package can run on the star-schema tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierlake import scratch
from tierlake.contracts import BEDS, PANEL_FIELDS, WIDE_IDS
from tierlake.functions.casts import blank_to_null, safe_cast
from tierlake.functions.keys import key_hash, match_key
from tierlake.functions.scores import step_label
from tierlake.operators import checks, dedupe, gates, joins, profiles, ranking
from tierlake.plans import marts, reports
from tierlake.plans.scorecard import scorecard
from tierlake.registry import expected as x
from tierlake.sinks.tables import LOG_SCHEMA, LOG_TABLE, REJECT_SCHEMA, REJECT_TABLE, Lake
from tierlake.sources import delimited, positions, star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}


def query(expected: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if expected is not None:
            EXPECTED[run.__name__] = x.sql(expected)
        return run

    return register


def panel_silver(spark: SparkSession, d: str, grain: str = "nation") -> DataFrame:
    return gates.silver(star.panel_bronze(spark, d, grain), star.panel())


def outbreak_silver_(spark: SparkSession, d: str, grain: str = "nation") -> DataFrame:
    return gates.silver(star.outbreak_bronze(spark, d, grain), star.outbreak())


def outbreak_stored(spark: SparkSession, d: str, grain: str = "nation") -> DataFrame:
    """The silver table as a refresh leaves it: stored, so that a plan may read it more than once."""
    return scratch.stored(outbreak_silver_(spark, d, grain), "silver")


def capacity_silver_(spark: SparkSession, d: str, grain: str = "nation") -> DataFrame:
    return gates.silver(star.capacity_bronze(spark, d, grain), star.capacity())


def card(spark: SparkSession, d: str, grain: str = "nation", variant: str = "full") -> DataFrame:
    return scorecard(
        panel_silver(spark, d, grain), outbreak_silver_(spark, d, grain), capacity_silver_(spark, d, grain), variant
    )


def raw(spark: SparkSession, d: str) -> list[tuple]:
    """Contract and rows of each raw table."""
    return [
        (star.panel(), star.panel_bronze(spark, d)),
        (star.outbreak(), star.outbreak_bronze(spark, d)),
        (star.capacity(), star.capacity_bronze(spark, d, "customer")),
    ]


def evaluated(spark: SparkSession, d: str, snapshots: bool = True) -> list[tuple]:
    """Contract and evaluated frame of each raw table."""
    return [(contract, gates.evaluate(bronze, contract, snapshots=snapshots)) for contract, bronze in raw(spark, d)]


def rejected(spark: SparkSession, d: str, snapshots: bool = True) -> DataFrame:
    found = evaluated(spark, d, snapshots)
    return profiles.stacked([gates.rejects(gated, contract, snapshots=snapshots) for contract, gated in found])


def new_lake(spark: SparkSession) -> Lake:
    """An empty lake of its own in the shared folder."""
    lake = Lake(spark, f"run_{uuid.uuid4().hex}_")
    lake.bootstrap(scratch.folder(spark, "lake"))
    return lake


# -- sources -----------------------------------------------------------------------------------

# In a file an empty field and a missing one are the same and land as NULL.
_PANEL_NAMES = ", ".join(f"""nullif("{f[0]}", '') AS "{f[0]}\"""" for f in PANEL_FIELDS)
# Headers as they come in real files: outer and doubled inner blanks.
RAW_HEADERS = {
    "BMI": " BMI ",
    "under-five deaths": "under-five deaths ",
    "HIV/AIDS": " HIV/AIDS",
    "thinness 1-19 years": " thinness  1-19 years",
}


@query(f"SELECT {_PANEL_NAMES} FROM panel_raw")
def ingest_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch.folder(spark, "csv")
    rows = star.panel_bronze(spark, d).drop(*star.PANEL_ORDER).withColumnsRenamed(RAW_HEADERS)
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    frame = delimited.read_contract(spark, path, star.panel())
    return delimited.well_formed(frame).select(*star.panel().source_columns)


ROWS_PER_FILE = 250_000


def panel_files(spark: SparkSession, d: str) -> DataFrame:
    """The raw rows as delimited files in the order of o_orderkey, read back with their place in the load."""
    path = scratch.folder(spark, "csv")
    rows = star.panel_bronze(spark, d)
    columns = star.panel().source_columns
    # Several files of a small load, and of a large one as many as it takes to keep each in bounds.
    files = max(5, -(-star.table(spark, d, "orders").count() // ROWS_PER_FILE))
    ranged = rows.repartitionByRange(files, "o_orderkey").sortWithinPartitions("o_orderkey").select("o_orderkey", *columns)
    ranged.write.option("header", True).csv(path)
    frame = delimited.read_delimited(spark, path, ["o_orderkey", *columns])
    return positions.with_ordinal(frame, positions.survey(frame, delimited.is_malformed()))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS _ordinal FROM panel_raw")
def ingest_ordinal(spark: SparkSession, d: str) -> DataFrame:
    """The place of every row in a load of several files."""
    return panel_files(spark, d).select("o_orderkey", positions.ORDINAL)


@query(
    """SELECT * EXCLUDE (rn) FROM (SELECT trim("Country") AS country, trim("Year") AS year, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
           row_number() OVER (PARTITION BY trim("Country"), trim("Year") ORDER BY o_orderkey) AS rn FROM panel_raw
           WHERE trim("Country") <> '' AND trim("Year") <> '') WHERE rn = 1"""
)
def kept_from_files(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each key in file order, whatever the splits."""
    rows = panel_files(spark, d).select(F.trim("Country").alias("country"), F.trim("Year").alias("year"), "o_orderkey", positions.ORDINAL)
    named = rows.filter("country <> '' AND year <> ''")
    return dedupe.keep_first(named, ["country", "year"], [positions.ORDINAL]).drop(positions.ORDINAL)


_LINE = "concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus)"


@query(
    f"""SELECT CASE WHEN bad THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS orderkey,
               CASE WHEN bad THEN NULL ELSE o_orderstatus END AS status, bad AS malformed,
               CASE WHEN o_orderkey % 211 = 0 THEN {_LINE} || '|extra'
                    WHEN bad THEN concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR)) END AS line
        FROM (SELECT *, o_orderkey % 211 = 0 OR o_orderkey % 101 = 0 AS bad FROM orders)"""
)
def ingest_bad_records(spark: SparkSession, d: str) -> DataFrame:
    """Short and long rows keep their text and are told apart from good ones."""
    key = F.col("o_orderkey")
    short = F.concat_ws("|", key, "o_custkey")
    line = F.concat_ws("|", key, "o_custkey", "o_orderstatus")
    text = F.when(key % 211 == 0, F.concat(line, F.lit("|extra"))).when(key % 101 == 0, short).otherwise(line)
    path = scratch.folder(spark, "csv")
    star.table(spark, d, "orders").select(text.alias("value")).write.text(path)
    frame = delimited.read_delimited(spark, path, ["orderkey", "custkey", "status"], "|", header=False)
    bad = delimited.is_malformed()
    return frame.select(
        F.when(~bad, F.col("orderkey")).alias("orderkey"),
        F.when(~bad, F.col("status")).alias("status"),
        bad.alias("malformed"),
        F.col(delimited.CORRUPT).alias("line"),
    )


@query(f"""SELECT "Entity" || ', Rep.' AS "Entity", nullif("Code", '') AS "Code", "Year", "{BEDS}" FROM capacity_raw_c""")
def ingest_wide_csv(spark: SparkSession, d: str) -> DataFrame:
    """Every field quoted, commas inside names, a trailing comma, CRLF line ends."""
    years = [str(year) for year in star.ORDER_YEARS]
    wide = star.capacity_wide(spark, d, "customer").withColumn(
        WIDE_IDS[0], F.concat(F.col(WIDE_IDS[0]), F.lit(", Rep."))
    )
    quoted = [F.concat(F.lit('"'), F.coalesce(F.col(c), F.lit("")), F.lit('",')) for c in (*WIDE_IDS, *years)]
    path = scratch.folder(spark, "csv")
    wide.select(F.concat(*quoted).alias("value")).write.option("lineSep", "\r\n").text(path)
    frame = delimited.read_wide(spark, path, years, header=False, trailing_separator=True)
    long = delimited.wide_to_long(delimited.well_formed(frame), star.capacity(), years)
    return long.select(*star.capacity().source_columns)


@query(
    """SELECT 'bronze.who_health_indicators' AS table_name, CAST(0 AS BIGINT) AS rows_before,
              count(*) AS rows_after, count(*) AS rows_loaded FROM panel_raw
       UNION ALL SELECT 'bronze.disease_outbreaks', 0, count(*), count(*) FROM outbreak_raw
       UNION ALL SELECT 'bronze.hospital_capacity', 0, count(*), count(*) FROM capacity_raw_c"""
)
def ingestion_log(spark: SparkSession, d: str) -> DataFrame:
    """Three loads into an empty lake, and the log they leave."""
    return landed(spark, d).table(LOG_TABLE).select("table_name", "rows_before", "rows_after", "rows_loaded")


def landed(spark: SparkSession, d: str) -> Lake:
    lake = new_lake(spark)
    lake.empty(LOG_SCHEMA, LOG_TABLE)
    for log_id, (contract, frame) in enumerate(raw(spark, d), start=1):
        rows = lake.replace(frame, contract.bronze_table)
        lake.log_load(log_id, contract.bronze_table, f"{contract.label}.csv", 0, rows, contract.load_note)
    return lake


@query(
    """SELECT 'bronze.who_health_indicators' AS table_name, count(*) AS rows_loaded FROM panel_raw
       UNION ALL SELECT 'bronze.disease_outbreaks', count(*) FROM outbreak_raw
       UNION ALL SELECT 'bronze.hospital_capacity', count(*) FROM capacity_raw_c"""
)
def load_summary(spark: SparkSession, d: str) -> DataFrame:
    """The summary of three loads; the time of a load differs from run to run and is left out."""
    return landed(spark, d).load_summary().select("table_name", "rows_loaded")


@query(
    """SELECT source_table, count(*) AS rejected_rows, count(DISTINCT id) AS distinct_ids, min(id) AS first_id,
              max(id) AS last_id
       FROM (SELECT source_table, row_number() OVER (ORDER BY CASE source_table
                 WHEN 'bronze.who_health_indicators' THEN 1 WHEN 'bronze.disease_outbreaks' THEN 2 ELSE 3 END) AS id
             FROM rejected) GROUP BY source_table"""
)
def reject_ids(spark: SparkSession, d: str) -> DataFrame:
    """Rejects of three tables appended one after the other: ids go on without gaps."""
    lake = new_lake(spark)
    lake.empty(REJECT_SCHEMA, REJECT_TABLE)
    for contract, gated in evaluated(spark, d):
        lake.append_rejects(gates.rejects(gated, contract, extra=contract.order), contract.order)
    return lake.table(REJECT_TABLE).groupBy("source_table").agg(
        F.count(F.lit(1)).alias("rejected_rows"), F.count_distinct("reject_id").alias("distinct_ids"),
        F.min("reject_id").alias("first_id"), F.max("reject_id").alias("last_id"),
    )


# -- bronze ------------------------------------------------------------------------------------

_UTF16 = r"regexp_replace(hex({0}), '(..)', '\100', 'g')"
_PANEL_HASH = _UTF16.format("""coalesce("Country", '') || '|' || coalesce("Year", '')""")
_OUTBREAK_HASH = _UTF16.format(
    """coalesce("Country/Region", '') || '|' || coalesce("Province/State", '') || '|' || coalesce("Date", '')"""
)


@query(
    f"""SELECT "Country", "Year", 'orders.parquet' AS _src_file,
               upper(sha256(unhex({_PANEL_HASH}))) AS _row_hash
        FROM panel_raw"""
)
def bronze_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Ingest columns; the load time and the ordinal differ from run to run and are left out."""
    landed = delimited.add_metadata(star.panel_bronze(spark, d, with_file=True), star.panel())
    return landed.select("Country", "Year", "_src_file", "_row_hash")


@query(
    f"""SELECT "Country/Region", "Province/State", "Date",
               upper(sha256(unhex({_OUTBREAK_HASH}))) AS utf16_hash,
               upper(sha256(coalesce("Country/Region", '') || '|' || coalesce("Province/State", '') || '|'
                            || coalesce("Date", ''))) AS utf8_hash
        FROM outbreak_raw"""
)
def row_key_hash(spark: SparkSession, d: str) -> DataFrame:
    names = list(star.outbreak().hash_key)
    return star.outbreak_bronze(spark, d).select(
        *names, key_hash(names).alias("utf16_hash"), key_hash(names, "UTF-8").alias("utf8_hash")
    )


_PROFILE = """SELECT '{0}' AS table_name, count(*) AS total_rows, count(DISTINCT {1}) AS distinct_entities,
    count(DISTINCT {2}) AS distinct_periods, min({2}) AS min_period, max({2}) AS max_period FROM {3}"""


@query(
    " UNION ALL ".join(
        [
            _PROFILE.format("bronze.who_health_indicators", '"Country"', '"Year"', "panel_raw"),
            _PROFILE.format("bronze.disease_outbreaks", '"Country/Region"', '"Date"', "outbreak_raw"),
            _PROFILE.format("bronze.hospital_capacity", '"Entity"', '"Year"', "capacity_raw_c"),
        ]
    )
)
def bronze_profile(spark: SparkSession, d: str) -> DataFrame:
    return profiles.stacked(
        [
            profiles.bronze_profile(star.panel_bronze(spark, d), star.panel()),
            profiles.bronze_profile(star.outbreak_bronze(spark, d), star.outbreak()),
            profiles.bronze_profile(star.capacity_bronze(spark, d, "customer"), star.capacity()),
        ]
    )


@query(
    """SELECT l_returnflag, l_linestatus, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_shipdate) AS days,
              count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY ALL"""
)
def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    """Several distinct counts per group, each in an aggregate of its own."""
    counted = {"suppliers": "l_suppkey", "days": "l_shipdate", "parts": "l_partkey"}
    return profiles.distinct_counts(star.table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], counted)


@query(
    """SELECT 'DS1 - empty Country' AS issue, count(*) AS cnt FROM panel_all WHERE k1 = ''
       UNION ALL SELECT 'DS1 - empty Year', count(*) FROM panel_all WHERE k2 = ''
       UNION ALL SELECT 'DS2 - empty Country/Region', count(*) FROM outbreak_all WHERE k1 = ''
       UNION ALL SELECT 'DS2 - unparseable Date', count(*) FROM outbreak_all WHERE d IS NULL
       UNION ALL SELECT 'DS3 - empty Code', count(*) FROM capacity_all_c WHERE k1 = ''
       UNION ALL SELECT 'DS1 - duplicate Country+Year', count(*) FROM (
           SELECT "Country", "Year" FROM panel_raw GROUP BY ALL HAVING count(*) > 1)"""
)
def bronze_key_checks(spark: SparkSession, d: str) -> DataFrame:
    return profiles.bronze_key_checks(
        star.panel_bronze(spark, d),
        star.outbreak_bronze(spark, d),
        star.capacity_bronze(spark, d, "customer"),
        star.outbreak(),
    )


@query(f"""SELECT "Entity", "Code", "Year", "{BEDS}" FROM capacity_raw_c""")
def unpivot_wide(spark: SparkSession, d: str) -> DataFrame:
    return star.capacity_bronze(spark, d, "customer").drop(*star.CAPACITY_ORDER)


# -- casts -------------------------------------------------------------------------------------

@query(
    f"""SELECT o_orderkey, {x.whole('"Year"', "SMALLINT")} AS year, {x.number('"Life expectancy"')} AS life,
               {x.whole('"Life expectancy"', "INTEGER")} AS life_as_int,
               {x.whole('"infant deaths"', "INTEGER")} AS infant_deaths,
               {x.whole('"Population"', "BIGINT")} AS population, {x.number('"GDP"')} AS gdp,
               CASE WHEN {x.blank('"Hepatitis B"')} THEN 0.0::DOUBLE ELSE {x.number('"Hepatitis B"')} END AS hepatitis_zero,
               {x.day('"Country"')} AS no_date, CAST(o_orderdate AS DATE) AS order_day
        FROM panel_raw"""
)
def safe_casts(spark: SparkSession, d: str) -> DataFrame:
    """Good and bad text to every type, in both blank modes."""
    rows = star.panel_bronze(spark, d).withColumn("day", F.col("o_orderdate").cast("date").cast("string"))
    return rows.select(
        "o_orderkey",
        safe_cast("Year", "smallint").alias("year"),
        safe_cast("Life expectancy", "double").alias("life"),
        safe_cast("Life expectancy", "int").alias("life_as_int"),
        safe_cast("infant deaths", "int").alias("infant_deaths"),
        safe_cast("Population", "bigint").alias("population"),
        safe_cast("GDP", "double").alias("gdp"),
        safe_cast("Hepatitis B", "double", blank="zero", null_as_blank=True).alias("hepatitis_zero"),
        safe_cast("Country", "date").alias("no_date"),
        safe_cast("day", "date").alias("order_day"),
    )


@query(
    f"""SELECT o_orderkey, {x.text('"Country"')} AS country, {x.text('"Year"')} AS year,
               {x.text('"Status"')} AS status FROM panel_raw"""
)
def blank_to_null_(spark: SparkSession, d: str) -> DataFrame:
    return star.panel_bronze(spark, d).select(
        "o_orderkey", *[blank_to_null(c).alias(c.lower()) for c in ("Country", "Year", "Status")]
    )


# -- gates and silver --------------------------------------------------------------------------


@query("SELECT 'bronze.who_health_indicators' AS source_table, * FROM panel_gates")
def gates_panel(spark: SparkSession, d: str) -> DataFrame:
    return gates.rejects(gates.assess(star.panel_bronze(spark, d), star.panel()), star.panel())


@query("SELECT 'bronze.disease_outbreaks' AS source_table, * FROM outbreak_gates")
def gates_outbreak(spark: SparkSession, d: str) -> DataFrame:
    return gates.rejects(gates.assess(star.outbreak_bronze(spark, d), star.outbreak()), star.outbreak())


@query("SELECT 'bronze.hospital_capacity' AS source_table, * FROM capacity_gates")
def gates_capacity(spark: SparkSession, d: str) -> DataFrame:
    bronze = star.capacity_bronze(spark, d, "customer")
    return gates.rejects(gates.assess(bronze, star.capacity()), star.capacity())


def _duplicates(bronze: DataFrame, contract) -> DataFrame:
    found = gates.rejects(gates.evaluate(bronze, contract), contract)
    return found.filter(F.col("reason_code") == contract.duplicates.code)


@query("SELECT 'bronze.who_health_indicators' AS source_table, * FROM panel_dups")
def dup_panel(spark: SparkSession, d: str) -> DataFrame:
    return _duplicates(star.panel_bronze(spark, d), star.panel())


@query("SELECT 'bronze.disease_outbreaks' AS source_table, * FROM outbreak_dups")
def dup_outbreak(spark: SparkSession, d: str) -> DataFrame:
    return _duplicates(star.outbreak_bronze(spark, d), star.outbreak())


@query("SELECT 'bronze.hospital_capacity' AS source_table, * FROM capacity_dups")
def dup_capacity(spark: SparkSession, d: str) -> DataFrame:
    return _duplicates(star.capacity_bronze(spark, d, "customer"), star.capacity())


@query("SELECT l_suppkey, min(l_quantity) AS l_quantity, CAST(1 AS BIGINT) AS firsts FROM lineitem GROUP BY l_suppkey")
def first_of_ties(spark: SparkSession, d: str) -> DataFrame:
    """One first row per key where many rows of a key share the lowest place."""
    rows = star.table(spark, d, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag")
    flagged = dedupe.flag_first(rows, [F.col("l_suppkey")], ["l_quantity"], {"first": F.lit(True)}, unique=False)
    return flagged.filter("first").groupBy("l_suppkey", "l_quantity").agg(F.count(F.lit(1)).alias("firsts"))


@query("SELECT * FROM panel_silver")
def silver_panel(spark: SparkSession, d: str) -> DataFrame:
    return panel_silver(spark, d)


@query("SELECT * FROM panel_silver_c")
def silver_panel_by_customer(spark: SparkSession, d: str) -> DataFrame:
    """Many keys instead of few."""
    return panel_silver(spark, d, "customer")


@query("SELECT * FROM outbreak_silver")
def silver_outbreak(spark: SparkSession, d: str) -> DataFrame:
    return outbreak_silver_(spark, d)


@query("SELECT * FROM capacity_silver_c")
def silver_capacity(spark: SparkSession, d: str) -> DataFrame:
    return capacity_silver_(spark, d, "customer")


@query("SELECT * FROM rejected")
def quarantine_rows(spark: SparkSession, d: str) -> DataFrame:
    return rejected(spark, d)


@query(
    """SELECT source_table, reason_code, reject_reason, count(*) AS rejected_rows FROM rejected
       GROUP BY ALL ORDER BY source_table, reason_code"""
)
def gate_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.gate_summary(rejected(spark, d, snapshots=False))


@query("SELECT source_table, count(*) AS total_rejected FROM rejected GROUP BY ALL ORDER BY source_table")
def rejects_per_table(spark: SparkSession, d: str) -> DataFrame:
    return reports.rejects_per_table(rejected(spark, d, snapshots=False))


@query(
    """SELECT 'bronze.who_health_indicators' AS source_table, (SELECT count(*) FROM panel_raw) AS bronze_rows,
           (SELECT count(*) FROM panel_silver) AS silver_rows,
           (SELECT count(*) FROM panel_all WHERE NOT ok) + (SELECT count(*) FROM panel_dups) AS rejected_rows,
           CAST(0 AS BIGINT) AS rejected_and_loaded, CAST(0 AS BIGINT) AS unaccounted_rows
       UNION ALL
       SELECT 'bronze.disease_outbreaks', count(*), count(*) FILTER (loaded), count(*) FILTER (bad),
           count(*) FILTER (loaded AND bad), count(*) FILTER (NOT loaded AND NOT bad)
       FROM (SELECT coalesce(l.rn = 1, false) AS loaded,
                 a.k1 = '' OR a.d IS NULL OR coalesce(r.rn > 1, false)
                 OR ((a.n1 IS NULL OR a.n2 IS NULL)
                     AND (trim(coalesce(a."Confirmed", '')) <> '' OR trim(coalesce(a."Deaths", '')) <> '')) AS bad
             FROM outbreak_all a
             LEFT JOIN outbreak_ranked r USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)
             LEFT JOIN outbreak_loaded l USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice))
       UNION ALL
       SELECT 'bronze.hospital_capacity', count(*), count(*) FILTER (loaded), count(*) FILTER (bad), 0,
           count(*) FILTER (NOT loaded AND NOT bad)
       FROM (SELECT coalesce(r.rn = 1, false) AS loaded,
                 a.k0 = '' OR length(a.k1) <> 3 OR NOT a.y_ok OR coalesce(r.rn > 1, false) AS bad
             FROM capacity_all_c a LEFT JOIN capacity_ranked_c r ON a._id = r._id AND a.k2 = r.k2)"""
)
def reconcile(spark: SparkSession, d: str) -> DataFrame:
    return profiles.stacked(
        [checks.reconcile(gated, contract.bronze_table) for contract, gated in evaluated(spark, d, snapshots=False)]
    )


@query(
    """SELECT 'silver.who_health_indicators' AS silver_table, count(*) AS total_rows,
           count(DISTINCT country_name) AS distinct_countries, min(year) AS min_year, max(year) AS max_year
       FROM panel_silver
       UNION ALL SELECT 'silver.disease_outbreaks', count(*), count(DISTINCT country_region), NULL, NULL
       FROM outbreak_silver
       UNION ALL SELECT 'silver.hospital_capacity', count(*), count(DISTINCT country_code), min(year), max(year)
       FROM capacity_silver_c"""
)
def silver_profile(spark: SparkSession, d: str) -> DataFrame:
    return reports.silver_profile(
        [
            (star.panel(), panel_silver(spark, d), "country_name", "year"),
            (star.outbreak(), outbreak_silver_(spark, d), "country_region", None),
            (star.capacity(), capacity_silver_(spark, d, "customer"), "country_code", "year"),
        ]
    )


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS total FROM panel_silver_c"
        for c in reports.PROFILED_COLUMNS
    )
)
def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return reports.panel_nulls(panel_silver(spark, d, "customer"))


_KEY_CHECK = """SELECT '{0}' AS table_name, coalesce(CAST(sum(n) AS BIGINT), 0) AS total_rows,
    count(*) FILTER (n > 1) AS repeated_keys, coalesce(CAST(sum(n) AS BIGINT), 0) - count(*) AS surplus_rows,
    coalesce(CAST(sum(m) AS BIGINT), 0) AS null_rows
    FROM (SELECT {1}, count(*) AS n, count(*) FILTER ({2}) AS m FROM {3} GROUP BY {1})"""


@query(
    " UNION ALL ".join(
        [
            _KEY_CHECK.format(
                "silver.who_health_indicators", "country_name, year",
                "country_name IS NULL OR year IS NULL", "panel_silver_c",
            ),
            _KEY_CHECK.format(
                "silver.hospital_capacity", "country_code, year",
                "country_name IS NULL OR country_code IS NULL OR year IS NULL OR hospital_beds_per1k IS NULL",
                "capacity_silver_c",
            ),
            _KEY_CHECK.format("gold.health_scorecard", "country_name", "country_name IS NULL", "card"),
            _KEY_CHECK.format(
                "lineitem", "l_orderkey, l_linenumber", "l_orderkey IS NULL OR l_linenumber IS NULL", "lineitem"
            ),
        ]
    )
)
def assert_keys(spark: SparkSession, d: str) -> DataFrame:
    """What the key assertion would raise on; the last table does have repeats."""
    return profiles.stacked(
        [
            checks.key_violations(
                panel_silver(spark, d, "customer"), ["country_name", "year"], (), star.panel().silver_table
            ),
            checks.key_violations(
                capacity_silver_(spark, d, "customer"),
                ["country_code", "year"],
                ["country_name", "hospital_beds_per1k"],
                star.capacity().silver_table,
            ),
            checks.key_violations(card(spark, d), ["country_name"], (), reports.GOLD_SCORECARD),
            checks.key_violations(
                star.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], (), "lineitem"
            ),
        ]
    )


# -- gold --------------------------------------------------------------------------------------


@query("SELECT * FROM profile")
def profile_latest(spark: SparkSession, d: str) -> DataFrame:
    return marts.country_profile(panel_silver(spark, d))


@query("SELECT * EXCLUDE (population, pct_expenditure, measles, thinness_1_19_years, thinness_5_9_years) FROM profile_c")
def profile_latest_demo(spark: SparkSession, d: str) -> DataFrame:
    return marts.country_profile(panel_silver(spark, d, "customer"), "demo")


@query("SELECT * FROM summary")
def outbreak_summary(spark: SparkSession, d: str) -> DataFrame:
    return marts.outbreak_summary(outbreak_stored(spark, d))


_CFR3 = x.rounded("CAST(peak_deaths AS DOUBLE) / peak_confirmed * 100", 3)


@query(
    f"""SELECT country_region, who_region, first_report_date, last_report_date, peak_confirmed, peak_deaths,
               peak_recovered, CASE WHEN peak_confirmed > 0 THEN {_CFR3} END AS case_fatality_rate_pct, reporting_days
        FROM summary_c"""
)
def outbreak_summary_demo(spark: SparkSession, d: str) -> DataFrame:
    return marts.outbreak_summary(outbreak_stored(spark, d, "customer"), "demo")


@query(
    f"""SELECT t.* EXCLUDE (c, m, r),
               CASE WHEN c > 0 THEN {x.rounded("CAST(m AS DOUBLE) / c * 100", 4)} END AS case_fatality_rate_pct,
               CASE WHEN c > 0 THEN {x.rounded("CAST(r AS DOUBLE) / c * 100", 2)} END AS recovery_rate_pct,
               c AS peak_confirmed, m AS peak_deaths, r AS peak_recovered, n.province_count
        FROM (SELECT country_region, who_region, min(report_date) AS first_report_date,
                     max(report_date) AS last_report_date,
                     CAST(datediff('day', min(report_date), max(report_date)) AS INTEGER) AS days_tracked,
                     CAST(max(confirmed) AS BIGINT) AS c, CAST(max(deaths) AS BIGINT) AS m,
                     CAST(max(recovered) AS BIGINT) AS r, CAST(max(active) AS BIGINT) AS peak_active,
                     count(*) AS reporting_days
              FROM (SELECT country_region, who_region, report_date, sum(confirmed) AS confirmed,
                           sum(deaths) AS deaths, sum(recovered) AS recovered, sum(active) AS active
                    FROM outbreak_silver GROUP BY ALL) GROUP BY ALL) t
        JOIN (SELECT country_region, who_region, count(DISTINCT province_state) AS province_count
              FROM outbreak_silver GROUP BY ALL) n USING (country_region, who_region)"""
)
def outbreak_summary_by_date(spark: SparkSession, d: str) -> DataFrame:
    """Peaks of the daily totals over provinces, and a plain province count."""
    return marts.outbreak_summary(outbreak_stored(spark, d), corrected=True, sum_provinces=True)


@query("SELECT * FROM region_view")
def region_summary(spark: SparkSession, d: str) -> DataFrame:
    return marts.region_summary(outbreak_silver_(spark, d), digits=6)


_REGION = f"""SELECT who_region, count(*) AS countries_in_region, CAST(sum(c) AS BIGINT) AS region_total_confirmed,
    CAST(sum(m) AS BIGINT) AS region_total_deaths, {x.rounded("avg(rate)", 6)} AS avg_cfr_pct FROM {{0}} GROUP BY ALL"""


@query(_REGION.format("regions_c"))
def region_summary_corrected(spark: SparkSession, d: str) -> DataFrame:
    return marts.region_summary(outbreak_silver_(spark, d, "customer"), corrected=True, digits=6)


@query("SELECT * FROM trend_c")
def beds_trend(spark: SparkSession, d: str) -> DataFrame:
    profile = marts.country_profile(panel_silver(spark, d, "customer"))
    return marts.beds_trend(capacity_silver_(spark, d, "customer"), profile)


@query(
    """SELECT c.country_code, c.country_name, c.year, c.hospital_beds_per1k, p.status AS development_status,
              p.gdp AS gdp_per_capita
       FROM capacity_silver c
       LEFT JOIN (SELECT DISTINCT country_name, status, gdp FROM panel_silver s
                  WHERE year = (SELECT max(year) FROM panel_silver t WHERE t.country_name = s.country_name)) p
         ON c.country_name = p.country_name"""
)
def beds_trend_exact(spark: SparkSession, d: str) -> DataFrame:
    return marts.beds_trend_exact(capacity_silver_(spark, d), panel_silver(spark, d))


@query(f"SELECT country_code, year, hospital_beds_per1k, {x.tier('hospital_beds_per1k')} AS capacity_tier FROM capacity_silver_c")
def capacity_tier(spark: SparkSession, d: str) -> DataFrame:
    return capacity_silver_(spark, d, "customer").select(
        "country_code", "year", "hospital_beds_per1k", step_label("hospital_beds_per1k").alias("capacity_tier")
    )


_COVER = """SELECT '{0}' AS source, (SELECT count(DISTINCT lower(trim(country_name))) FROM panel_silver) AS base_keys,
    count(*) AS matched, (SELECT count(DISTINCT lower(trim(country_name))) FROM panel_silver) - count(*) AS unmatched
    FROM (SELECT DISTINCT lower(trim(country_name)) AS k FROM panel_silver
          INTERSECT SELECT DISTINCT lower(trim({1})) FROM {2})"""


@query(
    _COVER.format("capacity", "country_name", "capacity_silver")
    + " UNION ALL "
    + _COVER.format("outbreak", "country_region", "outbreak_silver")
)
def join_coverage(spark: SparkSession, d: str) -> DataFrame:
    return joins.join_coverage(
        panel_silver(spark, d).select(match_key("country_name").alias("k")),
        {
            "capacity": capacity_silver_(spark, d).select(match_key("country_name").alias("k")),
            "outbreak": outbreak_silver_(spark, d).select(match_key("country_region").alias("k")),
        },
        "k",
    )


@query(
    """SELECT DISTINCT lower(trim(country_name)) AS k FROM panel_silver
       EXCEPT SELECT lower(trim(country_name)) FROM capacity_silver"""
)
def join_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return joins.unmatched_keys(
        panel_silver(spark, d).select(match_key("country_name").alias("k")),
        capacity_silver_(spark, d).select(match_key("country_name").alias("k")),
        "k",
    )


@query("SELECT * FROM card")
def scorecard_(spark: SparkSession, d: str) -> DataFrame:
    return card(spark, d)


@query("SELECT * FROM card_c")
def scorecard_by_customer(spark: SparkSession, d: str) -> DataFrame:
    """Every side of the joins grows with the data."""
    return card(spark, d, "customer")


@query(
    f"""SELECT * EXCLUDE (population, bmi_avg, alcohol_consumption, thinness_1_19_pct, beds_capacity_tier,
                covid_peak_recovered, covid_recovery_rate_pct, covid_days_tracked, composite_health_score)
        REPLACE (CASE WHEN covid_peak_confirmed > 0 THEN
                 {x.rounded("CAST(covid_peak_deaths AS DOUBLE) / covid_peak_confirmed * 100", 3)} END
                 AS covid_fatality_rate_pct)
        FROM card_c"""
)
def scorecard_demo(spark: SparkSession, d: str) -> DataFrame:
    return card(spark, d, "customer", "demo")


@query("SELECT country_name, life_expectancy, infant_deaths, health_risk_tier FROM card_c")
def risk_tier(spark: SparkSession, d: str) -> DataFrame:
    return card(spark, d, "customer").select("country_name", "life_expectancy", "infant_deaths", "health_risk_tier")


@query("SELECT country_name, composite_health_score FROM card_c")
def composite_score(spark: SparkSession, d: str) -> DataFrame:
    return card(spark, d, "customer").select("country_name", "composite_health_score")


# -- reports -----------------------------------------------------------------------------------


@query(
    """SELECT 'gold.health_scorecard' AS gold_object, count(*) AS rows FROM card
       UNION ALL SELECT 'gold.vw_country_health_profile', count(*) FROM profile
       UNION ALL SELECT 'gold.vw_covid_country_summary', count(*) FROM summary
       UNION ALL SELECT 'gold.vw_hospital_beds_trend', count(*) FROM trend
       UNION ALL SELECT 'gold.vw_region_summary', count(*) FROM region_view"""
)
def gold_counts(spark: SparkSession, d: str) -> DataFrame:
    panel, outbreak, capacity = panel_silver(spark, d), outbreak_silver_(spark, d), capacity_silver_(spark, d)
    profile = marts.country_profile(panel)
    return reports.gold_counts(
        {
            reports.GOLD_SCORECARD: scorecard(panel, outbreak, capacity),
            reports.GOLD_PROFILE: profile,
            reports.GOLD_OUTBREAK: marts.outbreak_summary(outbreak),
            reports.GOLD_CAPACITY: marts.beds_trend(capacity, profile),
            reports.GOLD_REGION: marts.region_summary(outbreak),
        }
    )


@query(
    f"""SELECT health_risk_tier, count(*) AS country_count,
               {x.rounded("count(*)::DOUBLE * 100 / sum(count(*)) OVER ()", 1)} AS pct_of_total,
               {x.rounded("avg(life_expectancy)", 1)} AS avg_life_exp,
               {x.rounded("avg(gdp_per_capita)", 0)} AS avg_gdp,
               {x.rounded("avg(infant_deaths)", 1)} AS avg_infant_deaths
        FROM card_c GROUP BY health_risk_tier"""
)
def tier_distribution(spark: SparkSession, d: str) -> DataFrame:
    return reports.tier_distribution(card(spark, d, "customer"))


@query(
    f"""SELECT development_status, count(*) AS country_count,
               {x.rounded("avg(life_expectancy)", 2)} AS avg_life_expectancy,
               {x.rounded("avg(infant_deaths)", 1)} AS avg_infant_deaths,
               {x.rounded("avg(gdp_per_capita)", 0)} AS avg_gdp_per_capita,
               {x.rounded("avg(hospital_beds_per1k)", 2)} AS avg_beds_per1k,
               {x.rounded("avg(hepatitis_b_pct)", 1)} AS avg_hepb_coverage,
               {x.rounded("avg(schooling_years)", 1)} AS avg_schooling_yrs
        FROM card_c WHERE development_status IS NOT NULL GROUP BY development_status"""
)
def status_comparison(spark: SparkSession, d: str) -> DataFrame:
    return reports.status_comparison(card(spark, d, "customer"))


_LIFE = """SELECT country_name, development_status, who_latest_year, life_expectancy, infant_deaths,
    hospital_beds_per1k, composite_health_score, health_risk_tier FROM card_c
    WHERE life_expectancy IS NOT NULL ORDER BY life_expectancy {0}, country_name LIMIT 10"""


@query(_LIFE.format("DESC"))
def top_n(spark: SparkSession, d: str) -> DataFrame:
    return reports.longest_lived(card(spark, d, "customer"))


@query(_LIFE.format("ASC"))
def bottom_n(spark: SparkSession, d: str) -> DataFrame:
    return reports.shortest_lived(card(spark, d, "customer"))


@query(
    """SELECT country_region, who_region, peak_confirmed, peak_deaths, case_fatality_rate_pct, recovery_rate_pct,
              days_tracked FROM summary_c WHERE peak_confirmed IS NOT NULL
       ORDER BY peak_confirmed DESC, country_region, who_region LIMIT 15"""
)
def top_outbreak(spark: SparkSession, d: str) -> DataFrame:
    return reports.worst_outbreaks(marts.outbreak_summary(outbreak_stored(spark, d, "customer")))


@query(
    """SELECT country_name, development_status, hospital_beds_per1k, beds_latest_year, life_expectancy,
              infant_deaths, gdp_per_capita, health_risk_tier
       FROM card_c WHERE hospital_beds_per1k < 1.0"""
)
def capacity_gap(spark: SparkSession, d: str) -> DataFrame:
    return reports.capacity_gap(card(spark, d, "customer"))


@query(
    """SELECT rank() OVER (ORDER BY composite_health_score DESC) AS rank_no, country_name, development_status,
              life_expectancy, income_composition, hepatitis_b_pct, polio_pct, composite_health_score, health_risk_tier
       FROM card_c WHERE composite_health_score IS NOT NULL"""
)
def score_ranking(spark: SparkSession, d: str) -> DataFrame:
    return reports.score_ranking(scratch.stored(card(spark, d, "customer"), "scorecard"))


@query(
    """SELECT country_name, development_status, life_expectancy, infant_deaths, under_five_deaths,
              hospital_beds_per1k, gdp_per_capita, hepatitis_b_pct, polio_pct, composite_health_score
       FROM card_c WHERE health_risk_tier = 'High Risk'"""
)
def high_risk(spark: SparkSession, d: str) -> DataFrame:
    return reports.high_risk(card(spark, d, "customer"))


@query(
    """SELECT country_name, development_status, who_latest_year, life_expectancy, infant_deaths, under_five_deaths,
              hospital_beds_per1k, covid_peak_confirmed, covid_peak_deaths, covid_fatality_rate_pct, health_risk_tier
       FROM card"""
)
def scorecard_listing(spark: SparkSession, d: str) -> DataFrame:
    return reports.scorecard_listing(card(spark, d))


@query("SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS id FROM orders")
def dense_id(spark: SparkSession, d: str) -> DataFrame:
    rows = star.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ranking.dense_index(rows, [F.col("o_totalprice"), F.col("o_orderkey")], key=["o_totalprice", "o_orderkey"])


@query("SELECT l_orderkey, l_linenumber, l_quantity, rank() OVER (ORDER BY l_quantity DESC) AS rank_no FROM lineitem")
def quantity_rank(spark: SparkSession, d: str) -> DataFrame:
    """Rank over every order line, with long ties."""
    rows = star.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return ranking.rank_by_score(rows, "l_quantity", "rank_no", ["l_orderkey", "l_linenumber"])


def _plain(names: dict) -> dict:
    """Public names: a trailing underscore only keeps a function apart from an imported one."""
    return {name.rstrip("_"): value for name, value in names.items()}


def queries() -> dict[str, Query]:
    return _plain(QUERIES)


def oracle_sql() -> dict[str, str]:
    return _plain(EXPECTED)
