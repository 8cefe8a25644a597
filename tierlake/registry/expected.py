"""DuckDB SQL that states the expected results over the same tables.

Common table expressions are kept by name; ``sql(body, *names)`` puts the ones a body needs in front.
"""

from __future__ import annotations

import re

# Fixed values, stated apart from the code that they check: texts of the published rules, a column name.
REASONS = {
    "panel country": "Country is NULL or empty – primary geographic key missing",
    "panel year missing": "Year is NULL – time dimension key missing",
    "panel year range": "Year outside valid dataset range (2000-2015)",
    "panel duplicate": "Duplicate Country+Year – only first-ingested row retained",
    "outbreak country": "Country/Region is NULL or empty – geographic key missing",
    "outbreak date": "Date value cannot be parsed as a valid calendar date",
    "outbreak duplicate": "Duplicate Country+Province+Date – first-ingested row retained",
    "outbreak counts": "Confirmed or Deaths contains non-numeric text – cannot cast to BIGINT",
    "capacity keys": "Entity (country name) or Code (ISO) is NULL or empty",
    "capacity code": "Country Code is not a valid 3-letter ISO 3166-1 Alpha-3 code",
    "capacity year": "Year cannot be parsed or is outside valid range (1960-2024)",
    "capacity duplicate": "Duplicate Code+Year – first-ingested row retained",
}
BEDS = "Hospital beds (per 1,000 people)"

WHOLE, NUMBER = r"^[+-]?[0-9]+$", r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def blank(x: str) -> str:
    return f"(trim(coalesce({x}, '')) = '')"


def whole(x: str, kind: str) -> str:
    return f"(CASE WHEN regexp_matches(trim({x}), '{WHOLE}') THEN TRY_CAST(trim({x}) AS {kind}) END)"


def number(x: str) -> str:
    value = f"TRY_CAST(trim({x}) AS DOUBLE)"
    return f"(CASE WHEN regexp_matches(trim({x}), '{NUMBER}') AND isfinite({value}) THEN {value} END)"


def day(x: str) -> str:
    return f"(CASE WHEN regexp_matches(trim({x}), '{DAY}') THEN TRY_CAST(trim({x}) AS DATE) END)"


def text(x: str) -> str:
    return f"nullif(trim({x}), '')"


def rounded(x: str, digits: int) -> str:
    """Half away from zero on the decimal value."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def shown(label: str, x: str, lead: str = "") -> str:
    return f"'{lead}{label}=[' || coalesce({x}, 'NULL') || ']'"


def tenths(a: str, b: str) -> str:
    return f"(CAST({a} AS VARCHAR) || '.' || CAST({b} AS VARCHAR))"


def reason(name: str) -> str:
    return "'" + REASONS[name].replace("'", "''") + "'"


def tier(x: str) -> str:
    return f"""CASE WHEN {x} >= 3.0 THEN 'Above WHO Recommended' WHEN {x} >= 1.0 THEN 'Near WHO Threshold'
                 ELSE 'Below WHO Threshold' END"""


PARTS: dict[str, str] = {}


def _panel(name: str, entity: str, join: str) -> None:
    price = "CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR)"
    PARTS[name] = f"""
    SELECT CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN NULL
                WHEN o_orderkey % 5 = 0 THEN ' ' || {entity} || ' ' ELSE {entity} END AS "Country",
           CASE WHEN o_orderkey % 83 = 0 THEN '9999' WHEN o_orderkey % 79 = 0 THEN 'n/a'
                WHEN o_orderkey % 73 = 0 THEN '' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS "Year",
           CASE WHEN c_custkey % 4 = 0 THEN 'Developed' WHEN c_custkey % 7 = 0 THEN ' '
                ELSE ' Developing ' END AS "Status",
           CASE WHEN o_orderkey % 71 = 0 THEN 'abc' WHEN o_orderkey % 67 = 0 THEN ''
                ELSE {tenths("40 + c_custkey % 45", "o_orderkey % 10")} END AS "Life expectancy",
           CAST(c_custkey % 400 AS VARCHAR) AS "Adult Mortality",
           CASE WHEN o_orderkey % 61 <> 0 THEN CAST(o_orderkey % 300 AS VARCHAR) END AS "infant deaths",
           {tenths("o_orderkey % 15", "c_custkey % 10")} AS "Alcohol",
           {price} AS "percentage expenditure",
           CASE WHEN o_orderkey % 59 = 0 THEN '' ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS "Hepatitis B",
           CAST(c_custkey AS VARCHAR) AS "Measles",
           {tenths("15 + o_orderkey % 30", "o_orderkey % 7")} AS "BMI",
           CAST(o_orderkey % 350 AS VARCHAR) AS "under-five deaths",
           CAST(o_orderkey % 101 AS VARCHAR) AS "Polio",
           {tenths("o_orderkey % 12", "o_orderkey % 10")} AS "Total expenditure",
           CAST((o_orderkey + c_custkey) % 100 AS VARCHAR) AS "Diphtheria",
           {tenths("o_orderkey % 13", "c_custkey % 10")} AS "HIV/AIDS",
           CASE WHEN o_orderkey % 53 <> 0 THEN {price} END AS "GDP",
           CASE WHEN o_orderkey % 47 = 0 THEN 'many'
                ELSE CAST(c_custkey * 100000 + o_orderkey AS VARCHAR) END AS "Population",
           {tenths("o_orderkey % 28", "o_orderkey % 9")} AS "thinness 1-19 years",
           {tenths("o_orderkey % 29", "o_orderkey % 8")} AS "thinness 5-9 years",
           '0.' || CAST(100 + o_orderkey % 900 AS VARCHAR) AS "Income composition of resources",
           {tenths("o_orderkey % 18", "o_orderkey % 10")} AS "Schooling",
           o_orderdate, o_orderkey
    FROM orders JOIN customer ON o_custkey = c_custkey {join}"""


_panel("panel_raw", "n_name", "JOIN nation ON c_nationkey = n_nationkey")
_panel("panel_raw_c", "c_name", "")


def _outbreak(name: str, entity: str, join: str) -> None:
    PARTS[name] = f"""
    SELECT CASE WHEN l_suppkey % 4 <> 0 THEN s_name END AS "Province/State",
           CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_partkey % 103 = 0 THEN '  '
                ELSE {entity} END AS "Country/Region",
           {tenths("l_partkey % 90", "l_linenumber")} AS "Lat",
           CASE WHEN l_partkey % 97 = 0 THEN 'east' ELSE {tenths("l_partkey % 180", "l_linenumber")} END AS "Long",
           CASE WHEN l_partkey % 107 = 0 THEN '13-45-2023'
                ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS "Date",
           CASE WHEN l_partkey % 109 = 0 THEN 'abc' WHEN l_partkey % 113 = 0 THEN ''
                ELSE CAST(l_partkey AS VARCHAR) END AS "Confirmed",
           CASE WHEN l_partkey % 113 <> 0 THEN CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) END AS "Deaths",
           CASE WHEN l_partkey % 127 = 0 THEN '' ELSE CAST(l_partkey % 50 + l_linenumber AS VARCHAR) END AS "Recovered",
           CASE WHEN l_partkey % 131 = 0 THEN 'n/a' ELSE CAST(l_suppkey AS VARCHAR) END AS "Active",
           r_name AS "WHO Region",
           l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey {join} JOIN region ON n_regionkey = r_regionkey"""


_outbreak("outbreak_raw", "n_name", "JOIN nation ON s_nationkey = n_nationkey")
_outbreak(
    "outbreak_raw_c",
    "c_name",
    "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey",
)

YEARS = [str(y) for y in range(1995, 2002)]
_counts = ", ".join(f"count(*) FILTER (year(o_orderdate) = {y}) AS y{y}" for y in YEARS)
PARTS["wide_c"] = f"""
    SELECT c_name AS "Country Name",
           CASE WHEN c_custkey % 37 = 0 THEN '' WHEN c_custkey % 31 = 0 THEN 'XX'
                ELSE 'C' || right(CAST(100 + c_custkey % 900 AS VARCHAR), 2) END AS "Country Code",
           {", ".join(
               {
                   "1997": "CASE WHEN c_custkey % 41 = 0 THEN 'n/a' ELSE CAST(y1997 AS VARCHAR) END AS y1997",
                   "1998": "CASE WHEN c_custkey % 2 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN NULL "
                           "ELSE CAST(y1998 AS VARCHAR) END AS y1998",
               }.get(y, f"CAST(y{y} AS VARCHAR) AS y{y}") for y in YEARS)},
           c_custkey AS _id
    FROM (SELECT c_custkey, c_name, {_counts} FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
PARTS["wide"] = f"""
    SELECT CASE WHEN n_nationkey % 11 = 0 THEN 'Republic of ' || n_name
                WHEN n_nationkey % 3 = 0 THEN ' ' || lower(n_name) ELSE n_name END AS "Country Name",
           CASE WHEN n_nationkey % 5 = 0 THEN 'n' ELSE 'N' END || right(CAST(100 + n_nationkey AS VARCHAR), 2)
               AS "Country Code",
           {", ".join(
               {"2001": f"CASE WHEN n_nationkey % 4 = 0 THEN ' ' ELSE {tenths('y2001 % 5', 'y2001 % 10')} END AS y2001"}
               .get(y, f"{tenths(f'y{y} % 5', f'y{y} % 10')} AS y{y}") for y in YEARS)},
           CAST(n_nationkey AS BIGINT) AS _id
    FROM (SELECT n_nationkey, n_name, {_counts} FROM orders JOIN customer ON o_custkey = c_custkey
          JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"""
for _suffix in ("", "_c"):
    PARTS[f"capacity_raw{_suffix}"] = " UNION ALL ".join(
        f"""SELECT "Country Name" AS "Entity", "Country Code" AS "Code", '{y}' AS "Year", y{y} AS "{BEDS}", _id
            FROM wide{_suffix} WHERE NOT {blank(f"y{y}")}"""
        for y in YEARS
    )

for _suffix in ("", "_c"):
    # Rows with their keys, casts and usability.
    PARTS[f"panel_all{_suffix}"] = f"""
    SELECT *, trim(coalesce("Country", '')) AS k1, trim(coalesce("Year", '')) AS k2,
           {whole('"Year"', "SMALLINT")} AS y,
           NOT {blank('"Country"')} AND coalesce({whole('"Year"', "SMALLINT")} BETWEEN 1995 AND 2001, false) AS ok
    FROM panel_raw{_suffix}"""
    PARTS[f"panel_ranked{_suffix}"] = f"""
    SELECT *, row_number() OVER (PARTITION BY k1, k2 ORDER BY o_orderdate, o_orderkey) AS rn
    FROM panel_all{_suffix} WHERE ok"""
    PARTS[f"panel_silver{_suffix}"] = f"""
    SELECT {text('"Country"')} AS country_name, y AS year, {text('"Status"')} AS status,
           {number('"Life expectancy"')} AS life_expectancy, {number('"Adult Mortality"')} AS adult_mortality,
           {whole('"infant deaths"', "INTEGER")} AS infant_deaths, {number('"Alcohol"')} AS alcohol,
           {number('"percentage expenditure"')} AS pct_expenditure, {number('"Hepatitis B"')} AS hepatitis_b,
           {whole('"Measles"', "INTEGER")} AS measles, {number('"BMI"')} AS bmi,
           {whole('"under-five deaths"', "INTEGER")} AS under_five_deaths, {number('"Polio"')} AS polio,
           {number('"Total expenditure"')} AS total_expenditure, {number('"Diphtheria"')} AS diphtheria,
           {number('"HIV/AIDS"')} AS hiv_aids, {number('"GDP"')} AS gdp,
           {whole('"Population"', "BIGINT")} AS population,
           {number('"thinness 1-19 years"')} AS thinness_1_19_years,
           {number('"thinness 5-9 years"')} AS thinness_5_9_years,
           {number('"Income composition of resources"')} AS income_composition,
           {number('"Schooling"')} AS schooling
    FROM panel_ranked{_suffix} WHERE rn = 1"""
    PARTS[f"outbreak_all{_suffix}"] = f"""
    SELECT *, trim(coalesce("Country/Region", '')) AS k1, trim(coalesce("Province/State", '')) AS k2,
           trim(coalesce("Date", '')) AS k3, {day('"Date"')} AS d,
           {whole('"Confirmed"', "BIGINT")} AS n1, {whole('"Deaths"', "BIGINT")} AS n2
    FROM outbreak_raw{_suffix}"""
    _order = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
    PARTS[f"outbreak_ranked{_suffix}"] = f"""
    SELECT *, row_number() OVER (PARTITION BY k1, k2, k3 ORDER BY {_order}) AS rn
    FROM outbreak_all{_suffix} WHERE k1 <> '' AND d IS NOT NULL"""
    PARTS[f"outbreak_loaded{_suffix}"] = f"""
    SELECT *, row_number() OVER (PARTITION BY k1, k2, k3 ORDER BY {_order}) AS rn
    FROM outbreak_all{_suffix} WHERE k1 <> '' AND d IS NOT NULL AND n1 IS NOT NULL AND n2 IS NOT NULL"""
    PARTS[f"outbreak_silver{_suffix}"] = f"""
    SELECT {text('"Province/State"')} AS province_state, {text('"Country/Region"')} AS country_region,
           {number('"Lat"')} AS lat, {number('"Long"')} AS long, d AS report_date, n1 AS confirmed, n2 AS deaths,
           {whole('"Recovered"', "BIGINT")} AS recovered, {whole('"Active"', "BIGINT")} AS active,
           {text('"WHO Region"')} AS who_region
    FROM outbreak_loaded{_suffix} WHERE rn = 1"""
    PARTS[f"capacity_all{_suffix}"] = f"""
    SELECT *, trim(coalesce("Entity", '')) AS k0, trim(coalesce("Code", '')) AS k1,
           trim(coalesce("Year", '')) AS k2, {whole('"Year"', "SMALLINT")} AS y,
           {number(f'"{BEDS}"')} AS beds,
           coalesce({whole('"Year"', "SMALLINT")} BETWEEN 1996 AND 2001, false) AS y_ok
    FROM capacity_raw{_suffix}"""
    PARTS[f"capacity_ranked{_suffix}"] = f"""
    SELECT *, row_number() OVER (PARTITION BY k1, k2 ORDER BY _id) AS rn
    FROM capacity_all{_suffix} WHERE k0 <> '' AND length(k1) = 3 AND y_ok AND beds IS NOT NULL"""
    PARTS[f"capacity_silver{_suffix}"] = f"""
    SELECT k0 AS country_name, upper(k1) AS country_code, y AS year, beds AS hospital_beds_per1k
    FROM capacity_ranked{_suffix} WHERE rn = 1"""

_panel_keys = f"{shown('Country', chr(34) + 'Country' + chr(34))} || {shown('Year', chr(34) + 'Year' + chr(34), ' | ')}"
_no_year = f"""{shown('Country', '"Country"')} || ' | Year=[NULL]'"""
PARTS["panel_gates"] = f"""
    SELECT 'QG-001' AS reason_code, {reason("panel country")} AS reject_reason, {_panel_keys} AS raw_snapshot
    FROM panel_all WHERE k1 = ''
    UNION ALL SELECT 'QG-001', {reason("panel year missing")}, {_no_year} FROM panel_all WHERE k1 <> '' AND k2 = ''
    UNION ALL SELECT 'QG-002', {reason("panel year range")}, {_panel_keys}
    FROM panel_all WHERE k1 <> '' AND k2 <> '' AND NOT coalesce(y BETWEEN 1995 AND 2001, false)"""
PARTS["panel_dups"] = f"""
    SELECT 'QG-003' AS reason_code, {reason("panel duplicate")} AS reject_reason, {_panel_keys} AS raw_snapshot
    FROM panel_ranked WHERE rn > 1"""
_place = f"""{shown('Country/Region', '"Country/Region"')} || {shown('Date', '"Date"', ' | ')}"""
_cases = f"""{shown('Country', '"Country/Region"')} || {shown('Confirmed', '"Confirmed"', ' | ')}
    || {shown('Deaths', '"Deaths"', ' | ')}"""
PARTS["outbreak_gates"] = f"""
    SELECT 'QG-001' AS reason_code, {reason("outbreak country")} AS reject_reason, {_place} AS raw_snapshot
    FROM outbreak_all WHERE k1 = ''
    UNION ALL SELECT 'QG-002', {reason("outbreak date")}, {_place} FROM outbreak_all WHERE k1 <> '' AND d IS NULL
    UNION ALL SELECT 'QG-005', {reason("outbreak counts")}, {_cases} FROM outbreak_all
    WHERE k1 <> '' AND d IS NOT NULL AND (n1 IS NULL OR n2 IS NULL)
      AND NOT ({blank('"Confirmed"')} AND {blank('"Deaths"')})"""
PARTS["outbreak_dups"] = f"""
    SELECT 'QG-003' AS reason_code, {reason("outbreak duplicate")} AS reject_reason,
           {shown('Country', '"Country/Region"')} || {shown('Province', '"Province/State"', ' | ')}
           || {shown('Date', '"Date"', ' | ')} AS raw_snapshot
    FROM outbreak_ranked WHERE rn > 1"""
_coded = f"""{shown('Entity', '"Entity"')} || {shown('Code', '"Code"', ' | ')}"""
PARTS["capacity_gates"] = f"""
    SELECT 'QG-001' AS reason_code, {reason("capacity keys")} AS reject_reason, {_coded} AS raw_snapshot
    FROM capacity_all_c WHERE k0 = '' OR k1 = ''
    UNION ALL SELECT 'QG-004', {reason("capacity code")}, {_coded} FROM capacity_all_c
    WHERE k0 <> '' AND k1 <> '' AND length(k1) <> 3
    UNION ALL SELECT 'QG-002', {reason("capacity year")}, {shown('Entity', '"Entity"')} || {shown('Year', '"Year"', ' | ')}
    FROM capacity_all_c WHERE k0 <> '' AND length(k1) = 3 AND NOT y_ok"""
PARTS["capacity_dups"] = f"""
    SELECT 'QG-003' AS reason_code, {reason("capacity duplicate")} AS reject_reason,
           {_coded} || {shown('Year', '"Year"', ' | ')} AS raw_snapshot
    FROM capacity_ranked_c WHERE rn > 1"""
PARTS["rejected"] = " UNION ALL ".join(
    f"SELECT '{table}' AS source_table, * FROM {name}_{kind}"
    for name, table in (
        ("panel", "bronze.who_health_indicators"),
        ("outbreak", "bronze.disease_outbreaks"),
        ("capacity", "bronze.hospital_capacity"),
    )
    for kind in ("gates", "dups")
)

PROFILE_MORE = ", population, pct_expenditure, measles, thinness_1_19_years, thinness_5_9_years"
for _suffix in ("", "_c"):
    PARTS[f"profile{_suffix}"] = f"""
    SELECT country_name, status, year AS latest_year, life_expectancy, adult_mortality, infant_deaths,
           under_five_deaths, gdp, schooling, income_composition, total_expenditure, hiv_aids, hepatitis_b,
           polio, diphtheria, alcohol, bmi {PROFILE_MORE}
    FROM panel_silver{_suffix}
    QUALIFY row_number() OVER (PARTITION BY country_name ORDER BY year DESC) = 1"""
    _cfr = "CAST(max(deaths) AS DOUBLE) / max(confirmed) * 100"
    _rec = "CAST(max(recovered) AS DOUBLE) / max(confirmed) * 100"
    PARTS[f"summary{_suffix}"] = f"""
    SELECT country_region, who_region, min(report_date) AS first_report_date, max(report_date) AS last_report_date,
           CAST(datediff('day', min(report_date), max(report_date)) AS INTEGER) AS days_tracked,
           max(confirmed) AS peak_confirmed, max(deaths) AS peak_deaths, max(recovered) AS peak_recovered,
           max(active) AS peak_active,
           CASE WHEN max(confirmed) > 0 THEN {rounded(_cfr, 4)} END AS case_fatality_rate_pct,
           CASE WHEN max(confirmed) > 0 THEN {rounded(_rec, 2)} END AS recovery_rate_pct,
           count(DISTINCT report_date) AS reporting_days,
           count(DISTINCT province_state) - 1 AS province_count
    FROM outbreak_silver{_suffix} GROUP BY country_region, who_region"""
    PARTS[f"trend{_suffix}"] = f"""
    SELECT c.country_code, c.country_name, c.year, c.hospital_beds_per1k, p.status AS development_status,
           p.life_expectancy AS life_expectancy_latest, p.gdp AS gdp_latest,
           {tier("c.hospital_beds_per1k")} AS capacity_tier
    FROM capacity_silver{_suffix} c LEFT JOIN profile{_suffix} p
      ON lower(trim(c.country_name)) = lower(trim(p.country_name))"""
    PARTS[f"regions{_suffix}"] = f"""
    SELECT who_region, country_region, max(confirmed) AS c, max(deaths) AS m,
           CASE WHEN max(confirmed) > 0 THEN {_cfr} END AS rate
    FROM outbreak_silver{_suffix} GROUP BY who_region, country_region"""
    PARTS[f"region_view{_suffix}"] = f"""
    SELECT who_region, CAST(1 AS BIGINT) AS countries_in_region,
           CAST(sum(c) OVER w AS BIGINT) AS region_total_confirmed,
           CAST(sum(m) OVER w AS BIGINT) AS region_total_deaths,
           {rounded("avg(rate) OVER w", 6)} AS avg_cfr_pct
    FROM regions{_suffix} WINDOW w AS (PARTITION BY who_region)"""
    PARTS[f"beds_latest{_suffix}"] = f"""
    SELECT country_name, hospital_beds_per1k, year AS beds_latest_year, {tier("hospital_beds_per1k")} AS beds_capacity_tier
    FROM capacity_silver{_suffix}
    QUALIFY row_number() OVER (PARTITION BY country_name ORDER BY year DESC, country_code) = 1"""
    _score = """coalesce(life_expectancy / 90.0::DOUBLE * 40, 0) + coalesce(income_composition * 30, 0)
        + coalesce((1 - least(hiv_aids / 10.0::DOUBLE, 1)) * 15, 0)
        + (coalesce(hepatitis_b, 0) + coalesce(polio, 0) + coalesce(diphtheria, 0)) / 300.0::DOUBLE * 15"""
    PARTS[f"card{_suffix}"] = f"""
    SELECT p.country_name, p.status AS development_status, p.latest_year AS who_latest_year, p.life_expectancy,
           p.adult_mortality, p.infant_deaths, p.under_five_deaths, p.population, p.gdp AS gdp_per_capita,
           p.schooling AS schooling_years, p.income_composition, p.total_expenditure AS health_expenditure_pct,
           p.hiv_aids AS hiv_aids_deaths, p.hepatitis_b AS hepatitis_b_pct, p.polio AS polio_pct,
           p.diphtheria AS diphtheria_pct, p.bmi AS bmi_avg, p.alcohol AS alcohol_consumption,
           p.thinness_1_19_years AS thinness_1_19_pct,
           b.hospital_beds_per1k, b.beds_latest_year, b.beds_capacity_tier,
           s.peak_confirmed AS covid_peak_confirmed, s.peak_deaths AS covid_peak_deaths,
           s.peak_recovered AS covid_peak_recovered, s.case_fatality_rate_pct AS covid_fatality_rate_pct,
           s.recovery_rate_pct AS covid_recovery_rate_pct, s.who_region AS covid_who_region,
           s.days_tracked AS covid_days_tracked,
           CASE WHEN p.life_expectancy >= 70 AND coalesce(p.infant_deaths, 9999) < 50 THEN 'Low Risk'
                WHEN p.life_expectancy >= 60 AND coalesce(p.infant_deaths, 9999) < 200 THEN 'Medium Risk'
                ELSE 'High Risk' END AS health_risk_tier,
           {rounded(_score, 2)} AS composite_health_score
    FROM profile{_suffix} p
    LEFT JOIN beds_latest{_suffix} b ON lower(trim(b.country_name)) = lower(trim(p.country_name))
    LEFT JOIN summary{_suffix} s ON lower(trim(s.country_region)) = lower(trim(p.country_name))"""

_NAME = re.compile(r"[a-z_0-9]+")


def _needed(body: str, found: list[str]) -> list[str]:
    for word in _NAME.findall(body):
        if word in PARTS and word not in found:
            _needed(PARTS[word], found)
            found.append(word)
    return found


def sql(body: str) -> str:
    """The statement with every named part it refers to, directly or not, in front."""
    parts = [f"{name} AS ({PARTS[name]})" for name in _needed(body, [])]
    return (f"WITH {', '.join(parts)} " if parts else "") + body
