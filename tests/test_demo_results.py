"""Golden results of the sample rows, through gates, marts and scorecard."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import demo
from tierlake.contracts import capacity_contract, outbreak_contract, panel_contract
from tierlake.functions.keys import key_hash
from tierlake.functions.scores import step_label
from tierlake.operators import checks, gates, profiles
from tierlake.plans import marts, reports
from tierlake.plans.scorecard import scorecard, scorecard_columns


@pytest.fixture(scope="module", params=["full", "demo"])
def variant(request):
    return request.param


@pytest.fixture(scope="module")
def contracts(variant):
    return panel_contract(variant), outbreak_contract(variant), capacity_contract(variant)


@pytest.fixture(scope="module")
def bronze(spark, contracts):
    return [df.cache() for df in demo.lake_rows(spark, contracts)]


@pytest.fixture(scope="module")
def gated(bronze, contracts):
    return [gates.evaluate(df, c).cache() for df, c in zip(bronze, contracts)]


@pytest.fixture(scope="module")
def silver(gated, contracts):
    return [gates.loaded(df, c).cache() for df, c in zip(gated, contracts)]


def values(df, *columns):
    return {tuple(row) for row in (df.select(*columns) if columns else df).collect()}


def test_bronze(bronze, contracts):
    assert [df.count() for df in bronze] == [14, 15, 15]
    found = profiles.stacked([profiles.bronze_profile(df, c) for df, c in zip(bronze, contracts)])
    assert values(found) == {
        ("bronze.who_health_indicators", 14, 8, 3, "2014", "9999"),
        ("bronze.disease_outbreaks", 15, 8, 6, "13-45-2023", "2020-06-01"),
        ("bronze.hospital_capacity", 15, 8, 4, "2016", "2019"),
    }


def test_estimated_profile(bronze, contracts):
    row = profiles.bronze_profile(bronze[0], contracts[0], rsd=0.05).first()
    assert (row.total_rows, row.distinct_entities, row.distinct_periods) == (14, 8, 3)


def test_key_checks(bronze, contracts):
    found = profiles.bronze_key_checks(*bronze, contracts[1])
    assert values(found) == {
        ("DS1 - empty Country", 2),
        ("DS1 - empty Year", 1),
        ("DS2 - empty Country/Region", 1),
        ("DS2 - unparseable Date", 1),
        ("DS3 - empty Code", 1),
        ("DS1 - duplicate Country+Year", 1),
    }


def test_gates(gated, contracts):
    rejected = profiles.stacked([gates.rejects(df, c) for df, c in zip(gated, contracts)])
    counts = reports.gate_summary(rejected).groupBy("source_table", "reason_code").agg(F.sum("rejected_rows"))
    panel, outbreak, capacity = (c.bronze_table for c in contracts)
    assert values(counts) == {
        (panel, "QG-001", 2), (panel, "QG-002", 1), (panel, "QG-003", 1),
        (outbreak, "QG-001", 1), (outbreak, "QG-002", 1), (outbreak, "QG-003", 1),
        (capacity, "QG-001", 1), (capacity, "QG-003", 1),
    }
    assert values(reports.rejects_per_table(rejected)) == {(panel, 4), (outbreak, 3), (capacity, 2)}
    texts = {row.raw_snapshot for row in rejected.collect()}
    assert {"Country=[] | Year=[2015]", "Country=[NULL] | Year=[NULL]", "Country=[Pakistan] | Year=[9999]"} <= texts
    assert "Country/Region=[NULL] | Date=[2020-03-26]" in texts
    assert "Entity=[Pakistan] | Code=[PAK] | Year=[2017]" in texts


def test_duplicate_snapshot_of_outbreak(gated, contracts, variant):
    row = gates.rejects(gated[1], contracts[1]).filter("reason_code = 'QG-003'").first()
    province = " | Province=[NULL]" if variant == "full" else ""
    assert row.raw_snapshot == f"Country=[Pakistan]{province} | Date=[2020-03-26]"


def test_silver(bronze, silver, contracts):
    assert [df.count() for df in silver] == [10, 12, 13]
    for raw, df, contract in zip(bronze, silver, contracts):
        assert values(gates.silver(raw, contract)) == values(df)
        assert df.columns == [f.target for f in contract.fields]
        types = {f.target: f.dtype for f in contract.fields}
        assert {n: t for n, t in df.dtypes} == types
    china = silver[0].filter("country_name = 'China'").first()
    assert china.bmi is None and china.population == 1376048943


def test_blank_as_zero(bronze, contracts):
    literal = contracts[0].with_options(blank="zero")
    assert gates.silver(bronze[0], literal).filter("country_name = 'China'").first().bmi == 0


def test_reconcile(gated, contracts):
    found = profiles.stacked([checks.reconcile(df, c.bronze_table) for df, c in zip(gated, contracts)])
    panel, outbreak, capacity = (c.bronze_table for c in contracts)
    assert values(found) == {(panel, 14, 10, 4, 0, 0), (outbreak, 15, 12, 3, 0, 0), (capacity, 15, 13, 2, 0, 0)}


def test_null_profile(silver):
    found = values(reports.panel_nulls(silver[0]))
    assert found == {
        ("life_expectancy", 0, 10), ("gdp", 0, 10), ("population", 0, 10), ("hepatitis_b", 0, 10), ("bmi", 1, 10),
    }


def test_silver_profile(silver, contracts):
    entities = (("country_name", "year"), ("country_region", None), ("country_code", "year"))
    found = reports.silver_profile([(c, df, *e) for c, df, e in zip(contracts, silver, entities)])
    assert values(found) == {
        (contracts[0].silver_table, 10, 7, 2014, 2015),
        (contracts[1].silver_table, 12, 7, None, None),
        (contracts[2].silver_table, 13, 7, 2016, 2019),
    }


def test_profile(silver, variant):
    found = marts.country_profile(silver[0], variant)
    assert len(found.columns) == (22 if variant == "full" else 17)
    assert values(found, "country_name", "latest_year") == {
        (name, 2015)
        for name in (
            "Pakistan", "India", "Afghanistan", "Iran (Islamic Republic of)", "Saudi Arabia", "Bangladesh", "China"
        )
    }


SUMMARY = {
    # days, confirmed, deaths, recovered, active, rate (3 digits), rate (4 digits), recovery, reporting days
    "Afghanistan": (47, 15205, 257, 1328, 13620, 1.690, 1.6902, 8.73, 2),
    "Bangladesh": (0, 52445, 711, 11053, 40681, 1.356, 1.3557, 21.08, 1),
    "China": (39, 79968, 2873, 41625, 35470, 3.593, 3.5927, 52.05, 2),
    "India": (67, 190609, 5408, 91817, 93384, 2.837, 2.8372, 48.17, 2),
    "Iran": (67, 154445, 7921, 122650, 23874, 5.129, 5.1287, 79.41, 2),
    "Pakistan": (67, 72460, 1543, 26317, 44600, 2.129, 2.1295, 36.32, 2),
    "Saudi Arabia": (0, 87142, 524, 63224, 23394, 0.601, 0.6013, 72.55, 1),
}


def test_summary(silver, variant):
    found = marts.outbreak_summary(silver[1], variant)
    if variant == "full":
        expected = {(k, *v[:5], v[6], v[7], v[8], -1) for k, v in SUMMARY.items()}
        columns = (
            "days_tracked", "peak_confirmed", "peak_deaths", "peak_recovered", "peak_active",
            "case_fatality_rate_pct", "recovery_rate_pct", "reporting_days", "province_count",
        )
    else:
        expected = {(k, *v[1:4], v[5], v[8]) for k, v in SUMMARY.items()}
        columns = ("peak_confirmed", "peak_deaths", "peak_recovered", "case_fatality_rate_pct", "reporting_days")
    assert values(found, "country_region", *columns) == expected
    assert found.filter("country_region = 'China'").first().first_report_date == dt.date(2020, 1, 22)


def test_corrected_province_count(silver):
    found = marts.outbreak_summary(silver[1], corrected=True)
    assert {row.province_count for row in found.collect()} == {0}


def test_regions(silver):
    literal = marts.region_summary(silver[1])
    assert sorted(row.who_region for row in literal.collect()) == sorted(
        ["Eastern Mediterranean"] * 4 + ["South-East Asia"] * 2 + ["Western Pacific"]
    )
    assert {row.countries_in_region for row in literal.collect()} == {1}
    expected = {
        ("Eastern Mediterranean", 4, 329252, 10245, 2.387422),
        ("South-East Asia", 2, 243054, 6119, 2.096464),
        ("Western Pacific", 1, 79968, 2873, 3.592687),
    }
    assert values(marts.region_summary(silver[1], corrected=True, digits=6)) == expected
    assert {(r, t, d) for r, _, t, d, _ in expected} == values(
        literal, "who_region", "region_total_confirmed", "region_total_deaths"
    )


def test_trend(silver):
    found = marts.beds_trend(silver[2], marts.country_profile(silver[0]))
    assert found.count() == 13
    tiers = {row[0]: row[1] for row in found.groupBy("capacity_tier").count().collect()}
    assert tiers == {"Below WHO Threshold": 9, "Near WHO Threshold": 4}
    status = {row.country_name: row.development_status for row in found.collect()}
    assert status["Iran"] is None and status["Pakistan"] == "Developing"
    exact = marts.beds_trend_exact(silver[2], silver[0])
    assert exact.count() == 13
    assert exact.filter("country_name = 'Pakistan'").first().gdp_per_capita == 1194.8


def test_tier_edges(spark):
    df = spark.createDataFrame([(3.0,), (2.99,), (1.0,), (0.99,), (None,)], "beds double")
    assert [row[0] for row in df.select(step_label("beds")).collect()] == [
        "Above WHO Recommended", "Near WHO Threshold", "Near WHO Threshold", "Below WHO Threshold",
        "Below WHO Threshold",
    ]


CARD = {
    ("Afghanistan", 65.0, 62, 0.4, 2018, "Medium Risk", 64.91),
    ("Bangladesh", 72.0, 116, 0.8, 2017, "Medium Risk", 78.20),
    ("China", 76.1, 162, None, None, "Medium Risk", 85.42),
    ("India", 68.3, 1414, 0.5, 2018, "High Risk", 74.31),
    ("Iran (Islamic Republic of)", 75.4, 16, None, None, "Low Risk", 85.71),
    ("Pakistan", 66.5, 146, 0.6, 2018, "Medium Risk", 72.76),
    ("Saudi Arabia", 74.4, 12, 2.2, 2018, "Low Risk", 87.82),
}
CARD_COLUMNS = (
    "country_name", "life_expectancy", "infant_deaths", "hospital_beds_per1k", "beds_latest_year", "health_risk_tier",
)


def test_scorecard(silver, variant):
    card = scorecard(*silver, variant)
    assert card.columns == scorecard_columns(variant)
    assert len(card.columns) == (31 if variant == "full" else 22)
    if variant == "full":
        assert values(card, *CARD_COLUMNS, "composite_health_score") == CARD
        china = card.filter("country_name = 'China'").first()
        assert china.beds_capacity_tier is None and china.covid_peak_confirmed == 79968
    else:
        assert values(card, *CARD_COLUMNS) == {row[:6] for row in CARD}
        assert card.filter("country_name = 'China'").first().covid_fatality_rate_pct == 3.593


def test_aliases(spark, silver):
    aliases = spark.createDataFrame([("Iran (Islamic Republic of)", "Iran")], "alias string, name string")
    row = scorecard(*silver, aliases=aliases).filter("country_name like 'Iran%'").first()
    assert (row.hospital_beds_per1k, row.covid_peak_confirmed) == (1.6, 154445)


def test_reports(silver):
    card = scorecard(*silver).cache()
    assert [tuple(r)[:3] for r in reports.tier_distribution(card).collect()] == [
        ("Medium Risk", 4, 57.1), ("Low Risk", 2, 28.6), ("High Risk", 1, 14.3),
    ]
    assert [r.country_name for r in reports.longest_lived(card, 2).collect()] == ["China", "Iran (Islamic Republic of)"]
    assert [r.country_name for r in reports.shortest_lived(card, 2).collect()] == ["Afghanistan", "Pakistan"]
    assert [r.country_name for r in reports.high_risk(card).collect()] == ["India"]
    assert [r.country_name for r in reports.capacity_gap(card).collect()] == [
        "Afghanistan", "India", "Pakistan", "Bangladesh",
    ]
    ranks = [(r.rank_no, r.country_name) for r in reports.score_ranking(card).collect()]
    assert ranks[0] == (1, "Saudi Arabia") and ranks[-1] == (7, "Afghanistan")
    assert reports.status_comparison(card).first().country_count == 7
    assert reports.scorecard_listing(card).first().country_name == "China"
    summary = marts.outbreak_summary(silver[1])
    assert [r.country_region for r in reports.worst_outbreaks(summary, 2).collect()] == ["India", "Iran"]
    assert values(reports.gold_counts({"a": card, "b": summary})) == {("a", 7), ("b", 7)}


def test_key_hash(spark):
    df = spark.createDataFrame([("Pakistan", "2015")], "c string, y string")
    row = df.select(key_hash(["c", "y"]).alias("a"), key_hash(["c", "y"], "UTF-8").alias("b")).first()
    assert row.a == "F0AA72294DD752E2C7287F50F95B0085020572340F7D30E19E1AD3C96629D805"
    assert row.b == "BB38550028641674BB49DC8CCC5E11707494D06466CAC4DFEA94042E3479A3CD"
