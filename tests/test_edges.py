"""Casts, blanks and the known traps of the rules, in published and corrected form."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import demo
from tierlake.contracts import capacity_contract, outbreak_contract, panel_contract
from tierlake.functions.casts import blank_to_null, safe_cast
from tierlake.functions.keys import snapshot
from tierlake.functions.scores import composite_score, risk_label
from tierlake.operators import checks, gates
from tierlake.plans import marts
from tierlake.plans.scorecard import scorecard

CASTS = [
    # text, smallint, bigint, double, date
    ("2015", 2015, 2015, 2015.0, None),
    (" 12 ", 12, 12, 12.0, None),
    ("+7", 7, 7, 7.0, None),
    ("-7", -7, -7, -7.0, None),
    ("66.5", None, None, 66.5, None),
    ("1e5", None, None, 100000.0, None),
    (".5", None, None, 0.5, None),
    ("5.", None, None, 5.0, None),
    ("1.0d", None, None, None, None),
    ("1f", None, None, None, None),
    ("NaN", None, None, None, None),
    ("Infinity", None, None, None, None),
    ("99999", None, 99999, 99999.0, None),
    ("9999999999999999999", None, None, 1e19, None),
    ("1e400", None, None, None, None),
    ("-1e999", None, None, None, None),
    ("9" * 400, None, None, None, None),
    ("", None, None, None, None),
    ("  ", None, None, None, None),
    (None, None, None, None, None),
    ("abc", None, None, None, None),
    ("1,000", None, None, None, None),
    ("13-45-2023", None, None, None, None),
    ("2020-01-05", None, None, None, dt.date(2020, 1, 5)),
    ("2020-1-5", None, None, None, dt.date(2020, 1, 5)),
    ("2020-02-30", None, None, None, None),
    ("2020", 2020, 2020, 2020.0, None),
    ("2020-01-05T10:00:00", None, None, None, None),
]


def test_safe_casts(spark):
    df = spark.createDataFrame([(i, row[0]) for i, row in enumerate(CASTS)], "i int, t string")
    got = df.select("i", *[safe_cast("t", d).alias(d) for d in ("smallint", "bigint", "double", "date")]).orderBy("i")
    assert [tuple(r)[1:] for r in got.collect()] == [row[1:] for row in CASTS]


def test_blank_modes(spark):
    df = spark.createDataFrame([("",), (" ",), (None,), ("x",), ("4",)], "t string")
    got = df.select(
        safe_cast("t", "int", blank="zero").alias("a"),
        safe_cast("t", "double", blank="zero", null_as_blank=True).alias("b"),
        safe_cast("t", "date", blank="zero").alias("c"),
        blank_to_null("t").alias("d"),
    )
    assert [tuple(r) for r in got.collect()] == [
        (0, 0.0, None, None), (0, 0.0, None, None), (None, 0.0, None, None), (None, None, None, "x"), (4, 4.0, None, "4"),
    ]
    with pytest.raises(ValueError):
        safe_cast("t", "int", blank="other")
    with pytest.raises(ValueError):
        safe_cast("t", "interval")


def test_more_date_formats(spark):
    df = spark.createDataFrame([("2020-01-22",), ("1/22/2020",), ("22.01.2020",)], "t string")
    got = df.select(safe_cast("t", "date", date_formats=("yyyy-M-d", "M/d/yyyy")).alias("d"))
    assert [r.d for r in got.collect()] == [dt.date(2020, 1, 22), dt.date(2020, 1, 22), None]


def test_snapshot_shows_null(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(snapshot((("X", "x"), ("Y", "y"), ("Z", None)))).first()[0] == "X=[a] | Y=[NULL] | Z=[NULL]"


def outbreak_row(country="A", province=None, date="2020-01-01", confirmed="1", deaths="0", region="R", **more):
    base = {"Recovered": "0", "Active": "0", "Lat": "0.0", "Long": "0.0"} | more
    return [province, country, base["Lat"], base["Long"], date, confirmed, deaths, base["Recovered"], base["Active"], region]


def evaluated(spark, contract, rows, **options):
    return gates.evaluate(demo.frame(spark, contract, rows), contract, **options)


def codes(df, contract):
    return sorted(r.reason_code for r in gates.rejects(df, contract).collect())


def test_rejected_and_loaded(spark):
    """First copy without a usable count: the second is a duplicate and is loaded all the same."""
    contract = outbreak_contract()
    gated = evaluated(spark, contract, [outbreak_row(confirmed="abc"), outbreak_row(confirmed="5")])
    assert codes(gated, contract) == ["QG-003", "QG-005"]
    assert [r.confirmed for r in gates.loaded(gated, contract).collect()] == [5]
    row = checks.reconcile(gated, "t").first()
    assert (row.bronze_rows, row.silver_rows, row.rejected_rows, row.rejected_and_loaded) == (2, 1, 2, 1)


def test_three_copies_with_mixed_counts(spark):
    contract = outbreak_contract()
    rows = [outbreak_row(confirmed=c) for c in ("abc", "5", "6", "xyz")]
    gated = evaluated(spark, contract, rows)
    assert codes(gated, contract) == ["QG-003"] * 3 + ["QG-005"] * 2
    assert [r.confirmed for r in gates.loaded(gated, contract).collect()] == [5]


def test_both_counts_missing_is_unaccounted(spark):
    contract = outbreak_contract()
    rows = [outbreak_row(confirmed=None, deaths=None), outbreak_row("B", confirmed="", deaths=None), outbreak_row("C")]
    gated = evaluated(spark, contract, rows)
    assert codes(gated, contract) == []
    assert checks.reconcile(gated, "t").first().unaccounted_rows == 2
    assert checks.unaccounted(gated).count() == 2
    reported = evaluated(spark, contract, rows, report_unaccounted=True)
    assert codes(reported, contract) == ["QG-006", "QG-006"]
    assert checks.reconcile(reported, "t").first().unaccounted_rows == 0


def test_one_count_missing_is_rejected(spark):
    contract = outbreak_contract()
    gated = evaluated(spark, contract, [outbreak_row(confirmed="", deaths="3"), outbreak_row("B", deaths="x")])
    assert codes(gated, contract) == ["QG-005", "QG-005"]
    literal = outbreak_contract(blank="zero")
    gated = evaluated(spark, literal, [outbreak_row(confirmed="", deaths="3")])
    assert [r.confirmed for r in gates.loaded(gated, literal).collect()] == [0]


def test_padded_and_null_keys_are_equal(spark):
    contract = outbreak_contract()
    rows = [outbreak_row(" A "), outbreak_row("A", ""), outbreak_row("A", " "), outbreak_row("A", "P"), outbreak_row("a")]
    assert codes(evaluated(spark, contract, rows), contract) == ["QG-003", "QG-003"]
    folded = contract.with_options(match="ci")
    assert codes(evaluated(spark, folded, rows), folded) == ["QG-003"] * 3
    with pytest.raises(ValueError):
        contract.with_options(match="fuzzy").key_columns()


def test_date_text_variants_are_two_keys(spark):
    contract = outbreak_contract()
    rows = [outbreak_row(date="2020-01-01"), outbreak_row(date="2020-1-1")]
    assert codes(evaluated(spark, contract, rows), contract) == []
    typed = contract.with_options(match="typed")
    assert codes(evaluated(spark, typed, rows), typed) == ["QG-003"]


def test_capacity_gates(spark):
    contract = capacity_contract()
    rows = [
        ["A", "AA", "2000", "1"],  # QG-004
        ["A", "AAA", "1959", "1"],  # QG-002
        ["A", "AAA", "n/a", "1"],  # QG-002
        ["A", "AAA", "2025", "1"],  # QG-002
        ["A", " ", "2000", "1"],  # QG-001
        [None, "AAA", "2000", "1"],  # QG-001
        ["A", "AAA", "2000", "many"],  # no gate, not loaded
        ["A", "aaa ", "2000", "2.5"],
        ["A", "aaa", "2000", "2.6"],  # QG-003
    ]
    gated = evaluated(spark, contract, rows)
    assert codes(gated, contract) == ["QG-001"] * 2 + ["QG-002"] * 3 + ["QG-003", "QG-004"]
    assert [tuple(r) for r in gates.loaded(gated, contract).collect()] == [("A", "AAA", 2000, 2.5)]
    assert checks.reconcile(gated, "t").first().unaccounted_rows == 1


def test_capacity_demo_gates(spark):
    """No year gate, and the duplicate gate does not ask for usable beds."""
    contract = capacity_contract("demo")
    rows = [["A", "AAA", "1959", "1"], ["A", "AAA", "2000", "many"], ["A", "AAA", "2000", "2"]]
    gated = evaluated(spark, contract, rows)
    assert codes(gated, contract) == ["QG-003"]
    row = checks.reconcile(gated, "t").first()
    assert (row.silver_rows, row.rejected_and_loaded, row.unaccounted_rows) == (1, 1, 2)


def test_listed_codes(spark):
    rows = [["A", "zzz", "2000", "1"], ["B", "bbb", "2000", "1"]]
    contract = capacity_contract()
    assert codes(evaluated(spark, contract, rows), contract) == []
    strict = capacity_contract(known_code="_known")
    listed = spark.createDataFrame([("BBB",)], "code string")
    bronze = gates.mark_known(demo.frame(spark, strict, rows), "Code", listed)
    gated = gates.evaluate(bronze, strict)
    assert codes(gated, strict) == ["QG-004"]
    assert [r.country_code for r in gates.loaded(gated, strict).collect()] == ["BBB"]


def test_unknown_variant():
    with pytest.raises(ValueError):
        panel_contract("other")


SILVER = "province_state string, country_region string, report_date date, confirmed bigint, deaths bigint, recovered bigint, active bigint, who_region string"


def silver_outbreak(spark, rows):
    data = [(p, c, dt.date(2020, 1, d), n, m, 0, 0, r) for p, c, d, n, m, r in rows]
    return spark.createDataFrame(data, SILVER)


def test_province_peaks(spark):
    df = silver_outbreak(
        spark,
        [("P", "A", 1, 10, 1, "R"), ("Q", "A", 1, 20, 1, "R"), ("P", "A", 2, 15, 3, "R"), (None, "B", 1, 0, 0, None)],
    )
    row = marts.outbreak_summary(df).filter("country_region = 'A'").first()
    assert (row.peak_confirmed, row.peak_deaths, row.reporting_days, row.province_count) == (20, 3, 2, 1)
    summed = {r.country_region: r for r in marts.outbreak_summary(df, corrected=True, sum_provinces=True).collect()}
    assert (summed["A"].peak_confirmed, summed["A"].peak_deaths) == (30, 3)
    assert (summed["A"].reporting_days, summed["A"].province_count) == (2, 2)
    none = summed["B"]
    assert (none.who_region, none.case_fatality_rate_pct, none.province_count) == (None, None, 0)


def test_region_without_name(spark):
    df = silver_outbreak(spark, [(None, "A", 1, 10, 1, None), (None, "B", 1, 30, 3, None), (None, "C", 1, 0, 0, "R")])
    got = sorted(tuple(r) for r in marts.region_summary(df).filter("who_region is null").collect())
    assert got == [(None, 1, 40, 4, 10.0)] * 2
    assert marts.region_summary(df).filter("who_region = 'R'").first().avg_cfr_pct is None


PANEL_ROW = ["A", "2015", "Developing", "70", *["1"] * 18]


def test_two_regions_fan_out(spark):
    panel = gates.silver(demo.frame(spark, panel_contract(), [PANEL_ROW]), panel_contract())
    cap = capacity_contract()
    capacity = gates.silver(demo.frame(spark, cap, [[" a", "AAA", "2001", "2"], ["a ", "BBB", "2003", "3"]]), cap)
    outbreak = silver_outbreak(spark, [(None, "a", 1, 10, 1, "R"), (None, "A ", 2, 30, 1, "S"), (None, "a", 3, 20, 1, "S")])
    card = scorecard(panel, outbreak, capacity)
    assert card.count() == 3
    with pytest.raises(checks.KeyViolation):
        checks.assert_keys(card, ["country_name"])
    assert scorecard(panel, outbreak.filter("country_region = 'a'"), capacity, one_region=True).first().covid_who_region == "S"
    assert {(r.hospital_beds_per1k, r.beds_latest_year) for r in card.collect()} == {(3.0, 2003)}


def test_score_terms(spark):
    df = spark.createDataFrame(
        [(90.0, 1.0, 0.0, 100.0, 100.0, 100.0), (None,) * 6, (45.0, None, 25.0, None, 30.0, None)],
        "l double, i double, h double, a double, b double, c double",
    )
    got = df.select(composite_score("l", "i", "h", ["a", "b", "c"]).alias("s"))
    assert [r.s for r in got.collect()] == [100.0, 0.0, 21.5]


def test_risk_edges(spark):
    rows = [(70.0, 49), (70.0, 50), (60.0, 199), (60.0, 200), (80.0, None), (None, 1), (59.9, 1)]
    df = spark.createDataFrame(rows, "l double, d int")
    assert [r[0] for r in df.select(risk_label("l", "d")).collect()] == [
        "Low Risk", "Medium Risk", "Medium Risk", "High Risk", "High Risk", "High Risk", "High Risk",
    ]


def test_nulls_in_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v int")
    row = checks.key_violations(df, ["k", "v"]).first()
    assert (row.total_rows, row.repeated_keys, row.surplus_rows, row.null_rows) == (3, 1, 1, 1)
    checks.assert_keys(df.filter("v = 1").distinct(), ["k"], ["v"])
    with pytest.raises(checks.KeyViolation):
        checks.assert_keys(df.filter("v = 2"), ["k"])


def test_empty_table(spark):
    contract = panel_contract()
    none = demo.frame(spark, contract, [PANEL_ROW]).filter(F.lit(False))
    gated = gates.evaluate(none, contract)
    assert gates.loaded(gated, contract).count() == 0
    assert checks.reconcile(gated, "t").first().bronze_rows == 0
    assert checks.key_violations(none, ["Country"]).first().total_rows == 0


def test_region_summary_keeps_unnamed_entities(spark):
    rows = [("R", "a", 10, 1), ("R", None, 20, 2), ("S", None, 5, 0)]
    outbreak = spark.createDataFrame(rows, "who_region string, country_region string, confirmed bigint, deaths bigint")
    found = marts.region_summary(outbreak).select("who_region", "countries_in_region", "region_total_confirmed").collect()
    assert sorted(map(tuple, found)) == [("R", 0, 30), ("R", 1, 30), ("S", 0, 5)]
