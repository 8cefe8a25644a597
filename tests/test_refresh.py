"""Files to gold: reading, tolerance, log, quarantine, key assertion."""

from __future__ import annotations

import dataclasses
import itertools
import pathlib

import pytest
from pyspark.sql import functions as F

import demo
from tierlake import scratch
from tierlake.contracts import WIDE_IDS, capacity_contract, panel_contract
from tierlake.operators.checks import KeyViolation
from tierlake.plans import reports
from tierlake.plans.lake_reports import lake_reports
from tierlake.plans.refresh import Inputs, Refresh
from tierlake.sinks.tables import LOG_TABLE, REJECT_TABLE, Lake, Release, session_views
from tierlake.sources import delimited


def write(path: pathlib.Path, header: str, lines: list[str], end: str = "\n") -> str:
    path.write_text(end.join([header, *lines]) + end, encoding="utf-8", newline="")
    return str(path)


def plain(text: str) -> list[str]:
    return text.strip("\n").replace("''", "").split("\n")


PANEL_HEADER = ",".join(
    {"BMI": " BMI ", "HIV/AIDS": " HIV/AIDS", "thinness 1-19 years": " thinness  1-19 years"}.get(n, n)
    for n in panel_contract().source_columns
)
OUTBREAK_HEADER = "Province/State,Country/Region,Lat,Long,Date,Confirmed,Deaths,Recovered,Active,WHO Region"
CAPACITY_HEADER = "Entity,Code,Year,Hospital beds (per 1,000 people)"


def wide_lines() -> list[str]:
    """The long sample as a pipe-separated wide file with 60 year columns."""
    cells: dict[tuple, dict] = {}
    for entity, code, year, beds in demo.rows_of(demo.CAPACITY)[:12]:
        cells.setdefault((entity, code), {})[year] = beds
    years = [str(y) for y in range(1960, 2020)]
    return [
        "|".join([*key, "beds", "SH.MED.BEDS.ZS", *[values.get(y, "") for y in years]]) for key, values in cells.items()
    ]


WIDE_HEADER = "|".join([*WIDE_IDS, *[str(y) for y in range(1960, 2020)]])


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    return Inputs(
        write(folder / "panel.csv", PANEL_HEADER, plain(demo.PANEL), "\r\n"),
        write(folder / "outbreak.csv", OUTBREAK_HEADER, plain(demo.OUTBREAK)),
        write(folder / "wide.txt", WIDE_HEADER, wide_lines()),
    )


@pytest.fixture(scope="module")
def refreshed(spark, files):
    lake = Lake(spark, "full_")
    checked = Refresh(lake).run(files)
    return lake, {row.source_table: row for row in checked.collect()}


@pytest.fixture(scope="module")
def lake(refreshed):
    return refreshed[0]


def test_bronze_tables(lake):
    bronze = lake.table("bronze.who_health_indicators")
    assert bronze.count() == 14
    assert set(bronze.columns) >= {"Life expectancy", "_src_file", "_ingested_at", "_row_hash", "_ordinal"}
    assert all(t == "string" for n, t in bronze.dtypes if not n.startswith("_"))
    assert bronze.select("_src_file").distinct().first()[0] == "panel.csv"
    assert bronze.select(F.count_distinct("_ordinal")).first()[0] == 14
    assert lake.table("bronze.hospital_capacity").count() == 12


def test_log(lake):
    rows = lake.table(LOG_TABLE).orderBy("log_id").collect()
    assert [(r.log_id, r.table_name, r.src_file, r.rows_before, r.rows_after, r.rows_loaded) for r in rows] == [
        (1, "bronze.who_health_indicators", "panel.csv", 0, 14, 14),
        (2, "bronze.disease_outbreaks", "outbreak.csv", 0, 15, 15),
        (3, "bronze.hospital_capacity", "wide.txt", 0, 12, 12),
    ]
    assert [r.rows_loaded for r in lake.load_summary().collect()] == [14, 15, 12]


def test_silver_and_quarantine(refreshed):
    lake, checked = refreshed
    counts = {t: lake.table(t).count() for t in ("silver.who_health_indicators", "silver.disease_outbreaks")}
    assert counts == {"silver.who_health_indicators": 10, "silver.disease_outbreaks": 12}
    rejected = lake.table(REJECT_TABLE)
    ids = [r.reject_id for r in rejected.orderBy("reject_id").collect()]
    assert ids == list(range(1, 8))
    assert rejected.filter("raw_row is null or rejected_at is null").count() == 0
    kept = rejected.filter("reason_code = 'QG-002' and source_table like '%outbreaks'").first()
    assert '"Confirmed":"abc"' in kept.raw_row
    row = checked["bronze.disease_outbreaks"]
    assert (row.bronze_rows, row.silver_rows, row.rejected_rows, row.unaccounted_rows) == (15, 12, 3, 0)


def test_gold(lake):
    card = lake.table(reports.GOLD_SCORECARD)
    assert card.count() == 7 and "_gold_created" in card.columns
    assert lake.table(reports.GOLD_CAPACITY).count() == 12
    assert lake.table(reports.GOLD_REGION).count() == 7
    session_views({"vw_card": card})
    assert lake.spark.sql("SELECT count(*) FROM vw_card WHERE health_risk_tier = 'High Risk'").first()[0] == 1


def test_rerun_gives_the_same(lake, files):
    before = {tuple(r) for r in lake.table(reports.GOLD_SCORECARD).drop("_gold_created").collect()}
    Refresh(lake).run(files)
    assert {tuple(r) for r in lake.table(reports.GOLD_SCORECARD).drop("_gold_created").collect()} == before
    assert lake.table(REJECT_TABLE).count() == 7
    assert lake.table(LOG_TABLE).count() == 3


def test_demo_refresh(spark, files, tmp_path):
    lake = Lake(spark, "demo_")
    capacity = write(tmp_path / "long.csv", CAPACITY_HEADER, plain(demo.CAPACITY))
    run = Refresh(lake, "demo", capacity=capacity_contract("demo", separator=","))
    run.run(Inputs(files.panel, files.outbreak, capacity, wide=None))
    assert lake.table("silver.hospital_capacity").count() == 13
    assert lake.table(REJECT_TABLE).count() == 9
    assert len(lake.table(reports.GOLD_SCORECARD).columns) == 23


def test_reports_of_the_lake(spark, files, refreshed):
    lake, _ = refreshed
    rows = {name: df.collect() for name, df in lake_reports(Refresh(lake)).items()}
    assert len(rows) == 17
    assert [r.rows_loaded for r in rows["load_summary"]] == [14, 15, 12]
    assert sum(r.total_rejected for r in rows["rejects_per_table"]) == 7
    assert len(rows["scorecard_listing"]) == 7 and len(rows["bronze_profile"]) == 3
    ranks = [r.rank_no for r in rows["score_ranking"]]
    assert ranks == sorted(ranks)
    lives = [r.life_expectancy for r in rows["longest_lived"]]
    assert lives == sorted(lives, reverse=True)


@pytest.mark.parametrize("stage", ["land_files", "clean_one", "publish"])
def test_a_failed_run_keeps_log_and_rejects(lake, files, stage, monkeypatch):
    def fail(*_):
        raise RuntimeError(stage)

    before = [lake.table(t).orderBy(k).collect() for t, k in ((LOG_TABLE, "log_id"), (REJECT_TABLE, "reject_id"))]
    monkeypatch.setattr(Refresh, stage, fail)
    with pytest.raises(RuntimeError):
        Refresh(lake).run(files)
    after = [lake.table(t).orderBy(k).collect() for t, k in ((LOG_TABLE, "log_id"), (REJECT_TABLE, "reject_id"))]
    assert before == after


def test_a_swap_that_stopped_is_undone(spark):
    lake = Lake(spark, "swap_")
    lake.bootstrap()
    lake.replace(spark.range(3), "gold.t")
    lake._rename("gold.t", "gold.t__replaced")
    lake.bootstrap()
    assert lake.table("gold.t").count() == 3
    with pytest.raises(Exception):
        lake.promote("gold.missing", "gold.t")
    assert lake.table("gold.t").count() == 3
    assert lake.replace(spark.range(5), "gold.t") == 5
    assert lake.table("gold.t").count() == 5 and not lake.exists("gold.t__replaced")


def test_a_release_is_all_or_nothing(spark, monkeypatch):
    """A crash after each step of publishing: readers see both tables old or both new, also after the next start."""
    lake, run, tables = Lake(spark, "atomic_"), Release(spark, "atomic_"), ("gold.a", "silver.b")
    lake.bootstrap()
    for table in tables:
        lake.replace(spark.range(1), table)
    outcomes = []
    for allowed in itertools.count():
        run.begin()
        before = lake.table("gold.a").count()
        for table in tables:
            run.replace(spark.range(before + 1), table)
            assert run.table(table).count() == before + 1 and lake.table(table).count() == before
        left = [allowed]
        with monkeypatch.context() as patched:
            for name in ("_rename", "_drop"):

                def step(self, *given, real=getattr(Lake, name)):
                    if not left[0]:
                        raise RuntimeError("crash")
                    left[0] -= 1
                    real(self, *given)

                patched.setattr(Lake, name, step)
            try:
                run.publish()
                ended = True
            except RuntimeError:
                ended = False
        seen = {lake.table(table).count() for table in tables}
        assert len(seen) == 1
        lake.bootstrap()
        assert {lake.table(table).count() for table in tables} == seen
        outcomes.append(seen.pop() - before)
        if ended:
            break
    # The first rename is the release: old tables before it, new ones from then on.
    assert outcomes == [0, 0] + [1] * (len(outcomes) - 2) and len(outcomes) > 10
    assert lake.tables() == sorted(tables)


def test_repeated_steps_change_nothing(spark, files):
    lake = Lake(spark, "again_")
    run = Refresh(lake)
    run.start()
    run.land_files(files)
    run.land_files(files)
    run.clean_one(run.outbreak)
    run.clean()
    run.clean_one(run.panel)
    assert lake.tables() and not lake.exists(REJECT_TABLE) and not lake.exists("silver.disease_outbreaks")
    run.finish()
    ids = {r.source_table: [] for r in lake.table(REJECT_TABLE).collect()}
    for row in lake.table(REJECT_TABLE).collect():
        ids[row.source_table].append(row.reject_id)
    assert sorted(itertools.chain(*ids.values())) == list(range(1, 8))
    assert max(ids["bronze.who_health_indicators"]) < min(ids["bronze.disease_outbreaks"])
    assert lake.table(LOG_TABLE).count() == 3
    assert not [table for table in lake.tables() if "__" in table]


def test_swapped_columns_stop_the_load(spark, files, tmp_path):
    header = OUTBREAK_HEADER.replace("Confirmed,Deaths", "Deaths,Confirmed")
    for name, first in (("a.csv", OUTBREAK_HEADER), ("b.csv", header)):
        write(tmp_path / name, first, plain(demo.OUTBREAK))
    lake, given = Lake(spark, "heads_"), dataclasses.replace(files, outbreak=str(tmp_path))
    run = Refresh(lake)
    run.start()
    with pytest.raises(delimited.HeaderMismatch, match="b.csv") as raised:
        run.land_files(given)
    assert "a.csv" not in str(raised.value) and not run.work.exists("bronze.disease_outbreaks__next")
    run = Refresh(lake, check_headers=False)
    run.start()
    run.land_files(given)
    assert run.work.table("bronze.disease_outbreaks").count() == 30


def test_stored_gate_outcomes_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "_root", lambda _: str(tmp_path))
    with pytest.raises(ValueError):
        with scratch.temporary(spark.range(4), "gated") as rows:
            assert rows.count() == 4
            raise ValueError
    assert not list(tmp_path.iterdir())


def test_wide_file_with_another_year_and_a_long_name(spark, files, tmp_path):
    header, lines = WIDE_HEADER + "|2020", [line + "|7.5" for line in wide_lines()]
    lines.append("|".join(["x" * 301, "XXX", "beds", "SH.MED.BEDS.ZS", *["1.0"] * 61]))
    path = write(tmp_path / "wide.txt", header, lines)
    lake = Lake(spark, "wide_")
    run = Refresh(lake)
    run.start()
    run.land_files(dataclasses.replace(files, capacity=path))
    run.finish()
    rows = lake.table("bronze.hospital_capacity")
    assert rows.count() == 12 + len(lines) - 1 and rows.filter("Year = '2020'").count() == len(lines) - 1
    assert [r.reason_code for r in lake.table(REJECT_TABLE).collect()] == ["QG-000"]


def load_outbreak(spark, prefix, lines, folder, allowed):
    lake = Lake(spark, prefix)
    run = Refresh(lake)
    run.outbreak = run.outbreak.with_options(max_errors=allowed)
    run.start()
    path = write(folder / "outbreak.csv", OUTBREAK_HEADER, lines)
    frame = delimited.read_contract(spark, path, run.outbreak)
    loaded = run.land(frame, run.outbreak, 1, path, delimited.is_malformed(run.outbreak))
    run.finish()
    return lake, loaded


def test_bad_rows_within_tolerance(spark, tmp_path):
    lines = [*plain(demo.OUTBREAK)[:3], "too,short", plain(demo.OUTBREAK)[3] + ",too,long", "x" * 201 + ",Chad" + ",1" * 8]
    lake, loaded = load_outbreak(spark, "bad_", lines, tmp_path, 3)
    assert loaded == 3 and lake.table("bronze.disease_outbreaks").count() == 3
    skipped = lake.table(REJECT_TABLE).collect()
    assert {r.reason_code for r in skipped} == {"QG-000"} and len(skipped) == 3
    assert "too,short" in {r.raw_snapshot for r in skipped}


def test_too_many_bad_rows_keep_the_old_table(spark, tmp_path):
    lake, _ = load_outbreak(spark, "worse_", plain(demo.OUTBREAK), tmp_path, 0)
    with pytest.raises(delimited.TooManyBadRows):
        load_outbreak(spark, "worse_", ["a,b", *plain(demo.OUTBREAK)[:1]], tmp_path, 0)
    assert lake.table("bronze.disease_outbreaks").count() == 15
    assert not spark.catalog.tableExists("worse_bronze.disease_outbreaks__loading")
    assert lake.table(LOG_TABLE).count() == 1


def test_key_assertion_stops_the_load(spark, files, tmp_path):
    """2015 and 02015 are two keys as text and one key as numbers."""
    line = plain(demo.PANEL)[0]
    path = write(tmp_path / "panel.csv", PANEL_HEADER, [line, line.replace("2015", "02015")])
    lake = Lake(spark, "keys_")
    run = Refresh(lake)
    run.start()
    frame = delimited.read_contract(spark, path, run.panel)
    run.land(frame, run.panel, 1, path, delimited.is_malformed(run.panel))
    with pytest.raises(KeyViolation):
        run.clean_one(run.panel)
    assert not spark.catalog.tableExists("keys_silver.who_health_indicators")
    run.panel = run.panel.with_options(match="typed")
    assert run.clean_one(run.panel).first().silver_rows == 1


def test_quoted_wide_file_with_trailing_comma(spark, tmp_path):
    header = ",".join(f'"{n}"' for n in [*WIDE_IDS, "2017", "2018"]) + ","
    lines = ['"Korea, Rep.","KOR","beds","SH",' + '"11.9","",', '"Say ""hi""","HII","beds","SH","1.0"," ",']
    path = write(tmp_path / "wide.csv", header, lines, "\r\n")
    wide = delimited.well_formed(delimited.read_wide(spark, path, ["2017", "2018"], trailing_separator=True))
    long = delimited.wide_to_long(wide, capacity_contract())
    assert {tuple(r)[:4] for r in long.select(*capacity_contract().source_columns).collect()} == {
        ("Korea, Rep.", "KOR", "2017", "11.9"), ('Say "hi"', "HII", "2017", "1.0"),
    }


def test_latin_encoding(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("Name\nCôte d'Ivoire\n".encode("latin-1"))
    frame = delimited.read_delimited(spark, str(path), ["name"], encoding="ISO-8859-1")
    assert frame.first().name == "Côte d'Ivoire"
