"""Places in files under other splits, loads that stop early, ties, narrow ids and plans without copied rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F

from tierlake import scratch
from tierlake.contracts import panel_contract
from tierlake.operators import dedupe, profiles, ranking
from tierlake.plans import marts
from tierlake.plans.refresh import Inputs, Refresh
from tierlake.registry import catalog
from tierlake.sinks.tables import Lake
from tierlake.sources import delimited, positions, star

SPLITS = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def splits(spark):
    before = spark.conf.get(SPLITS)
    yield lambda size: spark.conf.set(SPLITS, size)
    spark.conf.set(SPLITS, before)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """Three files, the second one empty but for its header; rows of four keys with blanks and a short row."""
    folder = tmp_path_factory.mktemp("positions")
    rng = random.Random(4)
    lines = [f"{rng.choice('abcd')},{k}" for k in range(900)]
    lines[17] = "short"
    for name, part in (("one.csv", lines[:500]), ("three.csv", []), ("two.csv", lines[500:])):
        (folder / name).write_text("\n".join(["key,number", *part]) + "\n")
    return str(folder), lines


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_places_and_kept_rows_do_not_follow_the_splits(spark, files, splits):
    path, lines = files
    kept = []
    for size in ("128m", "1k", "311"):
        splits(size)
        frame = delimited.read_delimited(spark, path, ["key", "number"])
        found = positions.survey(frame, delimited.is_malformed())
        assert (found.rows, found.malformed) == (900, 1)
        rows = positions.with_ordinal(frame, found)
        assert [(r._ordinal, r.key) for r in rows.orderBy("_ordinal").collect()] == [(k, line.split(",")[0]) for k, line in enumerate(lines)]
        good = delimited.well_formed(rows)
        kept.append(sorted(tuple(r) for r in dedupe.keep_first(good, ["key"], ["_ordinal"]).select("key", "number", "_ordinal").collect()))
        assert size == "128m" or found.n_blocks > 3
    assert kept[0] == kept[1] == kept[2]


def test_other_splits_than_counted_stop_the_load(spark, files, splits):
    frame = delimited.read_delimited(spark, files[0], ["key", "number"])
    found = positions.survey(frame, delimited.is_malformed())
    splits("1k")
    with pytest.raises(Exception, match="split in another way"):
        positions.with_ordinal(delimited.read_delimited(spark, files[0], ["key", "number"]), found).collect()


def test_empty_files(spark, tmp_path):
    (tmp_path / "none.csv").write_text("key,number\n")
    frame = delimited.read_delimited(spark, str(tmp_path), ["key", "number"])
    found = positions.survey(frame, delimited.is_malformed())
    assert (found.rows, found.malformed) == (0, 0) and positions.with_ordinal(frame, found).count() == 0


def test_headers_are_compared_in_the_same_pass(spark, tmp_path, splits):
    heads = ["key,number", " Key ,  NUMBER", "\ufeffkey,number", '"key"," number "']
    for k, head in enumerate(heads):
        (tmp_path / f"{k}.csv").write_text("\n".join([head, *[f"k{n},{n}" for n in range(60 * k)]]) + "\n")
    (tmp_path / "empty.csv").write_text("")
    path, names, bad = str(tmp_path), ["key", "number"], delimited.is_malformed()
    expected = None
    for size in ("128m", "100"):
        splits(size)
        plain = delimited.read_delimited(spark, path, names)
        rows = [tuple(r) for r in positions.with_ordinal(plain, positions.survey(plain, bad)).orderBy("_ordinal").collect()]
        frame = delimited.read_delimited(spark, path, names, header=False)
        found = positions.survey(frame, bad, delimited.is_header(names))
        assert (found.rows, found.malformed, found.headless) == (360, 0, ())
        assert [tuple(r) for r in positions.with_ordinal(frame, found).orderBy("_ordinal").collect()] == rows
        assert expected in (None, rows)
        expected = rows
    swapped = delimited.read_delimited(spark, path, names[::-1], header=False)
    assert len(positions.survey(swapped, bad, delimited.is_header(names[::-1])).headless) == 4
    # A name with an unquoted separator makes the line malformed as a row; it is still known, and not counted.
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "x.csv").write_text("key,per 1,000\na,1\n")
    frame = delimited.read_delimited(spark, str(tmp_path / "more"), ["key", "per 1,000"], header=False)
    found = positions.survey(frame, bad, delimited.is_header(["key", "per 1,000"]))
    assert (found.rows, found.malformed, found.headless) == (1, 0, ())
    assert positions.with_ordinal(frame, found).select("key").collect() == [("a",)]


def test_a_bad_file_writes_nothing(spark, tmp_path, monkeypatch):
    columns = panel_contract().source_columns
    (tmp_path / "panel.csv").write_text(",".join(columns) + "\n" + "a,b\n" * 3)
    run = Refresh(Lake(spark, "early_"))
    run.panel = run.panel.with_options(max_errors=2)
    run.start()
    monkeypatch.setattr(Lake, "replace", lambda *_: pytest.fail("a table was written"))
    with pytest.raises(delimited.TooManyBadRows, match="3 malformed"):
        run.land_files(Inputs(str(tmp_path / "panel.csv"), "", ""))


def test_cells_of_wide_rows_have_places_of_their_own(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("h\n" + "\n".join(f"n{k},c,i,j,{k}.1,,{k}.3" for k in range(4)) + "\n")
    frame = delimited.read_wide(spark, str(tmp_path / "wide.csv"), ["1960", "1961", "1962"])
    placed = positions.with_ordinal(frame, positions.survey(frame, delimited.is_malformed()))
    contract = star.capacity()
    long = delimited.add_metadata(delimited.wide_to_long(delimited.well_formed(placed), contract), contract)
    value = contract.source_columns[-1]
    assert [r[0] for r in long.orderBy("_ordinal").select(value).collect()] == [f"{k}.{j}" for k in range(4) for j in (1, 3)]
    assert long.select(F.count_distinct("_ordinal")).first()[0] == 8


def test_a_third_of_the_rows_tied(spark):
    rows = [("hot", None, k % 2) if k % 3 == 0 else (f"k{k % 50}", k % 7, k % 2) for k in range(3000)]
    df = spark.createDataFrame(rows, "k string, place int, ok int").repartition(5)
    flagged = dedupe.flag_first(df, [F.col("k")], ["place"], {"every": F.lit(True), "some": F.col("ok") == 1}, unique=False)
    # No window, so no task gathers a key; the join is on a number that differs from row to row.
    assert "Window" not in plan(flagged)
    for name, given in (("every", df), ("some", df.filter("ok = 1"))):
        naive = given.groupBy("k").agg(F.min(F.struct(F.col("place").isNotNull(), "place")).getField("place").alias("place"))
        taken = flagged.filter(name).select("k", "place").collect()
        assert sorted(map(str, taken)) == sorted(map(str, naive.collect()))
    joined = flagged.select("k", "place", "every")
    assert joined.count() == 3000
    sizes = [r["count"] for r in flagged.groupBy(F.pmod(F.xxhash64("k", "place", "every"), F.lit(8))).count().collect()]
    assert sum(sizes) == 3000


def test_ids_fix_only_the_places(spark, monkeypatch):
    rows = [(k % 5 if k % 11 else None, k, "x" * 50) for k in range(400)]
    df = spark.createDataFrame(rows, "v int, n int, wide string").repartition(4)
    fixed = []
    monkeypatch.setattr(scratch, "checkpointed", lambda given, real=scratch.checkpointed: fixed.append(given.columns) or real(given))
    got = ranking.dense_index(df, [F.col("v").desc(), F.col("n")], "id", partitions=3, key=["v", "n"])
    naive = df.withColumn("id", F.row_number().over(Window.orderBy(F.col("v").desc(), "n")).cast("bigint"))
    assert sorted(map(str, got.collect())) == sorted(map(str, naive.collect()))
    assert fixed == [["v", "n", "_part", "_position"]]


def test_a_partition_beyond_its_positions_stops(spark, monkeypatch):
    monkeypatch.setattr(ranking, "POSITION_MASK", 3)
    with pytest.raises(Exception, match="more rows than positions"):
        ranking.dense_index(spark.range(40), [F.col("id")], "n", partitions=2).collect()


def test_distinct_counts_copy_no_rows(spark, sf_dir):
    for df in (
        marts.outbreak_summary(catalog.outbreak_silver_(spark, sf_dir)),
        marts.outbreak_summary(catalog.outbreak_silver_(spark, sf_dir), corrected=True, sum_provinces=True),
        profiles.bronze_profile(star.panel_bronze(spark, sf_dir), star.panel()),
    ):
        assert "Expand" not in plan(df)
    rows = [("a", 1, None), ("a", 1, "x"), ("a", None, "x"), (None, 2, "y"), (None, 2, "z")]
    df = spark.createDataFrame(rows, "k string, n int, t string")
    found = profiles.distinct_counts(df, ["k"], {"numbers": "n", "texts": "t"}).collect()
    assert {tuple(r) for r in found} == {("a", 1, 1), (None, 1, 2)}
    assert profiles.distinct_counts(df.limit(0), [], {"numbers": "n"}).first().numbers == 0


def test_silver_reads_only_what_is_asked(spark, sf_dir):
    text = plan(profiles.null_profile(catalog.panel_silver(spark, sf_dir), ["gdp"]))
    assert "o_totalprice" in text and "c_mktsegment" not in text and "xxhash64(o_orderdate" not in text
