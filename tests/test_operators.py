"""Operators against naive forms, with a third of the rows in one key, and the shape of plans."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F
from pyspark.sql import DataFrame

from tierlake.operators import dedupe, joins, ranking, reshape
from tierlake.plans import marts, reports
from tierlake.registry import catalog
from tierlake.sources import star


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: one key holds a third, many keys occur once."""
    rng = random.Random(7)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(1200)}", rng.randrange(50), rng.random() < 0.7) for i in range(3000)]
    order = list(range(3000))
    rng.shuffle(order)
    data = [(k, v, ok, n) for (k, v, ok), n in zip(rows, order)]
    return spark.createDataFrame(data, "k string, v int, ok boolean, n bigint").repartition(6).cache()


def rows(df: DataFrame) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flag_first(skewed):
    for order in (["n"], ["v", "n"]):
        flagged = dedupe.flag_first(skewed, [F.col("k")], order, {"every": F.lit(True), "good": F.col("ok")})
        naive = skewed.withColumn(
            "every", F.row_number().over(Window.partitionBy("k").orderBy(*order)) == 1
        ).withColumn(
            "good", F.col("ok") & (F.row_number().over(Window.partitionBy("k", "ok").orderBy(*order)) == 1)
        )
        columns = ["k", "v", "n", "every", "good"]
        assert rows(flagged.select(columns)) == rows(naive.select(columns))


def test_keep_first_and_latest(skewed):
    naive = skewed.groupBy("k").agg(F.min_by(F.struct("v", "n"), "n").alias("s")).select("k", "s.*")
    assert rows(dedupe.keep_first(skewed.select("k", "v", "n"), ["k"], ["n"])) == rows(naive)
    latest = dedupe.latest_per_key(skewed.select("k", "v", "n"), ["k"], "v", ["n"])
    best = skewed.groupBy("k").agg(F.min(F.struct((-F.col("v")).alias("m"), "n")).alias("s"))
    assert rows(latest.select("k", F.col("v"), "n")) == rows(best.select("k", (-F.col("s.m")).alias("v"), "s.n"))


def test_keep_first_filters_before_the_shuffle(skewed):
    text = plan(dedupe.keep_first(skewed, ["k"], ["n"]))
    assert text.count("WindowGroupLimit") == 2


def test_dense_index(skewed):
    got = ranking.dense_index(skewed, [F.col("v").desc(), F.col("n")], "id", partitions=5)
    naive = skewed.withColumn("id", F.row_number().over(Window.orderBy(F.col("v").desc(), "n")).cast("bigint"))
    assert rows(got) == rows(naive)
    assert got.agg(F.max("id")).first()[0] == 3000
    assert ranking.dense_index(skewed.limit(0), [F.col("n")]).count() == 0


@pytest.mark.parametrize("limits", [{}, {"heavy_rows": 100}])
def test_rank_by_score(skewed, limits):
    scored = skewed.withColumn("v", F.when(F.col("k") == "hot", F.lit(25)).when(F.col("v") > 2, F.col("v")))
    got = ranking.rank_by_score(scored, "v", "r", ["n"], partitions=5, **limits)
    naive = scored.filter("v is not null").withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc())))
    assert rows(got.select("r", "k", "v", "n")) == rows(naive.select("r", "k", "v", "n"))


@pytest.mark.parametrize("heavy_rows", [100, 10**9, None])
def test_spread_left_join(spark, skewed, heavy_rows):
    left = skewed.withColumn("k", F.when(F.col("v") > 3, F.col("k")))
    right = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k1", "c"), ("none", "d")], "k string, w string")
    got = joins.spread_left_join(left, right, "k", ["n"], heavy_rows=heavy_rows, salts=4)
    assert rows(got) == rows(left.join(right, "k", "left"))


def test_coverage(spark):
    base = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    other = spark.createDataFrame([("a",), ("a",), ("z",)], "k string")
    got = joins.join_coverage(base, {"one": other, "two": base}, "k")
    assert rows(got) == [("one", 3, 1, 2), ("two", 3, 3, 0)]
    assert rows(joins.unmatched_keys(base, other, "k")) == [("b",), ("c",)]


def test_unpivot(spark):
    df = spark.createDataFrame([("a", "1", " ", None), ("b", None, "", "2")], "id string, `2001` string, `2002` string, `2003` string")
    assert reshape.year_columns(df) == ["2001", "2002", "2003"]
    assert rows(reshape.unpivot_wide(df, ["id"])) == [("a", "2001", "1"), ("b", "2003", "2")]


def test_top_n_keeps_only_n_rows_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(catalog.queries()["top_n"](spark, sf_dir))


def test_scan_reads_only_needed_columns(spark, sf_dir):
    summary = marts.outbreak_summary(catalog.outbreak_silver_(spark, sf_dir))
    text = plan(summary)
    assert "l_shipdate" in text and "l_tax" not in text and "l_returnflag" not in text


def test_filters_reach_the_stored_table(spark, sf_dir, tmp_path):
    path = str(tmp_path / "card")
    catalog.card(spark, sf_dir).write.parquet(path)
    text = plan(reports.high_risk(spark.read.parquet(path)))
    assert "EqualTo(health_risk_tier,High Risk)" in text
    assert "covid_peak_confirmed" not in text


def test_grain_names(spark, sf_dir):
    with pytest.raises(ValueError):
        star.panel_bronze(spark, sf_dir, "planet")


@pytest.mark.parametrize("order", [["d"], ["d", "i"]])
def test_flag_first_with_nulls_and_ties(spark, order):
    rows = [("a", None, 1), ("a", 5, 2), ("b", 1, 1), ("b", 1, 1), ("b", 1, 3), ("c", None, 9), ("d", None, None), ("d", None, None)]
    df = spark.createDataFrame(rows, "k string, d int, i int")
    flagged = dedupe.flag_first(df, [F.col("k")], order, {"every": F.lit(True), "some": F.col("i").isNotNull()}, unique=False)
    for name, key_rows in (("every", df), ("some", df.filter("i IS NOT NULL"))):
        taken = sorted(map(str, flagged.filter(name).select("k", "d", "i").collect()))
        kept = dedupe.keep_first(key_rows, [F.col("k")], [*order, dedupe.row_hash(df)])
        assert taken == sorted(map(str, kept.collect()))
