"""Reports on the quarantine, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierlake.contracts import Contract
from tierlake.operators.profiles import null_profile, stacked
from tierlake.operators.ranking import rank_by_score

# Columns of the silver NULL profile, labels of the gold objects, limits.
PROFILED_COLUMNS = ("life_expectancy", "gdp", "population", "hepatitis_b", "bmi")
GOLD_SCORECARD = "gold.health_scorecard"
GOLD_PROFILE = "gold.vw_country_health_profile"
GOLD_OUTBREAK = "gold.vw_covid_country_summary"
GOLD_CAPACITY = "gold.vw_hospital_beds_trend"
GOLD_REGION = "gold.vw_region_summary"
SHORTAGE_BELOW = 1.0
EXTREMES, WORST_OUTBREAKS = 10, 15


def gate_summary(rejected: DataFrame) -> DataFrame:
    counted = rejected.groupBy("source_table", "reason_code", "reject_reason").agg(
        F.count(F.lit(1)).alias("rejected_rows")
    )
    return counted.orderBy("source_table", "reason_code")


def rejects_per_table(rejected: DataFrame) -> DataFrame:
    counted = rejected.groupBy("source_table").agg(F.count(F.lit(1)).alias("total_rejected"))
    return counted.orderBy("source_table")


def silver_profile(tables: list[tuple[Contract, DataFrame, str, str | None]]) -> DataFrame:
    """Rows, distinct entities and year range; NULL years where a table has none.

    Each item is (contract, silver frame, entity column, year column or None).
    """

    def one(contract: Contract, df: DataFrame, entity: str, year: str | None) -> DataFrame:
        none = F.lit(None).cast("smallint")
        return df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_distinct(entity).alias("distinct_countries"),
            (F.min(year) if year else F.max(none)).alias("min_year"),
            (F.max(year) if year else F.max(none)).alias("max_year"),
        ).select(F.lit(contract.silver_table).alias("silver_table"), "*")

    return stacked([one(*item) for item in tables])


def panel_nulls(panel: DataFrame) -> DataFrame:
    return null_profile(panel, PROFILED_COLUMNS)


def gold_counts(objects: dict[str, DataFrame]) -> DataFrame:
    """Rows per gold object."""
    return stacked(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("gold_object"), "rows")
            for name, df in objects.items()
        ]
    )


def tier_distribution(card: DataFrame) -> DataFrame:
    counted = card.groupBy("health_risk_tier").agg(
        F.count(F.lit(1)).alias("country_count"),
        F.round(F.avg("life_expectancy"), 1).alias("avg_life_exp"),
        F.round(F.avg("gdp_per_capita"), 0).alias("avg_gdp"),
        F.round(F.avg("infant_deaths"), 1).alias("avg_infant_deaths"),
    )
    # The window sees one row per tier, of which there are three.
    share = F.col("country_count").cast("double") * 100 / F.sum("country_count").over(Window.partitionBy())
    return counted.select(
        "health_risk_tier", "country_count", F.round(share, 1).alias("pct_of_total"),
        "avg_life_exp", "avg_gdp", "avg_infant_deaths",
    ).orderBy(F.desc("country_count"), "health_risk_tier")


def _by_life(card: DataFrame, order: Column, n: int) -> DataFrame:
    rows = card.filter(F.col("life_expectancy").isNotNull()).orderBy(order, "country_name").limit(n)
    return rows.select(
        "country_name", "development_status", "who_latest_year", "life_expectancy", "infant_deaths",
        "hospital_beds_per1k", "composite_health_score", "health_risk_tier",
    )


def longest_lived(card: DataFrame, n: int = EXTREMES) -> DataFrame:
    return _by_life(card, F.desc("life_expectancy"), n)


def shortest_lived(card: DataFrame, n: int = EXTREMES) -> DataFrame:
    return _by_life(card, F.asc("life_expectancy"), n)


def worst_outbreaks(summary: DataFrame, n: int = WORST_OUTBREAKS) -> DataFrame:
    rows = summary.filter(F.col("peak_confirmed").isNotNull())
    ordered = rows.orderBy(F.desc("peak_confirmed"), "country_region", "who_region").limit(n)
    return ordered.select(
        "country_region", "who_region", "peak_confirmed", "peak_deaths", "case_fatality_rate_pct",
        "recovery_rate_pct", "days_tracked",
    )


def capacity_gap(card: DataFrame, below: float = SHORTAGE_BELOW) -> DataFrame:
    return (
        card.filter(F.col("hospital_beds_per1k") < below)
        .select(
            "country_name", "development_status", "hospital_beds_per1k", "beds_latest_year",
            "life_expectancy", "infant_deaths", "gdp_per_capita", "health_risk_tier",
        )
        .orderBy("hospital_beds_per1k", "country_name")
    )


def score_ranking(card: DataFrame, **options) -> DataFrame:
    """Every scored entity with its rank, best first."""
    columns = card.select(
        "country_name", "development_status", "life_expectancy", "income_composition",
        "hepatitis_b_pct", "polio_pct", "composite_health_score", "health_risk_tier",
    )
    ranked = rank_by_score(columns, "composite_health_score", "rank_no", ["country_name"], **options)
    return ranked.orderBy("rank_no", "country_name")


def status_comparison(card: DataFrame) -> DataFrame:
    """Means per development status."""
    means = card.filter(F.col("development_status").isNotNull()).groupBy("development_status").agg(
        F.count(F.lit(1)).alias("country_count"),
        F.round(F.avg("life_expectancy"), 2).alias("avg_life_expectancy"),
        F.round(F.avg("infant_deaths"), 1).alias("avg_infant_deaths"),
        F.round(F.avg("gdp_per_capita"), 0).alias("avg_gdp_per_capita"),
        F.round(F.avg("hospital_beds_per1k"), 2).alias("avg_beds_per1k"),
        F.round(F.avg("hepatitis_b_pct"), 1).alias("avg_hepb_coverage"),
        F.round(F.avg("schooling_years"), 1).alias("avg_schooling_yrs"),
    )
    return means.orderBy(F.desc("avg_life_expectancy"), "development_status")


def high_risk(card: DataFrame) -> DataFrame:
    return (
        card.filter(F.col("health_risk_tier") == "High Risk")
        .select(
            "country_name", "development_status", "life_expectancy", "infant_deaths",
            "under_five_deaths", "hospital_beds_per1k", "gdp_per_capita", "hepatitis_b_pct",
            "polio_pct", "composite_health_score",
        )
        .orderBy("composite_health_score", "country_name")
    )


def scorecard_listing(card: DataFrame) -> DataFrame:
    return card.select(
        "country_name", "development_status", "who_latest_year", "life_expectancy", "infant_deaths",
        "under_five_deaths", "hospital_beds_per1k", "covid_peak_confirmed", "covid_peak_deaths",
        "covid_fatality_rate_pct", "health_risk_tier",
    ).orderBy(F.desc("life_expectancy"), "country_name")
