"""Integrated scorecard: one row per entity of the panel, with capacity and outbreak figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierlake.functions.keys import match_key
from tierlake.functions.scores import composite_score, percent_of, risk_label, step_label
from tierlake.operators.dedupe import latest_per_key
from tierlake.plans.marts import peaks

# Silver column and scorecard column, in output order; columns the demo leaves out.
PANEL_COLUMNS = (
    ("country_name", "country_name"),
    ("status", "development_status"),
    ("year", "who_latest_year"),
    ("life_expectancy", "life_expectancy"),
    ("adult_mortality", "adult_mortality"),
    ("infant_deaths", "infant_deaths"),
    ("under_five_deaths", "under_five_deaths"),
    ("population", "population"),
    ("gdp", "gdp_per_capita"),
    ("schooling", "schooling_years"),
    ("income_composition", "income_composition"),
    ("total_expenditure", "health_expenditure_pct"),
    ("hiv_aids", "hiv_aids_deaths"),
    ("hepatitis_b", "hepatitis_b_pct"),
    ("polio", "polio_pct"),
    ("diphtheria", "diphtheria_pct"),
    ("bmi", "bmi_avg"),
    ("alcohol", "alcohol_consumption"),
    ("thinness_1_19_years", "thinness_1_19_pct"),
)
CAPACITY_COLUMNS = ("hospital_beds_per1k", "beds_latest_year", "beds_capacity_tier")
OUTBREAK_COLUMNS = (
    "covid_peak_confirmed",
    "covid_peak_deaths",
    "covid_peak_recovered",
    "covid_fatality_rate_pct",
    "covid_recovery_rate_pct",
    "covid_who_region",
    "covid_days_tracked",
)
KPI_COLUMNS = ("health_risk_tier", "composite_health_score")
FULL_ONLY = {
    "population", "bmi_avg", "alcohol_consumption", "thinness_1_19_pct", "beds_capacity_tier",
    "covid_peak_recovered", "covid_recovery_rate_pct", "covid_days_tracked", "composite_health_score",
}

SCORECARD_KEY = ("country_name",)


def scorecard_columns(variant: str = "full") -> list[str]:
    names = [target for _, target in PANEL_COLUMNS]
    names += [*CAPACITY_COLUMNS, *OUTBREAK_COLUMNS, *KPI_COLUMNS]
    return [name for name in names if variant == "full" or name not in FULL_ONLY]


def latest_capacity(capacity: DataFrame) -> DataFrame:
    """Latest reading per entity name, tiered before any join so that a missing entity has no tier."""
    latest = latest_per_key(capacity, ["country_name"], "year", ["country_code"])
    return latest.select(
        "country_name",
        "hospital_beds_per1k",
        F.col("year").alias("beds_latest_year"),
        step_label("hospital_beds_per1k").alias("beds_capacity_tier"),
    )


def outbreak_totals(
    outbreak: DataFrame, digits: int = 4, sum_provinces: bool = False, one_region: bool = False
) -> DataFrame:
    """Peaks, rates and span per (entity, region); ``one_region`` keeps the region with the highest peak."""
    dates = (F.min("report_date").alias("_from"), F.max("report_date").alias("_to"))
    counts = ("confirmed", "deaths", "recovered")
    base = peaks(outbreak, sum_provinces=sum_provinces, counts=counts, extra=dates)
    if one_region:
        base = latest_per_key(base, ["country_region"], "peak_confirmed", ["who_region"])
    confirmed = F.col("peak_confirmed")
    return base.select(
        "country_region",
        confirmed.alias("covid_peak_confirmed"),
        F.col("peak_deaths").alias("covid_peak_deaths"),
        F.col("peak_recovered").alias("covid_peak_recovered"),
        percent_of(F.col("peak_deaths"), confirmed, digits).alias("covid_fatality_rate_pct"),
        percent_of(F.col("peak_recovered"), confirmed, 2).alias("covid_recovery_rate_pct"),
        F.col("who_region").alias("covid_who_region"),
        F.datediff("_to", "_from").alias("covid_days_tracked"),
    )


def with_match(df: DataFrame, name: str, aliases: DataFrame | None) -> DataFrame:
    """Add the join key of a name; ``aliases`` (alias, name) maps other spellings to one name."""
    keyed = df.withColumn("_match", match_key(name))
    if aliases is None:
        return keyed
    known = aliases.select(match_key("alias").alias("_match"), match_key("name").alias("_canonical")).distinct()
    joined = keyed.join(known, "_match", "left")
    return joined.withColumn("_match", F.coalesce("_canonical", "_match")).drop("_canonical")


def scorecard(
    panel: DataFrame,
    outbreak: DataFrame,
    capacity: DataFrame,
    variant: str = "full",
    aliases: DataFrame | None = None,
    sum_provinces: bool = False,
    one_region: bool = False,
) -> DataFrame:
    """All three sides are brought to one row per entity before they are joined.

    An entity reported under two regions appears once per region, as published; assert the key or
    use ``one_region``.
    """
    digits = 4 if variant == "full" else 3
    latest = latest_per_key(panel, ["country_name"], "year")
    base = latest.select([F.col(source).alias(target) for source, target in PANEL_COLUMNS])
    beds = with_match(latest_capacity(capacity), "country_name", aliases).drop("country_name")
    cases = with_match(
        outbreak_totals(outbreak, digits, sum_provinces, one_region), "country_region", aliases
    ).drop("country_region")
    joined = (
        with_match(base, "country_name", aliases)
        .join(beds, "_match", "left")
        .join(cases, "_match", "left")
        .withColumn("health_risk_tier", risk_label("life_expectancy", "infant_deaths"))
        .withColumn(
            "composite_health_score",
            composite_score(
                "life_expectancy",
                "income_composition",
                "hiv_aids_deaths",
                ["hepatitis_b_pct", "polio_pct", "diphtheria_pct"],
            ),
        )
    )
    return joined.select(*scorecard_columns(variant))
