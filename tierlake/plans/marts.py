"""Gold views over typed silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.functions.keys import match_key
from tierlake.functions.scores import percent_of, step_label
from tierlake.operators.dedupe import latest_per_key
from tierlake.operators.joins import spread_left_join
from tierlake.operators.profiles import side_by_side

# Output columns of the profile view, and those the demo leaves out.
PROFILE_COLUMNS = (
    "country_name", "status", "latest_year", "life_expectancy", "adult_mortality", "infant_deaths",
    "under_five_deaths", "gdp", "population", "schooling", "income_composition", "total_expenditure",
    "hiv_aids", "hepatitis_b", "polio", "diphtheria", "alcohol", "bmi", "pct_expenditure", "measles",
    "thinness_1_19_years", "thinness_5_9_years",
)
FULL_ONLY = ("population", "pct_expenditure", "measles", "thinness_1_19_years", "thinness_5_9_years")


def country_profile(panel: DataFrame, variant: str = "full") -> DataFrame:
    """One row per entity: its latest year."""
    columns = [c for c in PROFILE_COLUMNS if variant == "full" or c not in FULL_ONLY]
    latest = latest_per_key(panel, ["country_name"], "year").withColumnRenamed("year", "latest_year")
    return latest.select(*columns)


def peaks(
    outbreak: DataFrame,
    keys: tuple[str, ...] = ("country_region", "who_region"),
    sum_provinces: bool = False,
    counts: tuple[str, ...] = ("confirmed", "deaths", "recovered", "active"),
    extra: tuple[Column, ...] = (),
) -> DataFrame:
    """Highest value of each count per key. ``sum_provinces`` adds the provinces up per date first."""
    daily = outbreak
    if sum_provinces:
        daily = outbreak.groupBy(*keys, "report_date").agg(*[F.sum(c).alias(c) for c in counts])
    return daily.groupBy(*keys).agg(*[F.max(c).alias(f"peak_{c}") for c in counts], *extra)


def outbreak_summary(
    outbreak: DataFrame,
    variant: str = "full",
    digits: int | None = None,
    corrected: bool = False,
    sum_provinces: bool = False,
) -> DataFrame:
    """One row per (entity, region): date span, peaks, fatality and recovery rate, coverage.

    ``province_count`` is the number of named provinces minus one, as published; ``corrected`` drops
    the minus one. ``sum_provinces`` takes peaks of the entity's daily total instead of the highest
    single province.
    """
    full = variant == "full"
    keys = ("country_region", "who_region")
    digits = digits if digits is not None else (4 if full else 3)
    counts = ("confirmed", "deaths", "recovered", "active")
    dates = (F.min("report_date").alias("first_report_date"), F.max("report_date").alias("last_report_date"))
    days = F.count("report_date").alias("reporting_days")
    # One aggregate per date, and the provinces apart: both start from the same one, and neither counts two columns at once.
    rows = outbreak
    if full:
        total = [F.sum(c).alias(f"_sum_{c}") for c in counts]
        rows = outbreak.groupBy(*keys, "report_date", "province_state").agg(*[F.max(c).alias(c) for c in counts], *total)
    if sum_provinces and full:
        daily = rows.groupBy(*keys, "report_date").agg(*[F.sum(f"_sum_{c}").alias(c) for c in counts])
    else:
        step = F.sum if sum_provinces else F.max
        daily = rows.groupBy(*keys, "report_date").agg(*[step(c).alias(c) for c in counts])
    base = peaks(daily, keys, extra=(*dates, days))
    if full:
        named = rows.groupBy(*keys, "province_state").agg(F.max("report_date").alias("_last"))
        named = named.groupBy(*keys).agg(F.count("province_state").alias("_named"))
        province_count = (F.col("_named") - (0 if corrected else 1)).alias("province_count")
        base = side_by_side([base, named], keys).select("*", province_count)
    fatality = percent_of(F.col("peak_deaths"), F.col("peak_confirmed"), digits).alias("case_fatality_rate_pct")
    recovery = percent_of(F.col("peak_recovered"), F.col("peak_confirmed"), 2).alias("recovery_rate_pct")
    span = F.datediff("last_report_date", "first_report_date").alias("days_tracked")
    if full:
        return base.select(
            *keys, "first_report_date", "last_report_date", span, "peak_confirmed", "peak_deaths",
            "peak_recovered", "peak_active", fatality, recovery, "reporting_days", "province_count",
        )
    return base.select(
        *keys, "first_report_date", "last_report_date", "peak_confirmed", "peak_deaths", "peak_recovered",
        fatality, "reporting_days",
    )


def beds_trend(capacity: DataFrame, profile: DataFrame) -> DataFrame:
    """Every capacity reading with the latest status and indicators of its entity, and its tier.

    Names match without regard to case and outer blanks. ``profile`` is the latest-year view.
    """
    readings = capacity.withColumn("_match", match_key("country_name"))
    latest = profile.select(
        match_key("country_name").alias("_match"),
        F.col("status").alias("development_status"),
        F.col("life_expectancy").alias("life_expectancy_latest"),
        F.col("gdp").alias("gdp_latest"),
    )
    return spread_left_join(readings, latest, "_match", ["country_code", "year"]).select(
        "country_code", "country_name", "year", "hospital_beds_per1k", "development_status",
        "life_expectancy_latest", "gdp_latest", step_label("hospital_beds_per1k").alias("capacity_tier"),
    )


def beds_trend_exact(capacity: DataFrame, panel: DataFrame) -> DataFrame:
    """Demo form: names match exactly; distinct (status, gdp) of the rows in the entity's last year."""
    rows = panel.select("country_name", "status", "gdp", "year")
    last = rows.groupBy("country_name").agg(F.max("year").alias("year"))
    latest = rows.join(last, ["country_name", "year"]).select("country_name", "status", "gdp").distinct()
    return spread_left_join(capacity, latest, "country_name", ["country_code", "year"]).select(
        "country_code", "country_name", "year", "hospital_beds_per1k",
        F.col("status").alias("development_status"), F.col("gdp").alias("gdp_per_capita"),
    )


def region_summary(outbreak: DataFrame, corrected: bool = False, digits: int | None = None) -> DataFrame:
    """Totals of the entities' peaks per region and their mean fatality rate.

    As published there is one row per region and entity, and each counts one entity; ``corrected``
    gives one row per region. ``digits`` rounds the mean.
    """
    per_entity = peaks(outbreak, ("who_region", "country_region"), counts=("confirmed", "deaths"))
    rate = percent_of(F.col("peak_deaths"), F.col("peak_confirmed"), None)
    mean = F.avg(rate) if digits is None else F.round(F.avg(rate), digits)
    totals = per_entity.groupBy("who_region").agg(
        F.count("country_region").alias("countries_in_region"),
        F.sum("peak_confirmed").alias("region_total_confirmed"),
        F.sum("peak_deaths").alias("region_total_deaths"),
        mean.alias("avg_cfr_pct"),
    )
    if corrected:
        return totals
    # One row per entity, an unnamed one included: it counts 0 entities, as published.
    repeated = totals.drop("countries_in_region").withColumnRenamed("who_region", "_region")
    entities = per_entity.select("who_region", F.col("country_region").isNotNull().cast("bigint").alias("countries_in_region"))
    return entities.join(repeated, entities["who_region"].eqNullSafe(repeated["_region"])).drop("_region")
