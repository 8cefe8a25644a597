"""Tiers, rates and the weighted composite score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Labels, thresholds and weights of the published scorecard.
CAPACITY_STEPS = ((3.0, "Above WHO Recommended"), (1.0, "Near WHO Threshold"))
CAPACITY_REST = "Below WHO Threshold"
RISK_STEPS = ((70, 50, "Low Risk"), (60, 200, "Medium Risk"))
RISK_REST = "High Risk"
UNKNOWN_INFANT_DEATHS = 9999
LIFE_SPAN, LIFE_WEIGHT = 90.0, 40
INCOME_WEIGHT = 30
HIV_CEILING, HIV_WEIGHT = 10.0, 15
COVERAGE_TOTAL, COVERAGE_WEIGHT = 300.0, 15


def column(name_or_column: str | Column) -> Column:
    return F.col(name_or_column) if isinstance(name_or_column, str) else name_or_column


def step_label(
    value: str | Column,
    steps: Sequence[tuple[float, str]] = CAPACITY_STEPS,
    rest: str = CAPACITY_REST,
) -> Column:
    """Label of the first threshold the value reaches, highest threshold first."""
    value = column(value)
    label = F
    for threshold, name in steps:
        label = label.when(value >= threshold, F.lit(name))
    return label.otherwise(F.lit(rest))


def risk_label(
    life: str | Column,
    infant_deaths: str | Column,
    steps: Sequence[tuple[float, float, str]] = RISK_STEPS,
    rest: str = RISK_REST,
) -> Column:
    deaths = F.coalesce(column(infant_deaths), F.lit(UNKNOWN_INFANT_DEATHS))
    label = F
    for life_floor, death_ceiling, name in steps:
        label = label.when((column(life) >= life_floor) & (deaths < death_ceiling), F.lit(name))
    return label.otherwise(F.lit(rest))


def composite_score(
    life: str | Column,
    income: str | Column,
    hiv: str | Column,
    coverage: Sequence[str | Column],
    digits: int = 2,
) -> Column:
    """Weighted 0-100 score; a missing term counts 0, and so does a missing coverage figure."""
    zero = F.lit(0.0)
    life_part = column(life) / LIFE_SPAN * LIFE_WEIGHT
    income_part = column(income) * INCOME_WEIGHT
    # least() skips NULL, so an unknown rate counts as the ceiling and adds nothing.
    hiv_part = (1 - F.least(column(hiv) / HIV_CEILING, F.lit(1.0))) * HIV_WEIGHT
    covered = sum((F.coalesce(column(name), zero) for name in coverage), start=zero)
    coverage_part = covered / COVERAGE_TOTAL * COVERAGE_WEIGHT
    total = F.coalesce(life_part, zero) + F.coalesce(income_part, zero) + F.coalesce(hiv_part, zero)
    return F.round(total + coverage_part, digits)


def percent_of(part: Column, whole: Column, digits: int | None) -> Column:
    """part / whole * 100 as double, NULL unless whole is positive."""
    ratio = part.cast("double") / whole * 100
    return F.when(whole > 0, ratio if digits is None else F.round(ratio, digits))
