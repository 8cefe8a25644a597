"""All reports over the stored tables of a lake, as they end the stages of a refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tierlake.operators.profiles import bronze_key_checks, bronze_profile, stacked
from tierlake.plans import reports
from tierlake.plans.refresh import Refresh
from tierlake.sinks.tables import REJECT_TABLE


def lake_reports(run: Refresh) -> dict[str, DataFrame]:
    """Name and rows of each report, in the order bronze, silver, gold; nothing is computed before a report is read.

    The demo lake has no region view, and its gold tables lack columns that some reports show.
    """
    lake, full = run.lake, run.variant == "full"
    panel, outbreak, capacity = run.contracts
    raw = {contract: lake.table(contract.bronze_table) for contract in run.contracts}
    card, rejected = lake.table(reports.GOLD_SCORECARD), lake.table(REJECT_TABLE)
    views = [reports.GOLD_SCORECARD, reports.GOLD_PROFILE, reports.GOLD_OUTBREAK, reports.GOLD_CAPACITY]
    found = {
        "load_summary": lake.load_summary(),
        "bronze_profile": stacked([bronze_profile(rows, contract) for contract, rows in raw.items()]),
        "bronze_key_checks": bronze_key_checks(raw[panel], raw[outbreak], raw[capacity], outbreak),
        "gate_summary": reports.gate_summary(rejected),
        "rejects_per_table": reports.rejects_per_table(rejected),
        "silver_profile": reports.silver_profile(
            [
                (panel, run.silver(panel), "country_name", "year"),
                (outbreak, run.silver(outbreak), "country_region", None),
                (capacity, run.silver(capacity), "country_code", "year"),
            ]
        ),
        "null_profile": reports.panel_nulls(run.silver(panel)),
        "gold_counts": reports.gold_counts(
            {name: lake.table(name) for name in (*views, *((reports.GOLD_REGION,) if full else ()))}
        ),
        "tier_distribution": reports.tier_distribution(card),
        "capacity_gap": reports.capacity_gap(card),
        "scorecard_listing": reports.scorecard_listing(card),
    }
    if full:
        found |= {
            "longest_lived": reports.longest_lived(card),
            "shortest_lived": reports.shortest_lived(card),
            "worst_outbreaks": reports.worst_outbreaks(lake.table(reports.GOLD_OUTBREAK)),
            "score_ranking": reports.score_ranking(card),
            "status_comparison": reports.status_comparison(card),
            "high_risk": reports.high_risk(card),
        }
    return found
