"""Full refresh: files to bronze, bronze to silver and quarantine, silver to gold."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tierlake import scratch
from tierlake.contracts import WIDE_IDS, Contract, capacity_contract, outbreak_contract, panel_contract
from tierlake.operators import gates
from tierlake.operators.checks import assert_keys, reconcile
from tierlake.operators.profiles import stacked
from tierlake.plans import marts, reports
from tierlake.plans.scorecard import SCORECARD_KEY, scorecard
from tierlake.sinks.tables import LOG_SCHEMA, LOG_TABLE, Lake, Release
from tierlake.sources import delimited, positions

LOAD_CODE = "QG-000"
LOAD_REASON = "Malformed row skipped at load"


@dataclass
class Inputs:
    """File paths (globs allowed). ``wide`` is given when the capacity file has a column per year."""

    panel: str
    outbreak: str
    capacity: str
    wide: dict | None = field(default_factory=dict)


@dataclass
class Refresh:
    """One run over a lake. The three contracts may be replaced, e.g. for other year ranges.

    Nothing of a run is visible in the lake until it ends well. ``check_headers`` compares the first line of every file with the
    contract's names.
    """

    lake: Lake
    variant: str = "full"
    panel: Contract | None = None
    outbreak: Contract | None = None
    capacity: Contract | None = None
    report_unaccounted: bool = False
    check_headers: bool = True

    def __post_init__(self) -> None:
        self.panel = self.panel or panel_contract(self.variant)
        self.outbreak = self.outbreak or outbreak_contract(self.variant)
        self.capacity = self.capacity or capacity_contract(self.variant)

    @property
    def contracts(self) -> tuple[Contract, Contract, Contract]:
        return self.panel, self.outbreak, self.capacity

    @property
    def work(self) -> Release:
        """Where this run writes."""
        return Release(self.lake.spark, self.lake.prefix)

    def run(self, inputs: Inputs) -> DataFrame:
        """Everything; returns the reconciliation of the three tables."""
        self.start()
        self.land_files(inputs)
        checked = self.clean()
        self.publish()
        self.finish()
        return checked

    def start(self) -> None:
        """Tables, log and rejects of this run gather beside the last run's, which stay until this one ends well."""
        self.work.begin()
        self.work.empty(LOG_SCHEMA, LOG_TABLE)

    def finish(self) -> None:
        """This run's tables, log and rejects take the place of the last run's, all at once."""
        self.work.gather()
        self.work.publish()

    # -- bronze -------------------------------------------------------------------------------

    def land_files(self, inputs: Inputs) -> None:
        spark = self.lake.spark
        for log_id, (contract, path) in enumerate(
            zip(self.contracts, (inputs.panel, inputs.outbreak, inputs.capacity)), start=1
        ):
            wide = inputs.wide if contract is self.capacity else None
            options = {"separator": contract.separator, "header": True} | (wide or {})
            # With the check the first lines are read as rows, which the survey knows from the others.
            checked = self.check_headers and options["header"]
            if checked:
                options["header"] = False
            if wide is None:
                names, bad = contract.source_columns, delimited.is_malformed(contract)
                frame = delimited.read_contract(spark, path, contract, **options)
            else:
                options.setdefault("years", delimited.header_years(spark, path, options["separator"]))
                names, bad = [*WIDE_IDS, *options["years"]], delimited.is_malformed_wide(contract, options["years"])
                frame = delimited.read_wide(spark, path, **options)
            head = delimited.is_header(names, options["separator"]) if checked else None
            self.land(frame, contract, log_id, path, bad, wide is not None, head)

    def land(
        self, frame: DataFrame, contract: Contract, log_id: int, path: str, bad: Column, wide: bool = False, head: Column | None = None
    ) -> int:
        """Load one frame into its bronze table. A first, narrow pass counts its rows and places them, and ends a
        load with too many malformed rows, or with a first line that is not ``head``, before anything is written."""
        found = positions.survey(frame, bad, head)
        if found.headless:
            raise delimited.HeaderMismatch(f"{path}: first lines differ from the contract, e.g. in {', '.join(found.headless)}")
        if found.malformed > contract.max_errors:
            raise delimited.TooManyBadRows(f"{path}: {found.malformed} malformed rows, {contract.max_errors} allowed")
        placed = positions.with_ordinal(frame, found)
        good = delimited.well_formed(placed, bad)
        rows = delimited.wide_to_long(good, contract) if wide else good
        loaded = self.work.replace(delimited.add_metadata(rows, contract), contract.bronze_table)
        if found.malformed:
            whole = F.to_json(F.struct(*[c for c in frame.columns if not c.startswith("_")]))
            skipped = delimited.malformed(placed, bad).select(
                F.lit(contract.bronze_table).alias("source_table"),
                F.lit(LOAD_CODE).alias("reason_code"),
                F.lit(LOAD_REASON).alias("reject_reason"),
                F.coalesce(delimited.CORRUPT, whole).alias("raw_snapshot"),
            )
            self.work.put_rejects(skipped, log_id)
        src_file = path.rsplit("/", 1)[-1]
        self.work.log_load(
            log_id, contract.bronze_table, src_file, 0, loaded, contract.load_note
        )
        return loaded

    # -- silver -------------------------------------------------------------------------------

    def clean(self) -> DataFrame:
        return stacked([self.clean_one(contract) for contract in self.contracts])

    def clean_one(self, contract: Contract) -> DataFrame:
        """Gate one bronze table once; silver and quarantine both read the stored outcome."""
        bronze = self.work.table(contract.bronze_table)
        required = [f.target for f in contract.fields if f.required]

        def sound(df: DataFrame) -> None:
            if contract.silver_key_enforced:
                assert_keys(df, contract.silver_key, required, contract.silver_table)

        with scratch.temporary(gates.evaluate(bronze, contract, self.report_unaccounted), "gated") as gated:
            silver = gates.loaded(gated, contract).withColumn("_silver_loaded", F.current_timestamp())
            self.work.replace(silver, contract.silver_table, sound)
            rejected = gates.rejects(gated, contract, keep_row=True, extra=contract.order)
            self.work.put_rejects(rejected, len(self.contracts) + 1 + self.contracts.index(contract), contract.order)
            checked = reconcile(gated, contract.bronze_table)
            # One row, which outlives the stored outcome.
            return self.lake.spark.createDataFrame(checked.collect(), checked.schema)

    # -- gold ---------------------------------------------------------------------------------

    def silver(self, contract: Contract) -> DataFrame:
        return self.lake.table(contract.silver_table)

    def publish(self) -> None:
        """Marts are stored, each readable under the name of its view."""
        panel, outbreak, capacity = (self.work.table(contract.silver_table) for contract in self.contracts)
        full = self.variant == "full"
        replace = self.work.replace
        replace(marts.country_profile(panel, self.variant), reports.GOLD_PROFILE)
        replace(marts.outbreak_summary(outbreak, self.variant), reports.GOLD_OUTBREAK)
        profile = self.work.table(reports.GOLD_PROFILE)
        trend = marts.beds_trend(capacity, profile) if full else marts.beds_trend_exact(capacity, panel)
        replace(trend, reports.GOLD_CAPACITY)
        if full:
            replace(marts.region_summary(outbreak), reports.GOLD_REGION)
        card = scorecard(panel, outbreak, capacity, self.variant)

        def unique(df: DataFrame) -> None:
            if full:
                assert_keys(df, SCORECARD_KEY, (), reports.GOLD_SCORECARD)

        replace(card.withColumn("_gold_created", F.current_timestamp()), reports.GOLD_SCORECARD, unique)
