"""Full-refresh and append tables, releases of all tables of a run, the shared reject table, the load log and session views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tierlake import scratch
from tierlake.contracts import INGEST_ORDER
from tierlake.operators.ranking import dense_index

# Layer names, table names and columns.
LAYERS = ("bronze", "silver", "gold", "quarantine")
REJECT_TABLE = "quarantine.rejected_rows"
LOG_TABLE = "bronze.ingestion_log"
# Lists the tables of a release while they take their places; its existence is the release.
MANIFEST = "quarantine.release_manifest"
# Endings of tables that are being written, replaced, or wait for the release of their run; parts of a table of rejects.
LOADING, REPLACED, NEXT, PART = "__loading", "__replaced", "__next", "__part_"

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("reject_id", T.LongType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("reason_code", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("raw_snapshot", T.StringType()),
        T.StructField("raw_row", T.StringType()),
        T.StructField("rejected_at", T.TimestampType()),
    ]
)
LOG_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.IntegerType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("src_file", T.StringType()),
        T.StructField("rows_before", T.LongType()),
        T.StructField("rows_after", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("notes", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Lake:
    """The four databases, with an optional prefix so that several lakes can share a catalog."""

    spark: SparkSession
    prefix: str = ""

    def name(self, table: str) -> str:
        return self.prefix + table

    def table(self, table: str) -> DataFrame:
        """The released rows. A table of the newest release that has not got its name yet is read where it waits."""
        released = self.exists(MANIFEST) and self.exists(table + NEXT)
        return self.spark.table(self.name(table + NEXT if released else table))

    def tables(self) -> list[str]:
        """Names of all stored tables, with their layer."""
        listed = self.spark.catalog.listTables
        return sorted(f"{layer}.{t.name}" for layer in LAYERS for t in listed(f"{self.prefix}{layer}") if not t.isTemporary)

    def bootstrap(self, folder: str | None = None) -> None:
        """Create the databases (in ``folder`` if given), end a release that a crash stopped, and put back tables
        that one left under their old name."""
        for layer in LAYERS:
            place = f" LOCATION '{folder}/{layer}'" if folder else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer}{place}")
        if self.exists(MANIFEST):
            self.roll_forward()
        for table in self.tables():
            if table.endswith(REPLACED):
                self.recover(table.removesuffix(REPLACED))

    def roll_forward(self) -> None:
        """Give the tables of the release their names. Every step can be repeated after a crash."""
        for row in self.spark.table(self.name(MANIFEST)).collect():
            if self.exists(row.table_name + NEXT):
                self.promote(row.table_name + NEXT, row.table_name)
            self._drop(row.table_name + REPLACED)
        self._drop(MANIFEST)

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def recover(self, table: str) -> None:
        """Undo a swap that stopped half-way."""
        if self.exists(table + REPLACED) and not self.exists(table):
            self._rename(table + REPLACED, table)

    def _rename(self, table: str, to: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} RENAME TO {self.name(to)}")

    def _drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def promote(self, fresh: str, table: str) -> None:
        """Give a finished table its name. The old one is only dropped once the new one is in place."""
        self.recover(table)
        self._drop(table + REPLACED)
        if self.exists(table):
            self._rename(table, table + REPLACED)
        try:
            self._rename(fresh, table)
        except Exception:
            self.recover(table)
            raise
        self._drop(table + REPLACED)

    def replace(self, df: DataFrame, table: str, check: Callable[[DataFrame], None] | None = None) -> int:
        """Write beside the old table, check the result, then swap. Returns the number of rows.

        When the check raises, the old table stays and the new rows are removed.
        """
        fresh = table + LOADING
        counted = Observation()
        rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        self._drop(fresh)
        rows.write.mode("overwrite").saveAsTable(self.name(fresh))
        if check is not None:
            try:
                check(self.table(fresh))
            except Exception:
                self._drop(fresh)
                raise
        self.promote(fresh, table)
        return counted.get["rows"]

    def empty(self, schema: T.StructType, table: str) -> None:
        self.replace(self.spark.createDataFrame([], schema), table)

    def append_rejects(self, rejected: DataFrame, order: tuple[str, ...] = (), table: str = REJECT_TABLE) -> int:
        """Number the rejects on from the last id and append them; columns beyond the schema only order.

        ``order`` identifies a raw row, so it and the code number all failures; without it the texts do.
        """
        last = self.table(table).agg(F.max("reject_id")).first()[0] or 0
        counted = Observation()
        # Numbering reads the rows twice, to find the ranges and to place them; the gates behind them run once.
        with scratch.temporary(rejected, "rejects") as found:
            rows = self._numbered(found, order, last).observe(counted, F.count(F.lit(1)).alias("rows"))
            rows.write.mode("append").saveAsTable(self.name(table))
        return counted.get["rows"]

    def _numbered(self, rejected: DataFrame, order: tuple[str, ...], last: int = 0) -> DataFrame:
        named = [*order, "reason_code"] if order else ["source_table", "reason_code", "raw_snapshot"]
        places = [F.col(c).asc_nulls_first() for c in named]
        # The ordinal of the load tells all rows apart, other orders only those of one key.
        numbered = dense_index(rejected, places, "reject_id", key=named if order == INGEST_ORDER else None)
        return numbered.select(
            (F.col("reject_id") + last).alias("reject_id"),
            *[c if c in rejected.columns else F.lit(None).cast("string").alias(c) for c in REJECT_SCHEMA.names[1:6]],
            F.current_timestamp().alias("rejected_at"),
        )

    def log_load(
        self, log_id: int, table: str, src_file: str, before: int, after: int, note: str, log: str = LOG_TABLE
    ) -> None:
        """One row per load."""
        now = dt.datetime.now(dt.timezone.utc)
        row = (log_id, table, src_file, before, after, after - before, now, note)
        self.spark.createDataFrame([row], LOG_SCHEMA).write.mode("append").saveAsTable(self.name(log))

    def load_summary(self) -> DataFrame:
        columns = ("table_name", "src_file", "rows_loaded", "loaded_at", "notes")
        return self.table(LOG_TABLE).orderBy("loaded_at", "log_id").select(*columns)


@dataclass(frozen=True)
class Release(Lake):
    """The lake as one run sees it: tables that the run has written, else the released ones.

    What the run writes waits under other names until ``publish``, whose single rename makes all of it the lake's
    tables at once. Before that rename a crash leaves the old tables, after it the new ones: ``Lake.table`` reads them where
    they are, and the next ``bootstrap`` ends the tidying up. (Readers that name a table in SQL see it change when its
    own swap comes, moments later.) Every write replaces what the same step of the run wrote before, so steps can be
    repeated. One run at a time works on a lake.
    """

    def begin(self) -> None:
        """Forget what a run left that never published."""
        self.bootstrap()
        for table in self.tables():
            if NEXT in table or PART in table:
                self._drop(table)

    def table(self, table: str) -> DataFrame:
        waits = self.exists(table + NEXT)
        return self.spark.table(self.name(table + NEXT if waits else table))

    def replace(self, df: DataFrame, table: str, check: Callable[[DataFrame], None] | None = None) -> int:
        return super().replace(df, table + NEXT, check)

    def put_rejects(self, rejected: DataFrame, part: int, order: tuple[str, ...] = ()) -> int:
        """Rejects of one step, in place of those that it may have put before. Parts are numbered on in ``gather``."""
        return super().replace(self._numbered(rejected, order), f"{REJECT_TABLE}{PART}{part:02d}")

    def gather(self) -> None:
        """The run's table of rejects from its parts, with ids on from part to part."""
        rows, last = [self.spark.createDataFrame([], REJECT_SCHEMA)], 0
        parts = [table for table in self.tables() if table.startswith(REJECT_TABLE + PART)]
        for part in parts:
            rows.append(self.spark.table(self.name(part)).withColumn("reject_id", F.col("reject_id") + last))
            last += rows[-1].count()
        self.replace(reduce(DataFrame.unionByName, rows), REJECT_TABLE)

    def log_load(
        self, log_id: int, table: str, src_file: str, before: int, after: int, note: str, log: str = LOG_TABLE
    ) -> None:
        """One row per load; a repeated load replaces its row."""
        row = (log_id, table, src_file, before, after, after - before, dt.datetime.now(dt.timezone.utc), note)
        rows = self.spark.createDataFrame([row], LOG_SCHEMA)
        if self.exists(log + NEXT):
            # A handful of rows, read before their table is replaced.
            earlier = self.table(log).filter(F.col("log_id") != log_id).collect()
            rows = self.spark.createDataFrame([*earlier, row], LOG_SCHEMA)
        self.replace(rows, log)

    def publish(self) -> None:
        """Make everything that the run wrote the lake's tables, by one rename."""
        waiting = [(table.removesuffix(NEXT),) for table in self.tables() if table.endswith(NEXT)]
        self._drop(MANIFEST + LOADING)
        self.spark.createDataFrame(waiting, "table_name string").write.saveAsTable(self.name(MANIFEST + LOADING))
        self._rename(MANIFEST + LOADING, MANIFEST)
        self.roll_forward()
        for table in self.tables():
            if PART in table:
                self._drop(table)


def session_views(views: dict[str, DataFrame]) -> None:
    """Expose frames to SQL of this session; they are computed anew by each query."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
