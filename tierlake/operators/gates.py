"""Quality gates: one pass over the raw rows gives every failed rule and the rows to load.

Gates may overlap, so a row carries an array of failures rather than one code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierlake.contracts import Contract
from tierlake.functions.casts import literal, trimmed
from tierlake.functions.keys import snapshot_sql
from tierlake.operators.dedupe import flag_first, keep_first, row_hash

UNACCOUNTED_CODE = "QG-006"
UNACCOUNTED_REASON = "Row passes every gate but cannot be loaded"


def _failure(code: str, reason: str, text: str | None) -> str:
    shown = f", 'snapshot', {text}" if text else ""
    return f"named_struct('code', {literal(code)}, 'reason', {literal(reason)}{shown})"


def _failures(contract: Contract, snapshots: bool = True) -> list[str]:
    def shown(rule) -> str | None:
        return snapshot_sql(rule.snapshot) if snapshots else None

    return [_failure(rule.code, rule.reason, shown(rule)) for rule in contract.rules]


def assess(bronze: DataFrame, contract: Contract) -> DataFrame:
    """Narrow pass: adds ``_failed``, the failures of all rules that look at one row alone."""
    fails = [rule.fails(contract) for rule in contract.rules]
    return bronze.withColumn("_failed", F.expr(_listed(fails, _failures(contract))))


def _listed(fails: list[str], failures: list[str], otherwise: str = "") -> str:
    """The failures of a row; only rows that fail build them, others get an empty array from plain predicates.

    ``otherwise`` adds branches for rows that no rule fails. Nothing in it is a lambda, so all of it is generated code.
    """
    some = " OR ".join(f"coalesce({rule}, false)" for rule in fails)
    each = [f"CASE WHEN {rule} THEN array({failure}) ELSE array() END" for rule, failure in zip(fails, failures, strict=True)]
    return f"CASE WHEN {some} THEN concat({', '.join(each)}) {otherwise} ELSE array() END"


def evaluate(
    bronze: DataFrame, contract: Contract, report_unaccounted: bool = False, snapshots: bool = True
) -> DataFrame:
    """Adds ``_failed`` (all failures, duplicates included) and ``_load`` (goes to silver).

    Without ``snapshots`` failures carry code and reason only, enough to count them.
    """
    gate = contract.duplicates
    ranked, loadable = gate.ranked(contract), gate.loaded(contract)
    # Where both rankings cover the same rows, one serves for both.
    first = "_load" if ranked == loadable else "_first"
    # One bit for each rule, found before the shuffle: what is generated behind the join stays small enough to be compiled.
    bits = [f"CASE WHEN {rule.fails(contract)} THEN {1 << i}L ELSE 0L END" for i, rule in enumerate(contract.rules)]
    flagged = flag_first(
        bronze,
        [F.expr(key) for key in contract.key_columns()],
        contract.order,
        {first: F.expr(ranked), "_load": F.expr(loadable)},
        contract.order_is_unique,
        {"_rules": F.expr(" + ".join(bits) or "0L")},
    )
    repeated = _failure(gate.code, gate.reason, snapshot_sql(gate.snapshot) if snapshots else None)
    duplicate = f"_in_{first} AND NOT {first}"
    fails = [*[f"(_rules & {1 << i}L) <> 0L" for i in range(len(bits))], duplicate]
    missing = ""
    if report_unaccounted:
        everything = snapshot_sql(tuple((name, name) for name in contract.source_columns)) if snapshots else None
        missing = f"WHEN NOT _in__load THEN array({_failure(UNACCOUNTED_CODE, UNACCOUNTED_REASON, everything)})"
    failed = _listed(fails, [*_failures(contract, snapshots), repeated], missing)
    return flagged.withColumn("_failed", F.expr(failed)).drop("_in__first", "_in__load", "_first", "_rules")


def rejects(
    gated: DataFrame, contract: Contract, keep_row: bool = False, extra: tuple[str, ...] = (), snapshots: bool = True
) -> DataFrame:
    """One row per failure. ``keep_row`` adds the whole raw row as JSON, for reprocessing; ``snapshots`` as in ``evaluate``."""
    raw = [F.to_json(F.struct(*contract.source_columns)).alias("raw_row")] if keep_row else []
    return gated.filter(F.size("_failed") > 0).select(
        *extra,
        *raw,
        F.lit(contract.bronze_table).alias("source_table"),
        F.explode("_failed").alias("_f"),
    ).select(
        *extra,
        "source_table",
        F.col("_f.code").alias("reason_code"),
        F.col("_f.reason").alias("reject_reason"),
        *([F.col("_f.snapshot").alias("raw_snapshot")] if snapshots else []),
        *(["raw_row"] if keep_row else []),
    )


def loaded(gated: DataFrame, contract: Contract) -> DataFrame:
    """Typed silver rows of an evaluated frame."""
    return gated.filter("_load").selectExpr(*contract.silver_columns())


def silver(bronze: DataFrame, contract: Contract) -> DataFrame:
    """Typed silver rows straight from bronze, when the rejects are not wanted: one shuffle."""
    usable = bronze.filter(contract.duplicates.loaded(contract))
    # The hash reads every raw column, so it is only there where it decides something.
    ties = [] if contract.order_is_unique else [row_hash(bronze)]
    # Rows are cast before the shuffle: typed values are narrower than the raw text, and most key columns are among them.
    typed = {f"_s{i}": (f, contract.value(f.source)) for i, f in enumerate(contract.fields)}
    held = {f.source: name for name, (f, _) in typed.items() if f.dtype == "string" and not f.upper and contract.match == "exact"}
    keys = {f"_k{i}": (source, key) for i, (source, key) in enumerate(zip(contract.key, contract.key_columns(), strict=True))}
    # A silver text is the trimmed key with NULL for blank, which groups the same rows.
    names = [held.get(source, name) for name, (source, _) in keys.items()]
    places = [*contract.order, *ties]
    narrow = usable.select(
        *[F.expr(value).alias(name) for name, (_, value) in typed.items()],
        *[F.expr(key).alias(name) for name, (source, key) in keys.items() if source not in held],
        *[(F.col(place) if isinstance(place, str) else place).alias(f"_o{i}") for i, place in enumerate(places)],
    )
    first = keep_first(narrow, names, [f"_o{i}" for i in range(len(places))])
    return first.select(*[F.col(name).alias(f.target) for name, (f, _) in typed.items()])


def mark_known(bronze: DataFrame, column: str, codes: DataFrame, name: str = "_known") -> DataFrame:
    """Boolean column: does the upper-cased code occur in the single-column list ``codes``?

    Pass ``known_code=name`` to the contract to make the code gate require it.
    """
    listed = codes.select(F.upper(F.trim(F.col(codes.columns[0]))).alias("_code")).distinct()
    listed = listed.withColumn(name, F.lit(True))
    coded = bronze.withColumn("_code", F.upper(trimmed(column)))
    return coded.join(listed, "_code", "left").drop("_code").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
