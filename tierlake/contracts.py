"""Dataset contracts: what a raw table must look like, what is rejected and why, what silver holds.

A contract is data. The operators in ``tierlake.operators`` know nothing about the subjects below.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from tierlake.functions.casts import ISO_DATE, blank_sql, cast_sql, present_sql, quoted, trimmed_sql

# Spark SQL text of a condition, given the contract with its options.
Predicate = Callable[["Contract"], str]
Snapshot = tuple[tuple[str, str | None], ...]

# All rows of a full refresh carry one ingest time; the stored ordinal tells them apart.
INGEST_ORDER = ("_ordinal",)


@dataclass(frozen=True)
class Field:
    """One raw text column and its typed silver column."""

    source: str
    target: str
    dtype: str = "string"
    upper: bool = False
    required: bool = False
    null_as_blank: bool = False
    max_length: int | None = None


@dataclass(frozen=True)
class Rule:
    """One quality gate. ``fails`` must give true or false, never NULL."""

    code: str
    reason: str
    fails: Predicate
    snapshot: Snapshot


@dataclass(frozen=True)
class DuplicateRule:
    """Keep-first gate over the rows of ``ranked``; ``loaded`` rows are ranked again for silver."""

    code: str
    reason: str
    snapshot: Snapshot
    ranked: Predicate
    loaded: Predicate


@dataclass(frozen=True)
class Contract:
    label: str
    bronze_table: str
    silver_table: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    hash_key: tuple[str, ...]
    silver_key: tuple[str, ...]
    silver_key_enforced: bool
    rules: tuple[Rule, ...]
    duplicates: DuplicateRule
    entity: str
    period: str
    separator: str = ","
    max_errors: int = 0
    load_note: str = ""
    # Should identify a row within its key; the ordinal stored at ingest does.
    order: tuple[str, ...] = INGEST_ORDER
    # False where rows of a key may share their place in the order: then a hash of the whole row decides.
    order_is_unique: bool = True
    # "exact", "ci" (case-insensitive) or "typed" (compare the cast values, e.g. 2015 = 02015)
    match: str = "exact"
    blank: str = "null"
    date_formats: tuple[str, ...] = (ISO_DATE,)
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict, hash=False)

    @property
    def source_columns(self) -> list[str]:
        return [f.source for f in self.fields]

    def field_of(self, source: str) -> Field:
        return next(f for f in self.fields if f.source == source)

    def value(self, source: str) -> str:
        """Typed value of a raw column."""
        f = self.field_of(source)
        cast = cast_sql(f.source, f.dtype, self.blank, f.null_as_blank, self.date_formats)
        return f"upper({cast})" if f.upper else cast

    def in_range(self, source: str) -> str:
        low, high = self.ranges[source]
        return f"coalesce({self.value(source)} BETWEEN {low} AND {high}, false)"

    def parses(self, source: str) -> str:
        return f"({self.value(source)} IS NOT NULL)"

    def key_columns(self) -> list[str]:
        """Normalised de-duplication key, never NULL."""
        if self.match == "typed":
            return [f"coalesce(CAST({self.value(name)} AS STRING), '')" for name in self.key]
        if self.match == "ci":
            return [f"lower({trimmed_sql(name)})" for name in self.key]
        if self.match == "exact":
            return [trimmed_sql(name) for name in self.key]
        raise ValueError(f"match must be 'exact', 'ci' or 'typed', not {self.match!r}")

    def silver_columns(self) -> list[str]:
        return [f"{self.value(f.source)} AS {quoted(f.target)}" for f in self.fields]

    def with_options(self, **changes) -> "Contract":
        return replace(self, **changes)


def every(*conditions: str) -> str:
    return "(" + " AND ".join(conditions) + ")"


def some(*conditions: str) -> str:
    return "(" + " OR ".join(conditions) + ")"


def no(condition: str) -> str:
    return f"(NOT {condition})"


# ---------------------------------------------------------------------------------------------
# Names of tables and columns, reason codes and texts, ranges and limits.
PANEL, OUTBREAK, CAPACITY = "DS1", "DS2", "DS3"

PANEL_BRONZE, PANEL_SILVER = "bronze.who_health_indicators", "silver.who_health_indicators"
OUTBREAK_BRONZE, OUTBREAK_SILVER = "bronze.disease_outbreaks", "silver.disease_outbreaks"
CAPACITY_BRONZE, CAPACITY_SILVER = "bronze.hospital_capacity", "silver.hospital_capacity"

PANEL_YEARS = (2000, 2015)
CAPACITY_YEARS = (1960, 2024)
CAPACITY_CODE_LENGTH = 3
BEDS = "Hospital beds (per 1,000 people)"

# source column, silver column, type, declared length
PANEL_FIELDS = (
    ("Country", "country_name", "string", 200),
    ("Year", "year", "smallint", 10),
    ("Status", "status", "string", 50),
    ("Life expectancy", "life_expectancy", "double", 20),
    ("Adult Mortality", "adult_mortality", "double", 20),
    ("infant deaths", "infant_deaths", "int", 20),
    ("Alcohol", "alcohol", "double", 20),
    ("percentage expenditure", "pct_expenditure", "double", 30),
    ("Hepatitis B", "hepatitis_b", "double", 20),
    ("Measles", "measles", "int", 20),
    ("BMI", "bmi", "double", 20),
    ("under-five deaths", "under_five_deaths", "int", 20),
    ("Polio", "polio", "double", 20),
    ("Total expenditure", "total_expenditure", "double", 20),
    ("Diphtheria", "diphtheria", "double", 20),
    ("HIV/AIDS", "hiv_aids", "double", 20),
    ("GDP", "gdp", "double", 30),
    ("Population", "population", "bigint", 30),
    ("thinness 1-19 years", "thinness_1_19_years", "double", 20),
    ("thinness 5-9 years", "thinness_5_9_years", "double", 20),
    ("Income composition of resources", "income_composition", "double", 20),
    ("Schooling", "schooling", "double", 20),
)
OUTBREAK_FIELDS = (
    ("Province/State", "province_state", "string", 200),
    ("Country/Region", "country_region", "string", 200),
    ("Lat", "lat", "double", 30),
    ("Long", "long", "double", 30),
    ("Date", "report_date", "date", 30),
    ("Confirmed", "confirmed", "bigint", 30),
    ("Deaths", "deaths", "bigint", 30),
    ("Recovered", "recovered", "bigint", 30),
    ("Active", "active", "bigint", 30),
    ("WHO Region", "who_region", "string", 200),
)
CAPACITY_FIELDS = (
    ("Entity", "country_name", "string", 200),
    ("Code", "country_code", "string", 10),
    ("Year", "year", "smallint", 10),
    (BEDS, "hospital_beds_per1k", "double", 30),
)

REASONS = {
    "panel country": "Country is NULL or empty – primary geographic key missing",
    "panel country demo": "Country is NULL or empty string – primary geographic key missing",
    "panel year missing": "Year is NULL – time dimension key missing",
    "panel year range": "Year outside valid dataset range (2000-2015)",
    "panel year range demo": "Year is outside valid dataset range (2000-2015) – likely data entry error",
    "panel duplicate": "Duplicate Country+Year – only first-ingested row retained",
    "outbreak country": "Country/Region is NULL or empty – geographic key missing",
    "outbreak country demo": "Country/Region is NULL or empty – cannot assign row to any geography",
    "outbreak date": "Date value cannot be parsed as a valid calendar date",
    "outbreak duplicate": "Duplicate Country+Province+Date – first-ingested row retained",
    "outbreak duplicate demo": "Duplicate Country/Region + Province/State + Date – first-ingested row kept",
    "outbreak counts": "Confirmed or Deaths contains non-numeric text – cannot cast to BIGINT",
    "outbreak counts demo": "Confirmed or Deaths contains non-numeric text (cannot be cast to integer)",
    "capacity keys": "Entity (country name) or Code (ISO) is NULL or empty",
    "capacity keys demo": "Entity (country name) or Code (ISO) is NULL or empty string",
    "capacity code": "Country Code is not a valid 3-letter ISO 3166-1 Alpha-3 code",
    "capacity year": "Year cannot be parsed or is outside valid range (1960-2024)",
    "capacity duplicate": "Duplicate Code+Year – first-ingested row retained",
    "capacity duplicate demo": "Duplicate Code+Year – first-ingested row kept",
}

PANEL_MAX_ERRORS, OUTBREAK_MAX_ERRORS, CAPACITY_MAX_ERRORS = 10, 50, 10

# Whole-file id columns of the wide capacity file; every other column is a four-digit year.
WIDE_IDS = ("Country Name", "Country Code", "Indicator Name", "Indicator Code")
WIDE_YEARS = tuple(str(year) for year in range(1960, 2020))
# ---------------------------------------------------------------------------------------------

VARIANTS = ("full", "demo")


def _reason(name: str, variant: str) -> str:
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, not {variant!r}")
    return REASONS.get(f"{name} demo", REASONS[name]) if variant == "demo" else REASONS[name]


def panel_contract(variant: str = "full", years: tuple[int, int] = PANEL_YEARS, **options) -> Contract:
    """Entity and year indicators."""

    def usable(c: Contract) -> str:
        return every(present_sql("Country"), c.in_range("Year"))

    keys: Snapshot = (("Country", "Country"), ("Year", "Year"))
    # The full load reads a missing metric as '', the demo load only a missing BMI.
    blanked = {f[0] for f in PANEL_FIELDS[3:]} if variant == "full" else {"BMI"}
    return Contract(
        label=PANEL,
        bronze_table=PANEL_BRONZE,
        silver_table=PANEL_SILVER,
        fields=tuple(
            Field(s, t, d, required=s in ("Country", "Year"), null_as_blank=s in blanked, max_length=n)
            for s, t, d, n in PANEL_FIELDS
        ),
        key=("Country", "Year"),
        hash_key=("Country", "Year"),
        silver_key=("country_name", "year"),
        silver_key_enforced=variant == "full",
        rules=(
            Rule("QG-001", _reason("panel country", variant), lambda c: blank_sql("Country"), keys),
            Rule(
                "QG-001",
                _reason("panel year missing", variant),
                lambda c: every(present_sql("Country"), blank_sql("Year")),
                (("Country", "Country"), ("Year", None)),
            ),
            Rule(
                "QG-002",
                _reason("panel year range", variant),
                lambda c: every(present_sql("Country"), present_sql("Year"), no(c.in_range("Year"))),
                keys,
            ),
        ),
        duplicates=DuplicateRule("QG-003", _reason("panel duplicate", variant), keys, usable, usable),
        entity="Country",
        period="Year",
        max_errors=PANEL_MAX_ERRORS,
        ranges={"Year": years},
    ).with_options(**options)


def outbreak_contract(variant: str = "full", **options) -> Contract:
    """Entity, province and date counts."""

    def dated(c: Contract) -> str:
        return every(present_sql("Country/Region"), c.parses("Date"))

    def counted(c: Contract) -> str:
        return every(c.parses("Confirmed"), c.parses("Deaths"))

    place: Snapshot = (("Country/Region", "Country/Region"), ("Date", "Date"))
    province = (("Province", "Province/State"),) if variant == "full" else ()
    return Contract(
        label=OUTBREAK,
        bronze_table=OUTBREAK_BRONZE,
        silver_table=OUTBREAK_SILVER,
        fields=tuple(
            Field(s, t, d, required=s in ("Country/Region", "Date"), max_length=n)
            for s, t, d, n in OUTBREAK_FIELDS
        ),
        key=("Country/Region", "Province/State", "Date"),
        hash_key=("Country/Region", "Province/State", "Date"),
        silver_key=("country_region", "province_state", "report_date"),
        silver_key_enforced=False,
        rules=(
            Rule(
                "QG-001",
                _reason("outbreak country", variant),
                lambda c: blank_sql("Country/Region"),
                place,
            ),
            Rule(
                "QG-002",
                _reason("outbreak date", variant),
                lambda c: every(present_sql("Country/Region"), no(c.parses("Date"))),
                place,
            ),
            Rule(
                "QG-005",
                _reason("outbreak counts", variant),
                lambda c: every(dated(c), no(counted(c)), some(present_sql("Confirmed"), present_sql("Deaths"))),
                (("Country", "Country/Region"), ("Confirmed", "Confirmed"), ("Deaths", "Deaths")),
            ),
        ),
        # Duplicates are ranked with or without usable counts, silver only with them: a row can be
        # rejected as a duplicate of an unusable first copy and still be the first usable one.
        duplicates=DuplicateRule(
            "QG-003",
            _reason("outbreak duplicate", variant),
            (("Country", "Country/Region"), *province, ("Date", "Date")),
            dated,
            lambda c: every(dated(c), counted(c)),
        ),
        entity="Country/Region",
        period="Date",
        max_errors=OUTBREAK_MAX_ERRORS,
    ).with_options(**options)


def capacity_contract(
    variant: str = "full",
    years: tuple[int, int] = CAPACITY_YEARS,
    known_code: str | None = None,
    **options,
) -> Contract:
    """Entity, code and year capacity. ``known_code`` names a boolean column that must also hold."""

    def coded(c: Contract) -> str:
        code = f"(length({trimmed_sql('Code')}) = {CAPACITY_CODE_LENGTH})"
        return every(code, quoted(known_code)) if known_code else code

    def usable(c: Contract) -> str:
        return every(ranked(c), c.parses(BEDS))

    def ranked(c: Contract) -> str:
        return every(present_sql("Entity"), coded(c), c.in_range("Year"))

    keys: Snapshot = (("Entity", "Entity"), ("Code", "Code"))
    year_rule = Rule(
        "QG-002",
        REASONS["capacity year"],
        lambda c: every(present_sql("Entity"), coded(c), no(c.in_range("Year"))),
        (("Entity", "Entity"), ("Year", "Year")),
    )
    return Contract(
        label=CAPACITY,
        bronze_table=CAPACITY_BRONZE,
        silver_table=CAPACITY_SILVER,
        fields=tuple(
            Field(s, t, d, upper=s == "Code", required=True, max_length=n) for s, t, d, n in CAPACITY_FIELDS
        ),
        key=("Code", "Year"),
        hash_key=("Code", "Year"),
        silver_key=("country_code", "year"),
        silver_key_enforced=variant == "full",
        rules=(
            Rule(
                "QG-001",
                _reason("capacity keys", variant),
                lambda c: some(blank_sql("Entity"), blank_sql("Code")),
                keys,
            ),
            Rule(
                "QG-004",
                _reason("capacity code", variant),
                lambda c: every(present_sql("Entity"), present_sql("Code"), no(coded(c))),
                keys,
            ),
            *((year_rule,) if variant == "full" else ()),
        ),
        duplicates=DuplicateRule(
            "QG-003",
            _reason("capacity duplicate", variant),
            (*keys, ("Year", "Year")),
            usable if variant == "full" else ranked,
            usable,
        ),
        entity="Entity",
        period="Year",
        separator="|",
        max_errors=CAPACITY_MAX_ERRORS,
        ranges={"Year": years},
    ).with_options(**options)
