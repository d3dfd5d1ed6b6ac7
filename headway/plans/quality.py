"""Data quality suites, contracts, profiles, headline metrics and personal-data detection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import clock


@dataclass(frozen=True)
class Check:
    """One test of a table; ``kind`` is not_null, unique, between, in_set, row_count or condition."""

    name: str
    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    condition: str | None = None
    threshold: int = 0


def _failures(check: Check) -> Column:
    """Aggregate counting offending rows. NULLs offend only not_null."""
    if check.kind == "row_count":
        n = F.count("*")
        outside = n < check.low
        if check.high is not None:
            outside = outside | (n > check.high)
        return F.when(outside, F.greatest(n, F.lit(1))).otherwise(F.lit(0))
    if check.kind == "unique":
        return F.count(check.column) - F.countDistinct(check.column)
    if check.kind == "condition":
        return F.count_if(F.expr(check.condition))
    c = F.col(check.column)
    if check.kind == "not_null":
        return F.count_if(c.isNull())
    if check.kind == "between":
        low = F.lit(False) if check.low is None else c < check.low
        high = F.lit(False) if check.high is None else c > check.high
        return F.count_if(low | high)
    if check.kind == "in_set":
        return F.count_if(c.isNotNull() & ~c.isin(*check.values))
    raise ValueError(f"unknown check kind {check.kind}")


def run_checks(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(table, test, failed, passed) per check, from one aggregation over the table."""
    one = df.agg(*[_failures(c).cast("long").alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(F.lit(c.name).alias("test"), F.col(f"c{i}").alias("failed"), F.lit(c.threshold).alias("allowed"))
        for i, c in enumerate(checks)
    ]
    results = one.select(F.explode(F.array(*rows)).alias("r"))
    return results.select(
        F.lit(table).alias("table"), "r.test", "r.failed", (F.col("r.failed") <= F.col("r.allowed")).alias("passed")
    )


def baseline_checks(table: str, df: DataFrame) -> list[Check]:
    """What every table must meet without a curated list: some rows, and a filled first column."""
    checks = [Check(f"{table}_row_count_positive", "row_count", low=1)]
    if df.columns:
        checks.append(Check(f"{table}_{df.columns[0]}_not_null", "not_null", df.columns[0]))
    return checks


def run_suite(tables: dict[str, DataFrame], curated: dict[str, Sequence[Check]]) -> DataFrame:
    """All results of all tables; a curated list replaces the baseline of its table."""
    parts = [run_checks(name, df, curated.get(name) or baseline_checks(name, df)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


# Curated tests; the box covers the region's stops.
LAT_BOX, LON_BOX = (47.5, 49.5), (1.0, 3.8)
CURATED = {
    "stop_areas": [
        Check("stop_areas_station_id_not_null", "not_null", "station_id"),
        Check("stop_areas_station_id_unique", "unique", "station_id"),
        Check("stop_areas_lat_in_idf", "between", "station_lat", *LAT_BOX),
        Check("stop_areas_lon_in_idf", "between", "station_lon", *LON_BOX),
        Check("stop_areas_row_count_positive", "row_count", low=1),
    ],
    "station_accessibility": [
        Check("station_accessibility_level_not_null", "not_null", "accessibility_level_id"),
        Check("station_accessibility_pct_in_range", "between", "pct_elevators_available", 0, 100),
    ],
    "elevators_availability": [
        Check("elevators_pct_available_in_range", "between", "pct_available", 0, 100),
        Check("elevators_available_not_exceeding_total", "condition", condition="nb_available > nb_elevators"),
    ],
    "dim_stops": [
        Check("dim_stops_stop_id_not_null", "not_null", "stop_id"),
        Check("dim_stops_stop_id_unique", "unique", "stop_id"),
        Check("dim_stops_wheelchair_boarding_in_set", "in_set", "wheelchair_boarding", values=(0, 1, 2)),
    ],
    "transfer_walking": [
        Check("transfer_walking_from_not_null", "not_null", "from_stop_id"),
        Check("transfer_walking_to_not_null", "not_null", "to_stop_id"),
    ],
}

# --- contracts -------------------------------------------------------------


@dataclass(frozen=True)
class Contract:
    """Promises about one table: columns, rules each row must meet, unique columns, tests, freshness."""

    table: str
    columns: dict[str, str]
    rules: dict[str, str]
    unique: tuple[str, ...] = ()
    tests: tuple[str, ...] = ()
    fresh_column: str | None = None
    max_age_hours: int | None = None
    status: str = "Approved"


# Published contracts. The first names columns its table lacks, which is reported.
CONTRACTS = {
    "station_accessibility_contract": Contract(
        "station_accessibility",
        {
            "accessibility_level_id": "int",
            "pct_elevators_available": "double",
            "nb_elevators": "int",
            "stop_point_latitude": "double",
            "stop_point_longitude": "double",
        },
        {
            "accessibility-level-present": "accessibility_level_id IS NOT NULL",
            "elevator-availability-bounded": "pct_elevators_available BETWEEN 0 AND 100",
        },
        tests=("station_accessibility_level_not_null", "station_accessibility_pct_in_range"),
        max_age_hours=24,
    ),
    "elevators_availability_contract": Contract(
        "elevators_availability",
        {"station_area_id": "int", "nb_elevators": "int", "nb_available": "int", "pct_available": "double"},
        {
            "availability-bounded": "pct_available BETWEEN 0 AND 100",
            "available-not-exceeding-total": "nb_available <= nb_elevators",
        },
        tests=("elevators_pct_available_in_range", "elevators_available_not_exceeding_total"),
        max_age_hours=2,
    ),
    "dim_stops_contract": Contract(
        "dim_stops",
        {"stop_id": "int", "stop_name": "string", "parent_station_id": "int", "wheelchair_boarding": "int"},
        {"stop-id-present": "stop_id IS NOT NULL", "wheelchair-domain": "wheelchair_boarding IN (0, 1, 2)"},
        unique=("stop_id",),
        tests=("dim_stops_stop_id_not_null", "dim_stops_stop_id_unique", "dim_stops_wheelchair_boarding_in_set"),
        max_age_hours=24,
    ),
    "delays_by_stop_contract": Contract(
        "delays_by_stop",
        {"stop_point_ref": "string", "nb_passages": "bigint", "pct_on_time": "double", "avg_arrival_delay_sec": "double"},
        {"on-time-bounded": "pct_on_time BETWEEN 0 AND 100"},
        tests=("delays_by_stop_row_count_positive", "delays_by_stop_stop_point_ref_not_null"),
        max_age_hours=24,
    ),
    "crowding_features_contract": Contract(
        "crowding_features",
        {"id_refa_lda": "bigint"},
        {"station-key-present": "id_refa_lda IS NOT NULL"},
        tests=("crowding_features_row_count_positive", "crowding_features_id_refa_lda_not_null"),
        max_age_hours=24,
        status="Draft",
    ),
    "users_contract": Contract(
        "users",
        {"id": "int", "email": "string", "created_at": "timestamp"},
        {"email-present": "email IS NOT NULL"},
        unique=("email",),
        max_age_hours=1,
    ),
}

_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _type_fits(wanted: str, actual: str) -> bool:
    """Integer widths and both timestamp kinds are interchangeable; other types must agree."""
    if wanted in _WHOLE:
        return actual in _WHOLE
    return actual == wanted or (wanted == "timestamp" and actual == "timestamp_ntz")


def check_contract(
    name: str, contract: Contract, df: DataFrame, as_of: datetime, test_results: DataFrame | None = None
) -> DataFrame:
    """(contract, check, kind, violations, passed) per promise; one aggregation over the table.

    A missing column is reported and the run goes on; rules over missing columns fail.
    A rule counts rows where it is false, as a NULL outcome is unknown, not a breach.
    """
    types = dict(df.dtypes)
    aggs, rows = [], []

    def add(check: str, kind: str, violations: Column) -> None:
        rows.append(F.struct(F.lit(check).alias("check"), F.lit(kind).alias("kind"), violations.cast("long").alias("violations")))

    for column, wanted in contract.columns.items():
        fits = column in types and _type_fits(wanted, types[column])
        add(column, "schema", F.lit(0 if fits else 1))
    for i, (rule, text) in enumerate(contract.rules.items()):
        known = all(c in types for c in contract.columns if c in text.split())
        if known:
            aggs.append(F.count_if(~F.expr(text)).alias(f"r{i}"))
            add(rule, "rule", F.col(f"r{i}"))
        else:
            add(rule, "rule", F.lit(1))
    for i, column in enumerate(contract.unique):
        aggs.append((F.count(column) - F.countDistinct(column)).alias(f"u{i}"))
        add(f"{column}-unique", "rule", F.col(f"u{i}"))
    if contract.fresh_column and contract.max_age_hours:
        age = F.unix_timestamp(clock.moment(as_of)) - F.unix_timestamp(F.max(contract.fresh_column))
        aggs.append(F.when(age <= contract.max_age_hours * 3600, 0).otherwise(1).alias("age"))
        add("freshness", "sla", F.col("age"))
    one = df.agg(*(aggs or [F.lit(0).alias("none")]))
    out = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if test_results is not None and contract.tests:
        linked = test_results.where(F.col("test").isin(*contract.tests)).select(
            F.col("test").alias("check"), F.lit("test").alias("kind"), F.col("failed").alias("violations")
        )
        out = out.unionByName(linked)
    return out.select(
        F.lit(name).alias("contract"), "check", "kind", "violations", (F.col("violations") == 0).alias("passed")
    )


# --- profiles --------------------------------------------------------------


def profile_columns(
    table: str, df: DataFrame, fraction: float | None = None, exact: bool = False, seed: int = 7
) -> DataFrame:
    """(table, column, rows, null_pct, distinct_pct, min, max, mean) per column.

    Over all rows unless a fraction is asked for. One scan with constant state a column and
    a sketch for distinct counts (relative standard deviation 5 %); ``exact`` counts each
    column's distinct values in a narrow pass of its own, which multiplies no rows.
    """
    sampled = df.sample(fraction=fraction, seed=seed) if fraction is not None and fraction < 1 else df
    types = dict(df.dtypes)
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    plain = [c for c, t in types.items() if not t.startswith(("array", "map", "struct", "variant"))]
    aggs = [F.count("*").alias("n")]
    for i, c in enumerate(plain):
        aggs += [
            F.count(c).alias(f"k{i}"),
            F.min(c).cast("string").alias(f"lo{i}"),
            F.max(c).cast("string").alias(f"hi{i}"),
            (F.avg(c) if types[c] in numeric else F.lit(None).cast("double")).alias(f"m{i}"),
        ]
        if not exact:
            aggs.append(F.approx_count_distinct(c).alias(f"d{i}"))
    one = sampled.agg(*aggs)
    if exact:
        one = one.withColumns({f"d{i}": sampled.agg(F.countDistinct(c)).scalar() for i, c in enumerate(plain)})
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("n").alias("rows"),
            F.round(F.try_divide(100.0 * (F.col("n") - F.col(f"k{i}")), F.col("n")), 2).alias("null_pct"),
            F.round(F.try_divide(100.0 * F.col(f"d{i}"), F.col("n")), 2).alias("distinct_pct"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
            F.round(f"m{i}", 4).alias("mean"),
        )
        for i, c in enumerate(plain)
    ]
    return one.select(F.lit(table).alias("table"), F.explode(F.array(*rows)).alias("r")).select("table", "r.*")


# --- headline metrics ------------------------------------------------------

# The seven headline metrics as (table, aggregate, filter).
KPIS = {
    "network_on_time_rate": (
        "delays_by_stop",
        "round(100.0D * sum(nb_passages - nb_delayed) / nullif(sum(nb_passages), 0), 2)",
        None,
    ),
    "avg_arrival_delay_seconds": (
        "delays_by_stop",
        "round(sum(cast(round(avg_arrival_delay_sec * 10) as bigint) * nb_passages) / 10D / nullif(sum(nb_passages), 0), 1)",
        None,
    ),
    "active_disruptions": ("disruptions_active", "cast(count(*) as double)", "is_active"),
    "step_free_station_rate": (
        "station_accessibility",
        "round(100.0D * count_if(nb_available > 0) / nullif(count(*), 0), 2)",
        None,
    ),
    "elevator_availability_rate": (
        "elevators_availability",
        "round(100.0D * sum(nb_available) / nullif(sum(nb_elevators), 0), 2)",
        None,
    ),
    "avg_transfer_walking_distance_m": ("transfer_walking", "round(avg(pathway_length_m), 1)", "pathway_length_m is not null"),
}


def kpi_metrics(tables: dict[str, DataFrame]) -> DataFrame:
    """(kpi, value) of the headline metrics, each one aggregation of its gold table."""
    parts = []
    for name, (table, value, keep) in KPIS.items():
        df = tables[table].where(keep) if keep else tables[table]
        parts.append(df.agg(F.expr(value).cast("double").alias("value")).select(F.lit(name).alias("kpi"), "value"))
    daily = tables["validations_daily_by_stop"].groupBy("jour").agg(F.sum("total_validations").alias("total"))
    newest = daily.agg(F.max_by("total", "jour").cast("double").alias("value"))
    parts.append(newest.select(F.lit("daily_validation_volume").alias("kpi"), "value"))
    return reduce(DataFrame.unionByName, parts)


# --- personal data ---------------------------------------------------------

# Patterns a value must contain to count as personal data of that kind.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"(^|[^0-9])(\+[0-9]{1,3}[ .-]?)?[0-9]{2,4}([ .-][0-9]{2,4}){2,4}($|[^0-9])",
    "ip_address": r"(^|[^0-9.])[0-9]{1,3}(\.[0-9]{1,3}){3}($|[^0-9.])",
}

# What every match of a pattern contains; the others contain a digit.
PII_MARKS = {"email": "@", "ip_address": "."}

# Account columns that are personal data whatever their content.
PII_TAGS = {
    ("users", "email"): "PII.Sensitive",
    ("users", "password_hash"): "PII.Sensitive",
    ("users", "first_name"): "PII.Sensitive",
    ("users", "last_name"): "PII.Sensitive",
    ("users", "phone"): "PII.Sensitive",
    ("subscriptions", "origin_station"): "PII.NonSensitive",
    ("subscriptions", "destination_station"): "PII.NonSensitive",
}
PII_CONFIDENCE = 80


def pii_columns(table: str, df: DataFrame, fraction: float | None = None, seed: int = 7) -> DataFrame:
    """(table, column, kind, matched, pct, tag) per text column and pattern.

    ``tag`` is the explicit one if the column has it, else PII.Sensitive from the
    confidence share upward. One scan; ``fraction`` samples it.
    """
    sampled = df.sample(fraction=fraction, seed=seed) if fraction is not None and fraction < 1 else df
    texts = [c for c, t in df.dtypes if t == "string"]
    aggs, rows = [], []
    for i, c in enumerate(texts):
        aggs.append(F.count(c).alias(f"n{i}"))
        for kind, pattern in PII_PATTERNS.items():
            # A text without the letter or digit that a pattern needs isn't searched for it.
            likely = F.col(c).contains(PII_MARKS[kind]) if kind in PII_MARKS else F.col(c).rlike("[0-9]")
            aggs.append(F.count_if(F.when(likely, F.col(c).rlike(pattern)).otherwise(F.lit(False))).alias(f"{kind}{i}"))
            pct = F.round(F.try_divide(100.0 * F.col(f"{kind}{i}"), F.col(f"n{i}")), 2)
            explicit = F.lit(PII_TAGS.get((table, c))).cast("string")
            rows.append(
                F.struct(
                    F.lit(c).alias("column"),
                    F.lit(kind).alias("kind"),
                    F.col(f"{kind}{i}").alias("matched"),
                    pct.alias("pct"),
                    F.coalesce(explicit, F.when(pct >= PII_CONFIDENCE, F.lit("PII.Sensitive"))).alias("tag"),
                )
            )
    return sampled.agg(*aggs).select(F.lit(table).alias("table"), F.explode(F.array(*rows)).alias("r")).select("table", "r.*")


# Coverage goals in percent.
COVERAGE_GOALS = {"completed_description": 80, "completed_ownership": 90}


def coverage_metrics(assets: DataFrame, descriptions: DataFrame, owners: DataFrame, key: str = "asset") -> DataFrame:
    """(metric, pct, goal, met): share of assets with a non-blank description, and with an owner."""
    described = descriptions.where(F.trim("description") != "").select(key).distinct().withColumn("_d", F.lit(1))
    owned = owners.where(F.col("owner").isNotNull()).select(key).distinct().withColumn("_o", F.lit(1))
    one = (
        assets.select(key)
        .join(described, key, "left")
        .join(owned, key, "left")
        .agg(F.count("*").alias("n"), F.count("_d").alias("completed_description"), F.count("_o").alias("completed_ownership"))
    )
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.round(F.try_divide(100.0 * F.col(m), F.col("n")), 2).alias("pct"),
            F.lit(goal).alias("goal"),
        )
        for m, goal in COVERAGE_GOALS.items()
    ]
    out = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.withColumn("met", F.col("pct") >= F.col("goal"))


# --- account constraints ---------------------------------------------------

ACCOUNT_CHECKS = {
    "users": [Check("users_email_not_null", "not_null", "email"), Check("users_email_unique", "unique", "email")],
    "subscriptions": [
        Check("subscriptions_sensitivity_range", "between", "crowding_sensitivity", 0, 3),
        Check("subscriptions_max_transfers_positive", "between", "max_transfers", 0),
    ],
}


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose reference has no parent."""
    return child.where(F.col(column).isNotNull()).join(
        parent.select(F.col(key).alias(column)), column, "left_anti"
    )


def constraint_check(users: DataFrame, subscriptions: DataFrame, notifications: DataFrame) -> DataFrame:
    """(table, test, failed, passed) for the account tables: checks, references, one notice a day."""

    def count(table: str, test: str, failed: DataFrame) -> DataFrame:
        return failed.agg(F.count("*").alias("failed")).select(
            F.lit(table).alias("table"), F.lit(test).alias("test"), "failed", (F.col("failed") == 0).alias("passed")
        )

    repeated = notifications.groupBy("subscription_id", "notify_date").count().where("count > 1")
    parts = [
        run_checks("users", users, ACCOUNT_CHECKS["users"]),
        run_checks("subscriptions", subscriptions, ACCOUNT_CHECKS["subscriptions"]),
        count("subscriptions", "subscriptions_user_exists", orphan_rows(subscriptions, "user_id", users, "id")),
        count(
            "notifications",
            "notifications_subscription_exists",
            orphan_rows(notifications, "subscription_id", subscriptions, "id"),
        ),
        count("notifications", "notifications_one_per_day", repeated),
    ]
    return reduce(DataFrame.unionByName, parts)
