"""Accounts, personal data, quality suites and headline metrics."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.plans import analytics, privacy, quality, sketches
from headway.queries import adapters as a
from headway.queries.registry import ORACLE, Tables, query, shared, stored, view


@shared
def users(t: Tables) -> DataFrame:
    """Customers as accounts; a few e-mails are missing or shared."""
    k = F.col("c_custkey")
    email = F.when(k % 333 == 1, F.lit(None).cast("string")).when(k % 400 == 7, "shared@example.org")
    return t.customer.select(
        k.alias("id"),
        F.when(k % 333 != 1, F.coalesce(email, a.cat("user", a.txt(k), "@example.org"))).alias("email"),
        F.md5("c_name").alias("password_hash"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        a.cat("+33 6 ", a.two(k % 90), " ", a.two(k % 70), " ", a.two(k % 50), " 11").alias("phone"),
        F.date_add(F.lit(date(2021, 1, 1)), (k % 900).cast("int")).cast("timestamp").alias("created_at"),
    )


def _lpad2(text: str) -> str:
    return f"lpad(CAST({text} AS VARCHAR), 2, '0')"


view(
    "v_users",
    f"""
SELECT c_custkey AS id, CASE WHEN c_custkey % 333 = 1 THEN NULL WHEN c_custkey % 400 = 7 THEN 'shared@example.org'
                             ELSE 'user'||c_custkey||'@example.org' END AS email,
       md5(c_name) AS password_hash, c_mktsegment AS first_name, c_name AS last_name,
       '+33 6 '||{_lpad2('c_custkey % 90')}||' '||{_lpad2('c_custkey % 70')}||' '||{_lpad2('c_custkey % 50')}||' 11' AS phone,
       TIMESTAMP '2021-01-01' + to_days(CAST(c_custkey % 900 AS INTEGER)) AS created_at
FROM customer
""",
)


@shared
def subscriptions(t: Tables) -> DataFrame:
    """Orders as journey subscriptions at rush hours."""
    k = F.col("o_orderkey")
    hour = F.get(F.array(*[F.lit(h) for h in (7, 8, 17, 18)]), (k % 4).cast("int"))
    return t.orders.select(
        k.alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.when(k % 11 == 0, "Stop 7").otherwise(a.cat(" nation_", a.txt(F.col("o_custkey") % 25))).alias("origin_station"),
        a.cat("NATION_", a.txt(k % 23)).alias("destination_station"),
        (hour * 3600 + F.floor(k / 4) % 4 * 900).cast("int").alias("notify_time"),
        (k % 3 == 0).alias("accessible_required"),
        (F.floor(k / 3) % 4).cast("int").alias("crowding_sensitivity"),
        (F.floor(k / 2) % 2 == 0).alias("minimize_walking"),
        (k % 5 % 3).cast("int").alias("max_transfers"),
        (k % 10 != 9).alias("active"),
        F.col("o_orderdate").alias("created_at"),
    )


view(
    "v_subs",
    """
SELECT o_orderkey AS id, o_custkey AS user_id, CASE WHEN o_orderkey % 11 = 0 THEN 'Stop 7' ELSE ' nation_'||(o_custkey % 25) END AS origin_station,
       'NATION_'||(o_orderkey % 23) AS destination_station,
       CAST(CASE o_orderkey % 4 WHEN 0 THEN 7 WHEN 1 THEN 8 WHEN 2 THEN 17 ELSE 18 END * 3600 + o_orderkey // 4 % 4 * 900 AS INTEGER) AS notify_time,
       o_orderkey % 3 = 0 AS accessible_required, CAST(o_orderkey // 3 % 4 AS INTEGER) AS crowding_sensitivity,
       o_orderkey // 2 % 2 = 0 AS minimize_walking, CAST(o_orderkey % 5 % 3 AS INTEGER) AS max_transfers,
       o_orderkey % 10 <> 9 AS active, o_orderdate AS created_at
FROM orders
""",
)


@shared
def notifications(t: Tables) -> DataFrame:
    """Order lines as sent notifications."""
    rows = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_shipdate").alias("at"), F.min("l_linestatus").alias("s")
    )
    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("subscription_id"),
        F.date_add("at", a.DAY_SHIFT).alias("notify_date"),
        F.when(F.col("s") == "O", "sent").otherwise("no_route").alias("status"),
        F.col("at").alias("created_at"),
    )


view(
    "v_notes",
    f"""
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS subscription_id, CAST(min(l_shipdate) AS DATE) + {a.DAY_SHIFT} AS notify_date,
       CASE WHEN min(l_linestatus) = 'O' THEN 'sent' ELSE 'no_route' END AS status, min(l_shipdate) AS created_at
FROM lineitem GROUP BY l_orderkey, l_linenumber
""",
)

# --- history, export, rectification, erasure -------------------------------


@query(
    "person_history",
    "SELECT n.*, s.user_id FROM v_notes n JOIN v_subs s ON n.subscription_id = s.id",
)
def person_history(t: Tables) -> DataFrame:
    """Notification history with its owner, for all persons."""
    return analytics.notification_history(notifications(t), subscriptions(t))


_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"


@query(
    "person_export",
    f"""
SELECT id AS user_id, NULL AS subscription_id, NULL AS notification_id, 'account' AS record,
       CAST(to_json({{'id': id, 'email': email, 'first_name': first_name, 'last_name': last_name, 'phone': phone,
                'created_at': {_ISO.format('created_at')}}}) AS VARCHAR) AS content FROM v_users
UNION ALL
SELECT user_id, id, NULL, 'subscription', CAST(to_json({{'id': id, 'user_id': user_id, 'origin_station': origin_station,
       'destination_station': destination_station, 'notify_time': notify_time, 'accessible_required': accessible_required,
       'crowding_sensitivity': crowding_sensitivity, 'minimize_walking': minimize_walking, 'max_transfers': max_transfers,
       'active': active, 'created_at': {_ISO.format('created_at')}}}) AS VARCHAR) FROM v_subs
UNION ALL
SELECT s.user_id, n.subscription_id, n.id, 'notification', CAST(to_json({{'id': n.id, 'subscription_id': n.subscription_id,
       'notify_date': strftime(n.notify_date, '%Y-%m-%d'), 'status': n.status,
       'created_at': {_ISO.format('n.created_at')}}}) AS VARCHAR)
FROM v_notes n JOIN v_subs s ON n.subscription_id = s.id
""",
)
def person_export(t: Tables) -> DataFrame:
    return privacy.person_export(users(t), subscriptions(t), notifications(t))


@query(
    "person_documents",
    f"""
WITH r AS ({ORACLE["person_export"]}),
n AS (SELECT *, lag(record) OVER w AS before, lead(record) OVER w AS after FROM r
      WINDOW w AS (PARTITION BY user_id ORDER BY subscription_id NULLS FIRST, notification_id NULLS FIRST))
SELECT user_id, subscription_id, notification_id,
       CASE WHEN before IS NULL THEN CASE record WHEN 'account' THEN '{{"account":' ELSE '{{"account":null,"subscriptions":[' END
            WHEN record = 'subscription' AND before <> 'account' THEN ']}},' WHEN record = 'notification' AND before = 'notification' THEN ',' ELSE '' END
       || CASE record WHEN 'account' THEN content || ',"subscriptions":[' WHEN 'subscription' THEN left(content, length(content) - 1) || ',"notifications":['
                      ELSE content END
       || CASE WHEN after IS NOT NULL THEN '' WHEN record = 'account' THEN ']}}' ELSE ']}}]}}' END AS piece,
       before IS NULL AS first FROM n
""",
)
def person_documents(t: Tables) -> DataFrame:
    """Every person's nested document in pieces, in whose order it is written."""
    return privacy.person_documents(privacy.person_export(users(t), subscriptions(t), notifications(t)))


@shared
def updates(t: Tables) -> DataFrame:
    """One requested change per supplier: new mails, some taken, repeated, blank or of unknown persons."""
    k = F.col("s_suppkey")
    mail = (
        F.when(k % 7 == 0, a.cat(" User", a.txt(k + 1), "@Example.org "))
        .when(k % 7 == 1, F.lit("New@example.org"))
        .when(k % 7 == 2, F.lit("  "))
        .when(k % 7 != 3, a.cat("fresh", a.txt(k), "@example.org"))
    )
    return t.supplier.select(
        (k * 20).alias("id"), mail.alias("email"), F.when(k % 7 != 3, a.cat(" Name", a.txt(k))).alias("last_name")
    )


view(
    "v_outcomes",
    """
SELECT u.id, u.email, u.last_name, CASE WHEN x.id IS NULL THEN 'unknown person'
            WHEN u.email IS NULL AND u.last_name IS NULL THEN 'nothing to change' WHEN u.email = '' THEN 'blank value'
            WHEN h.holder <> u.id OR f.first < u.id THEN 'email already used' END AS refused
FROM (SELECT s_suppkey * 20 AS id, CASE s_suppkey % 7 WHEN 0 THEN 'user'||(s_suppkey + 1)||'@example.org' WHEN 1 THEN 'new@example.org'
             WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'fresh'||s_suppkey||'@example.org' END AS email,
             CASE WHEN s_suppkey % 7 <> 3 THEN 'Name'||s_suppkey END AS last_name FROM supplier) u
LEFT JOIN v_users x ON u.id = x.id
LEFT JOIN (SELECT email, min(id) AS holder FROM v_users GROUP BY email) h ON u.email = h.email
LEFT JOIN (SELECT CASE s_suppkey % 7 WHEN 0 THEN 'user'||(s_suppkey + 1)||'@example.org' WHEN 1 THEN 'new@example.org'
                  WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'fresh'||s_suppkey||'@example.org' END AS email, min(s_suppkey * 20) AS first
           FROM supplier GROUP BY 1) f ON u.email = f.email
""",
)


@query("rectification_outcomes", "SELECT * FROM v_outcomes")
def rectification_outcomes(t: Tables) -> DataFrame:
    return privacy.rectification_outcomes(users(t), updates(t))


@query(
    "person_rectify",
    """
SELECT u.id, coalesce(o.email, u.email) AS email, coalesce(o.last_name, u.last_name) AS last_name, u.first_name, u.phone
FROM v_users u LEFT JOIN v_outcomes o ON u.id = o.id AND o.refused IS NULL
""",
)
def person_rectify(t: Tables) -> DataFrame:
    changed = privacy.person_rectify(users(t), updates(t))
    return changed.select("id", "email", "last_name", "first_name", "phone")


@query(
    "person_erase",
    """
SELECT g.id AS user_id, 1 AS accounts, count(DISTINCT s.id) AS subscriptions, count(n.id) AS notifications
FROM (SELECT c_custkey AS id FROM customer WHERE c_acctbal < 0) g LEFT JOIN v_subs s ON s.user_id = g.id
LEFT JOIN v_notes n ON n.subscription_id = s.id GROUP BY g.id
""",
)
def person_erase(t: Tables) -> DataFrame:
    """What erasing all accounts in debt would remove, per person."""
    gone = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    return privacy.person_erase(users(t), subscriptions(t), notifications(t), gone)[3]


@query(
    "person_erase_rest",
    """
SELECT 'users' AS table_name, count(*) AS left_rows FROM v_users u WHERE u.id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
UNION ALL
SELECT 'subscriptions', count(*) FROM v_subs s WHERE s.user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
UNION ALL
SELECT 'notifications', count(*) FROM v_notes n LEFT JOIN v_subs s ON n.subscription_id = s.id
WHERE s.user_id IS NULL OR s.user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""",
)
def person_erase_rest(t: Tables) -> DataFrame:
    gone = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    kept = privacy.person_erase(users(t), subscriptions(t), notifications(t), gone)[:3]
    parts = [
        df.agg(F.count("*").alias("left_rows")).select(F.lit(name).alias("table_name"), "left_rows")
        for name, df in zip(("users", "subscriptions", "notifications"), kept)
    ]
    return parts[0].union(parts[1]).union(parts[2])


# --- quality ---------------------------------------------------------------


def _suite_tables(t: Tables) -> dict[str, DataFrame]:
    return {
        "stop_areas": a.stop_areas(t),
        "elevators_availability": a.availability(t),
        "dim_stops": a.dim_stops(t),
        "transfer_walking": a.walking(t),
        "station_accessibility": a.station_access(t),
        "crowding_features": a.crowding(t),
        "delays_by_stop": a.delays_by_stop(t),
        "validations_daily": a.validations(t),
    }


def _sql_row(table: str, test: str, failed: str, source: str, allowed: int = 0) -> str:
    return f"SELECT '{table}' AS \"table\", '{test}' AS test, CAST(({failed}) AS BIGINT) AS failed, ({failed}) <= {allowed} AS passed FROM {source}"


_EMPTY = "CASE WHEN count(*) < 1 THEN 1 ELSE 0 END"


view(
    "v_suite",
    "\nUNION ALL\n".join(
        [
            _sql_row("stop_areas", "stop_areas_station_id_not_null", "count(*) FILTER (WHERE station_id IS NULL)", "v_stop_areas"),
            _sql_row("stop_areas", "stop_areas_station_id_unique", "count(station_id) - count(DISTINCT station_id)", "v_stop_areas"),
            _sql_row("stop_areas", "stop_areas_lat_in_idf", "count(*) FILTER (WHERE station_lat < 47.5 OR station_lat > 49.5)", "v_stop_areas"),
            _sql_row("stop_areas", "stop_areas_lon_in_idf", "count(*) FILTER (WHERE station_lon < 1.0 OR station_lon > 3.8)", "v_stop_areas"),
            _sql_row("stop_areas", "stop_areas_row_count_positive", _EMPTY, "v_stop_areas"),
            _sql_row("elevators_availability", "elevators_pct_available_in_range", "count(*) FILTER (WHERE pct_available < 0 OR pct_available > 100)", "v_availability"),
            _sql_row("elevators_availability", "elevators_available_not_exceeding_total", "count(*) FILTER (WHERE nb_available > nb_elevators)", "v_availability"),
            _sql_row("dim_stops", "dim_stops_stop_id_not_null", "count(*) FILTER (WHERE stop_id IS NULL)", "v_dim_stops"),
            _sql_row("dim_stops", "dim_stops_stop_id_unique", "count(stop_id) - count(DISTINCT stop_id)", "v_dim_stops"),
            _sql_row("dim_stops", "dim_stops_wheelchair_boarding_in_set", "count(*) FILTER (WHERE wheelchair_boarding NOT IN (0, 1, 2))", "v_dim_stops"),
            _sql_row("transfer_walking", "transfer_walking_from_not_null", "count(*) FILTER (WHERE from_stop_id IS NULL)", "v_walking"),
            _sql_row("transfer_walking", "transfer_walking_to_not_null", "count(*) FILTER (WHERE to_stop_id IS NULL)", "v_walking"),
            _sql_row("station_accessibility", "station_accessibility_level_not_null", "count(*) FILTER (WHERE accessibility_level_id IS NULL)", "v_station_access"),
            _sql_row("station_accessibility", "station_accessibility_pct_in_range", "count(*) FILTER (WHERE pct_elevators_available < 0 OR pct_elevators_available > 100)", "v_station_access"),
            _sql_row("crowding_features", "crowding_features_row_count_positive", _EMPTY, "v_crowding"),
            _sql_row("crowding_features", "crowding_features_id_refa_lda_not_null", "count(*) FILTER (WHERE id_refa_lda IS NULL)", "v_crowding"),
            _sql_row("delays_by_stop", "delays_by_stop_row_count_positive", _EMPTY, "v_delays_by_stop"),
            _sql_row("delays_by_stop", "delays_by_stop_stop_point_ref_not_null", "count(*) FILTER (WHERE stop_point_ref IS NULL)", "v_delays_by_stop"),
            _sql_row("validations_daily", "validations_daily_row_count_positive", _EMPTY, "v_validations"),
            _sql_row("validations_daily", "validations_daily_jour_not_null", "count(*) FILTER (WHERE jour IS NULL)", "v_validations"),
        ]
    ),
)


@shared
def suite(t: Tables) -> DataFrame:
    return quality.run_suite(_suite_tables(t), quality.CURATED)


@query("quality_suite", "SELECT * FROM v_suite")
def quality_suite(t: Tables) -> DataFrame:
    return suite(t)


_BASE = {
    "customer": "c_custkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "events": "event_id",
    "documents": "doc_id",
    "part": "p_partkey",
}


@query(
    "quality_baseline",
    "\nUNION ALL\n".join(
        row
        for name, key in _BASE.items()
        for row in (
            _sql_row(name, f"{name}_row_count_positive", _EMPTY, name),
            _sql_row(name, f"{name}_{key}_not_null", f"count(*) FILTER (WHERE {key} IS NULL)", name),
        )
    ),
)
def quality_baseline(t: Tables) -> DataFrame:
    """Checks made from the schema alone, for tables without a curated list."""
    return quality.run_suite({name: getattr(t, name) for name in _BASE}, {})


def _promise(check: str, kind: str, violations: str) -> str:
    return f"SELECT '{check}' AS \"check\", '{kind}' AS kind, CAST(({violations}) AS BIGINT) AS violations"


@query(
    "contract_check",
    "SELECT 'station_accessibility_contract' AS contract, \"check\", kind, violations, violations = 0 AS passed FROM (\n"
    + "\nUNION ALL\n".join(
        [
            _promise("accessibility_level_id", "schema", "0"),
            _promise("pct_elevators_available", "schema", "0"),
            _promise("nb_elevators", "schema", "0"),
            _promise("stop_point_latitude", "schema", "1"),
            _promise("stop_point_longitude", "schema", "1"),
            _promise("accessibility-level-present", "rule", "SELECT count(*) FROM v_station_access WHERE accessibility_level_id IS NULL"),
            _promise(
                "elevator-availability-bounded",
                "rule",
                "SELECT count(*) FROM v_station_access WHERE NOT (pct_elevators_available BETWEEN 0 AND 100)",
            ),
            "SELECT test, 'test', failed FROM v_suite WHERE \"table\" = 'station_accessibility'",
        ]
    )
    + """
)
UNION ALL
SELECT 'dim_stops_contract', "check", kind, violations, violations = 0 FROM (
"""
    + "\nUNION ALL\n".join(
        [
            *[_promise(c, "schema", "0") for c in ("stop_id", "stop_name", "parent_station_id", "wheelchair_boarding")],
            _promise("stop-id-present", "rule", "SELECT count(*) FROM v_dim_stops WHERE stop_id IS NULL"),
            _promise("wheelchair-domain", "rule", "SELECT count(*) FROM v_dim_stops WHERE wheelchair_boarding NOT IN (0, 1, 2)"),
            _promise("stop_id-unique", "rule", "SELECT count(stop_id) - count(DISTINCT stop_id) FROM v_dim_stops"),
            "SELECT test, 'test', failed FROM v_suite WHERE \"table\" = 'dim_stops'",
        ]
    )
    + """
)
UNION ALL
SELECT 'users_contract', "check", kind, violations, violations = 0 FROM (
"""
    + "\nUNION ALL\n".join(
        [
            *[_promise(c, "schema", "0") for c in ("id", "email", "created_at")],
            _promise("email-present", "rule", "SELECT count(*) FROM v_users WHERE email IS NULL"),
            _promise("email-unique", "rule", "SELECT count(email) - count(DISTINCT email) FROM v_users"),
            _promise(
                "freshness",
                "sla",
                f"SELECT CASE WHEN epoch({a.AS_OF_SQL}) - epoch(max(created_at)) <= 3600 THEN 0 ELSE 1 END FROM v_users",
            ),
        ]
    )
    + "\n)",
)
def contract_check(t: Tables) -> DataFrame:
    """Three contracts; the first names columns its table lacks, and the run goes on."""
    results = suite(t)
    tables = {"station_accessibility": a.station_access(t), "dim_stops": a.dim_stops(t), "users": users(t)}
    fresh = {"users_contract": replace(quality.CONTRACTS["users_contract"], fresh_column="created_at")}
    parts = []
    for name in ("station_accessibility_contract", "dim_stops_contract", "users_contract"):
        contract = fresh.get(name, quality.CONTRACTS[name])
        parts.append(quality.check_contract(name, contract, tables[contract.table], a.AS_OF, results))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _profile_row(table: str, column: str, mean: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", count(*) AS rows, "
        f"round(100.0::DOUBLE * (count(*) - count({column})) / count(*), 2) AS null_pct, "
        f"round(100.0::DOUBLE * count(DISTINCT {column}) / count(*), 2) AS distinct_pct, "
        f"CAST(min({column}) AS VARCHAR) AS min, CAST(max({column}) AS VARCHAR) AS max, {mean} AS mean FROM {table}"
    )


@query(
    "profile_columns",
    "\nUNION ALL\n".join(
        _profile_row("v_users", c, m).replace("'v_users' AS", "'users' AS")
        for c, m in [
            ("id", "round(avg(id), 4)"),
            ("email", "CAST(NULL AS DOUBLE)"),
            ("password_hash", "CAST(NULL AS DOUBLE)"),
            ("first_name", "CAST(NULL AS DOUBLE)"),
            ("last_name", "CAST(NULL AS DOUBLE)"),
            ("phone", "CAST(NULL AS DOUBLE)"),
        ]
    ),
)
def profile_columns(t: Tables) -> DataFrame:
    """Exact profile over all rows."""
    return quality.profile_columns("users", users(t).drop("created_at"), fraction=None, exact=True)


_LINE_COLUMNS = {
    **dict.fromkeys(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"], True),
    **dict.fromkeys(["l_returnflag", "l_linestatus", "l_shipdate"], False),
}


@query(
    "profile_sketch",
    "\nUNION ALL\n".join(
        _profile_row("lineitem", c, f"round(avg({c}), 4)" if numeric else "CAST(NULL AS DOUBLE)") for c, numeric in _LINE_COLUMNS.items()
    ),
)
def profile_sketch(t: Tables) -> DataFrame:
    """All order lines, distinct values counted exactly in place of the sketch."""
    return quality.profile_columns("lineitem", t.lineitem.select(*_LINE_COLUMNS), exact=True)


@stored
def line_sketches(t: Tables) -> DataFrame:
    """Sketches of the order lines for every ship day, as each day's load leaves them."""
    return sketches.day_sketches(t.lineitem.select(*_LINE_COLUMNS), "l_shipdate")


_SKETCHED = {c: numeric for c, numeric in _LINE_COLUMNS.items() if c != "l_shipdate"}


@query(
    "profile_incremental",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 2) AS null_pct, "
        f"{f'CAST(min({c}) AS DOUBLE)' if numeric else 'NULL'} AS low, {f'CAST(max({c}) AS DOUBLE)' if numeric else 'NULL'} AS high, "
        f"{f'round(avg({c}), 4)' if numeric else 'CAST(NULL AS DOUBLE)'} AS mean, true AS distinct_within FROM lineitem"
        for c, numeric in _SKETCHED.items()
    ),
)
def profile_incremental(t: Tables) -> DataFrame:
    """The profile merged from all days' sketches, and whether the distinct counts keep to three standard deviations."""
    found = sketches.profile(line_sketches(t))
    exact = [F.struct(F.lit(c).alias("column"), F.count_distinct(c).alias("n")) for c in _SKETCHED]
    true = t.lineitem.agg(F.array(*exact).alias("x")).select(F.inline("x"))
    off = F.abs(F.col("n_distinct") - F.col("n")) <= F.greatest(F.lit(1.0), 3 * sketches.DISTINCT_DEVIATION * F.col("n"))
    number = F.when(F.col("mean").isNotNull(), F.lit(True))
    return found.join(true, "column").select(
        "column", "rows", "null_pct", F.when(number, F.col("min").cast("double")).alias("low"), F.when(number, F.col("max").cast("double")).alias("high"), "mean", off.alias("distinct_within")
    )


_FRACTIONS = [0.01, 0.25, 0.5, 0.8, 0.99]


@query(
    "quantile_sketch",
    f"""
SELECT "column", fraction, (SELECT count(*) FROM lineitem) AS rows, true AS within
FROM (SELECT unnest([{", ".join(f"'{c}'" for c, numeric in _SKETCHED.items() if numeric)}]) AS "column"), (SELECT unnest({_FRACTIONS}::DOUBLE[]) AS fraction)
""",
)
def quantile_sketch(t: Tables) -> DataFrame:
    """Quantiles merged from all days' sketches, and whether their true ranks keep to the stated error."""
    found = [tuple(r) for r in sketches.quantiles(line_sketches(t), _FRACTIONS).collect()]  # a few a column
    misses = sketches.rank_misses(t.lineitem, found)
    return misses.select("column", "fraction", "rows", (F.col("miss") <= sketches.RANK_ERROR).alias("within"))


@query(
    "kpi_metrics",
    """
SELECT 'network_on_time_rate' AS kpi, CAST(round(100.0::DOUBLE * sum(nb_passages - nb_delayed) / sum(nb_passages), 2) AS DOUBLE) AS value FROM v_delays_by_stop
UNION ALL
SELECT 'avg_arrival_delay_seconds', round(sum(CAST(round(avg_arrival_delay_sec * 10) AS BIGINT) * nb_passages) / 10.0::DOUBLE / sum(nb_passages), 1) FROM v_delays_by_stop
UNION ALL
SELECT 'active_disruptions', CAST(count(*) AS DOUBLE) FROM v_active WHERE is_active
UNION ALL
SELECT 'step_free_station_rate', round(100.0::DOUBLE * count(*) FILTER (WHERE nb_available > 0) / count(*), 2) FROM v_station_access
UNION ALL
SELECT 'elevator_availability_rate', round(100.0::DOUBLE * sum(nb_available) / sum(nb_elevators), 2) FROM v_availability
UNION ALL
SELECT 'avg_transfer_walking_distance_m', round(avg(pathway_length_m), 1) FROM v_walking WHERE pathway_length_m IS NOT NULL
UNION ALL
SELECT 'daily_validation_volume', CAST(sum(total_validations) AS DOUBLE) FROM v_daily_by_stop WHERE jour = (SELECT max(jour) FROM v_daily_by_stop)
""",
)
def kpi_metrics(t: Tables) -> DataFrame:
    return quality.kpi_metrics(
        {
            "delays_by_stop": a.delays_by_stop(t),
            "disruptions_active": a.active(t),
            "station_accessibility": a.station_access(t),
            "elevators_availability": a.availability(t),
            "transfer_walking": a.walking(t),
            "validations_daily_by_stop": a.daily_by_stop(t),
        }
    )


def _pii_rows(table: str, source: str, columns: list[str], tags: dict[str, str]) -> str:
    rows = []
    for c in columns:
        for kind, pattern in quality.PII_PATTERNS.items():
            tag = f"'{tags[c]}'" if c in tags else "CASE WHEN p >= 80 THEN 'PII.Sensitive' END"
            hit = f"count(*) FILTER (WHERE regexp_matches({c}, '{pattern}'))"
            rows.append(
                f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", '{kind}' AS kind, m AS matched, p AS pct, {tag} AS tag "
                f"FROM (SELECT {hit} AS m, round(100.0::DOUBLE * {hit} / nullif(count({c}), 0), 2) AS p FROM {source})"
            )
    return "\nUNION ALL\n".join(rows)


@query(
    "pii_columns",
    _pii_rows(
        "users",
        "v_users",
        ["email", "password_hash", "first_name", "last_name", "phone"],
        {c: "PII.Sensitive" for c in ("email", "password_hash", "first_name", "last_name", "phone")},
    )
    + "\nUNION ALL\n"
    + _pii_rows("documents", "documents", ["text", "lang", "source"], {})
    + "\nUNION ALL\n"
    + _pii_rows("conversations", "conversations", ["role", "text"], {}),
)
def pii_columns(t: Tables) -> DataFrame:
    parts = [
        quality.pii_columns(name, df)
        for name, df in (("users", users(t)), ("documents", t.documents), ("conversations", t.conversations))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "coverage_metrics",
    """
SELECT metric, pct, CAST(goal AS INTEGER) AS goal, pct >= goal AS met FROM (
    SELECT 'completed_description' AS metric, 80 AS goal,
           round(100.0::DOUBLE * count(*) FILTER (WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE trim(l_returnflag) <> '')) / count(*), 2) AS pct
    FROM part
    UNION ALL
    SELECT 'completed_ownership', 90,
           round(100.0::DOUBLE * count(*) FILTER (WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 25)) / count(*), 2)
    FROM part)
""",
)
def coverage_metrics(t: Tables) -> DataFrame:
    """Parts as assets; order lines describe them, large ones also own them."""
    assets = t.part.select(F.col("p_partkey").alias("asset"))
    described = t.lineitem.select(F.col("l_partkey").alias("asset"), F.col("l_returnflag").alias("description"))
    owned = t.lineitem.select(
        F.col("l_partkey").alias("asset"), F.when(F.col("l_quantity") >= 25, F.col("l_suppkey")).alias("owner")
    )
    return quality.coverage_metrics(assets, described, owned)


@query(
    "constraint_check",
    "\nUNION ALL\n".join(
        [
            _sql_row("users", "users_email_not_null", "count(*) FILTER (WHERE email IS NULL)", "v_users"),
            _sql_row("users", "users_email_unique", "count(email) - count(DISTINCT email)", "v_users"),
            _sql_row("subscriptions", "subscriptions_sensitivity_range", "count(*) FILTER (WHERE crowding_sensitivity < 0 OR crowding_sensitivity > 3)", "v_subs"),
            _sql_row("subscriptions", "subscriptions_max_transfers_positive", "count(*) FILTER (WHERE max_transfers < 0)", "v_subs"),
            _sql_row("subscriptions", "subscriptions_user_exists", "count(*) FILTER (WHERE user_id NOT IN (SELECT id FROM v_users))", "v_subs"),
            _sql_row("notifications", "notifications_subscription_exists", "count(*) FILTER (WHERE subscription_id NOT IN (SELECT id FROM v_subs))", "v_notes"),
            _sql_row(
                "notifications",
                "notifications_one_per_day",
                "count(*)",
                "(SELECT subscription_id FROM v_notes GROUP BY subscription_id, notify_date HAVING count(*) > 1)",
            ),
        ]
    ),
)
def constraint_check(t: Tables) -> DataFrame:
    return quality.constraint_check(users(t), subscriptions(t), notifications(t))

