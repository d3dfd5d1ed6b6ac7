"""Ticket validations, day types and crowding."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import clock, text
from headway.operators.ranking import share_of_total
from headway.operators.snapshot import latest_snapshot, retained_snapshots
from headway.plans import analytics
from headway.queries import adapters as a
from headway.queries.registry import Tables, query
from headway.sources.maintenance import orphan_files


@query("validations_daily", "SELECT * FROM v_validations")
def validations_daily(t: Tables) -> DataFrame:
    return a.validations.plan(t)


@query("validations_profile", "SELECT * FROM v_profile")
def validations_profile(t: Tables) -> DataFrame:
    return a.profile.plan(t)


@query("day_type_calendar", "SELECT * FROM v_calendar")
def day_type_calendar(t: Tables) -> DataFrame:
    return a.calendar.plan(t)


@query("crowding_features", "SELECT * FROM v_crowding")
def crowding_features(t: Tables) -> DataFrame:
    return a.crowding.plan(t)


@query("validations_by_stop", "SELECT * FROM v_daily_by_stop")
def validations_by_stop(t: Tables) -> DataFrame:
    return a.daily_by_stop.plan(t)


@query("validations_by_category", "SELECT * FROM v_by_category")
def validations_by_category(t: Tables) -> DataFrame:
    return a.by_category.plan(t)


@query(
    "masked_number",
    """
SELECT jour, stif_arret, categorie_titre, nb_vald, nb_vald_masked, id_refa_lda FROM v_validations
""",
)
def masked_number(t: Tables) -> DataFrame:
    """Counts the publisher masked become NULL with a flag; '12.0' becomes 12."""
    return a.raw_validations(t).select(
        F.col("JOUR").try_cast("date").alias("jour"),
        F.col("CODE_STIF_ARRET").try_cast("int").alias("stif_arret"),
        text.name_key("CATEGORIE_TITRE").alias("categorie_titre"),
        text.masked_count("NB_VALD").alias("nb_vald"),
        (~text.is_number("NB_VALD")).alias("nb_vald_masked"),
        text.whole_number("ID_REFA_LDA").alias("id_refa_lda"),
    )


@query("hour_band", "SELECT stif_arret, cat_jour, hour_start, hour_end FROM v_profile")
def hour_band(t: Tables) -> DataFrame:
    start, end = clock.hour_band("TRNC_HORR_60")
    return a.raw_profile(t).select(
        F.col("CODE_STIF_ARRET").cast("int").alias("stif_arret"),
        text.name_key("CAT_JOUR").alias("cat_jour"),
        start.alias("hour_start"),
        end.alias("hour_end"),
    )


@query("decimal_comma", "SELECT stif_arret, cat_jour, hour_start, pct_validations FROM v_profile")
def decimal_comma(t: Tables) -> DataFrame:
    start, _ = clock.hour_band("TRNC_HORR_60")
    return a.raw_profile(t).select(
        F.col("CODE_STIF_ARRET").cast("int").alias("stif_arret"),
        text.name_key("CAT_JOUR").alias("cat_jour"),
        start.alias("hour_start"),
        text.decimal_comma("pourc_validations").alias("pct_validations"),
    )


@query(
    "join_composite",
    """
SELECT d.stif_arret, d.validations, p.cat_jour, p.hour_start, p.pct_validations
FROM (SELECT stif_trns, stif_res, stif_arret, CAST(sum(nb_vald) AS BIGINT) AS validations FROM v_validations GROUP BY ALL) d
JOIN v_profile p ON d.stif_trns = p.stif_trns AND d.stif_res = p.stif_res AND d.stif_arret = p.stif_arret
""",
)
def join_composite(t: Tables) -> DataFrame:
    """Stop totals and hourly shares, which share a three-part key."""
    stop = ["stif_trns", "stif_res", "stif_arret"]
    shares = a.profile(t).select(*stop, "cat_jour", "hour_start", "pct_validations")
    totals = a.validations(t).groupBy(*stop).agg(F.sum("nb_vald").alias("validations"))
    return totals.join(shares, stop).select("stif_arret", "validations", "cat_jour", "hour_start", "pct_validations")


@query(
    "latest_snapshot",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)",
)
def newest_orders(t: Tables) -> DataFrame:
    return latest_snapshot(t.orders, "o_orderdate").select("o_orderkey", "o_custkey", "o_orderdate")


_LAST_DAY = datetime(2001, 8, 1).date()


@query(
    "retain_snapshots",
    """
SELECT snapshot FROM (SELECT snapshot, dense_rank() OVER (ORDER BY snapshot DESC) AS r
                      FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS snapshot FROM orders))
WHERE r <= 50 OR snapshot >= DATE '2001-08-01' - 30
""",
)
def retain_snapshots(t: Tables) -> DataFrame:
    """Snapshot days retention keeps: the newest 50 and any younger than 30 days."""
    return retained_snapshots(t.orders, "o_orderdate", 30, 50, _LAST_DAY)


@query(
    "orphan_files",
    """
SELECT 'part-'||o_orderkey AS path FROM orders
WHERE o_orderdate < TIMESTAMP '2001-08-01' - INTERVAL 5 DAY AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""",
)
def orphans(t: Tables) -> DataFrame:
    """Listed files that no table refers to and that are older than the safety age."""
    listing = t.orders.select(a.cat("part-", a.txt("o_orderkey")).alias("path"), F.col("o_orderdate").alias("modified_at"))
    referenced = t.lineitem.select(a.cat("part-", a.txt("l_orderkey")).alias("path"))
    return orphan_files(listing, referenced, datetime(2001, 8, 1), 5).select("path")


@query(
    "share_of_day",
    """
SELECT v.jour, v.stif_arret, CAST(sum(v.nb_vald) AS BIGINT) AS validations,
       round(100.0::DOUBLE * sum(v.nb_vald) / nullif(max(d.total), 0), 2) AS pct_of_day
FROM v_validations v JOIN (SELECT jour, CAST(sum(nb_vald) AS BIGINT) AS total FROM v_validations GROUP BY jour) d ON v.jour = d.jour
GROUP BY v.jour, v.stif_arret
""",
)
def share_of_day(t: Tables) -> DataFrame:
    """Detail joined to its own aggregate, both reduced before the join."""
    stops = a.validations(t).groupBy("jour", "stif_arret").agg(F.sum("nb_vald").alias("validations"))
    days = stops.groupBy("jour").agg(F.sum("validations").alias("total"))
    share = F.round(F.try_divide(F.lit(100.0) * F.col("validations"), F.col("total")), 2)
    return stops.join(days, "jour").select("jour", "stif_arret", "validations", share.alias("pct_of_day"))


@query(
    "agg_multilevel",
    """
SELECT id_refa_lda, round(avg(total), 1) AS avg_daily, max(total) AS max_daily FROM (
    SELECT id_refa_lda, jour, CAST(sum(peak) AS BIGINT) AS total FROM (
        SELECT id_refa_lda, jour, stif_arret, max(nb_vald) AS peak FROM v_validations GROUP BY ALL) GROUP BY ALL)
GROUP BY id_refa_lda
""",
)
def agg_multilevel(t: Tables) -> DataFrame:
    """Stop-day maximum, station-day sum, station mean."""
    peaks = a.validations(t).groupBy("id_refa_lda", "jour", "stif_arret").agg(F.max("nb_vald").alias("peak"))
    days = peaks.groupBy("id_refa_lda", "jour").agg(F.sum("peak").alias("total"))
    return days.groupBy("id_refa_lda").agg(
        F.round(F.avg("total"), 1).alias("avg_daily"), F.max("total").alias("max_daily")
    )


@query(
    "share_of_total",
    """
SELECT categorie_titre, CAST(sum(nb_vald) AS BIGINT) AS n, round(100.0::DOUBLE * sum(nb_vald) / sum(sum(nb_vald)) OVER (), 1) AS pct
FROM v_validations GROUP BY categorie_titre
""",
)
def share(t: Tables) -> DataFrame:
    volumes = a.validations(t).groupBy("categorie_titre").agg(F.sum("nb_vald").alias("n"))
    return share_of_total(volumes, "n", "pct")


@query(
    "ticket_categories",
    """
SELECT categorie_titre AS ticket_category, CAST(sum(nb_vald) AS BIGINT) AS validations,
       round(100.0::DOUBLE * sum(nb_vald) / sum(sum(nb_vald)) OVER (), 1) AS validations_pct
FROM v_by_category WHERE contains(upper(libelle_arret), 'NATION') AND jour >= DATE '2018-01-01' AND jour <= DATE '2022-12-31'
GROUP BY categorie_titre ORDER BY validations DESC, ticket_category LIMIT 100
""",
)
def ticket_categories(t: Tables) -> DataFrame:
    return analytics.ticket_categories(a.by_category(t), "nation", "2018-01-01", "2022-12-31")


@query(
    "crowding_timeseries",
    """
SELECT strftime(jour, '%Y-%m-%d') AS date, coalesce(CAST(sum(total_validations) AS BIGINT), 0) AS total_validations,
       count(DISTINCT id_refa_lda) AS stations
FROM v_daily_by_stop WHERE jour >= DATE '2020-01-01' GROUP BY jour ORDER BY jour DESC LIMIT 500 OFFSET 10
""",
)
def crowding_timeseries(t: Tables) -> DataFrame:
    return analytics.crowding_timeseries(a.daily_by_stop(t), date_from="2020-01-01", limit=500, offset=10)


@query(
    "crowding_summary",
    """
SELECT count(DISTINCT id_refa_lda) AS stations, strftime(min(jour), '%Y-%m-%d') AS date_from, strftime(max(jour), '%Y-%m-%d') AS date_to,
       CAST(sum(total) AS BIGINT) AS total_validations, round(avg(total), 1) AS avg_daily_validations_per_station,
       CAST(max(total) AS BIGINT) AS max_daily_validations_at_one_station
FROM (SELECT jour, id_refa_lda, CAST(sum(total) AS BIGINT) AS total FROM (
          SELECT jour, id_refa_lda, stif_trns, stif_res, stif_arret, max(daily_total_validations) AS total
          FROM v_crowding WHERE id_refa_lda IS NOT NULL GROUP BY ALL) GROUP BY jour, id_refa_lda)
""",
)
def crowding_summary(t: Tables) -> DataFrame:
    return analytics.crowding_summary(a.crowding(t))


@query(
    "crowding_stations",
    """
WITH f AS (SELECT * FROM v_crowding WHERE id_refa_lda IS NOT NULL),
sd AS (SELECT jour, id_refa_lda, stif_trns, stif_res, stif_arret, max(libelle_arret) AS n, max(daily_total_validations) AS v,
              max(geo_point) AS g FROM f GROUP BY ALL),
d AS (SELECT jour, id_refa_lda, max(n) AS n, CAST(sum(v) AS BIGINT) AS v, max(g) AS g FROM sd GROUP BY jour, id_refa_lda),
ds AS (SELECT id_refa_lda, max(n) AS n, round(avg(v), 1) AS av, max(g) AS g FROM d GROUP BY id_refa_lda),
h AS (SELECT jour, id_refa_lda, hour_start, sum(estimated_validations) AS e FROM f GROUP BY ALL),
hs AS (SELECT h.id_refa_lda, round(avg(e), 1) AS ae, round(max(e), 1) AS pe, round(max(100.0::DOUBLE * e / nullif(v, 0)), 1) AS pp
       FROM h JOIN d ON h.jour = d.jour AND h.id_refa_lda = d.id_refa_lda GROUP BY h.id_refa_lda),
m AS (SELECT id_refa_lda, array_to_string(list_sort(list(DISTINCT stif_trns)), ',') AS modes FROM f GROUP BY id_refa_lda)
SELECT ds.id_refa_lda AS station_id, ds.n AS station_name, ds.av AS avg_daily_validations, hs.ae AS avg_estimated_validations,
       hs.pe AS peak_estimated_validations, hs.pp AS peak_hour_validations_pct,
       CAST(regexp_extract(ds.g, '\\((\\S+)', 1) AS DOUBLE) AS longitude, CAST(regexp_extract(ds.g, ' ([^ )]+)\\)', 1) AS DOUBLE) AS latitude,
       m.modes AS transport_modes
FROM ds JOIN hs ON ds.id_refa_lda = hs.id_refa_lda LEFT JOIN m ON ds.id_refa_lda = m.id_refa_lda
ORDER BY hs.ae DESC, ds.n, ds.id_refa_lda LIMIT 100
""",
)
def crowding_stations(t: Tables) -> DataFrame:
    rows = analytics.crowding_stations(a.crowding(t))
    return rows.withColumn("transport_modes", F.array_join(F.col("transport_modes").cast("array<string>"), ","))


@query(
    "day_category",
    """
SELECT o.date, coalesce(c.cat_jour, CASE WHEN isodow(o.date) >= 6 THEN 'SAHV' ELSE 'JOHV' END) AS cat_jour
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) + 8218 + 60 AS date FROM orders) o LEFT JOIN v_calendar c ON o.date = c.date
""",
)
def day_category(t: Tables) -> DataFrame:
    """Day type per date, by weekday where the calendar ends."""
    dates = t.orders.select(F.date_add(a.order_day(), 60).alias("date")).distinct()
    return analytics.day_category(dates, a.calendar(t))
