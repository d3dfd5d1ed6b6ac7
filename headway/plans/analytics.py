"""Read-only queries over gold tables.

Absent parameters add no predicate. Every page is ordered by a total order (unique
columns break ties), so consecutive pages neither overlap nor miss rows. ``orderBy`` +
``limit`` plans as a distributed top-k, not as a full sort.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import clock, geo, text
from headway.functions.measures import count_where, percent
from headway.operators.ranking import page, share_of_total
from headway.plans import params


def _all(*conditions: Column | None) -> Column:
    return reduce(lambda a, b: a & b, [c for c in conditions if c is not None], F.lit(True))


def _search(term: str | None, *cols: str) -> Column | None:
    term = params.term(term)
    return text.contains_term(term, *cols) if term else None


def _days(column: str, date_from, date_to) -> Column | None:
    first, last = params.day_range(date_from, date_to)
    return _all(
        F.col(column) >= F.lit(first) if first else None,
        F.col(column) <= F.lit(last) if last else None,
    )


# --- stations and accessibility --------------------------------------------


def resolve_station(stops: DataFrame, name: str) -> DataFrame:
    """Stops whose own or station name starts with the text, ignoring case and outer blanks."""
    prefix = F.upper(F.trim(F.lit(name)))
    hit = text.name_key("stop_name").startswith(prefix) | text.name_key("parent_station_name").startswith(prefix)
    return stops.where(F.col("stop_id").isNotNull() & hit).select("stop_id", "parent_station_name").distinct()


def _accessible() -> Column:
    return F.max(F.when(F.col("wheelchair_boarding") == 1, 1).otherwise(0))


def accessibility_summary(stations: DataFrame) -> DataFrame:
    """Network indicators: stop rows reduced to stations, stations to one row."""
    per_station = (
        stations.where(F.col("parent_station_id").isNotNull())
        .groupBy("parent_station_id")
        .agg(
            _accessible().alias("accessible"),
            F.max(F.coalesce("nb_elevators", F.lit(0))).alias("lifts"),
            F.max(F.coalesce("nb_available", F.lit(0))).alias("working"),
            F.max("pct_elevators_available").alias("availability"),
            F.max("pct_uptime_30d").alias("uptime"),
        )
    )
    total, accessible = F.count("*"), F.coalesce(F.sum("accessible"), F.lit(0))
    return per_station.agg(
        total.alias("total_stations"),
        accessible.alias("accessible_stations"),
        (total - accessible).alias("non_accessible_or_unknown_stations"),
        F.coalesce(percent(F.sum("accessible"), total), F.lit(0.0)).alias("accessible_rate"),
        count_where(F.col("lifts") > 0).alias("stations_with_elevators"),
        count_where((F.col("lifts") > 0) & (F.col("working") == 0)).alias("stations_without_available_elevator"),
        F.round(F.avg("availability"), 1).alias("avg_elevator_availability"),
        F.round(F.avg("uptime"), 1).alias("avg_elevator_uptime_30d"),
    )


def accessibility_stations(
    stations: DataFrame, search=None, accessible=None, station_id=None, limit=params.DEFAULT_LIMIT, offset=0
) -> DataFrame:
    limit, offset = params.page_bounds(limit, offset)
    station_id, accessible = params.whole("station_id", station_id), params.flag("accessible", accessible)
    known = _all(
        F.col("parent_station_id").isNotNull(),
        F.col("parent_station_id") == station_id if station_id is not None else None,
        _search(search, "parent_station_name"),
    )
    grouped = (
        stations.where(known)
        .groupBy(F.col("parent_station_id").alias("station_id"))
        .agg(
            F.max("parent_station_name").alias("station_name"),
            (_accessible() == 1).alias("accessible"),
            F.countDistinct("stop_id").alias("stop_count"),
            F.max(F.coalesce("nb_elevators", F.lit(0))).alias("elevators_total"),
            F.max(F.coalesce("nb_available", F.lit(0))).alias("elevators_available"),
            F.max("pct_elevators_available").alias("availability_pct"),
            F.max(F.coalesce("nb_outages_30d", F.lit(0))).alias("outages_30d"),
            F.max("pct_uptime_30d").alias("uptime_30d_pct"),
            F.max("nb_lines_served").alias("lines_count"),
            F.max("nb_active_disruptions_today").alias("active_disruptions_today"),
            F.max("avg_daily_validations_30d").alias("avg_daily_validations_30d"),
            F.max("peak_hour_pct_validations").alias("peak_hour_validations_pct"),
        )
    )
    status = F.when(F.col("accessible"), "accessible").otherwise("non_accessible_or_unknown")
    grouped = grouped.withColumn("accessibility_status", status)
    if accessible is not None:
        grouped = grouped.where(F.col("accessible") == accessible)
    return page(grouped, [F.col("station_name").asc_nulls_last(), F.col("station_id")], limit, offset)


def elevator_list(availability: DataFrame, search=None, available=None, limit=params.DEFAULT_LIMIT, offset=0) -> DataFrame:
    limit, offset = params.page_bounds(limit, offset)
    available = params.flag("available", available)
    working = F.col("nb_available")
    wanted = None if available is None else (working > 0 if available else working == 0)
    rows = availability.where(_all(_search(search, "station_name"), wanted)).select(
        "station_area_id",
        "station_name",
        "transport_mode",
        F.col("nb_elevators").alias("elevators_total"),
        F.coalesce(working, F.lit(0)).alias("elevators_available"),
        (F.col("nb_elevators") - F.coalesce(working, F.lit(0))).alias("elevators_unavailable"),
        F.col("pct_available").alias("availability_pct"),
        F.col("station_latitude").alias("latitude"),
        F.col("station_longitude").alias("longitude"),
    )
    order = ["station_name", "transport_mode", "station_area_id"]
    return page(rows, [F.col(c).asc_nulls_last() for c in order], limit, offset)


def transfer_list(
    transfers: DataFrame,
    stops: DataFrame,
    search=None,
    accessible=None,
    max_distance_m=None,
    limit=params.DEFAULT_LIMIT,
    offset=0,
) -> DataFrame:
    """Transfer edges with the names of both ends, longest first."""
    limit, offset = params.page_bounds(limit, offset)
    accessible, reach = params.flag("accessible", accessible), params.real("max_distance_m", max_distance_m, 0)
    wanted = _all(
        F.col("accessible_transfer") == accessible if accessible is not None else None,
        F.col("pathway_length_m") <= reach if reach is not None else None,
    )
    ends = [
        stops.select(F.col("stop_id").alias(f"{end}_stop_id"), F.col("stop_name").alias(f"{end}_stop_name"))
        for end in ("from", "to")
    ]
    named = transfers.where(wanted).join(ends[0], "from_stop_id", "left").join(ends[1], "to_stop_id", "left")
    rows = named.where(_all(_search(search, "from_stop_name", "to_stop_name"))).select(
        "from_stop_id",
        "from_stop_name",
        "to_stop_id",
        "to_stop_name",
        "transfer_type",
        F.col("min_transfer_time").alias("min_transfer_time_sec"),
        "pathway_length_m",
        F.col("pathway_traversal_time").alias("pathway_traversal_time_sec"),
        "has_stairs",
        "has_escalator",
        "has_elevator",
        F.col("nb_elevators").alias("elevators_total"),
        F.col("nb_available").alias("elevators_available"),
        F.col("pct_uptime_30d").alias("elevator_uptime_30d_pct"),
        F.col("accessible_transfer").alias("accessible"),
    )
    order = [F.col("pathway_length_m").desc_nulls_last(), F.col("from_stop_id"), F.col("to_stop_id")]
    return page(rows, order, limit, offset)


def elevator_worst(reliability: DataFrame, search=None, limit=params.DEFAULT_LIMIT, offset=0) -> DataFrame:
    """Lift reliability per station and mode, least uptime first."""
    limit, offset = params.page_bounds(limit, offset)
    rows = reliability.where(_all(_search(search, "station_name"))).select(
        "station_area_id",
        "station_name",
        "transport_mode",
        F.col("nb_elevators").alias("elevators_total"),
        F.col("nb_outages_30d").alias("outages_30d"),
        "downtime_minutes_30d",
        "avg_outage_minutes_30d",
        F.col("nb_outages_90d").alias("outages_90d"),
        "downtime_minutes_90d",
        "avg_outage_minutes_90d",
        F.col("pct_uptime_30d").alias("uptime_30d_pct"),
        F.col("pct_uptime_90d").alias("uptime_90d_pct"),
    )
    ties = [F.col(c).asc_nulls_last() for c in ("station_name", "transport_mode", "station_area_id")]
    return page(rows, [F.col("uptime_30d_pct").asc_nulls_first(), *ties], limit, offset)


def outage_events(
    downtime: DataFrame,
    as_of: datetime,
    search=None,
    ongoing=None,
    since_days=None,
    limit=params.DEFAULT_LIMIT,
    offset=0,
) -> DataFrame:
    """Outages, newest first; an open one is measured up to as_of."""
    limit, offset = params.page_bounds(limit, offset)
    ongoing, since = params.flag("ongoing", ongoing), params.whole("since_days", since_days, 1, 3650)
    open_ = F.col("ended_at").isNull()
    wanted = _all(
        _search(search, "station_name"),
        None if ongoing is None else (open_ if ongoing else ~open_),
        F.col("status_updated_at") >= clock.moment(as_of - timedelta(days=since)) if since else None,
    )
    seconds = F.coalesce("downtime_sec", clock.seconds_between("status_updated_at", clock.moment(as_of)))
    rows = downtime.where(wanted).select(
        "elevator_key",
        "elevator_id",
        "station_area_id",
        "station_name",
        "transport_mode",
        "status",
        F.col("status_reason").alias("reason"),
        clock.iso_stamp("status_updated_at").alias("started_at"),
        clock.iso_stamp("ended_at").alias("ended_at"),
        open_.alias("ongoing"),
        seconds.alias("downtime_sec"),
        F.round(seconds / 60, 1).alias("downtime_minutes"),
    )
    ties = [F.col(c).asc_nulls_last() for c in ("elevator_key", "status", "reason", "downtime_sec")]
    return page(rows, [F.col("started_at").desc_nulls_last(), *ties], limit, offset)


# --- crowding --------------------------------------------------------------

_STOP_OF_DAY = ["jour", "id_refa_lda", "stif_trns", "stif_res", "stif_arret"]


def crowding_summary(crowding: DataFrame, date_from=None, date_to=None) -> DataFrame:
    """Hourly rows repeat the day's total, so stop-days are reduced by max before summing."""
    rows = crowding.where(_all(F.col("id_refa_lda").isNotNull(), _days("jour", date_from, date_to)))
    stop_days = rows.groupBy(*_STOP_OF_DAY).agg(F.max("daily_total_validations").alias("total"))
    station_days = stop_days.groupBy("jour", "id_refa_lda").agg(F.sum("total").alias("total"))
    return station_days.agg(
        F.countDistinct("id_refa_lda").alias("stations"),
        clock.iso_date(F.min("jour")).alias("date_from"),
        clock.iso_date(F.max("jour")).alias("date_to"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("total_validations"),
        F.round(F.avg("total"), 1).alias("avg_daily_validations_per_station"),
        F.max("total").alias("max_daily_validations_at_one_station"),
    )


def crowding_stations(
    crowding: DataFrame,
    search=None,
    hour=None,
    cat_jour=None,
    date_from=None,
    date_to=None,
    limit=params.DEFAULT_LIMIT,
    offset=0,
) -> DataFrame:
    """Stations by estimated hourly crowding, with daily means, peaks and modes.

    The hourly rows are first reduced to (station, day, hour) partial sums beside the
    stop-day maxima; everything later works on those two small inputs.
    """
    limit, offset = params.page_bounds(limit, offset)
    hour, cat_jour = params.whole("hour", hour, 0, 23), params.term(cat_jour)
    rows = crowding.where(
        _all(
            F.col("id_refa_lda").isNotNull(),
            _search(search, "libelle_arret"),
            F.col("hour_start") == hour if hour is not None else None,
            text.equals_term(cat_jour, "cat_jour") if cat_jour else None,
            _days("jour", date_from, date_to),
        )
    )
    stop_days = rows.groupBy(*_STOP_OF_DAY).agg(
        F.max("libelle_arret").alias("name"),
        F.max("daily_total_validations").alias("total"),
        F.max("geo_point").alias("point"),
    )
    station_days = stop_days.groupBy("jour", "id_refa_lda").agg(
        F.max("name").alias("name"),
        F.sum("total").alias("total"),
        F.max("point").alias("point"),
        F.collect_set("stif_trns").alias("modes"),
    )
    daily = station_days.groupBy("id_refa_lda").agg(
        F.max("name").alias("station_name"),
        F.round(F.avg("total"), 1).alias("avg_daily_validations"),
        F.max("point").alias("geo_point"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("modes")))).alias("transport_modes"),
    )
    hours = (
        rows.groupBy("jour", "id_refa_lda", "hour_start")
        .agg(F.sum("estimated_validations").alias("estimated"))
        .join(station_days.select("jour", "id_refa_lda", "total"), ["jour", "id_refa_lda"])
    )
    share = F.try_divide(F.lit(100.0) * F.col("estimated"), F.col("total"))
    hourly = hours.groupBy("id_refa_lda").agg(
        F.round(F.avg("estimated"), 1).alias("avg_estimated_validations"),
        F.round(F.max("estimated"), 1).alias("peak_estimated_validations"),
        F.round(F.max(share), 1).alias("peak_hour_validations_pct"),
    )
    lon, lat = geo.wkt_coordinates("geo_point")
    stations = daily.join(hourly, "id_refa_lda").select(
        F.col("id_refa_lda").alias("station_id"),
        "station_name",
        "avg_daily_validations",
        "avg_estimated_validations",
        "peak_estimated_validations",
        "peak_hour_validations_pct",
        lon.alias("longitude"),
        lat.alias("latitude"),
        "transport_modes",
    )
    order = [
        F.col("avg_estimated_validations").desc_nulls_last(),
        F.col("station_name").asc_nulls_last(),
        F.col("station_id"),
    ]
    return page(stations, order, limit, offset)


def crowding_timeseries(
    by_stop: DataFrame, search=None, date_from=None, date_to=None, limit=params.DEFAULT_LIMIT, offset=0
) -> DataFrame:
    limit, offset = params.page_bounds(limit, offset)
    days = (
        by_stop.where(_all(_search(search, "libelle_arret"), _days("jour", date_from, date_to)))
        .groupBy("jour")
        .agg(
            F.coalesce(F.sum("total_validations"), F.lit(0)).alias("total_validations"),
            F.countDistinct("id_refa_lda").alias("stations"),
        )
        .select(clock.iso_date("jour").alias("date"), "total_validations", "stations")
    )
    return page(days, [F.col("date").desc()], limit, offset)


def ticket_categories(
    by_category: DataFrame, search=None, date_from=None, date_to=None, limit=params.DEFAULT_LIMIT, offset=0
) -> DataFrame:
    """Volume and share of all validations per ticket category."""
    limit, offset = params.page_bounds(limit, offset)
    volumes = (
        by_category.where(_all(_search(search, "libelle_arret"), _days("jour", date_from, date_to)))
        .groupBy(F.col("categorie_titre").alias("ticket_category"))
        .agg(F.sum("nb_vald").alias("validations"))
    )
    shared = share_of_total(volumes, "validations", "validations_pct")
    shared = shared.withColumn("validations", F.coalesce("validations", F.lit(0)))
    return page(shared, [F.col("validations").desc(), F.col("ticket_category").asc_nulls_last()], limit, offset)


# --- punctuality -----------------------------------------------------------


def _line(term) -> Column | None:
    return _search(term, "published_line", "line_ref")


def _punctuality() -> list[Column]:
    on_time = 100 * (1 - F.try_divide(F.sum("nb_delayed").cast("double"), F.sum("nb_passages")))
    return [
        F.coalesce(F.sum("nb_passages"), F.lit(0)).alias("passages"),
        F.coalesce(F.sum("nb_delayed"), F.lit(0)).alias("delayed_passages"),
        # Means are kept to one decimal, so tenths sum exactly as integers.
        F.round(
            F.try_divide(
                F.sum(F.round(F.col("avg_arrival_delay_sec") * 10).cast("long") * F.col("nb_passages")) / 10,
                F.sum("nb_passages"),
            ),
            1,
        ).alias("avg_arrival_delay_sec"),
        F.max("max_arrival_delay_sec").alias("max_arrival_delay_sec"),
        F.round(on_time, 1).alias("on_time_pct"),
    ]


def delays_summary(by_stop: DataFrame, line=None) -> DataFrame:
    rows = by_stop.where(_all(_line(line)))
    return rows.agg(
        F.countDistinct("stop_point_ref").alias("stops"),
        F.countDistinct(F.coalesce("published_line", "line_ref")).alias("lines"),
        *_punctuality(),
    )


def delays_by_line(by_stop: DataFrame, line=None, limit=params.DEFAULT_LIMIT, offset=0) -> DataFrame:
    """Passage-weighted punctuality per line, worst first."""
    limit, offset = params.page_bounds(limit, offset)
    lines = (
        by_stop.where(_all(_line(line)))
        .groupBy("line_ref", "published_line")
        .agg(F.countDistinct("stop_point_ref").alias("stops"), *_punctuality())
    )
    order = [
        F.col("on_time_pct").asc_nulls_first(),
        F.col("passages").desc(),
        F.col("line_ref").asc_nulls_last(),
        F.col("published_line").asc_nulls_last(),
    ]
    return page(lines, order, limit, offset)


def recent_delays(
    delays: DataFrame,
    as_of: datetime,
    line=None,
    min_delay_sec=60,
    since_hours=None,
    limit=params.DEFAULT_LIMIT,
    offset=0,
) -> DataFrame:
    """Delayed passages, newest first, the larger of both delays deciding."""
    limit, offset = params.page_bounds(limit, offset)
    threshold = params.whole("min_delay_sec", min_delay_sec, 0, 86400)
    since = params.whole("since_hours", since_hours, 1, 744)
    worst = F.greatest(F.coalesce("arrival_delay_sec", F.lit(0)), F.coalesce("departure_delay_sec", F.lit(0)))
    wanted = _all(
        worst >= threshold,
        _line(line),
        F.col("batch_time") >= clock.moment(as_of - timedelta(hours=since)) if since else None,
    )
    rows = page(
        delays.where(wanted).withColumn("_worst", worst),
        [
            F.col("batch_time").desc_nulls_last(),
            F.col("_worst").desc(),
            F.col("journey_ref"),
            F.col("stop_point_ref"),
        ],
        limit,
        offset,
    )
    return rows.select(
        "journey_ref",
        "stop_point_ref",
        "line_ref",
        "published_line",
        "direction",
        "destination_name",
        clock.iso_stamp("aimed_arrival").alias("aimed_arrival"),
        clock.iso_stamp("expected_arrival").alias("expected_arrival"),
        "arrival_delay_sec",
        "departure_delay_sec",
        "arrival_status",
        "departure_status",
        clock.iso_stamp("batch_time").alias("batch_time"),
    )


# --- disruptions -----------------------------------------------------------


def active_disruptions(
    active: DataFrame, search=None, line=None, severity=None, limit=params.DEFAULT_LIMIT, offset=0
) -> DataFrame:
    limit, offset = params.page_bounds(limit, offset)
    line, severity = params.term(line), params.term(severity)
    wanted = _all(
        F.col("is_active"),
        _search(search, *(F.coalesce(c, F.lit("")) for c in ("title", "short_message", "message"))),
        text.any_item_equals("impacted_lines", line) if line else None,
        text.equals_term(severity, "severity") if severity else None,
    )
    rows = page(active.where(wanted), [F.col("last_update").desc_nulls_last(), F.col("id")], limit, offset)
    stamps = ("begin_time", "end_time", "last_update", "batch_time")
    return rows.select(
        "id",
        "cause",
        "severity",
        "title",
        "short_message",
        "message",
        F.coalesce("impacted_lines", F.array().cast("array<string>")).alias("impacted_lines"),
        *(clock.iso_stamp(c).alias(c) for c in stamps),
    )


def disruption_history(
    by_line: DataFrame, line=None, date_from=None, date_to=None, limit=params.DEFAULT_LIMIT, offset=0
) -> DataFrame:
    limit, offset = params.page_bounds(limit, offset)
    rows = by_line.where(_all(_search(line, "line_id"), _days("day", date_from, date_to))).select(
        "line_id",
        clock.iso_date("day").alias("date"),
        F.col("nb_disruptions").alias("disruptions"),
        F.coalesce("severities", F.array().cast("array<string>")).alias("severities"),
    )
    return page(rows, [F.col("date").desc(), F.col("disruptions").desc(), F.col("line_id")], limit, offset)


# --- network ---------------------------------------------------------------


def network_lines(lines: DataFrame, search=None, limit=params.DEFAULT_LIMIT, offset=0) -> DataFrame:
    limit, offset = params.page_bounds(limit, offset)
    known = _all(
        F.col("route_id").isNotNull(), _search(search, "route_id", "route_short_name", "route_long_name")
    )
    rows = (
        lines.where(known)
        .groupBy("route_id")
        .agg(
            F.max("route_short_name").alias("route_short_name"),
            F.max("route_long_name").alias("route_long_name"),
            F.max("route_type").alias("route_type"),
            F.max("agency_id").alias("agency_id"),
            F.countDistinct(F.coalesce("parent_station_id", "stop_id")).alias("stations"),
            F.countDistinct("stop_id").alias("stops"),
        )
        .withColumn("transport_mode", text.route_type_name("route_type"))
    )
    order = [F.col("route_type").asc_nulls_last(), F.col("route_short_name").asc_nulls_last(), F.col("route_id")]
    return page(rows, order, limit, offset)


def line_stations(lines: DataFrame, stops: DataFrame, route_id: str, limit=params.MAX_LIMIT, offset=0) -> DataFrame:
    limit, offset = params.page_bounds(limit, offset)
    details = stops.select(
        "stop_id", "stop_name", "stop_lat", "stop_lon", "parent_station_lat", "parent_station_lon"
    )
    served = lines.where(F.col("route_id") == route_id).join(details, "stop_id", "left")
    rows = served.groupBy(F.coalesce("parent_station_id", "stop_id").alias("station_id")).agg(
        F.max(F.coalesce("parent_station_name", "stop_name")).alias("station_name"),
        F.max(F.coalesce("parent_station_lat", "stop_lat")).alias("latitude"),
        F.max(F.coalesce("parent_station_lon", "stop_lon")).alias("longitude"),
        F.countDistinct("stop_id").alias("stops"),
    )
    return page(rows, [F.col("station_name").asc_nulls_last(), F.col("station_id")], limit, offset)


def day_category(dates: DataFrame, calendar: DataFrame, day: str = "date") -> DataFrame:
    """Day type of each date, by weekday alone where the calendar has no entry."""
    known = calendar.select(F.col("date").alias("_day"), F.col("cat_jour").alias("_cat"))
    return dates.join(known, F.col(day) == F.col("_day"), "left").select(
        *dates.columns, F.coalesce("_cat", clock.fallback_day_category(F.col(day))).alias("cat_jour")
    )


def page_envelope(items: DataFrame, limit: int, offset: int) -> DataFrame:
    """One row (count, limit, offset, items) around a page, which is at most MAX_LIMIT rows."""
    limit, offset = params.page_bounds(limit, offset)
    return items.agg(
        F.count("*").alias("count"),
        F.lit(limit).alias("limit"),
        F.lit(offset).alias("offset"),
        F.collect_list(F.struct(*items.columns)).alias("items"),
    )


# --- accounts --------------------------------------------------------------


def subscriptions_of(subscriptions: DataFrame, person_id: int) -> DataFrame:
    return subscriptions.where(F.col("user_id") == person_id)


def notification_history(notifications: DataFrame, subscriptions: DataFrame, person_id: int | None = None) -> DataFrame:
    """Notifications with their owner, newest first for one person; all persons without one."""
    owned = subscriptions if person_id is None else subscriptions_of(subscriptions, person_id)
    owners = owned.select(F.col("id").alias("subscription_id"), "user_id")
    rows = notifications.join(owners, "subscription_id")
    if person_id is None:
        return rows
    return rows.orderBy(F.col("created_at").desc(), F.col("id"))

