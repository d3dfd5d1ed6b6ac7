"""Polled JSON payloads to one event per item, and event envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import clock

ENVELOPE = (
    "event_id string, payload_type string, source string, fetched_at string, "
    "event_date string, batch_time string, raw_json string"
)

# Keys that may identify an event, in order of preference.
DISRUPTION_ID_KEYS = ["id", "disruption_id", "DisruptionId", "SituationNumber", "id_"]
PASSAGE_ID_KEYS = ["DatedVehicleJourneyRef", "EstimatedVehicleJourneyCode", "VehicleJourneyRef", "id"]


def _items(v: Column, path: str) -> Column:
    """Array at the path; an object there counts as an array of one; NULL otherwise."""
    many = F.try_variant_get(v, path, "array<variant>")
    one = F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")).startswith("OBJECT"), F.try_variant_get(v, path, "variant"))
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)))


def _nested(v: Column, paths: Sequence[str]) -> Column:
    """Items under nested dict-or-list levels, flattened."""

    def below(path: str):
        return lambda x: F.coalesce(_items(x, path), F.array().cast("array<variant>"))

    found = _items(v, paths[0])
    for path in paths[1:]:
        found = F.flatten(F.transform(found, below(path)))
    return F.when(F.size(found) > 0, found)


def disruption_items(v: Column) -> list[tuple[str, Column]]:
    """(payload type, items) per known layout of a disruption payload, in order of preference."""
    return [
        ("disruption", F.try_variant_get(v, "$.disruptions", "array<variant>")),
        ("disruption", F.try_variant_get(v, "$.Disruption", "array<variant>")),
        (
            "pt_situation",
            _nested(v, ["$.Siri.ServiceDelivery.SituationExchangeDelivery", "$.Situations.PtSituationElement"]),
        ),
    ]


def passage_items(v: Column) -> list[tuple[str, Column]]:
    """(payload type, items) of an estimated timetable payload."""
    path = [
        "$.Siri.ServiceDelivery.EstimatedTimetableDelivery",
        "$.EstimatedJourneyVersionFrame",
        "$.EstimatedVehicleJourney",
    ]
    return [("estimated_vehicle_journey", _nested(v, path))]


LAYOUTS = {"disruptions": disruption_items, "passages": passage_items}


def explode_feed(payloads: DataFrame, layout: str, column: str = "payload") -> DataFrame:
    """One row per item with its type and canonical JSON (keys sorted, no blanks).

    Payloads that are not JSON are dropped here; a payload in no known layout is one item.
    Each payload is parsed once and each layout looked up once (see ``parse_once``).
    """
    keep = [c for c in payloads.columns if c != column]
    parsed = payloads.select(*keep, F.explode(F.array(F.try_parse_json(column))).alias("_v"))
    v = F.col("_v")
    found = [
        F.when(items.isNotNull(), F.struct(F.lit(kind).alias("kind"), items.alias("items")))
        for kind, items in LAYOUTS[layout](v)
    ]
    whole = F.struct(F.lit("raw_payload").alias("kind"), F.array(v).alias("items"))
    picked = parsed.where(v.isNotNull()).select(*keep, F.explode(F.array(F.coalesce(*found, whole))).alias("_p"))
    rows = picked.select(*keep, F.col("_p.kind").alias("payload_type"), F.explode("_p.items").alias("_item"))
    return rows.select(*keep, "payload_type", F.to_json("_item").alias("raw_json"))


def event_id(raw_json: str, id_keys: Sequence[str]) -> Column:
    """First non-empty candidate key, looking inside {"value": ...}, else the item's SHA-1."""
    raw = F.col(raw_json)
    found = []
    for key in id_keys:
        inner = F.get_json_object(raw, f"$.{key}.value")
        plain = F.get_json_object(raw, f"$.{key}")
        scalar = F.when(~plain.startswith("{") & ~plain.startswith("["), plain)
        for value in (inner, scalar):
            found.append(F.when(~F.trim(value).isin("", "0", "false"), value))
    return F.coalesce(*found, F.sha1(raw))


def event_envelope(items: DataFrame, id_keys: Sequence[str], source: str, fetched_at: str = "fetched_at") -> DataFrame:
    """Items (payload_type, raw_json, fetched_at timestamp) to envelope rows."""
    at = F.col(fetched_at)
    return items.select(
        event_id("raw_json", id_keys).alias("event_id"),
        "payload_type",
        F.lit(source).alias("source"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("fetched_at"),
        F.date_format(at, "yyyy-MM-dd").alias("event_date"),
        F.date_format(at, clock.STAMP_FORMAT).alias("batch_time"),
        "raw_json",
    )


def parse_once(df: DataFrame, column: str, schema: str, *keep: str) -> DataFrame:
    """Parsed JSON as the struct column ``raw`` beside the kept columns.

    The struct passes through a one-item explode. Without it the optimizer copies the
    parse into every filter on a parsed field, and each record is parsed twice.
    """
    return df.select(F.explode(F.array(F.from_json(column, schema))).alias("raw"), *keep)


def decode_envelope(records: DataFrame, value: str = "value") -> DataFrame:
    """Broker records to typed envelope columns; rows without an event id are malformed.

    Works alike on batch and stream frames. Split the result with ``well_formed``.
    """
    parsed = parse_once(records.select(F.col(value).cast("string").alias("_raw")), "_raw", ENVELOPE, "_raw")
    return parsed.select(
        "raw.event_id",
        "raw.payload_type",
        "raw.source",
        "raw.fetched_at",
        "raw.event_date",
        clock.stamp("raw.batch_time", clock.STAMP_FORMAT).alias("batch_time"),
        "raw.raw_json",
        "_raw",
    )


def well_formed(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("event_id").isNotNull()).drop("_raw")


def quarantined(decoded: DataFrame) -> DataFrame:
    """Records that are not envelopes, kept as text for inspection."""
    return decoded.where(F.col("event_id").isNull()).select(F.col("_raw").alias("raw_value"))


# --- reference JSON --------------------------------------------------------


def json_map_to_rows(df: DataFrame, column: str, key: str = "date", value: str = "libelle") -> DataFrame:
    """A JSON object column to one row per member."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(F.from_json(column, "map<string,string>")).alias(key, value))


def json_list_to_rows(df: DataFrame, column: str, fields: Sequence[str]) -> DataFrame:
    """A JSON array of records to one row per record with the fields as texts."""
    record = ", ".join(f"`{f}`: string" for f in fields)
    rest = [c for c in df.columns if c != column]
    rows = df.select(*rest, F.explode(F.from_json(column, f"array<struct<{record}>>")).alias("_r"))
    return rows.select(*rest, "_r.*")
