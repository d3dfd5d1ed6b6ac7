"""Text cleaning, code extraction and text search predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_string(c: Column | str) -> Column:
    """Trimmed text; blank becomes NULL."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))


def clean_label(c: Column | str) -> Column:
    """Like clean_string, with runs of white space folded into one blank first."""
    return clean_string(F.regexp_replace(_col(c), r"\s+", " "))


def name_key(c: Column | str) -> Column:
    """Key used to join tables that only share a station or line name."""
    return F.upper(F.trim(_col(c)))


def first_int(c: Column | str) -> Column:
    """First run of digits as an integer, NULL where there is none."""
    return F.regexp_extract(_col(c), r"(\d+)", 1).try_cast("int")


def tail_token(c: Column | str) -> Column:
    """Last alphanumeric token before an optional closing colon; '' where none matches."""
    return F.regexp_extract(_col(c), r"([A-Za-z0-9]+):?$", 1)


def tail_digits(c: Column | str) -> Column:
    """Last digit run before an optional closing colon; '' where none matches."""
    return F.regexp_extract(_col(c), r"(\d+):?$", 1)


def segment(c: Column | str, index: int, sep: str = ":") -> Column:
    """The index-th segment (from 0), NULL where the text has fewer."""
    return F.get(F.split(_col(c), sep), F.lit(index))


def last_segment(c: Column | str, sep: str = ":") -> Column:
    return F.substring_index(_col(c), sep, -1)


def decimal_comma(c: Column | str) -> Column:
    """'4,25' to 4.25."""
    return F.regexp_replace(_col(c), ",", ".").try_cast("double")


def whole_number(c: Column | str) -> Column:
    """'123.0' to 123."""
    return _col(c).try_cast("double").try_cast("long")


def is_number(c: Column | str) -> Column:
    return _col(c).rlike("^[0-9]+$")


def masked_count(c: Column | str) -> Column:
    """The count, or NULL where the publisher masked a small one."""
    return F.when(is_number(c), _col(c).try_cast("long"))


def surrogate_key(elevator_id: Column, external_id: Column, area_id: Column, name: Column) -> Column:
    """Lift key: own id, else the operator's id, else the station."""
    return (
        F.when(elevator_id.isNotNull(), F.concat(F.lit("lift:"), elevator_id.cast("string")))
        .when(external_id.isNotNull(), F.concat(F.lit("external:"), external_id))
        .otherwise(F.concat_ws(":", F.lit("station"), area_id.cast("string"), name))
    )


def availability_flag(status: Column | str) -> Column:
    """True when available, False for any other status, NULL when the status is unknown."""
    s = _col(status)
    return F.when(s.isNotNull(), s == "available")


# Route type codes of the timetable format and their names.
ROUTE_TYPE_NAMES = {
    0: "tram",
    1: "metro",
    2: "rail",
    3: "bus",
    4: "ferry",
    5: "cable_tram",
    6: "aerial_lift",
    7: "funicular",
    11: "trolleybus",
    12: "monorail",
}


def route_type_name(code: Column | str) -> Column:
    pairs = [F.lit(x) for kv in ROUTE_TYPE_NAMES.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(code).cast("int")), F.lit("unknown"))


def contains_term(term: str, *cols: Column | str) -> Column:
    """Any of the columns holds the term, ignoring case and outer blanks of both."""
    needle = F.upper(F.trim(F.lit(term)))
    found = F.lit(False)
    for c in cols:
        found = found | F.contains(name_key(c), needle)
    return found


def equals_term(term: str, c: Column | str) -> Column:
    return name_key(c) == F.upper(F.trim(F.lit(term)))


def any_item_equals(items: Column | str, term: str) -> Column:
    """Some array item equals the term; a NULL array has none."""
    wanted = F.upper(F.trim(F.lit(term)))
    return F.coalesce(F.exists(_col(items), lambda x: F.upper(F.trim(x)) == wanted), F.lit(False))
