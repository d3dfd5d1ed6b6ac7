"""Checks of query parameters; each returns the typed value or raises ValueError."""

from __future__ import annotations

from datetime import date

# Page sizes and bounds accepted by the queries.
DEFAULT_LIMIT = 100
MAX_LIMIT = 500
TRUE_TEXTS = ("1", "true", "yes")
FALSE_TEXTS = ("0", "false", "no")


def _number(kind, name: str, value, low, high):
    if value is None:
        return None
    try:
        number = kind(value)
    except (TypeError, ValueError) as error:
        raise ValueError(f"{name}: not a {kind.__name__}: {value!r}") from error
    if (low is not None and not number >= low) or (high is not None and not number <= high):
        raise ValueError(f"{name}: {number} is outside [{low}, {high}]")
    return number


def whole(name: str, value, low: int | None = None, high: int | None = None) -> int | None:
    return _number(int, name, value, low, high)


def real(name: str, value, low: float | None = None, high: float | None = None) -> float | None:
    return _number(float, name, value, low, high)


def flag(name: str, value) -> bool | None:
    if value is None or isinstance(value, bool):
        return value
    word = str(value).strip().lower()
    if word in TRUE_TEXTS:
        return True
    if word in FALSE_TEXTS:
        return False
    raise ValueError(f"{name}: not a yes/no value: {value!r}")


def day(name: str, value) -> date | None:
    if value is None or value == "":
        return None
    if isinstance(value, date):
        return value
    try:
        return date.fromisoformat(str(value).strip())
    except ValueError as error:
        raise ValueError(f"{name}: not an ISO date: {value!r}") from error


def day_range(date_from, date_to) -> tuple[date | None, date | None]:
    first, last = day("date_from", date_from), day("date_to", date_to)
    if first and last and first > last:
        raise ValueError(f"date range is reversed: {first} > {last}")
    return first, last


def term(value) -> str | None:
    return (value or "").strip() or None


def page_bounds(limit=DEFAULT_LIMIT, offset=0) -> tuple[int | None, int]:
    """Checked page size and start; None, for batch use, is no limit."""
    return whole("limit", limit, 1, MAX_LIMIT), whole("offset", offset, 0)
