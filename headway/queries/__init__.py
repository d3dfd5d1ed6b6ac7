"""Registered queries over the given tables, each with its SQL counterpart."""

from headway.queries import (  # noqa: F401 - importing registers the queries
    accounts,
    disruptions,
    journeys,
    learning,
    lifts,
    realtime,
    timetable,
    validations,
)
from headway.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
