"""Registered queries over the driver's tables, each with its SQL where SQL can express it."""

from voxtally.catalog import (  # noqa: F401  (modules register on import)
    aggregates, columns, dashboards, joining, models, numbering, scans, streams, textual,
)
from voxtally.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
