"""All registered queries: importing this package fills ``QUERIES`` and ``SQL``."""

from shelfcast.plans.catalog import (  # noqa: F401
    aggregates,
    flows,
    joins,
    lookups,
    models,
    monitoring,
    nested,
    scalars,
    scans,
    streams,
    windows,
)
from shelfcast.plans.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
