"""The registered queries: one per operator, each over whole tables, with its
checking SQL where the result can be said in SQL."""

from ripplekit.plans.catalog.base import REGISTRY, oracle_sql, queries
from ripplekit.plans.catalog import (  # noqa: F401  (registers on import)
    aggregation,
    filtering,
    joining,
    keyed_state,
    payloads,
    scalars,
    scans_sinks,
    streams,
    text_search,
)

__all__ = ["REGISTRY", "oracle_sql", "queries"]
