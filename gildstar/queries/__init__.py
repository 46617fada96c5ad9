"""Registered queries over the generic tables, each beside its SQL counterpart."""

from gildstar.queries.registry import REGISTRY, Query, register
from gildstar.queries import (  # noqa: F401  (imported for their registrations)
    aggregates,
    checks,
    dataflows,
    extraction,
    joins,
    loads,
    projections,
    scalars,
    sources,
    windows,
)

__all__ = ["REGISTRY", "Query", "register"]
