"""Every registered query, keyed by name."""

from starloom.queries import (  # noqa: F401
    aggregates,
    checks,
    defects,
    joins,
    ordering,
    projections,
    scalars,
    sets,
    stored,
    warehouse,
    warehouse_marts,
)
from starloom.queries.base import REGISTRY  # noqa: F401
