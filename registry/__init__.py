"""The registered queries: each key names an operator, with its Spark plan and, where the result
is expressible in plain SQL, an independently written statement that must give the same rows."""

from registry.core import ORACLES, QUERIES
from registry import (  # noqa: F401  (importing a module registers its queries)
    aggregates,
    filters,
    history,
    jobs,
    joins,
    ladders,
    live,
    marts,
    published,
    quality,
    scalars,
    sinks,
    sources,
    windows,
)

__all__ = ["ORACLES", "QUERIES"]
