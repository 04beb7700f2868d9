"""One query per operator over the benchmark tables, each with its SQL oracle."""

from starloom.queries import (  # noqa: F401  (importing registers the queries)
    dedup,
    dims,
    facts,
    headers,
    history,
    loads,
    scalars,
    scans,
    validation,
)
from starloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
