"""All registered queries, one module per family."""

from . import aggregations, others, paging, places, predicates, relations, scored, writes  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
