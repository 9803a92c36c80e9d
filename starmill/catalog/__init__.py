"""Registered queries: each operator on the star tables, with its SQL counterpart."""

from starmill.catalog import analyses, checks, cleaning, dimensions, facts, loads, sources
from starmill.catalog.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "analyses",
    "checks",
    "cleaning",
    "dimensions",
    "facts",
    "loads",
    "sources",
]
