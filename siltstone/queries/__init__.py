"""Registered queries over the given tables."""

from siltstone.queries import checks, intake, runs, star  # noqa: F401
from siltstone.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
