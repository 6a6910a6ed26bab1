"""Registered queries over the given tables; importing the package fills the registry."""

from terrace.queries import cleaning, layers, matching, racing, star, streams, timeseries, writing  # noqa: F401
from terrace.queries.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
