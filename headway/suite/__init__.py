"""Registered queries over the driver's tables, each next to its SQL oracle."""

from headway.suite import aggregates, cleaning, jobs, joins, models, products, scalars, sources, streams, tables, windows  # noqa: F401
from headway.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
