"""Queries over the given tables, one or more per operator, each with the SQL it has to agree with."""

from lapwise.catalog import race, tables  # noqa: F401  (importing them fills the registry)
from lapwise.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
