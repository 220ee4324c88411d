"""Registered queries over the warehouse tables and their DuckDB oracles."""

from martlens.plans.oracle import ORACLE_SQL
from martlens.plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
