"""Registered queries over the shared tables, and the SQL that checks them."""

from ruleweave.catalog.oracle import oracle_sql
from ruleweave.catalog.queries import queries

__all__ = ["oracle_sql", "queries"]
