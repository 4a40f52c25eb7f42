"""Runnable examples of every operator over the test tables, with the SQL that checks them."""

from sluice.catalog.oracle import ORACLE
from sluice.catalog.queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
