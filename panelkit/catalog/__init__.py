"""Queries over the driver tables, each with the SQL that must give the same rows."""

from panelkit.catalog import basics, finish, lookups, runs, trees, unions  # noqa: F401
from panelkit.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
