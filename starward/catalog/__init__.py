"""Every operator as a named query over the test tables, with the SQL it must agree with."""

from starward.catalog import changes, files, loads, relations, rows  # noqa: F401
from starward.catalog.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
