"""Every operator over the test tables, each beside the SQL that gives the same rows."""

from tideline.workload import documents, landing, models, series, tables
from tideline.workload.catalogue import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "documents", "landing", "models", "series", "tables"]
