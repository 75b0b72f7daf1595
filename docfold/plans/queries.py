"""All queries of the engine and the SQL each must agree with."""

from __future__ import annotations

from docfold.plans import landing_queries, merge_queries  # noqa: F401 - they register their queries
from docfold.plans.table_queries import ORACLES, QUERIES, TABLES, model_quality

__all__ = ["ORACLES", "QUERIES", "TABLES", "model_quality"]
