"""Check outcomes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Statuses and overall verdicts a check suite reports.
PASS = "PASS"
FAIL = "FAIL"
WARNING = "WARNING"
ERROR = "ERROR"
VERDICT_FAILED = "FAILED"
VERDICT_WARNINGS = "PASSED WITH WARNINGS"
VERDICT_PASSED = "ALL CHECKS PASSED"


def status_of(measure: Column, expected: Column, severity: Column | str) -> Column:
    severity = F.lit(severity) if isinstance(severity, str) else severity
    return F.when(measure == expected, F.lit(PASS)).otherwise(severity)


def success_rate(passed: Column, total: Column) -> Column:
    """Percentage with one decimal; 0 where nothing ran."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(F.lit(100.0) * passed / total, 1))
