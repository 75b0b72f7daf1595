"""Data-quality checks: declared, measured in one plan, summarised, and gating a run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.functions.status import (
    ERROR,
    FAIL,
    PASS,
    VERDICT_FAILED,
    VERDICT_PASSED,
    VERDICT_WARNINGS,
    WARNING,
    status_of,
    success_rate,
)
from docfold.operators.keys import ROWS, key_counts, linked_counts, rows_with_keys, unmatched_counts
from docfold.operators.reconcile import reconcile_envelopes, reconcile_stored
from docfold.specs import TableSpec

# A failing task reaches Python either as a Spark exception or, for some parse errors, as the plain Java one.
RUN_ERRORS = (PySparkException, Py4JJavaError)

RESULT_SCHEMA = "check_name string, check_type string, table_name string, measure bigint, expected bigint, status string"


@dataclass(frozen=True, eq=False)
class Link:
    """Rows of ``left`` that need a match in ``right``."""

    left: DataFrame
    right: DataFrame
    left_keys: tuple[str, ...]
    right_keys: tuple[str, ...]

    @property
    def identity(self) -> tuple:
        return (id(self.left), self.left_keys, id(self.right), self.right_keys)

    @property
    def reverse(self) -> Link:
        return Link(self.right, self.left, self.right_keys, self.left_keys)


@dataclass(frozen=True, eq=False)
class Check:
    """One rule. ``terms`` are (side, rows, aggregate): side is ``measure`` or ``expected``, which is 0 if not given.

    ``offending`` builds the rows that break the rule. ``link`` names the two sides of a check between tables.
    """

    name: str
    kind: str
    table: str
    severity: str
    terms: Callable[[], list[tuple[str, DataFrame, Column]]]
    offending: Callable[[], DataFrame] | None = field(default=None)
    link: Link | None = field(default=None)


def unique(df: DataFrame, keys: Sequence[str], name: str, table: str, severity: str = FAIL) -> Check:
    """Rows in groups that share a key, NULL keys counting as one group. A key seen three times measures 3."""

    def repeated():
        return key_counts(df, keys).where(F.col(ROWS) > 1)

    return Check(
        name, "unique", table, severity,
        lambda: [("measure", repeated(), F.sum(ROWS))],
        lambda: rows_with_keys(df, repeated(), keys),
    )


def not_null(df: DataFrame, columns: Mapping[str, str], table: str, severity: str = FAIL) -> list[Check]:
    """One check per column, given as ``{check name: column}``; a suite measures them all in one scan."""

    def check(name: str, column: str) -> Check:
        return Check(
            name, "not_null", table, severity,
            lambda: [("measure", df, F.count_if(F.col(column).isNull()))],
            lambda: df.where(F.col(column).isNull()),
        )

    return [check(name, column) for name, column in columns.items()]


def foreign_key(
    child: DataFrame,
    parent: DataFrame,
    child_keys: Sequence[str],
    parent_keys: Sequence[str],
    name: str,
    table: str,
    severity: str = FAIL,
    kind: str = "foreign_key",
) -> Check:
    """Child rows without a parent; a NULL key has none."""

    def orphans():
        return unmatched_counts(child, parent, child_keys, parent_keys)

    return Check(
        name, kind, table, severity,
        lambda: [("measure", orphans(), F.sum(ROWS))],
        lambda: rows_with_keys(child, orphans(), child_keys),
        Link(child, parent, tuple(child_keys), tuple(parent_keys)),
    )


def min_children(
    parent: DataFrame,
    child: DataFrame,
    parent_keys: Sequence[str],
    child_keys: Sequence[str],
    name: str,
    table: str,
    severity: str = WARNING,
) -> Check:
    """Parent rows without any child."""
    return foreign_key(parent, child, parent_keys, child_keys, name, table, severity, kind="min_children")


def row_count_match(source: DataFrame, model: DataFrame, name: str, table: str, severity: str = FAIL) -> Check:
    """The model holds as many rows as its source, exactly."""
    count = F.count(F.lit(1))
    return Check(name, "row_count_match", table, severity, lambda: [("measure", model, count), ("expected", source, count)])


def envelope_totals(envelopes: DataFrame, name: str, table: str, severity: str = FAIL) -> Check:
    """Files that hold another number of records than their envelope announces."""
    wrong = reconcile_envelopes(envelopes).where(F.col("status") != PASS)
    return Check(name, "envelope_totals", table, severity, lambda: [("measure", wrong, F.count(F.lit(1)))], lambda: wrong)


def stored_totals(declared: DataFrame, stored: DataFrame, name: str, table: str, severity: str = FAIL) -> Check:
    """Snapshots of which another number of records is stored than they announced."""
    wrong = reconcile_stored(declared, stored).where(F.col("status") != PASS)
    return Check(name, "stored_totals", table, severity, lambda: [("measure", wrong, F.count(F.lit(1)))], lambda: wrong)


def checks_for(spec: TableSpec, tables: Mapping[str, DataFrame]) -> list[Check]:
    """Key, NOT NULL and foreign-key checks that a table's declaration implies."""
    df, label = tables[spec.name], spec.name.upper()
    checks = [unique(df, spec.key, f"PK_{label}_UNIQUE", spec.name)]
    checks += not_null(df, {f"NOT_NULL_{label}_{c.upper()}": c for c in spec.required}, spec.name)
    for fk in spec.foreign_keys:
        checks.append(
            foreign_key(df, tables[fk.table], fk.columns, fk.ref_columns, f"FK_{label}_TO_{fk.table.upper()}", spec.name)
        )
    return checks


def violations(check: Check) -> DataFrame:
    """The rows that break a rule, in the shape of the checked table."""
    if check.offending is None:
        raise ValueError(f"{check.name} compares two counts: no single row breaks it")
    return check.offending()


def run_suite(checks: Sequence[Check]) -> DataFrame:
    """One row per check, in order, as one plan.

    Aggregates over the same DataFrame share one scan, and two checks that compare the same tables in opposite
    directions share one join. A check that cannot be planned is reported with status ERROR instead of being left out.
    """
    if not checks:
        raise ValueError("an empty suite proves nothing")
    both_ways = _two_way_terms(checks)
    scans: dict[int, tuple[DataFrame, list[Column]]] = {}
    broken: list[tuple[int, Check]] = []
    for place, check in enumerate(checks):
        try:
            terms = both_ways.get(place) or check.terms()
            for _, df, value in terms:
                df.agg(value)
        except PySparkException:
            broken.append((place, check))
            continue
        for side, df, value in terms:
            item = F.struct(
                *_labels(place, check), F.lit(side).alias("side"), F.coalesce(value, F.lit(0)).cast("bigint").alias("value")
            )
            scans.setdefault(id(df), (df, []))[1].append(item)
    parts = [df.agg(F.array(*items).alias("items")).select(F.inline("items")) for df, items in scans.values()]
    if broken:
        parts.append(_broken_rows(broken))
    merged = reduce(DataFrame.unionByName, parts)
    labels = ["place", "check_name", "check_type", "table_name", "severity"]
    measure = F.max(F.when(F.col("side") == "measure", F.col("value")))
    expected = F.coalesce(F.max(F.when(F.col("side") == "expected", F.col("value"))), F.lit(0))
    return (
        merged.groupBy(*labels)
        .agg(measure.alias("measure"), expected.alias("expected"))
        .withColumn("status", F.coalesce(status_of(F.col("measure"), F.col("expected"), F.col("severity")), F.lit(ERROR)))
        .orderBy("place")
        .select("check_name", "check_type", "table_name", "measure", "expected", "status")
    )


def _two_way_terms(checks: Sequence[Check]) -> dict[int, list[tuple[str, DataFrame, Column]]]:
    """Terms by place for pairs of checks such as "every child has a parent" and "every parent has a child"."""
    places = {c.link.identity: i for i, c in enumerate(checks) if c.link}
    terms = {}
    for i, check in enumerate(checks):
        other = places.get(check.link.reverse.identity) if check.link else None
        if other is None or i in terms or other in terms or other == i:
            continue
        link = check.link
        try:
            linked = linked_counts(link.left, link.right, link.left_keys, link.right_keys)
        except PySparkException:
            continue
        terms[i] = [("measure", linked, F.sum(F.when(F.col("__right").isNull(), F.col("__left"))))]
        terms[other] = [("measure", linked, F.sum(F.when(F.col("__left").isNull(), F.col("__right"))))]
    return terms


def _labels(place: int, check: Check) -> list[Column]:
    return [
        F.lit(place).alias("place"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.kind).alias("check_type"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.severity).alias("severity"),
    ]


def _broken_rows(broken: list[tuple[int, Check]]) -> DataFrame:
    rows = [(place, c.name, c.kind, c.table, ERROR, "measure", None) for place, c in broken]
    schema = "place int, check_name string, check_type string, table_name string, severity string, side string, value bigint"
    return SparkSession.active().createDataFrame(rows, schema)


def evaluate(checks: Sequence[Check]) -> DataFrame:
    """Results computed now, as a small local DataFrame of one row per check.

    If the one plan fails while running, each check runs alone and only the failing ones become ERROR.
    """
    spark = SparkSession.active()
    try:
        rows = [tuple(r) for r in run_suite(checks).collect()]
    except RUN_ERRORS:
        rows = []
        for check in checks:
            try:
                rows += [tuple(r) for r in run_suite([check]).collect()]
            except RUN_ERRORS:
                rows.append((check.name, check.kind, check.table, None, 0, ERROR))
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def summarise(results: DataFrame) -> DataFrame:
    """One row: totals per status, success rate and overall verdict."""
    status = F.col("status")
    counts = results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == PASS).alias("passed"),
        F.count_if(status == FAIL).alias("failed"),
        F.count_if(status == WARNING).alias("warnings"),
        F.count_if(status == ERROR).alias("errors"),
    )
    blocked = (F.col("failed") > 0) | (F.col("errors") > 0) | (F.col("total") == 0)
    return counts.withColumn("success_rate", success_rate(F.col("passed"), F.col("total"))).withColumn(
        "verdict",
        F.when(blocked, VERDICT_FAILED).when(F.col("warnings") > 0, VERDICT_WARNINGS).otherwise(VERDICT_PASSED),
    )


def blocking(results: DataFrame) -> DataFrame:
    """Checks that stop a run; warnings do not."""
    return results.where(F.col("status").isin(FAIL, ERROR))


class QualityGateError(Exception):
    """A run was stopped by its checks."""

    results: DataFrame | None = None


def gate(results: DataFrame) -> None:
    """Raises with the names of the blocking checks, or if nothing was checked; the exception carries the results."""
    rows = results.select("check_name", "measure", "status").collect()
    if not rows:
        raise QualityGateError("no check ran")
    bad = [f"{r.check_name} ({r.measure})" for r in rows if r.status in (FAIL, ERROR)]
    if bad:
        error = QualityGateError(f"{len(bad)} of {len(rows)} checks failed: {', '.join(bad)}")
        error.results = results
        raise error
