"""Uniqueness and row counts of a stored table, kept up to date merge by merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.operators.maintained import VALUE, counts_after, measure_changes, value_changes, value_counts
from docfold.session import written
from docfold.sources.tables import replace_table, scan, upsert_table
from docfold.specs import Column, TableSpec

MEASURES = (Column("n_rows", "bigint"), Column("repeated", "bigint"))


class MaintainedUnique:
    """Counts of the values of ``columns`` of a stored table, beside it in tables of their own.

    ``rebuild`` counts the whole table; ``upsert`` merges and counts what the merge changes. The counts lie in ranges of the value, so that only
    files with a changed value are read or rewritten. A crash between the table and its counts shows as a
    row total that is not the table's; ``rebuild`` mends it.
    """

    def __init__(self, spark: SparkSession, database: str, spec: TableSpec, columns: Sequence[str], ranges: int = 16):
        self.spark, self.database, self.spec, self.columns = spark, database, spec, list(columns)
        name = f"{spec.name}_{'_'.join(columns)}"
        self.counts = TableSpec(f"{name}_counts", (Column(VALUE, required=True), Column("n", "bigint")), (VALUE,), ranges=ranges)
        self.measured = TableSpec(f"{name}_measures", MEASURES, ("n_rows",))

    def rebuild(self) -> None:
        replace_table(self.spark, self.database, self.counts, value_counts(scan(self.spark, self.database, self.spec.name), self.columns))
        counts = scan(self.spark, self.database, self.counts.name).select(VALUE, F.lit(0).cast("bigint").alias("before"), F.col("n").alias("after"))
        replace_table(self.spark, self.database, self.measured, measure_changes(counts))

    def upsert(self, source: DataFrame) -> None:
        stored = scan(self.spark, self.database, self.spec.name)
        changes = written(value_changes(stored, source, self.spec.key, self.columns), "changes")
        upsert_table(self.spark, self.database, self.spec, source)
        after = written(counts_after(scan(self.spark, self.database, self.counts.name), changes), "counts")
        upsert_table(self.spark, self.database, self.counts, after.select(VALUE, F.col("after").alias("n")))
        both = self.measures().unionByName(measure_changes(after))
        replace_table(self.spark, self.database, self.measured, both.agg(F.sum("n_rows").alias("n_rows"), F.sum("repeated").alias("repeated")))

    def measures(self) -> DataFrame:
        """``n_rows, repeated`` of the table as it is, out of one stored row."""
        return scan(self.spark, self.database, self.measured.name)
