"""Counting what was announced, loaded and stored."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.functions.status import FAIL, status_of
from docfold.operators.keys import ROWS, key_counts


def record_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n)`` for several tables in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def reconcile_envelopes(envelopes: DataFrame) -> DataFrame:
    """Per file: records announced by the envelope against records it holds. Rows with the same ``file_path``, if there is one, are parts of a file."""
    declared = F.col("total_records").cast("bigint")
    held = F.greatest(F.coalesce(F.size("data"), F.lit(0)), F.lit(0)).cast("bigint")
    if "file_path" in envelopes.columns:
        envelopes = envelopes.groupBy("file_path", "file_name").agg(F.max(declared).alias("total_records"), F.sum(held).alias("held"))
        declared, held = F.col("total_records"), F.col("held")
    agrees = status_of(held, F.coalesce(declared, F.lit(-1)), FAIL)
    return envelopes.select(
        F.col("file_name").alias("source_file"), declared.alias("declared"), held.alias("loaded"), agrees.alias("status")
    )


def verify_load(loaded: DataFrame, stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group, rows meant to be stored against rows stored; groups on one side only show as 0 on the other."""
    by = list(by)
    sides = key_counts(loaded, by).withColumn("side", F.lit("loaded")).unionByName(
        key_counts(stored, by).withColumn("side", F.lit("stored"))
    )
    return (
        sides.groupBy(*by)
        .agg(
            F.coalesce(F.sum(F.when(F.col("side") == "loaded", F.col(ROWS))), F.lit(0)).alias("loaded"),
            F.coalesce(F.sum(F.when(F.col("side") == "stored", F.col(ROWS))), F.lit(0)).alias("stored"),
        )
        .withColumn("status", status_of(F.col("stored"), F.col("loaded"), FAIL))
    )


def reconcile_stored(declared: DataFrame, stored: DataFrame) -> DataFrame:
    """Per snapshot, the total it announced (``source_file, total_records``) against its rows in a stored table."""
    sides = declared.select("source_file", F.col("total_records").alias("declared"), F.lit(0).cast("bigint").alias("stored")).unionByName(
        key_counts(stored, ["source_file"]).select("source_file", F.lit(None).cast("bigint").alias("declared"), F.col(ROWS).alias("stored"))
    )
    totals = sides.groupBy("source_file").agg(F.sum("declared").alias("declared"), F.sum("stored").alias("stored"))
    return totals.withColumn("status", status_of(F.col("stored"), F.coalesce("declared", F.lit(-1)), FAIL))


def preview(df: DataFrame, columns: Sequence, order_col: str, n: int = 5) -> DataFrame:
    """First ``n`` rows by ``order_col``, as a top-n that keeps ``n`` rows per task."""
    return df.orderBy(order_col).limit(n).select(*columns)
