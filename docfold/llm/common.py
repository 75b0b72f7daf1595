"""What the corpus operators share: given tables, chosen columns, Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text handed to a vectorised step at once, in bytes; one longer text is handed over alone.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chosen(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns of ``df``, under new names, so that extra columns cannot clash."""
    return df.select(*[df[column].alias(name) for name, column in columns.items()])


def doc_columns(df: DataFrame) -> DataFrame:
    """``doc_id`` as bigint and ``text`` with null as empty."""
    return df.select(df["doc_id"].cast("bigint").alias("doc_id"), F.coalesce(df["text"], F.lit("")).alias("text"))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, each with at most ``limit`` characters of ``column``, or one row."""
    start, held = 0, 0
    for i, size in enumerate(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)
