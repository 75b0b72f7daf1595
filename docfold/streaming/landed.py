"""Merging newly landed snapshots only, as a stream that stops when it has caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docfold.operators.flatten import flatten
from docfold.operators.snapshots import latest_snapshot
from docfold.sources.landing import load_records
from docfold.sources.tables import upsert_table
from docfold.specs import FlattenSpec, TableSpec


def landed_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of record lines below ``folder/snapshot=<stamp>/``, each named by its snapshot."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else spark.readStream
    lines = reader.schema("value string, snapshot string").text(folder)
    return lines.select("value", F.col("snapshot").alias("file_name"))


def merge_landed(
    lines: DataFrame,
    database: str,
    table: TableSpec,
    fields: FlattenSpec,
    checkpoint: str,
    id_type: str = "bigint",
    newest_by: str | None = None,
) -> StreamingQuery:
    """Upserts each batch into a stored table.

    If a batch spans several snapshots of a record, the newest counts. A batch that is replayed after a failure changes
    nothing, as the merge is idempotent. ``newest_by`` names a column of the table that takes the snapshot's stamp; then a snapshot that lands late does
    not overwrite rows of a newer one either.
    """

    def merge(batch: DataFrame, _: int) -> None:
        newest = latest_snapshot(load_records(batch, id_type=id_type), ["id"], "source_file")
        rows = flatten(newest, fields, carry={newest_by: "source_file"} if newest_by else None)
        upsert_table(batch.sparkSession, database, table, rows, newest_by=newest_by)

    writer = lines.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
