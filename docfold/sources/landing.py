"""JSON snapshots: enveloped files, page files, record lines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.functions.documents import field
from docfold.functions.timing import folder_stamp, iso_text, load_time, snapshot_name, utc_now
from docfold.operators.flatten import elements
from docfold.sources.envelopes import split_parts

# Each array element becomes a value of its own, so only a single record has to stay below the size limit of a variant.
ENVELOPE_SCHEMA = "ingested_at string, source string, total_records variant, data array<variant>"
PAGE_SCHEMA = "results array<variant>, info variant"
MANIFESTS = "_manifests"
#: Envelopes of more bytes are read by several tasks each; what is far larger could not be one row, which ends at 2 GB.
SPLIT_ABOVE = 128 << 20


def read_snapshots(spark: SparkSession, path: str, pattern: str | None = None, strict: bool = True) -> DataFrame:
    """Whole files as documents: ``(file_name, modified_at, doc)``. Without ``strict`` a malformed file gives NULL."""
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    parse = F.parse_json if strict else F.try_parse_json
    return reader.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        parse("value").alias("doc"),
    )


def read_envelopes(spark: SparkSession, path: str, pattern: str | None = None, strict: bool = True, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Enveloped files: ``(file_path, file_name, modified_at, ingested_at, source, total_records, data, corrupt)``.

    ``strict`` stops at a malformed file, otherwise its text is kept in ``corrupt``. A file is read as one value and is one row. With
    ``strict``, one of more than ``split_above`` bytes is read by as many tasks as it has splits, and is one row with its total and no
    records, and a row without total for each record; its name of the array must be written without escapes.
    """
    if strict and _any_larger(spark, path, pattern, split_above):
        small = _json_files(spark, path, ENVELOPE_SCHEMA, pattern, strict, split_above)
        small = small.withColumn("total_records", F.try_variant_get("total_records", "$", "bigint"))
        return small.unionByName(_split_envelopes(spark, path, pattern, split_above))
    df = _json_files(spark, path, ENVELOPE_SCHEMA, pattern, strict)
    return df.withColumn("total_records", F.try_variant_get("total_records", "$", "bigint"))


def _any_larger(spark: SparkSession, path: str, pattern: str | None, size: int) -> bool:
    """Whether there is a file of more than ``size`` bytes; contents are not read."""
    reader = spark.read.format("binaryFile")
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    return bool(reader.load(path).where(F.col("length") > size).select("length").take(1))


def _split_envelopes(spark: SparkSession, path: str, pattern: str | None, larger_than: int) -> DataFrame:
    """Rows of the large files: their heads without records, then each record."""
    heads, records = split_parts(spark, path, pattern, larger_than=larger_than)
    about = heads.select("file_path", "modified_at", "ingested_at", "source")  # one row for each file
    none = F.filter(F.array(F.parse_json(F.lit("0"))), lambda _: F.lit(False))
    records = records.join(F.broadcast(about), "file_path").select("*", F.lit(None).cast("bigint").alias("total_records"), F.array("value").alias("data")).drop("value")
    return heads.withColumn("data", none).unionByName(records).withColumn("corrupt", F.lit(None).cast("string"))


def read_pages(spark: SparkSession, path: str, pattern: str | None = None, strict: bool = True) -> DataFrame:
    """Page files named ``..._<page>.json``: ``(file_name, modified_at, page, results, next, corrupt)``."""
    df = _json_files(spark, path, PAGE_SCHEMA, pattern, strict)
    page = F.regexp_extract("file_name", r"([0-9]+)\.json$", 1).cast("bigint")
    return df.select(
        "file_name", "modified_at", page.alias("page"), "results", field("info", "$.next").alias("next"), "corrupt"
    )


def _json_files(spark, path, schema, pattern, strict, at_most=None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if strict:
        df = reader.option("mode", "FAILFAST").schema(schema).json(path)
        corrupt = F.lit(None).cast("string")
    else:
        df = reader.option("columnNameOfCorruptRecord", "_corrupt").schema(f"{schema}, _corrupt string").json(path)
        corrupt = F.col("_corrupt")
    df = df if at_most is None else df.where(F.col("_metadata.file_size") <= at_most)
    return df.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        *[c for c in df.columns if c != "_corrupt"],
        corrupt.alias("corrupt"),
    )


def latest_file(spark: SparkSession, folder: str, entity: str) -> str:
    """Path of the entity's most recently modified file. Only the listing is read, not the contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{entity}_*.json").load(folder)
    newest = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first().path
    if newest is None:
        raise FileNotFoundError(f"no {entity} files in {folder}")
    return newest


def load_raw(
    df: DataFrame,
    array_path: str = "$.data",
    id_path: str = "$.id",
    id_type: str = "bigint",
    load_ts=None,
    strict: bool = True,
) -> DataFrame:
    """RAW rows ``(id, raw_data, ingested_at, source_file)`` from whole documents, typed envelopes or single records.

    Whole documents (``doc``) are exploded at ``array_path``; envelopes (``data``) by element; records (``value``) are taken as they are.
    """
    if "value" in df.columns:
        items = df.select("file_name", "value")
    elif "data" in df.columns:
        held = F.col("data")
        if strict:  # a snapshot without its records must not pass for an empty one
            missing = F.concat(F.col("file_name"), F.lit(" holds no data"))
            held = F.when(held.isNull(), F.raise_error(missing)).otherwise(held)
        items = df.select("file_name", F.explode(held).alias("value"))
    else:
        items = elements(df.select("file_name", "doc"), array_path, "doc")
    return items.select(
        field("value", id_path, id_type, strict).alias("id"),
        F.col("value").alias("raw_data"),
        load_time(load_ts).alias("ingested_at"),
        F.col("file_name").alias("source_file"),
    )


def load_records(
    df: DataFrame, text: str = "value", id_path: str = "$.id", id_type: str = "bigint", load_ts=None, strict: bool = True
) -> DataFrame:
    """RAW rows from one JSON text per record, which splits over tasks where one big array cannot."""
    parse = F.parse_json if strict else F.try_parse_json
    return df.select(parse(text).alias("raw_data"), F.col("file_name")).select(
        field("raw_data", id_path, id_type, strict).alias("id"),
        "raw_data",
        load_time(load_ts).alias("ingested_at"),
        F.col("file_name").alias("source_file"),
    )


def read_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """JSON lines as ``(value, file_name)``, blank lines left out."""
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    lines = reader.text(path).select("value", F.col("_metadata.file_name").alias("file_name"))
    return lines.where(F.trim("value") != "")


def load_by_name(
    lines: DataFrame,
    schema: T.StructType | str,
    columns: Sequence[str] | None = None,
    text: str = "value",
    strict: bool = True,
) -> DataFrame:
    """Table rows from JSON lines, fields matched to columns by name without regard to case.

    Missing fields give NULL and unknown ones are dropped. Nested values stay JSON text, or become a document where
    the column is a variant. ``columns`` restricts the load to some columns. ``strict`` stops at a line that is no JSON
    object, or that names a field twice; otherwise such a line gives NULLs or its last value, and
    :func:`by_name_rejects` lists those that are no objects.
    """
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wanted = None if columns is None else {c.lower() for c in columns}
    rows = lines.select(_fields_by_name(text, strict).alias("__fields"))
    selected = []
    for f in target.fields:
        if wanted is not None and f.name.lower() not in wanted:
            continue
        name = f.name.lower()
        value = F.col("__fields")[name] if strict else _last_named(name)
        if isinstance(f.dataType, T.VariantType):
            value = F.parse_json(value) if strict else F.try_parse_json(value)
        else:
            value = value.cast(f.dataType) if strict else value.try_cast(f.dataType)
        selected.append(value.alias(f.name))
    return rows.select(*selected)


def _fields_by_name(text: str, strict: bool):
    """Fields of an object: a map by lower-case name, or without ``strict`` the entries as they come."""
    if not strict:
        return F.map_entries(F.from_json(text, "map<string,string>"))
    # from_json would give NULL for a line that parse_json refuses
    whole = F.when(F.parse_json(text).isNotNull(), F.from_json(text, "map<string,string>", {"mode": "FAILFAST"}))
    return F.transform_keys(whole, lambda k, _: F.lower(k))


def _last_named(name: str):
    return F.get(F.reverse(F.filter("__fields", lambda e: F.lower(e["key"]) == name)), F.lit(0))["value"]


def by_name_rejects(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines that are no JSON objects, and so hold nothing that :func:`load_by_name` could load."""
    parsed = F.try_parse_json(text)
    return lines.where(parsed.isNull() | ~F.schema_of_variant(parsed).startswith("OBJECT"))


def to_snapshot(df: DataFrame, entity: str, source: str, load_ts=None) -> tuple[DataFrame, DataFrame]:
    """(records as JSON lines, one-row manifest with the envelope's fields).

    A document column is written as it is, other rows as JSON objects of their columns.
    """
    whole = len(df.columns) == 1 and isinstance(df.schema[0].dataType, T.VariantType)
    record = F.to_json(df.columns[0]) if whole else F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    stamp = load_time(load_ts)
    manifest = df.agg(F.count(F.lit(1)).alias("total_records")).select(
        snapshot_name(entity, stamp).alias("snapshot"),
        iso_text(stamp).alias("ingested_at"),
        F.lit(source).alias("source"),
        "total_records",
    )
    return df.select(record.alias("value")), manifest


def write_snapshot(df: DataFrame, root: str, entity: str, source: str, load_ts: dt.datetime | None = None) -> str:
    """Writes records, then the manifest that makes the snapshot visible; returns the snapshot's stamp.

    The total is counted from the written lines, so a retried task cannot inflate it.
    """
    spark = df.sparkSession
    ts = load_ts or utc_now()
    stamp = folder_stamp(ts)
    records, _ = to_snapshot(df, entity, source, ts)
    folder = f"{root}/{entity}/snapshot={stamp}"
    records.write.mode("overwrite").text(folder)
    _, manifest = to_snapshot(spark.read.text(folder), entity, source, ts)
    manifest.coalesce(1).write.mode("overwrite").json(f"{root}/{MANIFESTS}/{entity}/snapshot={stamp}")
    return stamp


def read_manifests(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Manifests of all complete snapshots, ``stamp`` naming the folder."""
    schema = "snapshot string, ingested_at string, source string, total_records bigint"
    path = f"{root}/{MANIFESTS}/{entity}"
    stamp = F.regexp_extract(F.col("_metadata.file_path"), "/snapshot=([^/]+)/", 1)
    files = spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
    return files.select("*", stamp.alias("stamp"))


def read_latest_records(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Lines of the newest complete snapshot as ``(value, file_name)``; only its folder is read."""
    newest = read_manifests(spark, root, entity).agg(F.max_by(F.struct("stamp", "snapshot"), "ingested_at").alias("m")).first().m
    if newest is None:
        raise FileNotFoundError(f"no {entity} snapshot in {root}")
    lines = spark.read.text(f"{root}/{entity}/snapshot={newest.stamp}")
    return lines.select("value", F.lit(newest.snapshot).alias("file_name"))
