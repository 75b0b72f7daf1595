"""Stored tables: created from a spec, replaced whole, and merged into.

Version ``n`` of a table is the view ``<table>__v<n>`` over one data table or several parts of them, and the table itself is a view over its
newest version. A writer reads the newest version, writes its rows into a data table of its own name, and publishes by creating the
next view. A catalog creates a name once only, so of several writers that have read the same version one publishes and the
others raise :class:`ConcurrentWriteError`; nothing that was published is lost, and what a writer left behind blocks nobody.

A merge rewrites as little as the layout allows. Of a sliced table, the slices that hold a key of the source; of a table without buckets, the
files that hold one, as ``_metadata`` tells, where key ranges keep Parquet from reading the others. The rest stays in
place, and the new version leaves out what was rewritten. Rows with new keys only add a part. A table with many parts is written
anew as a whole, and so is a bucketed one at each merge.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docfold.operators.keys import FIXED_WIDTH, all_equal, renamed_keys
from docfold.operators.merge import insert_only, new_rows, not_older, reject_null_keys, upsert
from docfold.specs import Column, TableSpec

SLICE = "key_slice"
FILE = "__file"
PARTS = "docfold.parts"
#: A version of more parts, or one that leaves out more files, is written anew as a whole.
MAX_PARTS, MAX_FILES = 32, 1000


@dataclass(frozen=True)
class Part:
    """A data table without the rows of some files and slices."""

    data: str
    files: tuple[str, ...] = ()
    slices: tuple[int, ...] = ()

    def condition(self) -> str:
        listed = [f"_metadata.file_name NOT IN ({', '.join(repr(f) for f in self.files)})"] if self.files else []
        listed += [f"{SLICE} NOT IN ({', '.join(map(str, self.slices))})"] if self.slices else []
        return " AND ".join(listed) or "true"


def parts_for(spark: SparkSession, path: str, part_bytes: int = 1 << 30, at_least: int = 8) -> int:
    """Number of buckets or slices for a table about as large as the files at ``path``; only their sizes are read."""
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(at_least, -(-size // part_bytes))


def create_database(spark: SparkSession, database: str, folder: str | None = None) -> None:
    location = f" LOCATION '{folder}'" if folder else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{location}")


def versions(spark: SparkSession, database: str, table: str) -> list[int]:
    """Version numbers of a table, oldest first."""
    names = [r.tableName for r in spark.sql(f"SHOW TABLES IN `{database}` LIKE '{table}__v*'").collect()]
    found = [re.fullmatch(rf"{re.escape(table)}__v(\d+)", n) for n in names]
    return sorted(int(m.group(1)) for m in found if m)


def scan(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Current rows, pinned to the version that is current now."""
    known = versions(spark, database, table)
    return spark.table(f"`{database}`.`{table}__v{known[-1]}`" if known else f"`{database}`.`{table}`")


def parts_of(spark: SparkSession, database: str, table: str, version: int) -> list[Part]:
    """What a version is made of."""
    held = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES `{database}`.`{table}__v{version}`").collect()}
    return [Part(p["data"], tuple(p["files"]), tuple(p["slices"])) for p in json.loads(held[PARTS])]


def _with_files(spark: SparkSession, database: str, parts: Sequence[Part]) -> DataFrame:
    """Rows of the parts, each with its file as ``data table/file name``, of a sliced table ``data table/slice/file name``."""
    within = F.regexp_extract(F.col("_metadata.file_path"), f"((?:{SLICE}=[^/]*/)?[^/]+)$", 1)
    frames = [spark.table(f"`{database}`.`{p.data}`").where(p.condition()).select("*", F.concat(F.lit(f"{p.data}/"), within).alias(FILE)) for p in parts]
    whole = frames[0]
    for more in frames[1:]:
        whole = whole.unionByName(more)
    return whole


def files(spark: SparkSession, database: str, table: str) -> list[str]:
    """Files of the current version that hold rows, with their data table."""
    parts = parts_of(spark, database, table, versions(spark, database, table)[-1])
    return sorted(r[0] for r in _with_files(spark, database, parts).select(FILE).distinct().collect())


def create_table(spark: SparkSession, database: str, spec: TableSpec) -> None:
    """Publishes an empty version and drops all earlier ones. Numbers go on, so a writer that has read one of those is refused."""
    while True:
        known = versions(spark, database, spec.name)
        version = (known[-1] if known else 0) + 1
        data = _declare(spark, database, spec, version)
        try:
            _publish(spark, database, spec, version, [Part(data)])
        except ConcurrentWriteError:
            continue
        break
    drop_old_versions(spark, database, spec, keep=1)


class ConcurrentWriteError(Exception):
    """Another writer published a version after the one this write was computed from."""


def replace_table(
    spark: SparkSession, database: str, spec: TableSpec, df: DataFrame, colocated: bool = False, base: int | None = None
) -> int:
    """Stores ``df`` as the new version; returns its number of rows. Columns it lacks get their default.

    Required columns and text widths are enforced while writing; a required column without default must be there.
    ``colocated`` says that ``df`` is already partitioned into the table's buckets. ``base`` is the version that ``df``
    was computed from, the newest one if not given: the write fails if another one is published before it.
    """
    base = _base(spark, database, spec) if base is None else base
    rows = enforce_required(completed(df, spec), spec)
    _still(spark, database, spec, base)
    if spec.buckets and not colocated:
        rows = rows.repartition(spec.buckets, *spec.key)
    if spec.ranges:
        rows = rows.repartitionByRange(spec.ranges, *spec.key)
    return _write(spark, database, spec, rows, base, [])


def _write(spark: SparkSession, database: str, spec: TableSpec, rows: DataFrame, base: int, kept: Sequence[Part]) -> int:
    """Stores rows in a data table of their own and publishes it, beside the ``kept`` parts, as the version after ``base``.

    Returns how many rows were written, as observed by the write itself: behind the last shuffle, where each task counts once.
    """
    rows = _by_slice(rows, spec) if spec.slices else rows
    data = _declare(spark, database, spec, base + 1)
    try:
        names = ", ".join(f"`{c}`" for c in [*spec.column_names, SLICE] if c in rows.columns)
        counted = Observation()
        rows = rows.observe(counted, F.count(F.lit(1)).alias("n"))
        spark.sql(f"INSERT INTO `{database}`.`{data}` BY NAME SELECT {names} FROM {{rows}}", rows=rows)
        _publish(spark, database, spec, base + 1, [*kept, Part(data)])
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{data}`")
        raise
    return counted.get["n"]


def _base(spark: SparkSession, database: str, spec: TableSpec) -> int:
    known = versions(spark, database, spec.name)
    return known[-1] if known else 0


def _still(spark: SparkSession, database: str, spec: TableSpec, base: int) -> None:
    """Spares a writer that is too late the writing; what decides is :func:`_publish`."""
    newest = _base(spark, database, spec)
    if newest != base:
        raise ConcurrentWriteError(f"{spec.name}: version {newest} was published after version {base} had been read")


def completed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` with the default of each column it lacks; refused if it lacks a required one that has none."""
    lacking = [c for c in spec.columns if c.name not in df.columns]
    needed = [c.name for c in lacking if c.required and c.default is None]
    if needed:
        raise ValueError(f"{spec.name}: the source has no column {', '.join(needed)}")
    return df.withColumns({c.name: F.expr(c.default).cast(c.type) for c in lacking if c.default is not None})


def upsert_table(
    spark: SparkSession,
    database: str,
    spec: TableSpec,
    source: DataFrame,
    update_cols: Sequence[str] | None = None,
    newest_by: str | None = None,
) -> int:
    """Keyed upsert into a stored table; returns how many rows were written, those of rewritten files and slices included.

    With buckets, only the source is shuffled: the stored side is read bucket by bucket. With slices, only the touched
    ones are read and rewritten. An empty table just takes the source. Columns that the source lacks keep their value in
    updated rows and get their default in inserted ones. Stored rows that share a key are all updated. With ``newest_by``, a row
    that is stored with a greater value of that column stays as it is, so batches may come in any order and more than once.
    """
    given = [c for c in spec.column_names if c in source.columns and c not in spec.key]
    changed = given if update_cols is None else list(update_cols)
    unknown = set(changed) - set(source.columns)
    if unknown:
        raise ValueError(f"the source has no column {', '.join(sorted(unknown))}")
    source = completed(source, spec)
    base = versions(spark, database, spec.name)[-1]
    stored = spark.table(f"`{database}`.`{spec.name}__v{base}`")
    if newest_by:
        source = not_older(stored.where(_bounds(source, spec)), source, spec.key, newest_by)
    if stored.isEmpty():
        return replace_table(spark, database, spec, source, base=base)
    every = set(changed) == set(spec.column_names) - set(spec.key)
    columns = None if every else changed

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        return upsert(old, new, spec.key, columns, target_keyed=False)

    if spec.buckets:
        merged = merge(stored, source.repartition(spec.buckets, *spec.key))
        return replace_table(spark, database, spec, merged, colocated=every, base=base)
    parts = parts_of(spark, database, spec.name, base)
    touched = _touched_slices(spark, database, spec, parts, source) if spec.slices else _touched_files(spark, database, spec, parts, source)
    if touched is None:
        return replace_table(spark, database, spec, merge(stored, source), base=base)
    old, kept, n = touched
    rows = enforce_required(merge(old.select(*spec.column_names), source), spec)
    return _write(spark, database, spec, rows.repartitionByRange(n + 1, *spec.key) if spec.ranges else rows, base, kept)


def insert_only_table(spark: SparkSession, database: str, spec: TableSpec, source: DataFrame) -> int:
    """Adds the source rows with a new key to a stored table. Columns the source lacks get their default.

    Without buckets nothing is rewritten: the new rows are a part of their own. Returns how many rows were written.
    """
    source = completed(source, spec)
    base = versions(spark, database, spec.name)[-1]
    stored = spark.table(f"`{database}`.`{spec.name}__v{base}`")
    if stored.isEmpty():
        return replace_table(spark, database, spec, source, base=base)
    if spec.buckets:
        merged = insert_only(stored, source.repartition(spec.buckets, *spec.key), spec.key)
        return replace_table(spark, database, spec, merged, colocated=True, base=base)
    parts = parts_of(spark, database, spec.name, base)
    if len(parts) >= MAX_PARTS:
        return replace_table(spark, database, spec, insert_only(stored, source, spec.key), base=base)
    if spec.slices:
        stored = _with_files(spark, database, parts).where(F.col(SLICE).isin(_slices_with(source, spec)))
    else:
        stored = stored.where(_bounds(source, spec))
    new = new_rows(stored.select(*spec.column_names), source, spec.key).select(*spec.column_names)
    return _write(spark, database, spec, enforce_required(new, spec), base, parts)


def _slices_with(source: DataFrame, spec: TableSpec) -> list[int]:
    """Slices that hold a complete key of the source; at most ``spec.slices`` numbers. As literals they prune the stored side's files."""
    keyed, _ = reject_null_keys(source, spec.key)
    return sorted(r[0] for r in keyed.select(_slice_of(spec)).distinct().collect())


def _touched_slices(spark, database, spec, parts, source) -> tuple[DataFrame, list[Part], int] | None:
    """Rows of the slices that a merge rewrites, and the parts without them; None if there are too many parts."""
    if len(parts) >= MAX_PARTS:
        return None
    touched = _slices_with(source, spec)
    kept = [Part(p.data, p.files, tuple(sorted({*p.slices, *touched}))) for p in parts]
    old = _with_files(spark, database, parts).where(F.col(SLICE).isin(touched))
    return old, [p for p in kept if len(p.slices) < spec.slices], len(touched)


def _bounds(source: DataFrame, spec: TableSpec):
    """Condition on the first key column that holds for every row the source can match; Parquet skips what its statistics rule out."""
    first = spec.key[0]
    kind = source.schema[first].dataType.simpleString()
    if kind not in FIXED_WIDTH and kind != "string":
        return F.lit(True)
    low, high = source.agg(F.min(first), F.max(first)).first()
    return F.lit(False) if low is None else F.col(first).between(low, high)


def _touched_files(spark, database, spec, parts, source) -> tuple[DataFrame, list[Part], int] | None:
    """Rows of the files that hold a key of the source, and the parts without those files.

    None if that is more than ``MAX_FILES`` or half of all files, or if there are too many parts: then the table is better written anew.
    """
    if len(parts) >= MAX_PARTS:
        return None
    stored = _with_files(spark, database, parts)
    listed = {p.data: {path.rsplit("/", 1)[-1] for path in spark.table(f"`{database}`.`{p.data}`").inputFiles()} - {*p.files} for p in parts}
    every = {f"{data}/{name}" for data, names in listed.items() for name in names}
    incoming, names = renamed_keys(source, spec.key)
    found = stored.where(_bounds(source, spec)).join(incoming, all_equal(spec.key, names), "left_semi")
    touched = [r[0] for r in found.select(FILE).distinct().limit(MAX_FILES + 1).collect()]
    gone = {p.data: sorted({*p.files, *(t.split("/", 1)[1] for t in touched if t.startswith(f"{p.data}/"))}) for p in parts}
    if len(touched) > len(every) / 2 or sum(map(len, gone.values())) > MAX_FILES:
        return None
    left = {name.split("/", 1)[0] for name in every - set(touched)}
    kept = [Part(p.data, tuple(gone[p.data])) for p in parts if p.data in left]
    return _of_files(spark, database, parts, touched), kept, len(touched)


def _of_files(spark: SparkSession, database: str, parts: Sequence[Part], touched: Sequence[str]) -> DataFrame:
    """Rows of the given files; others are not opened, as the condition is on their names."""
    whole = None
    for p in parts:
        own = [t.split("/", 1)[1] for t in touched if t.startswith(f"{p.data}/")]
        rows = spark.table(f"`{database}`.`{p.data}`").where(p.condition()).where(F.col("_metadata.file_name").isin(own))
        whole = rows if whole is None else whole.unionByName(rows)
    return whole


def _slice_of(spec: TableSpec):
    """Slice of a row. Rows without a complete key match nothing, wherever they lie, so they are spread by all their columns."""
    incomplete = F.lit(False)
    for k in spec.key:
        incomplete = incomplete | F.col(k).isNull()
    spread = F.xxhash64(*[F.col(c) for c in spec.column_names])
    return F.pmod(F.when(incomplete, spread).otherwise(F.xxhash64(*spec.key)), F.lit(spec.slices)).cast("int").alias(SLICE)


def _by_slice(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows with their slice as the last column, each slice in one task."""
    return rows.select("*", _slice_of(spec)).repartition(SLICE)


def drop_old_versions(spark: SparkSession, database: str, spec: TableSpec, keep: int = 2) -> list[int]:
    """Keeps the newest ``keep`` versions; running readers need the one before the current. Returns the numbers dropped.

    Data tables that no kept version uses go as well, unless they may still be published: those of the version to come.
    """
    known = versions(spark, database, spec.name)
    old, kept = known[: -max(keep, 1)], known[-max(keep, 1) :]
    used = {p.data for v in kept for p in parts_of(spark, database, spec.name, v)}
    for v in old:
        spark.sql(f"DROP VIEW IF EXISTS `{database}`.`{spec.name}__v{v}`")
    for r in spark.sql(f"SHOW TABLES IN `{database}` LIKE '{spec.name}__d*'").collect():
        m = re.fullmatch(rf"{re.escape(spec.name)}__d(\d+)_[0-9a-f]+", r.tableName)
        if m and r.tableName not in used and known and int(m.group(1)) <= known[-1]:
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{r.tableName}`")
    return old


def enforce_required(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` failing at run time on a NULL in a required column, which Parquet tables would store."""

    def column(c: Column):
        if not c.required:
            return F.col(c.name)
        message = F.lit(f"{spec.name}.{c.name} must not be NULL")
        return F.when(F.col(c.name).isNull(), F.raise_error(message)).otherwise(F.col(c.name)).alias(c.name)

    return df.select(*[column(c) for c in spec.columns if c.name in df.columns])


def _declare(spark: SparkSession, database: str, spec: TableSpec, version: int) -> str:
    """An empty data table for a version, under a name that no other writer has."""
    columns = ", ".join(
        f"`{c.name}` {c.sql_type}{' NOT NULL' if c.required else ''}{f' DEFAULT {c.default}' if c.default else ''}"
        for c in spec.columns
    )
    layout = ""
    if spec.slices:
        columns += f", {SLICE} int"
        layout = f" PARTITIONED BY ({SLICE})"
    if spec.buckets:
        keys = ", ".join(f"`{k}`" for k in spec.key)
        layout = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {spec.buckets} BUCKETS"
    data = f"{spec.name}__d{version}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE `{database}`.`{data}` ({columns}) USING parquet{layout}")
    return data


def _publish(spark: SparkSession, database: str, spec: TableSpec, version: int, parts: Sequence[Part]) -> None:
    """Creates the view of a version; the catalog lets one writer do so. Then the table's own view follows the newest version."""
    names = ", ".join(f"`{c}`" for c in spec.column_names)
    rows = " UNION ALL ".join(f"SELECT {names} FROM `{database}`.`{p.data}` WHERE {p.condition()}" for p in parts)
    held = json.dumps([{"data": p.data, "files": p.files, "slices": p.slices} for p in parts])
    try:
        spark.sql(f"CREATE VIEW `{database}`.`{spec.name}__v{version}` TBLPROPERTIES ('{PARTS}' = '{held}') AS {rows}")
    except AnalysisException as e:
        if e.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
            raise
        raise ConcurrentWriteError(f"{spec.name}: version {version} was published after version {version - 1} had been read") from e
    newest = version
    while True:
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{spec.name}` AS SELECT {names} FROM `{database}`.`{spec.name}__v{newest}`")
        known = versions(spark, database, spec.name)
        if not known or known[-1] <= newest:
            break
        newest = known[-1]  # another writer was between the two views
