"""Declarations the operators are driven by: tables, flattening, bridges and landed entities."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Column:
    """One stored column. ``width`` is the ``VARCHAR(n)`` limit of a text column."""

    name: str
    type: str = "string"
    width: int | None = None
    required: bool = False
    default: str | None = None

    @property
    def sql_type(self) -> str:
        return f"varchar({self.width})" if self.width else self.type


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    table: str
    ref_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    """A table with the keys Spark's Parquet tables cannot declare themselves.

    A large table takes one of three layouts. ``buckets`` hash-buckets the files on the key: a merge shuffles only its
    source, and rewrites the table, so it suits sources that touch most of it; key checks on it need no shuffle.
    ``slices`` partitions the table by a hash of the key: a merge rewrites only the slices its source touches, so it
    suits small sources. ``ranges`` cuts the table into files by ranges of the key: a merge rewrites only the files that hold a key of its
    source, so it suits sources that touch a stretch of keys, such as the newest. A part should fit a task; ``parts_for`` suggests a number.
    """

    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    buckets: int | None = None
    slices: int | None = None
    ranges: int | None = None

    def __post_init__(self):
        if sum(map(bool, (self.buckets, self.slices, self.ranges))) > 1:
            raise ValueError(f"{self.name}: choose buckets, slices or ranges")

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]


@dataclass(frozen=True)
class Field:
    """``path`` inside the document becomes ``column`` of Spark SQL type ``type``."""

    path: str
    column: str
    type: str = "string"


@dataclass(frozen=True)
class FlattenSpec:
    """Fields of one flat table; ``stamp`` names the load-time column, if the table has one."""

    fields: tuple[Field, ...]
    stamp: str | None = None


@dataclass(frozen=True)
class BridgeSpec:
    """Array at ``array_path`` becomes distinct (parent, child) rows.

    ``pattern`` cuts the child key out of each element's text; ``None`` takes the element itself.
    """

    parent: Field
    array_path: str
    child_column: str
    child_type: str = "bigint"
    pattern: str | None = None
    stamp: str | None = None
