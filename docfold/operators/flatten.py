"""From raw documents to flat columns and bridge rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.functions.documents import field, is_present
from docfold.functions.timing import load_time
from docfold.specs import BridgeSpec, FlattenSpec


def flatten(
    raw: DataFrame, spec: FlattenSpec, doc: str = "raw_data", strict: bool = True, load_ts=None, carry: Mapping[str, str] | None = None
) -> DataFrame:
    """One flat row per document, one typed column per declared path. ``carry`` names columns of ``raw`` that go along, as ``{new: old}``."""
    columns = [field(doc, f.path, f.type, strict).alias(f.column) for f in spec.fields]
    if spec.stamp:
        columns.append(load_time(load_ts).alias(spec.stamp))
    return raw.select(*columns, *[F.col(old).alias(new) for new, old in (carry or {}).items()])


def cast_rejects(raw: DataFrame, spec: FlattenSpec, doc: str = "raw_data") -> DataFrame:
    """Documents with a value that does not fit its declared type, and the columns concerned."""
    bad = [
        F.when(is_present(field(doc, f.path, "variant")) & field(doc, f.path, f.type, strict=False).isNull(), F.lit(f.column))
        for f in spec.fields
    ]
    return raw.withColumn("bad_columns", F.array_compact(F.array(*bad))).where(F.size("bad_columns") > 0)


def elements(raw: DataFrame, array_path: str, doc: str = "raw_data") -> DataFrame:
    """One row per array element beside the other columns: ``doc`` gives way to ``pos``, ``key`` and ``value``.

    The array is cut out before it is exploded, so a stored document is read for that array alone. Documents with an
    empty or missing array drop out, after the explosion: a filter before it would make Spark parse a document that is
    still text twice.
    """
    others = [c for c in raw.columns if c != doc]
    arrays = raw.select(*others, F.variant_get(doc, array_path, "variant").alias("__array"))
    exploded = arrays.lateralJoin(raw.sparkSession.tvf.variant_explode_outer(F.col("__array").outer()))
    return exploded.where(F.col("pos").isNotNull()).drop("__array")


def bridge(raw: DataFrame, spec: BridgeSpec, doc: str = "raw_data", strict: bool = True, load_ts=None) -> DataFrame:
    """Distinct (parent, child) pairs from an array of references.

    The parent key is read once per document, before the explosion. Duplicates are removed before the shuffle as well
    as after it. A reference without a key gives a NULL child, which ``reject_null_keys`` routes away.
    """
    parent = field(doc, spec.parent.path, spec.parent.type, strict).alias(spec.parent.column)
    pairs = (
        elements(raw.select(parent, doc), spec.array_path, doc)
        .where(is_present("value"))
        .select(spec.parent.column, _child_key(spec, strict).alias(spec.child_column))
        .dropDuplicates([spec.parent.column, spec.child_column])
    )
    return pairs.withColumn(spec.stamp, load_time(load_ts)) if spec.stamp else pairs


def _child_key(spec: BridgeSpec, strict: bool) -> Column:
    text = field("value", "$", "string", strict)
    if spec.pattern is not None:
        text = F.regexp_substr(text, F.lit(spec.pattern))
    return text.cast(spec.child_type) if strict else text.try_cast(spec.child_type)
