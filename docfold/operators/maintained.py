"""What a merge changes in the counts that uniqueness and NOT NULL checks are about.

A check over a table counts all of it. These operators count what one merge takes away and adds: the rows it updates, before and after, and
the rows it inserts. Counts that were true before the merge are then true after it, and only the values concerned are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.operators.keys import ROWS, all_equal, key_counts, renamed_keys
from docfold.operators.merge import new_rows

VALUE, DELTA = "value", "delta"


def value_of(columns: Sequence[str]) -> Column:
    """The columns as one text that is never NULL, so that a value with a NULL can be a key as well."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``value, n`` of all rows: what the changes below are added to."""
    return key_counts(df.select(value_of(columns).alias(VALUE)), [VALUE]).select(VALUE, F.col(ROWS).alias("n"))


def value_changes(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``value, delta``: by how much an upsert of ``source`` changes the number of rows with each value of ``columns``.

    Stored rows that share a key are all updated, as the merge does; source rows with a new or NULL key are inserted. ``source`` has
    all of ``columns``. Values whose number stays as it is are left out.
    """
    keys, columns = list(keys), list(columns)
    incoming, names = renamed_keys(source, keys)
    old = target.join(incoming, all_equal(keys, names), "left_semi").select(value_of(columns).alias(VALUE), F.lit(-1).alias(DELTA))
    stored, names = renamed_keys(target, keys)
    updated = source.join(stored, all_equal(keys, names)).select(value_of(columns).alias(VALUE), F.lit(1).alias(DELTA))
    inserted = new_rows(target, source, keys).select(value_of(columns).alias(VALUE), F.lit(1).alias(DELTA))
    changes = old.unionByName(updated).unionByName(inserted).groupBy(VALUE).agg(F.sum(DELTA).alias(DELTA))
    return changes.where(F.col(DELTA) != 0)


def counts_after(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """``value, before, after`` of the values that change; ``counts`` is ``value, n``."""
    known = counts.select(F.col(VALUE).alias("__value"), F.col("n").alias("__n"))
    both = changes.join(known, F.col(VALUE) == F.col("__value"), "left")
    before = F.coalesce("__n", F.lit(0).cast("bigint"))
    return both.select(VALUE, before.alias("before"), (before + F.col(DELTA)).alias("after"))


def measure_changes(after: DataFrame) -> DataFrame:
    """One row: by how much ``n_rows`` and ``repeated`` (rows whose value another row has too, as a uniqueness check measures) change."""
    repeated = lambda c: F.when(F.col(c) > 1, F.col(c)).otherwise(0)
    total = lambda x: F.coalesce(F.sum(x), F.lit(0).cast("bigint"))
    return after.agg(total(F.col("after") - F.col("before")).alias("n_rows"), total(repeated("after") - repeated("before")).alias("repeated"))
