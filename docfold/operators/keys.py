"""Keyed building blocks that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = "__rows"
HOT_KEYS = 1000
FIXED_WIDTH = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz"}


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with its number of rows; NULL keys form one group.

    Partial counts are made before the shuffle, so a hot key costs one row per task. Every check on the same table
    and key uses this same plan, which lets Spark reuse one exchange for all of them.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))


def narrow(df: DataFrame, column: str) -> Column:
    """The column, or its SHA-256 if its values have no fixed width. NULL stays NULL."""
    kind = df.schema[column].dataType.simpleString()
    if kind in FIXED_WIDTH or kind.startswith("decimal"):
        return F.col(column)
    if kind in ("string", "binary") or kind.startswith(("varchar", "char")):
        return F.sha2(F.col(column), 256)
    return F.when(F.col(column).isNotNull(), F.sha2(F.to_json(F.struct(column)), 256))


def digest(df: DataFrame, column: str, name: str = "__digest") -> DataFrame:
    """Adds the SHA-256 of a wide column, so that it can be grouped without being shuffled."""
    return df.withColumn(name, narrow(df, column))


def renamed_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Only the key columns, under names that cannot clash with the other side of a join."""
    names = [f"__key{i}" for i in range(len(keys))]
    return df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]), names


def all_equal(left: Sequence[str], right: Sequence[str], null_safe: bool = False) -> Column:
    pairs = [(F.col(a), F.col(b)) for a, b in zip(left, right)]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def rows_with_keys(rows: DataFrame, counted: DataFrame, keys: Sequence[str], hot_keys: int = HOT_KEYS) -> DataFrame:
    """Rows whose key is in ``counted``, a result of :func:`key_counts` over ``rows`` or a part of it.

    The ``hot_keys`` keys with the most rows are matched by broadcast, in a fixed width, and never shuffled. A key outside
    them holds at most ``1 / (hot_keys + 1)`` of the matched rows, so the shuffled rest is balanced. The order is total,
    so both branches see the same hot keys even when they are recomputed.
    """
    keys = list(keys)
    wanted, names = renamed_keys(counted, keys)
    largest = counted.orderBy(F.desc(ROWS), *keys).limit(hot_keys)
    hot = F.broadcast(largest.select(*[narrow(counted, k).alias(n) for k, n in zip(keys, names)]))
    is_hot = reduce(and_, [narrow(rows, k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    hot_rows = rows.join(hot, is_hot, "left_semi")
    rest = rows.join(hot, is_hot, "left_anti").join(wanted, all_equal(keys, names, null_safe=True), "left_semi")
    return hot_rows.unionByName(rest)


def looked_up(rows: DataFrame, values: DataFrame, keys: Sequence[str], hot_keys: int = HOT_KEYS) -> DataFrame:
    """``rows`` with the other columns of ``values``, which has one row per key; NULL where it has none.

    Keys that very many rows share are matched by broadcast, a bounded list as in :func:`rows_with_keys`, so the shuffled rest is balanced
    without help from adaptive execution. A NULL key matches nothing.
    """
    keys = list(keys)
    counted = key_counts(rows.where(reduce(and_, [F.col(k).isNotNull() for k in keys])), keys)
    hot = counted.where(F.col(ROWS) > 1).orderBy(F.desc(ROWS), *keys).limit(hot_keys).select(*keys)
    if not hot.take(1):
        return rows.join(values, keys, "left").select(*rows.columns, *[c for c in values.columns if c not in keys])
    others = [c for c in values.columns if c not in keys]
    hot = F.broadcast(hot.join(values, keys, "left").withColumn("__hot", F.lit(True)))
    flagged = rows.join(hot, keys, "left")
    rest = flagged.where(F.col("__hot").isNull()).select(*rows.columns).join(values, keys, "left")
    return flagged.where("__hot").select(*rows.columns, *others).unionByName(rest.select(*rows.columns, *others))


def unmatched_counts(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]) -> DataFrame:
    """Key counts of the ``left`` rows that no ``right`` row matches; a NULL key matches nothing.

    Both sides are reduced to one row per key before they meet, so neither can be skewed.
    """
    known, names = renamed_keys(key_counts(right, right_keys), right_keys)
    return key_counts(left, left_keys).join(known, all_equal(left_keys, names), "left_anti")


def linked_counts(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]) -> DataFrame:
    """``(__left, __right)``: rows per key on both sides, NULL where the other side has none.

    One join that tells what is unmatched in either direction.
    """
    sides = []
    for name, df, keys in (("left", left, left_keys), ("right", right, right_keys)):
        names = [f"__{name}_key{i}" for i in range(len(keys))]
        counted = key_counts(df, keys)
        sides.append((counted.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(ROWS).alias(f"__{name}")), names))
    (one, one_keys), (other, other_keys) = sides
    return one.join(other, all_equal(one_keys, other_keys), "full_outer").select("__left", "__right")
