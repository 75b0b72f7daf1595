"""Keyed upsert and insert-only merge as relational plans.

Equality follows SQL MERGE: a NULL key matches nothing, so such a source row is inserted by every run. Route those rows
away first with :func:`reject_null_keys`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.operators.keys import ROWS, all_equal, key_counts, renamed_keys

ACTIONS = ("update", "insert", "keep")


def reject_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a complete key, rows without).

    Missing parts are counted in one expression. As separate conditions, the one on a parent key would be pushed below
    the explosion of its document and parse that document a second time.
    """
    missing = sum((F.col(k).isNull().cast("int") for k in keys), F.lit(0))
    return df.where(missing == 0), df.where(missing > 0)


def merge_conflicts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that several source rows want to update: the merge would be ambiguous."""
    stored, names = renamed_keys(target, keys)
    repeated = key_counts(source, keys).where(F.col(ROWS) > 1)
    return repeated.join(stored, all_equal(keys, names), "left_semi")


def guarded(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source``, failing at run time if a stored key is updated more than once."""
    clashes = merge_conflicts(target, source, keys).agg(F.count(F.lit(1))).scalar()
    return source.where(F.when(clashes > 0, F.raise_error(_clash_message(keys))).otherwise(F.lit(True)))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    target_keyed: bool = True,
    check_source: bool = True,
) -> DataFrame:
    """Matched rows take the source's values, NULLs included; other source rows are inserted; other target rows stay.

    If every non-key column is updated, the result is the source plus the target rows it does not touch, found by one
    join against the source's keys. A target that may hold a key several times (``target_keyed`` off) also keeps that
    number of rows. Otherwise stored rows are joined with the source, a marker telling a missing row from a NULL value, and rows with
    new keys are added; rows with a NULL key match nothing and stay out of both. Several source rows for one stored row fail the merge at
    run time, unless ``check_source`` is off.
    """
    keys = list(keys)
    rest = [c for c in target.columns if c not in keys]
    changed = rest if update_cols is None else list(update_cols)
    unknown = set(update_cols or ()) - set(source.columns)
    if unknown:
        raise ValueError(f"the source has no column {', '.join(sorted(unknown))}")
    if set(changed) == set(rest) and set(rest) <= set(source.columns):
        merged = source.select(*target.columns).unionByName(_untouched(target, source, keys, check_source))
        return merged if target_keyed else merged.unionByName(_further(target, source, keys))
    source = guarded(target, source, keys) if check_source else source
    return _tagged_upsert(target, source, keys, rest, changed)


def _untouched(target, source, keys, check_source) -> DataFrame:
    """Target rows without a source row. The check counts source rows per key on the way into the same join."""
    if not check_source:
        incoming, names = renamed_keys(source, keys)
        return target.join(incoming, all_equal(keys, names), "left_anti")
    names = [f"__key{i}" for i in range(len(keys))]
    incoming = key_counts(source, keys).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], ROWS)
    stays = F.when(F.col(ROWS) > 1, F.raise_error(_clash_message(keys))).otherwise(F.col(ROWS).isNull())
    return target.join(incoming, all_equal(keys, names), "left").where(stays).select(*target.columns)


def _further(target, source, keys) -> DataFrame:
    """The source rows of keys that the target holds several times, once for each stored row but the first."""
    names = [f"__key{i}" for i in range(len(keys))]
    repeated = key_counts(target, keys).where(F.col(ROWS) > 1).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], ROWS)
    matched = source.select(*target.columns).join(repeated, all_equal(keys, names))
    return matched.select(*target.columns, F.explode(F.sequence(F.lit(2).cast("bigint"), F.col(ROWS))).alias("__n")).drop("__n")


def _clash_message(keys):
    return F.lit(f"several source rows update the same target row, key {', '.join(keys)}")


def _tagged_upsert(target, source, keys, rest, changed) -> DataFrame:
    """Stored rows look up what changes them, and rows with new keys are added. Neither join has to keep the rows of both sides, so a small
    source is broadcast and a skewed key can be split."""
    shared = [c for c in rest if c in source.columns]
    taken = [c for c in changed if c in shared]
    target, loose = reject_null_keys(target, keys)
    source, unkeyed = reject_null_keys(source, keys)
    incoming = source.select(*[F.col(c).alias(f"__s_{c}") for c in [*keys, *taken]], F.lit(True).alias("__s"))
    both = target.join(incoming, all_equal(keys, [f"__s_{k}" for k in keys]), "left")
    value = lambda c: F.when(F.col("__s").isNotNull(), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in taken else F.col(c)
    new = new_rows(target, source, keys).unionByName(unkeyed)
    new = new.select(*keys, *[(F.col(c) if c in shared else F.lit(None).cast(target.schema[c].dataType)).alias(c) for c in rest])
    return both.select(*map(value, target.columns)).unionByName(loose).unionByName(new)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows as they are, plus the source rows with a new key."""
    return target.unionByName(new_rows(target, source, keys).select(*target.columns))


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows with a key that the target does not hold."""
    stored, names = renamed_keys(target, keys)
    return source.join(stored, all_equal(keys, names), "left_anti")


def not_older(target: DataFrame, source: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """One source row per key, that of the greatest ``stamp``, unless the target holds the key with a greater one.

    A NULL stamp is older than any other. Rows with a NULL key match nothing and all stay. Of equal stamps the row that is greater as a whole
    counts, so the order of the source does not matter.
    """
    keyed, loose = reject_null_keys(source, keys)
    row = F.struct(stamp, *[c for c in source.columns if c != stamp])
    keyed = keyed.groupBy(*keys).agg(F.max(row).alias("__row")).select("__row.*").select(*source.columns)
    names = [f"__key{i}" for i in range(len(keys))]
    held = target.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.max(stamp).alias("__held"))
    joined = keyed.join(held, all_equal(keys, names), "left")
    late = F.coalesce(F.col(stamp) < F.col("__held"), F.col("__held").isNotNull())
    return joined.where(~late).select(*source.columns).unionByName(loose)


def upsert_actions(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(action, n)``: how many rows a merge updates, inserts and keeps.

    Both sides are counted per key before they meet.
    """
    keys = list(keys)
    old = key_counts(target, keys).select(*[F.col(k).alias(f"__t{i}") for i, k in enumerate(keys)], F.col(ROWS).alias("__old"))
    new = key_counts(source, keys).select(*[F.col(k).alias(f"__s{i}") for i, k in enumerate(keys)], F.col(ROWS).alias("__new"))
    pairs = range(len(keys))
    both = old.join(new, all_equal([f"__t{i}" for i in pairs], [f"__s{i}" for i in pairs]), "full_outer")
    has_old, has_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    totals = both.agg(
        F.sum(F.when(has_old & has_new, F.col("__old"))).alias("update"),
        F.sum(F.when(~has_old, F.col("__new"))).alias("insert"),
        F.sum(F.when(~has_new, F.col("__old"))).alias("keep"),
    )
    rows = F.array(*[F.struct(F.lit(a).alias("action"), F.coalesce(F.col(a), F.lit(0)).alias("n")) for a in ACTIONS])
    return totals.select(F.inline(rows))
