"""Choosing, keeping and auditing snapshots and pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docfold.operators.keys import ROWS, all_equal, key_counts, rows_with_keys

PAGE_BLOCK = 1000


def retain_snapshots(df: DataFrame, entity_cols: Sequence[str], order_col: str, keep: int = 1) -> DataFrame:
    """Rows of the ``keep`` newest snapshots of each entity.

    Ranking runs over one row per (entity, snapshot), so rows are never sorted; the kept snapshots are then matched
    back by :func:`rows_with_keys`, which does not shuffle the rows of a dominant snapshot.
    """
    keys = [*entity_cols, order_col]
    counted = key_counts(df, keys)
    if entity_cols:
        newest = Window.partitionBy(*entity_cols).orderBy(F.desc(order_col))
        kept = counted.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= keep).drop("__rank")
    else:
        kept = counted.orderBy(F.desc(order_col)).limit(keep)
    return rows_with_keys(df, kept, keys)


def latest_snapshot(df: DataFrame, entity_cols: Sequence[str], order_col: str) -> DataFrame:
    """Rows of the newest snapshot of each entity."""
    if entity_cols:
        return retain_snapshots(df, entity_cols, order_col, keep=1)
    return df.where(F.col(order_col) == df.agg(F.max(order_col)).scalar())


def union_pages(pages: DataFrame, keep: Sequence[str], results: str = "results") -> DataFrame:
    """Records of all pages, one row each: the ``keep`` columns, position on the page, and the record."""
    return pages.select(*keep, F.posexplode(results).alias("pos", "record"))


def page_counts(
    pages: DataFrame, entity_cols: Sequence[str], page_col: str, records: str, block: int = PAGE_BLOCK
) -> DataFrame:
    """Records per page and in total so far: ``(entity..., page, records, total_so_far)``.

    Pages are summed first. The running total is then taken inside blocks of ``block`` page numbers, each shifted by
    the total of the blocks before it, so no task walks through all pages of a long entity.
    """
    entity = list(entity_cols)
    per_page = (
        pages.groupBy(*entity, page_col)
        .agg(F.sum(records).alias("records"))
        .withColumn("__block", F.floor(F.col(page_col) / block))
    )
    before = Window.partitionBy(*entity).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        per_page.groupBy(*entity, "__block")
        .agg(F.sum("records").alias("__sum"))
        .withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
        .drop("__sum")
    )
    so_far = Window.partitionBy(*entity, "__block").orderBy(page_col)
    place, names = [*entity, "__block"], [f"__b_{c}" for c in [*entity, "__block"]]
    blocks = blocks.select(*[F.col(c).alias(n) for c, n in zip(place, names)], "__before")
    return (
        per_page.withColumn("__running", F.sum("records").over(so_far))
        .join(blocks, all_equal(place, names, null_safe=True))
        .select(*entity, page_col, "records", (F.col("__running") + F.col("__before")).alias("total_so_far"))
    )


def page_audit(pages: DataFrame, entity_cols: Sequence[str], page_col: str, records: str) -> DataFrame:
    """Per entity: pages seen, first and last page, missing and repeated pages, records.

    A page is counted once before its entity is, so the distinct count needs no second shuffle of the raw pages.
    """
    entity = list(entity_cols)
    per_page = pages.groupBy(*entity, page_col).agg(F.count(F.lit(1)).alias(ROWS), F.sum(records).alias("records"))
    return per_page.groupBy(*entity).agg(
        F.count(F.lit(1)).alias("pages"),
        F.min(page_col).alias("first_page"),
        F.max(page_col).alias("last_page"),
        (F.max(page_col) - F.min(page_col) + 1 - F.count(F.lit(1))).alias("missing_pages"),
        F.sum(F.col(ROWS) - 1).alias("repeated_pages"),
        F.sum("records").alias("records"),
    )


def page_faults(pages: DataFrame, entity_cols: Sequence[str], page_col: str, next_col: str, results_col: str) -> DataFrame:
    """Per entity, what keeps its pages from being one whole chain, each as a number of pages.

    A chain runs from page 1 through every number to the one page whose ``next`` is null, and each page has results.
    """
    entity = list(entity_cols)
    ends, empty = F.col(next_col).isNull(), F.col(results_col).isNull()
    per_page = pages.groupBy(*entity, page_col).agg(
        F.count(F.lit(1)).alias(ROWS), F.bool_or(ends).alias("__ends"), F.bool_or(empty).alias("__empty")
    )
    last, n = F.max(page_col), F.count(page_col)
    return per_page.groupBy(*entity).agg(
        F.coalesce(last - n, F.lit(0)).alias("missing_pages"),
        F.when(F.max_by("__ends", page_col), 0).otherwise(1).alias("unfinished"),
        (F.count_if("__ends") - F.coalesce(F.max_by("__ends", page_col).cast("int"), F.lit(0))).alias("early_ends"),
        F.sum(F.col(ROWS) - 1).alias("repeated_pages"),
        F.count_if("__empty").alias("without_results"),
        F.count_if(F.col(page_col).isNull() | (F.col(page_col) < 1)).alias("unnumbered"),
    )
