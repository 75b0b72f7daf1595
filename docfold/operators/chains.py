"""Pages as chains: following ``next`` from page to page without walking along it.

Where the walk along a chain takes as many steps as it has pages, pointer doubling takes the logarithm: every page looks up
where its pointer points and takes that page's pointer instead, so after k rounds it is 2**k pages on and knows how far
it is from the end. A page that reaches no end within the logarithm of its entity's pages lies on a cycle or leads into one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.operators.keys import ROWS, all_equal, looked_up
from docfold.session import written


def page_chain(pages: DataFrame, entity_cols: Sequence[str], page_col: str, next_col: str) -> DataFrame:
    """Per entity and page: ``next``, ``found`` (whether that page exists), ``linked`` (pages that name this one), ``__rows``,
    ``variants`` (different values of ``next`` among its copies) and ``steps`` to the end, NULL where none is ever reached.

    Of several copies of a page the least ``next`` counts. A page whose ``next`` does not exist ends its chain. Pages without
    a number are left out.
    """
    entity, node = list(entity_cols), [*entity_cols, page_col]
    link = F.col(next_col)
    nodes = pages.where(F.col(page_col).isNotNull()).groupBy(*node).agg(
        F.min(link).alias("next"), F.count(F.lit(1)).alias(ROWS), (F.count_distinct(link) + F.max(link.isNull().cast("int"))).alias("variants")
    )
    nodes = written(nodes, "pages")
    linked = nodes.where("next is not null").groupBy(*entity, "next").agg(F.count(F.lit(1)).alias("linked"))
    linked = linked.select(*entity, F.col("next").alias(page_col), "linked")
    nodes = nodes.join(linked, node, "left").withColumn("linked", F.coalesce("linked", F.lit(0)))
    there = nodes.select(*entity, F.col(page_col).alias("next"), F.lit(True).alias("found"))
    nodes = written(looked_up(nodes, there, [*entity, "next"]).withColumn("found", F.coalesce("found", F.lit(False))), "links")

    pointer = F.when(F.col("found"), F.col("next"))
    state = nodes.select(*node, pointer.alias("at"), F.col("found").cast("bigint").alias("steps"))
    most = nodes.groupBy(*entity).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(max(most - 1, 0).bit_length()):
        target = state.select(*entity, F.col(page_col).alias("at"), F.col("at").alias("__at"), F.col("steps").alias("__steps"))
        moving = looked_up(state.where("at is not null"), target, [*entity, "at"])
        moving = moving.select(*node, F.col("__at").alias("at"), (F.col("steps") + F.col("__steps")).alias("steps"))
        state = written(state.where("at is null").unionByName(moving), "chain")
        if not state.where("at is not null").take(1):
            break
    ranked = state.select(*[F.col(c).alias(f"__n{i}") for i, c in enumerate(node)], F.when(F.col("at").isNull(), F.col("steps")).alias("steps"))
    same = all_equal(node, [f"__n{i}" for i in range(len(node))], null_safe=True)
    return nodes.join(ranked, same).select(*node, "next", "found", "linked", ROWS, "variants", "steps")


def chain_faults(chain: DataFrame, entity_cols: Sequence[str], page_col: str) -> DataFrame:
    """Per entity, ``pages`` and ``chain_length`` (pages from the first one to the end, NULL if it has none), and what keeps its pages
    from being one chain, each as a number of pages.

    ``heads`` counts pages but the first that nothing links to, ``ends`` those but one that end properly, ``merged`` links to a page that another
    one links to as well, ``dangling`` links to pages that are not there, ``cyclic`` pages that lead to no end, ``misnumbered`` links that skip
    or go back, ``repeated`` further copies of pages, and ``conflicting`` pages whose copies link to different ones.
    """
    entity = list(entity_cols)
    first = F.min(page_col)
    steps = F.min_by("steps", page_col)
    count = lambda condition: F.count_if(condition)
    return chain.groupBy(*entity).agg(
        F.count(F.lit(1)).alias("pages"),
        (steps + 1).alias("chain_length"),
        (count(F.col("linked") == 0) - F.when(F.min_by("linked", page_col) == 0, 1).otherwise(0)).alias("heads"),
        F.abs(count(F.col("next").isNull()) - 1).alias("ends"),
        F.coalesce(F.sum(F.greatest(F.col("linked") - 1, F.lit(0))), F.lit(0)).alias("merged"),
        count(F.col("next").isNotNull() & ~F.col("found")).alias("dangling"),
        count(F.col("steps").isNull()).alias("cyclic"),
        count(F.col("next") != F.col(page_col) + 1).alias("misnumbered"),
        F.sum(F.col(ROWS) - 1).alias("repeated"),
        count(F.col("variants") > 1).alias("conflicting"),
        first.alias("first_page"),
    )
