"""Which keys of two tables differ, found from the top down.

Both tables are reduced to one digest for each range of a whole-number key: the number of rows and two order-free sums of row hashes. Only
ranges whose digests differ are looked at again in smaller ranges, and only the rows of the last ones are compared by key.
The bounds of what differs reach the scans as plain conditions, so files of other keys are skipped by their statistics. Where both
tables are alike, one pass over each and a comparison of a few digests is all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.session import written

WIDTHS = (1 << 20, 1 << 10)


def _digests(df: DataFrame, group, columns: Sequence[str]) -> DataFrame:
    # hashes pass over NULL, so a mark tells in which column it stands; sums of decimals do not overflow
    held = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    wide = "decimal(38,0)"
    return df.groupBy(group.alias("g")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*held).cast(wide)).alias("x"), F.sum(F.xxhash64(F.lit(1), *held).cast(wide)).alias("y")
    )


def _different(left: DataFrame, right: DataFrame, group, columns: Sequence[str]) -> DataFrame:
    a = _digests(left, group, columns).toDF("g", "n", "x", "y")
    b = _digests(right, group, columns).toDF("h", "m", "u", "v")
    unlike = ~(F.col("n").eqNullSafe(F.col("m")) & F.col("x").eqNullSafe(F.col("u")) & F.col("y").eqNullSafe(F.col("v")))
    joined = a.join(b, F.col("g").eqNullSafe(F.col("h")), "full_outer").where(unlike)
    left_rows, right_rows = F.coalesce("n", F.lit(0)).alias("left_rows"), F.coalesce("m", F.lit(0)).alias("right_rows")
    return joined.select(F.coalesce("g", "h").alias("g"), left_rows, right_rows)


def differing_keys(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] | None = None, widths: Sequence[int] = WIDTHS) -> DataFrame:
    """``<key>, left_rows, right_rows`` of each key under which the tables do not hold the same rows; NULL is a key like others.

    ``columns`` are those compared, all of ``left`` if not given; rows that occur several times count as often.
    """
    columns = list(columns or left.columns)
    left, right = left.select(*columns), right.select(*columns)
    for width in widths:
        group = F.floor(F.col(key) / width).cast("bigint")
        found = written(_different(left, right, group, columns).select(F.col("g").alias("__range")), "ranges")
        low, high = found.agg(F.min("__range"), F.max("__range")).first()
        within = F.col(key).isNull() if low is None else F.col(key).isNull() | F.col(key).between(low * width, (high + 1) * width - 1)
        matched = group.eqNullSafe(F.col("__range"))
        left, right = (df.where(within).join(found, matched, "left_semi") for df in (left, right))
    return _different(left, right, F.col(key), columns).withColumnRenamed("g", key)
