"""Foreign keys by exact bitmaps of whole-number keys.

Each side is reduced to one bit per key, 32,768 keys to a bucket, before anything is shuffled: a task sends at most 4 kB for each bucket it
has met, whatever the number of its rows. A bucket in which the child has bits that the parent lacks holds orphans; only keys in
such buckets are then shuffled as rows, and where every child has its parent, none are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET = "bucket"


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """``bucket, bits`` of the distinct keys; NULL keys have no bit."""
    kept = df.where(F.col(key).isNotNull()).select(F.bitmap_bucket_number(key).alias(BUCKET), F.bitmap_bit_position(key).alias("bit"))
    return kept.groupBy(BUCKET).agg(F.bitmap_construct_agg("bit").alias("bits"))


def orphan_buckets(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """``bucket, orphans``: the number of different child keys without a parent, where there are any."""
    known = key_bitmaps(parent, parent_key)
    both = key_bitmaps(child, child_key).unionByName(known).groupBy(BUCKET).agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    counted = both.join(known.select(BUCKET, F.bitmap_count("bits").alias("known")), BUCKET, "left")
    return counted.select(BUCKET, (F.col("n") - F.coalesce("known", F.lit(0))).alias("orphans")).where("orphans > 0")


def orphan_rows(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent, those with a NULL key included."""
    found = orphan_buckets(child, parent, child_key, parent_key).select(F.col(BUCKET).alias("__bucket"))
    near = F.bitmap_bucket_number(child_key) == F.col("__bucket")
    suspects = child.join(found, near, "left_semi")
    keys = parent.select(F.col(parent_key).alias("__key"))
    keys = keys.join(found, F.bitmap_bucket_number("__key") == F.col("__bucket"), "left_semi")
    orphans = suspects.join(keys, suspects[child_key] == F.col("__key"), "left_anti")
    return orphans.unionByName(child.where(F.col(child_key).isNull()))
