"""Key bitmaps and digests against sets and multisets."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docfold.operators.bitmaps import key_bitmaps, orphan_buckets, orphan_rows
from docfold.operators.differences import differing_keys
from docfold.operators.merge import not_older
from tests.conftest import rows


def test_orphans_by_bitmap(spark):
    rng = random.Random(2)
    keys = [None, 0, -1, -32768, -32769, 1, 32768, 32769, 2**40, -(2**40), 5, 5]
    child = keys + [rng.randrange(-100_000, 100_000) for _ in range(2000)]
    parent = keys[3:9] + [rng.randrange(-100_000, 100_000) for _ in range(60_000)] + [None]
    c = spark.createDataFrame([(k, i) for i, k in enumerate(child)], "k bigint, i int")
    p = spark.createDataFrame([(k,) for k in parent], "id bigint")
    known = set(parent) - {None}
    want = [(k, i) for i, k in enumerate(child) if k not in known]
    assert rows(orphan_rows(c, p, "k", "id")) == sorted(want, key=lambda t: [(v is not None, v) for v in t])
    found = orphan_buckets(c, p, "k", "id")
    assert found.agg(F.sum("orphans")).first()[0] == len({k for k, _ in want if k is not None})
    assert orphan_buckets(c.where("k = 5"), c, "k", "k").count() == 0
    assert orphan_rows(c.limit(0), p, "k", "id").count() == 0
    assert orphan_rows(c.where("k = 5"), p.limit(0), "k", "id").count() == 2


def test_bitmaps_shuffle_buckets_not_keys(spark):
    """A task sends one row for each bucket it has met."""
    df = spark.range(0, 200_000, numPartitions=4)
    plan = key_bitmaps(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and plan.count("Exchange") == 1


@pytest.mark.parametrize("seed", range(3))
def test_differing_keys(spark, seed):
    rng = random.Random(seed)
    left = [(rng.choice([None, rng.randrange(-50, 5000)]), rng.choice(["a", "b", None, "\x01"])) for _ in range(800)]
    right = [r for r in left if rng.random() < 0.99] + [(rng.randrange(9000), "a") for _ in range(3)]
    right += [right[0]] if seed else []
    a, b = (spark.createDataFrame(x, "k bigint, v string") for x in (left, right))
    by_key = lambda data: {k: Counter(v for x, v in data if x == k) for k, _ in data}
    x, y = by_key(left), by_key(right)
    want = [(k, sum(x.get(k, {}).values()), sum(y.get(k, {}).values())) for k in {*x, *y} if x.get(k, Counter()) != y.get(k, Counter())]
    for widths in ((1 << 20, 1 << 10), (64, 8), ()):
        assert rows(differing_keys(a, b, "k", widths=widths)) == sorted(want, key=lambda t: [(v is not None, v) for v in t])
    assert differing_keys(a, a, "k").count() == 0
    assert differing_keys(a.limit(0), b.limit(0), "k").count() == 0


def test_not_older(spark):
    target = spark.createDataFrame([(1, 5, "t"), (2, None, "t"), (2, None, "u"), (None, 9, "t")], "k int, s int, v string")
    source = spark.createDataFrame(
        [(1, 4, "old"), (1, 5, "same"), (2, None, "none"), (3, 1, "x"), (3, 2, "y"), (None, 1, "loose"), (None, 1, "loose")], "k int, s int, v string"
    )
    want = [(None, 1, "loose"), (None, 1, "loose"), (1, 5, "same"), (2, None, "none"), (3, 2, "y")]
    assert rows(not_older(target, source, ["k"], "s")) == want
    unstamped = spark.createDataFrame([(1, None, "no")], "k int, s int, v string")
    assert not_older(target, unstamped, ["k"], "s").count() == 0
