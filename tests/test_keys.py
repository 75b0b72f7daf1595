import random
from collections import Counter

from pyspark.sql import functions as F

from docfold.operators.keys import ROWS, digest, key_counts, linked_counts, rows_with_keys, unmatched_counts
from tests.conftest import rows


def skewed(spark, n=600):
    rng = random.Random(7)
    data = []
    for i in range(n):
        a = 1 if i % 3 == 0 else rng.choice([None, *range(2, 40)])
        data.append((a, rng.choice([None, "x", "y"]), i))
    return data, spark.createDataFrame(data, "a int, b string, i int")


def test_rows_with_keys_matches_brute_force(spark):
    data, df = skewed(spark)
    counts = Counter((a, b) for a, b, _ in data)
    expected = sorted(i for a, b, i in data if counts[(a, b)] > 6)
    for hot in (1, 3, 1000):
        found = rows_with_keys(df, key_counts(df, ["a", "b"]).where(F.col(ROWS) > 6), ["a", "b"], hot_keys=hot)
        assert found.columns == df.columns
        assert sorted(r.i for r in found.collect()) == expected


def test_ties_at_the_hot_limit_lose_nothing(spark):
    df = spark.range(400).select((F.col("id") % 100).alias("k"), "id").repartition(7)
    assert rows_with_keys(df, key_counts(df, ["k"]), ["k"], hot_keys=13).count() == 400


def test_unmatched_counts_treats_null_as_unmatched(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert rows(unmatched_counts(left, right, ["k"], ["k"])) == [(None, 2), (1, 2)]


def test_linked_counts_sees_both_directions(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (3,), (None,)], "q int")
    assert rows(linked_counts(left, right, ["k"], ["q"])) == [(None, 1), (None, 1), (1, None), (1, 1), (2, None)]


def test_digest_keeps_null(spark):
    for kind, value in (("string", "a"), ("array<int>", [1])):
        df = digest(spark.createDataFrame([(value,), (None,)], f"t {kind}"), "t")
        assert [r[0] is None for r in df.select("__digest").collect()] == [False, True]


def test_array_keys_are_told_apart(spark):
    data = [([1, 2], 1), ([12], 2), ([], 3), (None, 4), ([1, 2], 5), (None, 6), ([], 7)]
    df = spark.createDataFrame(data, "k array<int>, i int")
    repeated = key_counts(df, ["k"]).where(F.col(ROWS) > 1)
    for hot in (1, 1000):
        assert sorted(r.i for r in rows_with_keys(df, repeated, ["k"], hot).collect()) == [1, 3, 4, 5, 6, 7]
