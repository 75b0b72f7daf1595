import random

from pyspark.sql import functions as F

from docfold.operators.snapshots import latest_snapshot, page_audit, page_counts, retain_snapshots, union_pages
from tests.conftest import rows


def test_latest_and_retained_against_brute_force(spark):
    rng = random.Random(3)
    data = [("hot" if i % 3 else rng.choice("ab"), rng.randrange(9), i) for i in range(300)]
    df = spark.createDataFrame(data, "e string, s int, i int")
    newest = {e: sorted({s for x, s, _ in data if x == e}, reverse=True) for e, _, _ in data}
    for keep in (1, 2, 4):
        expected = sorted(i for e, s, i in data if s in newest[e][:keep])
        assert sorted(r.i for r in retain_snapshots(df, ["e"], "s", keep).collect()) == expected
    top = sorted({s for _, s, _ in data}, reverse=True)
    assert sorted(r.i for r in retain_snapshots(df, [], "s", 2).collect()) == sorted(i for _, s, i in data if s in top[:2])
    assert rows(latest_snapshot(df, ["e"], "s")) == rows(retain_snapshots(df, ["e"], "s", 1))
    assert {r.s for r in latest_snapshot(df, [], "s").collect()} == {top[0]}


def test_running_totals_cross_block_borders(spark):
    pages = [(e, p, (p * 7) % 5) for e in ("a", None) for p in range(1, 23)]
    df = spark.createDataFrame(pages + [("a", 4, 100)], "e string, page int, n int")
    got = {(r.e, r.page): (r.records, r.total_so_far) for r in page_counts(df, ["e"], "page", "n", block=4).collect()}
    for e in ("a", None):
        total = 0
        for x, p, n in sorted((row for row in pages if row[0] == e), key=lambda row: row[1]):
            n += 100 if (x, p) == ("a", 4) else 0
            total += n
            assert got[(e, p)] == (n, total)
    assert len(got) == 44


def test_page_audit_finds_gaps_and_repeats(spark):
    df = spark.createDataFrame([("a", 1, 20), ("a", 2, 20), ("a", 2, 20), ("a", 5, 3), ("b", 1, 7)], "e string, page int, n int")
    assert rows(page_audit(df, ["e"], "page", "n")) == [("a", 3, 1, 5, 2, 1, 63), ("b", 1, 1, 1, 0, 0, 7)]


def test_union_pages_keeps_order_inside_a_page(spark):
    df = spark.createDataFrame([(1, ["x", "y"]), (2, []), (3, ["z"])], "page int, results array<string>")
    assert rows(union_pages(df, ["page"])) == [(1, 0, "x"), (1, 1, "y"), (3, 0, "z")]
    assert union_pages(df.withColumn("results", F.lit(None).cast("array<string>")), ["page"]).count() == 0
