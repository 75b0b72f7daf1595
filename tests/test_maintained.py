"""Counts kept up to date by merges against counting everything."""

import random

from docfold.operators.checks import run_suite, unique
from docfold.plans.maintained_checks import MaintainedUnique
from docfold.sources.tables import create_database, replace_table, scan
from docfold.specs import Column, TableSpec


def test_ten_random_merges(spark):
    rng = random.Random(6)
    create_database(spark, "maintained_db")
    spec = TableSpec("items", (Column("id", "bigint"), Column("tag"), Column("x", "int")), ("id",))
    row = lambda k: (k, rng.choice(["a", "b", None, "c" * rng.randint(1, 3)]), rng.choice([None, 1, 2]))
    frame = lambda data: spark.createDataFrame(data, "id bigint, tag string, x int")
    replace_table(spark, "maintained_db", spec, frame([row(k) for k in [*range(20), 3, 3, 7, None]]))
    kept = MaintainedUnique(spark, "maintained_db", spec, ["tag", "x"], ranges=2)
    kept.rebuild()
    for k in range(10):
        ids = rng.sample(range(40), rng.randint(0, 6)) + [None] * (k % 3 == 0)
        kept.upsert(frame([row(i) for i in ids]))
        stored = scan(spark, "maintained_db", "items")
        full = run_suite([unique(stored, ["tag", "x"], "PK", "items")]).first().measure
        found = kept.measures().collect()
        assert [(r.n_rows, r.repeated) for r in found] == [(stored.count(), full)]
