import datetime as dt

from docfold.sources.landing import write_snapshot
from docfold.sources.tables import create_database, create_table, scan
from docfold.specs import Column, Field, FlattenSpec, TableSpec
from docfold.streaming.landed import landed_lines, merge_landed
from tests.conftest import rows

SPEC = TableSpec("items", (Column("id", "bigint", required=True), Column("name")), ("id",))
FIELDS = FlattenSpec((Field("$.id", "id", "bigint"), Field("$.name", "name")))


def test_only_new_snapshots_are_merged(spark, tmp_path):
    create_database(spark, "stream_db")
    create_table(spark, "stream_db", SPEC)
    root, checkpoint = str(tmp_path / "land"), str(tmp_path / "checkpoint")

    def land(day, data):
        write_snapshot(spark.createDataFrame(data, "id int, name string"), root, "items", "feed", dt.datetime(2024, 1, day))

    def merge():
        query = merge_landed(landed_lines(spark, f"{root}/items"), "stream_db", SPEC, FIELDS, checkpoint)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    land(1, [(1, "a"), (2, "b")])
    land(2, [(2, "B"), (3, "c")])
    assert merge() >= 4
    assert rows(scan(spark, "stream_db", "items")) == [(1, "a"), (2, "B"), (3, "c")]
    land(3, [(1, None)])
    merge()
    assert rows(scan(spark, "stream_db", "items")) == [(1, None), (2, "B"), (3, "c")]


def test_late_snapshots_change_only_older_rows(spark, tmp_path):
    """All orders in which three snapshots can land give the same table, each also when one lands twice."""
    from itertools import permutations

    spec = TableSpec("stamped", (*SPEC.columns, Column("snapshot")), ("id",))
    data = {1: [(1, "a"), (2, "b"), (4, "d")], 2: [(2, "B"), (3, "c")], 3: [(1, None), (3, "C")]}
    found = []
    create_database(spark, "late_db")
    for k, order in enumerate([*permutations(data), (3, 1, 2, 1)]):
        create_table(spark, "late_db", spec)
        root, checkpoint = str(tmp_path / f"land{k}"), str(tmp_path / f"checkpoint{k}")
        for n, day in enumerate(order):
            day_root = f"{root}/{n}"
            write_snapshot(spark.createDataFrame(data[day], "id int, name string"), day_root, "items", "feed", dt.datetime(2024, 1, day))
            merge_landed(landed_lines(spark, f"{day_root}/items"), "late_db", spec, FIELDS, f"{checkpoint}/{n}", newest_by="snapshot").awaitTermination()
        found.append(rows(scan(spark, "late_db", "stamped").select("id", "name")))
    assert found == [[(1, None), (2, "B"), (3, "C"), (4, "d")]] * len(found)
