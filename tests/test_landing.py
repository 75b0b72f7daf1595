import datetime as dt
import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docfold.functions.documents import field
from docfold.operators.checks import envelope_totals, run_suite, violations
from docfold.operators.reconcile import preview, reconcile_envelopes, reconcile_stored, record_counts, verify_load
from docfold.sources import landing as L
from tests.conftest import rows
from tests.series_data import CHARACTERS, write_envelope, write_pages

BROKEN = (PySparkException, Py4JJavaError)


def test_whole_documents_and_envelopes_load_the_same(spark, tmp_path):
    path = write_envelope(tmp_path, "characters", CHARACTERS, "2024-01-01", 1000)
    whole = L.load_raw(L.read_snapshots(spark, path), load_ts="2024-02-02")
    typed = L.load_raw(L.read_envelopes(spark, path), load_ts="2024-02-02")
    for raw in (whole, typed):
        assert [f.dataType.simpleString() for f in raw.schema] == ["bigint", "variant", "timestamp_ntz", "string"]
        assert sorted(r.id for r in raw.collect()) == [1, 2, 3, 4, 5]
        assert {(str(r.ingested_at), r.source_file) for r in raw.collect()} == {("2024-02-02 00:00:00", "characters_2024-01-01.json")}
    names = [df.select(field("raw_data", "$.name")).collect() for df in (whole, typed)]
    assert sorted(names[0]) == sorted(names[1])


def test_envelope_fields_stay(spark, tmp_path):
    write_envelope(tmp_path, "characters", CHARACTERS, "2024-01-01", 1000)
    row = L.read_envelopes(spark, f"{tmp_path}/characters", "characters_*.json").first()
    assert (row.ingested_at, row.source, row.total_records, row.corrupt) == ("2024-01-01", "https://h/api", 5, None)


def test_malformed_file(spark, tmp_path):
    (tmp_path / "x_1.json").write_text('{"data": [{"id": 1}')
    with pytest.raises(BROKEN):
        L.read_envelopes(spark, str(tmp_path)).collect()
    with pytest.raises(BROKEN):
        L.read_snapshots(spark, str(tmp_path)).collect()
    assert L.read_envelopes(spark, str(tmp_path), strict=False).first().corrupt.startswith('{"data"')
    assert L.read_snapshots(spark, str(tmp_path), strict=False).first().doc is None


def test_missing_empty_and_null_data(spark, tmp_path):
    for n, text in enumerate(['{"total_records": 0}', '{"data": [], "total_records": 0}', '{"data": null}', '{"data": [{"id": 1}]}']):
        (tmp_path / f"x_{n}.json").write_text(text)
    envelopes = L.read_envelopes(spark, str(tmp_path))
    assert L.load_raw(envelopes, strict=False).count() == 1
    with pytest.raises(BROKEN, match="holds no data"):
        L.load_raw(envelopes).collect()
    assert [r.status for r in reconcile_envelopes(envelopes).orderBy("source_file").collect()] == ["PASS", "PASS", "FAIL", "FAIL"]


def test_reconcile_finds_a_wrong_total(spark, tmp_path):
    write_envelope(tmp_path, "characters", CHARACTERS, "a", 1000)
    write_envelope(tmp_path, "characters", CHARACTERS, "b", 1000, total=6)
    envelopes = L.read_envelopes(spark, f"{tmp_path}/characters")
    assert rows(reconcile_envelopes(envelopes)) == [("characters_a.json", 5, 5, "PASS"), ("characters_b.json", 6, 5, "FAIL")]
    check = envelope_totals(envelopes, "TOTALS", "characters")
    assert (run_suite([check]).first().measure, run_suite([check]).first().status) == (1, "FAIL")
    assert rows(violations(check)) == [("characters_b.json", 6, 5, "FAIL")]


def test_newest_modification_time_wins(spark, tmp_path):
    write_envelope(tmp_path, "characters", CHARACTERS, "2024-01-09", 1000)
    write_envelope(tmp_path, "characters", CHARACTERS[:1], "2024-01-01", 2000)
    newest = L.latest_file(spark, f"{tmp_path}/characters", "characters")
    assert newest.endswith("characters_2024-01-01.json")
    with pytest.raises(FileNotFoundError):
        L.latest_file(spark, f"{tmp_path}/characters", "episodes")


def test_pages(spark, tmp_path):
    write_pages(tmp_path, "characters", CHARACTERS)
    pages = L.read_pages(spark, f"{tmp_path}/characters").orderBy("page").collect()
    assert [(p.page, len(p.results), p.next is None) for p in pages] == [(1, 2, False), (2, 2, False), (3, 1, True)]


def test_snapshot_round_trip(spark, tmp_path):
    first = spark.createDataFrame([(1, None)], "id int, name string")
    second = spark.createDataFrame([(1, "a\nb"), (2, "ü")], "id int, name string")
    L.write_snapshot(first, str(tmp_path), "items", "feed", dt.datetime(2024, 1, 1))
    stamp = L.write_snapshot(second, str(tmp_path), "items", "feed", dt.datetime(2024, 1, 2, 3, 4, 5))
    assert stamp == "2024-01-02T03-04-05"
    raw = L.load_records(L.read_latest_records(spark, str(tmp_path), "items"))
    got = raw.select("id", field("raw_data", "$.name"), "source_file")
    assert rows(got) == [(1, "a\nb", "items_2024-01-02T03-04-05.json"), (2, "ü", "items_2024-01-02T03-04-05.json")]
    manifests = L.read_manifests(spark, str(tmp_path), "items").orderBy("stamp").collect()
    assert [(m.total_records, m.source, m.ingested_at) for m in manifests] == [
        (1, "feed", "2024-01-01T00:00:00"),
        (2, "feed", "2024-01-02T03:04:05"),
    ]


def test_snapshot_without_manifest_is_not_seen(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "id int")
    L.write_snapshot(df, str(tmp_path), "items", "feed", dt.datetime(2024, 1, 1))
    (tmp_path / "items" / "snapshot=2024-09-09").mkdir()
    (tmp_path / "items" / "snapshot=2024-09-09" / "part.txt").write_text('{"id": 99}')
    assert [r.value for r in L.read_latest_records(spark, str(tmp_path), "items").collect()] == ['{"id":1}']


def test_load_by_name_ignores_case(spark, tmp_path):
    lines = [{"ID": 1, "Name": "a", "Nested": {"k": [1]}, "extra": 5}, {"id": "2", "unknown": None}]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(x) for x in lines) + "\n\n")
    (tmp_path / "b.txt").write_text("ignored")
    schema = "id bigint, name string, nested variant, seen timestamp_ntz"
    df = L.load_by_name(L.read_lines(spark, str(tmp_path), "*.json"), schema)
    assert rows(df.select("id", "name", field("nested", "$.k[0]", "int"), "seen")) == [(1, "a", 1, None), (2, None, None, None)]
    text = L.load_by_name(L.read_lines(spark, str(tmp_path), "*.json"), "id bigint, nested string", columns=["nested"])
    assert rows(text) == [(None,), ('{"k":[1]}',)]


def test_load_by_name_refuses_ambiguous_and_bad_values(spark):
    schema = "id bigint"
    with pytest.raises(BROKEN, match="DUPLICATED_MAP_KEY"):
        L.load_by_name(spark.createDataFrame([('{"ID":1,"id":2}',)], "value string"), schema).collect()
    bad = spark.createDataFrame([('{"id":"x"}',)], "value string")
    with pytest.raises(BROKEN):
        L.load_by_name(bad, schema).collect()
    assert L.load_by_name(bad, schema, strict=False).first().id is None


def test_counts_verification_and_preview(spark):
    loaded = spark.createDataFrame([("a",), ("a",), ("b",)], "f string")
    stored = spark.createDataFrame([("a",), ("a",), ("c",)], "f string")
    assert rows(verify_load(loaded, stored, ["f"])) == [("a", 2, 2, "PASS"), ("b", 1, 0, "FAIL"), ("c", 0, 1, "FAIL")]
    declared = spark.createDataFrame([("a", 2), ("b", 2), ("d", None)], "source_file string, total_records bigint")
    assert rows(reconcile_stored(declared, stored.withColumnRenamed("f", "source_file"))) == [
        ("a", 2, 2, "PASS"),
        ("b", 2, 0, "FAIL"),
        ("c", None, 1, "FAIL"),
        ("d", None, 0, "FAIL"),
    ]
    assert rows(record_counts({"x": loaded, "y": spark.range(0)})) == [("x", 3), ("y", 0)]
    assert [r.id for r in preview(spark.range(100).repartition(4), ["id"], "id", 3).collect()] == [0, 1, 2]


def test_lines_that_are_no_objects_stop_or_are_listed(spark):
    texts = ['{"ID": 1}', '{"ID":2,', "not json", '{"ID": 3, "id": 4}', "[5]"]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    for bad in texts[1:4]:
        with pytest.raises(BROKEN):
            L.load_by_name(lines.where(F.col("value") == bad), "id bigint").collect()
    assert sorted(r.id or 0 for r in L.load_by_name(lines, "id bigint", strict=False).collect()) == [0, 0, 0, 1, 4]
    assert sorted(r.value for r in L.by_name_rejects(lines).collect()) == sorted([texts[1], texts[2], texts[4]])
