"""Envelopes cut into splits against the same files read whole."""

import json
import random
import re

import pytest

from docfold.operators.reconcile import reconcile_envelopes
from docfold.sources.envelopes import _fragments, _pieces, read_split_envelopes
from docfold.sources.landing import load_raw, read_envelopes
from tests.test_landing import BROKEN

NASTY = ['}', '{"a": [1, 2}', '\\', '\\"', '"', '",{', '\n', '], "data": [', 'é中🙂', 'data', '\\\\"}', '\x01']


def record(rng, depth=0):
    kind = rng.randint(0, 6 if depth < 3 else 3)
    if kind < 2:
        return rng.choice(NASTY) + rng.choice(NASTY)
    if kind == 2:
        return rng.choice([None, True, 1, -2.5])
    if kind == 3:
        return {}
    if kind == 4:
        return [record(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(["id", "data", "x", *NASTY]): record(rng, depth + 1) for _ in range(rng.randint(0, 3))}


def envelope(rng, data):
    fields = [("ingested_at", "2024-01-01"), ("source", rng.choice(NASTY)), ("total_records", len(data)), ("data", data)]
    fields += [(f"more{i}", record(rng)) for i in range(rng.randint(0, 3))] + [("list", [{"data": [{}]}, {"b": 1}, 2, {"c": {}}])] * rng.randint(0, 1)
    rng.shuffle(fields)
    text = json.dumps(dict(fields), indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5, separators=rng.choice([(",", ":"), (" , ", " : ")]))
    return text + rng.choice(["", "\n", " \n "])


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "64")
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def test_random_envelopes(spark, small_splits, tmp_path):
    rng = random.Random(8)
    want_rows, want_heads = [], []
    for i in range(40):
        data = [record(rng) if i % 2 else {"id": k, "v": record(rng)} for k in range(rng.choice([0, 1, 2, 9]))]
        text = envelope(rng, data)
        (tmp_path / f"f{i}.json").write_text(text, encoding="utf-8")
        want_rows += [(f"f{i}.json", json.dumps(v, sort_keys=True)) for v in data]
        doc = json.loads(text)
        want_heads.append((f"f{i}.json", doc["ingested_at"], doc["source"], doc["total_records"]))
    heads, records = read_split_envelopes(spark, str(tmp_path))
    found = [(r.file_name, json.dumps(json.loads(r.v), sort_keys=True)) for r in records.selectExpr("file_name", "to_json(value) v").collect()]
    assert sorted(found) == sorted(want_rows)
    assert sorted(map(tuple, heads.select("file_name", "ingested_at", "source", "total_records").collect())) == sorted(want_heads)


def test_more_tasks_than_files_and_equal_to_the_whole_read(spark, small_splits, tmp_path):
    data = [{"id": i, "text": NASTY[i % len(NASTY)] * 3} for i in range(200)]
    (tmp_path / "one.json").write_text(json.dumps({"ingested_at": "t", "source": "s", "total_records": 200, "data": data}))
    whole = load_raw(read_envelopes(spark, str(tmp_path)))
    heads, records = read_split_envelopes(spark, str(tmp_path))
    show = lambda df: sorted(map(tuple, df.selectExpr("id", "to_json(raw_data)", "source_file").collect()))
    assert show(load_raw(records)) == show(whole)
    assert heads.first().total_records == 200
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 10


@pytest.mark.parametrize(
    "text",
    ['{"data": [{"id": 1}, {"id": 2}', '{"data": [{"id": 1}{"id": 2}]}', '{"data": [{"id": 1},, {"id": 2}]}', '{"data": [{"id": 1},]}', '{"x": [{"id": 1}]}', '{"data": null}', '{"data": [{"id": 1}], "data": [{"id": 2}]}', '{"data": [{"id": "}]}', '[{"data": [{"id": 1}]}]', '{"data": [{"id": 1}]}}'],
)
def test_malformed_envelopes_fail(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(BROKEN):
        heads, records = read_split_envelopes(spark, str(tmp_path))
        heads.collect()
        records.collect()


def test_text_stays_with_the_task_that_reads_it(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"data": [{"id": 1}, {"id": 2}]}')
    found = _fragments(_pieces(spark, str(tmp_path), None))
    query = found._jdf.queryExecution()
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(query, "formatted")
    moved = re.findall(r"\(\d+\) (?:Exchange|Sort|Window)\nInput[^:]*: (.*)", plan)
    assert moved and not any(re.search(r"\btext#", columns) for columns in moved)


def test_several_files_in_one_task_and_pieces_in_several_batches(spark, tmp_path):
    rng = random.Random(9)
    want = []
    for i in range(30):
        data = [record(rng) if i % 2 else {"id": k, "v": record(rng)} for k in range(rng.choice([0, 1, 2, 9]))]
        (tmp_path / f"f{i}.json").write_text(envelope(rng, data), encoding="utf-8")
        want += [(f"f{i}.json", json.dumps(v, sort_keys=True)) for v in data]
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "3")
    try:
        heads, records = read_split_envelopes(spark, str(tmp_path))
        found = [(r.file_name, json.dumps(json.loads(r.v), sort_keys=True)) for r in records.selectExpr("file_name", "to_json(value) v").collect()]
    finally:
        spark.conf.set(size, before)
    assert sorted(found) == sorted(want)
    assert heads.count() == 30


def test_large_envelopes_are_read_in_parts_and_small_ones_whole(spark, tmp_path):
    for name, n in (("small", 2), ("large", 40), ("empty", 0)):
        data = [{"id": i, "text": NASTY[i % len(NASTY)]} for i in range(n)]
        more = {"more": "x" * 800} if n == 0 else {}
        (tmp_path / f"{name}.json").write_text(json.dumps({"ingested_at": "t", "source": name, "total_records": max(n, 1), **more, "data": data}))
    whole = read_envelopes(spark, str(tmp_path))
    parts = read_envelopes(spark, str(tmp_path), split_above=500)
    assert parts.columns == whole.columns
    assert whole.count() == 3 and parts.count() == 1 + 41 + 1
    show = lambda df: sorted(map(tuple, df.selectExpr("id", "to_json(raw_data)", "source_file").collect()))
    assert show(load_raw(parts)) == show(load_raw(whole))
    totals = lambda df: sorted(map(tuple, reconcile_envelopes(df).collect()))
    assert totals(parts) == totals(whole) == [("empty.json", 1, 0, "FAIL"), ("large.json", 40, 40, "PASS"), ("small.json", 2, 2, "PASS")]
    about = lambda df: sorted(map(tuple, df.select("file_path", "file_name", "modified_at", "ingested_at", "source").distinct().collect()))
    assert about(parts) == about(whole)


def test_a_large_envelope_that_is_cut_off_fails_whatever_is_read_of_it(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"data": [{"id": 1}], "more": {"id": 2}')
    with pytest.raises(BROKEN):
        load_raw(read_envelopes(spark, str(tmp_path), split_above=8)).select("id").collect()
