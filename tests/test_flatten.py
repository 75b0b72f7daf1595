import pytest
from pyspark.errors import PySparkException

from docfold.operators.flatten import bridge, cast_rejects, elements, flatten
from docfold.operators.merge import reject_null_keys
from docfold.specs import BridgeSpec, Field, FlattenSpec
from tests.conftest import rows

FIELDS = FlattenSpec((Field("$.id", "id", "int"), Field("$.name", "name"), Field("$.origin.name", "origin_name")))
PAIRS = BridgeSpec(Field("$.id", "id", "int"), "$.episode", "episode_id", "int", "[0-9]+$")


def test_flatten_keeps_text_as_it_is(docs):
    raw = docs('{"id":1,"name":" a ","origin":{"name":""}}', '{"id":2,"name":null,"origin":null}', '{"id":3}')
    assert rows(flatten(raw, FIELDS)) == [(1, " a ", ""), (2, None, None), (3, None, None)]


def test_flatten_stamp(docs):
    spec = FlattenSpec(FIELDS.fields[:1], stamp="ingested_at")
    row = flatten(docs('{"id":1}'), spec, load_ts="2024-01-02 03:04:05").first()
    assert str(row.ingested_at) == "2024-01-02 03:04:05"


def test_strict_and_lenient(docs):
    raw = docs('{"id":"x","name":"a"}', id_path="$.missing")
    with pytest.raises(PySparkException):
        flatten(raw, FIELDS).collect()
    assert rows(flatten(raw, FIELDS, strict=False)) == [(None, "a", None)]


def test_cast_rejects_names_the_columns(docs):
    raw = docs('{"id":"x","name":"a"}', '{"id":2}', '{"id":null}', id_path="$.missing")
    assert [r.bad_columns for r in cast_rejects(raw, FIELDS).collect()] == [["id"]]


def test_elements_of_arrays_objects_and_others(docs):
    raw = docs('{"id":1,"episode":["a",null]}', '{"id":2,"episode":[]}', '{"id":3}', '{"id":4,"episode":5}', '{"id":5,"episode":{"k":1}}')
    assert rows(elements(raw, "$.episode").select("id", "pos")) == [(1, 0), (1, 1), (5, 0)]


def test_bridge_edges(docs):
    raw = docs(
        '{"id":1,"episode":["u/1","u/2","u/1",null]}',
        '{"id":2,"episode":[]}',
        '{"id":3}',
        '{"id":4,"episode":["none"]}',
        '{"id":1,"episode":["u/2"]}',
    )
    pairs = bridge(raw, PAIRS)
    assert rows(pairs) == [(1, 1), (1, 2), (4, None)]
    good, rejected = reject_null_keys(pairs, ["id", "episode_id"])
    assert rows(good) == [(1, 1), (1, 2)]
    assert rows(rejected) == [(4, None)]


def test_bridge_without_pattern_and_with_stamp(docs):
    spec = BridgeSpec(Field("$.id", "id", "int"), "$.tag", "tag", "string", stamp="created_at")
    out = bridge(docs('{"id":1,"tag":["x","y","x"]}'), spec, load_ts="2024-01-01")
    assert rows(out.select("id", "tag")) == [(1, "x"), (1, "y")]
    assert out.select("created_at").distinct().count() == 1


def test_flatten_undoes_wrapping(spark):
    from docfold.functions.documents import document_text
    from docfold.sources.landing import load_records
    from pyspark.sql import functions as F

    table = spark.createDataFrame([(1, "a"), (2, None), (3, 'q"\\\n')], "id int, name string")
    wrapped = table.select(document_text("id", "name").alias("value"), F.lit("f").alias("file_name"))
    spec = FlattenSpec((Field("$.id", "id", "int"), Field("$.name", "name")))
    assert rows(flatten(load_records(wrapped), spec)) == rows(table)
