import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docfold.functions.documents import document_text, field, is_present, parse_document, trailing_id
from docfold.functions.timing import iso_text, load_time, snapshot_name


def one(spark, json, *columns):
    return spark.range(1).select(F.parse_json(F.lit(json)).alias("d")).select(*columns).first()


def test_absent_null_and_nested_paths(spark):
    json = '{"id": "3", "name": "x", "origin": null, "location": {"url": "u"}}'
    paths = ["$.name", "$.origin.name", "$.location.name", "$.location.url", "$.missing"]
    assert tuple(one(spark, json, *[field("d", p) for p in paths])) == ("x", None, None, "u", None)


def test_numeric_text_is_a_number(spark):
    assert one(spark, '{"id": "3"}', field("d", "$.id", "int"))[0] == 3


def test_bad_number_fails_or_is_null(spark):
    with pytest.raises(PySparkException):
        one(spark, '{"id": "x"}', field("d", "$.id", "int"))
    assert one(spark, '{"id": "x"}', field("d", "$.id", "int", strict=False))[0] is None
    assert one(spark, '{"id": 9999999999}', field("d", "$.id", "int", strict=False))[0] is None


def test_timestamp_keeps_wall_clock_and_millis(spark):
    value = one(spark, '{"t": "2017-11-04T18:48:46.250Z"}', field("d", "$.t", "timestamp_ntz"))[0]
    assert value == dt.datetime(2017, 11, 4, 18, 48, 46, 250000)


def test_json_null_is_not_present(spark):
    v = F.variant_get("d", "$.a", "variant")
    assert one(spark, '{"a": null}', is_present(v))[0] is False
    assert one(spark, "{}", is_present(v))[0] is False
    assert one(spark, '{"a": 0}', is_present(v))[0] is True


def test_malformed_text(spark):
    df = spark.createDataFrame([("{",)], "t string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        df.select(parse_document("t")).collect()
    assert df.select(parse_document("t", strict=False)).first()[0] is None


@pytest.mark.parametrize("url, expected", [("https://h/e/28", 28), ("https://h/e/28/", None), ("7", 7), (None, None)])
def test_trailing_id(spark, url, expected):
    assert spark.createDataFrame([(url,)], "u string").select(trailing_id("u")).first()[0] == expected


def test_document_text_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(document_text("a", "b")).first()[0] == '{"a":1,"b":null}'


def test_load_time_and_snapshot_name(spark):
    ts = dt.datetime(2024, 3, 1, 12, 30, 45, 120000)
    df = spark.range(1).select(load_time(ts).alias("t"))
    assert df.select("t").first()[0] == ts
    assert df.select(iso_text("t")).first()[0] == "2024-03-01T12:30:45.120000"
    assert df.select(snapshot_name("episodes", "t")).first()[0] == "episodes_2024-03-01T12-30-45.120000.json"
    whole = load_time(dt.datetime(2024, 3, 1))
    assert df.select(iso_text(whole)).first()[0] == "2024-03-01T00:00:00"


def test_default_load_time_is_one_value(spark):
    assert spark.range(1000).repartition(4).select(load_time().alias("t")).distinct().count() == 1
