"""Types of documents against a declaration."""

from docfold.operators.drift import observed_types, schema_drift
from docfold.specs import Field, FlattenSpec
from tests.conftest import rows


def test_observed_types(docs):
    raw = docs('{"id": 1, "a": {"b": "x", "c": null}, "l": [1, "y"], "m": 1}', '{"id": 2, "a": {"d": 1.5}, "m": "text"}', "{}")
    assert observed_types(raw) == {"$.id": "bigint", "$.a.b": "string", "$.a.c": "void", "$.a.d": "decimal(2,1)", "$.l": "array<variant>", "$.m": "variant"}
    assert observed_types(raw.limit(0)) == {}


def test_drift(docs):
    spec = FlattenSpec((Field("$.id", "id", "bigint"), Field("$.name", "name"), Field("$.a", "a", "variant"), Field("$.a.b", "b"), Field("$.n", "n", "int"), Field("$.x", "x", "double")))
    raw = docs('{"id": 1, "a": {"b": 7}, "n": null, "x": 3}', '{"id": 2, "extra": true}')
    assert rows(schema_drift(raw, spec)) == [
        ("$.a", "variant", "object", "same"),
        ("$.a.b", "string", "bigint", "changed"),
        ("$.extra", None, "boolean", "new"),
        ("$.id", "bigint", "bigint", "same"),
        ("$.n", "int", "void", "same"),
        ("$.name", "string", None, "vanished"),
        ("$.x", "double", "bigint", "same"),
    ]
    assert [r.status for r in schema_drift(raw.limit(0), spec).collect()] == ["vanished"] * 6
