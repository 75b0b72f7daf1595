import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from docfold.operators.merge import insert_only, merge_conflicts, reject_null_keys, upsert, upsert_actions
from tests.conftest import rows

SCHEMA = "k int, v string, w int"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


TARGET = [(1, "a", 1), (2, "b", 2), (3, "c", 3)]
SOURCE = [(2, None, 20), (3, "C", 30), (4, "D", 40)]


def test_upsert_overwrites_with_null_keeps_and_inserts(spark):
    merged = upsert(frame(spark, TARGET), frame(spark, SOURCE), ["k"])
    assert rows(merged) == [(1, "a", 1), (2, None, 20), (3, "C", 30), (4, "D", 40)]


def test_both_forms_agree(spark):
    fast = upsert(frame(spark, TARGET), frame(spark, SOURCE), ["k"])
    general = upsert(frame(spark, TARGET), frame(spark, SOURCE), ["k"], target_keyed=False)
    assert rows(fast) == rows(general)


def test_partial_update(spark):
    merged = upsert(frame(spark, TARGET), frame(spark, SOURCE), ["k"], update_cols=["w"])
    assert rows(merged) == [(1, "a", 1), (2, "b", 20), (3, "c", 30), (4, "D", 40)]


def test_source_without_a_column(spark):
    merged = upsert(frame(spark, TARGET), frame(spark, [(2, 20), (4, 40)], "k int, w int"), ["k"], update_cols=["w"])
    assert rows(merged) == [(1, "a", 1), (2, "b", 20), (3, "c", 3), (4, None, 40)]


def test_update_of_a_column_the_source_lacks_is_refused(spark):
    with pytest.raises(ValueError, match="v"):
        upsert(frame(spark, TARGET), frame(spark, [(2, 20)], "k int, w int"), ["k"], update_cols=["v"])


def test_repeated_target_key_is_updated_everywhere(spark):
    target = frame(spark, [(1, "a", 1), (1, "b", 2)])
    merged = upsert(target, frame(spark, [(1, "z", 9)]), ["k"], target_keyed=False)
    assert rows(merged) == [(1, "z", 9), (1, "z", 9)]


@pytest.mark.parametrize("options", [{}, {"update_cols": ["w"]}])
def test_two_source_rows_for_one_stored_row_fail(spark, options):
    source = frame(spark, [(2, "x", 1), (2, "y", 2)])
    with pytest.raises(PySparkException, match="same target row"):
        upsert(frame(spark, TARGET), source, ["k"], **options).collect()
    assert rows(merge_conflicts(frame(spark, TARGET), source, ["k"])) == [(2, 2)]


@pytest.mark.parametrize("options", [{}, {"update_cols": ["w"]}])
def test_repeated_new_key_is_inserted_as_it_is(spark, options):
    source = frame(spark, [(9, "x", 1), (9, "y", 2)])
    assert upsert(frame(spark, TARGET), source, ["k"], **options).count() == 5


def test_null_key_never_matches(spark):
    target, source = frame(spark, [(None, "a", 1)]), frame(spark, [(None, "b", 2)])
    for keyed in (True, False):
        assert rows(upsert(target, source, ["k"], target_keyed=keyed)) == [(None, "a", 1), (None, "b", 2)]
    good, rejected = reject_null_keys(source, ["k"])
    assert good.count() == 0 and rejected.count() == 1


def test_insert_only_leaves_old_rows(spark):
    target = frame(spark, [(1, 1, "old"), (1, 2, "old")], "a int, b int, t string")
    source = frame(spark, [(1, 2, "new"), (1, 3, "new")], "a int, b int, t string")
    once = insert_only(target, source, ["a", "b"])
    assert rows(once) == [(1, 1, "old"), (1, 2, "old"), (1, 3, "new")]
    assert rows(insert_only(once, source, ["a", "b"])) == rows(once)


def test_actions(spark):
    target, source = frame(spark, TARGET), frame(spark, SOURCE)
    assert rows(upsert_actions(target, source, ["k"])) == [("insert", 1), ("keep", 1), ("update", 2)]
    assert rows(upsert_actions(target, frame(spark, []), ["k"])) == [("insert", 0), ("keep", 3), ("update", 0)]


table = st.dictionaries(st.integers(0, 8), st.tuples(st.none() | st.sampled_from("ab"), st.none() | st.integers(0, 3)), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(table, table)
def test_upsert_is_a_dictionary_update_and_idempotent(spark, target, source):
    def frames(d):
        return frame(spark, [(k, *v) for k, v in d.items()])

    merged = upsert(frames(target), frames(source), ["k"])
    assert {r.k: (r.v, r.w) for r in merged.collect()} == target | source
    assert merged.count() == len(target | source)
    assert rows(upsert(merged, frames(source), ["k"])) == rows(merged)
