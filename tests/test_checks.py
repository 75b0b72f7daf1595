import pytest
from pyspark.sql import functions as F

from docfold.operators import checks as C
from docfold.plans.series_model import BRIDGE, DIM_CHARACTERS, DIM_EPISODES, series_checks
from tests.conftest import rows

IDS = "id int, name string, episode string"
PAIRS = "character_id int, episode_id int"
CHARACTERS = [(1, "a", None), (2, "b", None), (3, "c", None)]
EPISODES = [(1, "p", "S1"), (2, "q", "S2")]
LINKS = [(1, 1), (1, 2), (2, 1), (3, 2)]


def suite(spark, characters=CHARACTERS, episodes=EPISODES, links=LINKS, raw_characters=3, raw_episodes=2):
    raw = {"characters": spark.range(raw_characters), "episodes": spark.range(raw_episodes)}
    model = {
        DIM_CHARACTERS.name: spark.createDataFrame(characters, IDS),
        DIM_EPISODES.name: spark.createDataFrame(episodes, IDS),
        BRIDGE.name: spark.createDataFrame(links, PAIRS),
    }
    return series_checks(raw, model)


def not_passed(checks):
    return {r.check_name: (r.measure, r.status) for r in C.run_suite(checks).collect() if r.status != "PASS"}


def test_sound_model_passes_all_thirteen(spark):
    results = C.run_suite(suite(spark))
    assert results.count() == 13 and not not_passed(suite(spark))
    assert results.schema.simpleString() == spark.createDataFrame([], C.RESULT_SCHEMA).schema.simpleString()
    assert C.summarise(results).first().verdict == "ALL CHECKS PASSED"


@pytest.mark.parametrize(
    "change, expected",
    [
        (dict(characters=[*CHARACTERS, (3, "c", None), (3, "c", None)], raw_characters=5), {"PK_CHARACTERS_UNIQUE": (3, "FAIL")}),
        (dict(episodes=[*EPISODES, (2, "q", "S2")], raw_episodes=3), {"PK_EPISODES_UNIQUE": (2, "FAIL")}),
        (dict(links=[*LINKS, (3, 2)]), {"PK_BRIDGE_UNIQUE": (2, "FAIL")}),
        (
            dict(characters=[*CHARACTERS, (None, "x", None)], raw_characters=4),
            {"NOT_NULL_CHARACTERS_ID": (1, "FAIL"), "BRIDGE_MIN_EPISODES_PER_CHARACTER": (1, "WARNING")},
        ),
        (dict(characters=[*CHARACTERS[:2], (3, None, None)]), {"NOT_NULL_CHARACTERS_NAME": (1, "FAIL")}),
        (dict(episodes=[*EPISODES, (None, "r", "S3")], raw_episodes=3), {"NOT_NULL_EPISODES_ID": (1, "FAIL")}),
        (dict(episodes=[(1, None, "S1"), EPISODES[1]]), {"NOT_NULL_EPISODES_NAME": (1, "FAIL")}),
        (dict(episodes=[(1, "p", None), EPISODES[1]]), {"NOT_NULL_EPISODES_EPISODE": (1, "FAIL")}),
        (dict(links=[*LINKS, (9, 1)]), {"FK_BRIDGE_TO_CHARACTERS": (1, "FAIL")}),
        (dict(links=[*LINKS, (None, 1)]), {"FK_BRIDGE_TO_CHARACTERS": (1, "FAIL")}),
        (dict(links=[*LINKS, (1, 9), (2, 9)]), {"FK_BRIDGE_TO_EPISODES": (2, "FAIL")}),
        (dict(raw_characters=4), {"ROW_COUNT_CHARACTERS": (3, "FAIL")}),
        (dict(raw_episodes=0), {"ROW_COUNT_EPISODES": (2, "FAIL")}),
        (dict(links=LINKS[:3]), {"BRIDGE_MIN_EPISODES_PER_CHARACTER": (1, "WARNING")}),
    ],
)
def test_one_broken_row_changes_only_its_check(spark, change, expected):
    assert not_passed(suite(spark, **change)) == expected


def test_null_keys_form_one_duplicate_group(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "id int")
    check = C.unique(df, ["id"], "PK", "t")
    assert C.run_suite([check]).first().measure == 2
    assert rows(C.violations(check)) == [(None,), (None,)]


def test_violations_are_the_offending_rows(spark):
    checks = {c.name: c for c in suite(spark, links=[*LINKS[:3], (9, 1), (None, 1), (1, 1)])}
    assert rows(C.violations(checks["PK_BRIDGE_UNIQUE"])) == [(1, 1), (1, 1)]
    assert rows(C.violations(checks["FK_BRIDGE_TO_CHARACTERS"])) == [(None, 1), (9, 1)]
    assert [r.id for r in C.violations(checks["BRIDGE_MIN_EPISODES_PER_CHARACTER"]).collect()] == [3]
    assert C.violations(checks["NOT_NULL_CHARACTERS_ID"]).count() == 0
    with pytest.raises(ValueError):
        C.violations(checks["ROW_COUNT_EPISODES"])


def test_empty_tables(spark):
    checks = suite(spark, [], [], [], 0, 0)
    assert not not_passed(checks)


def test_unplannable_check_is_an_error_not_a_gap(spark):
    df = spark.range(3)
    checks = [*C.not_null(df, {"A": "id", "B": "no_such"}, "t"), C.unique(df, ["id"], "PK", "t")]
    found = {r.check_name: r.status for r in C.run_suite(checks).collect()}
    assert found == {"A": "PASS", "B": "ERROR", "PK": "PASS"}
    with pytest.raises(C.QualityGateError, match="B"):
        C.gate(C.run_suite(checks))


def test_check_failing_at_run_time_does_not_hide_the_others(spark):
    good = spark.range(3)
    bad = good.select(F.raise_error(F.lit("broken file")).cast("int").alias("id"))
    checks = [*C.not_null(good, {"A": "id"}, "t"), *C.not_null(bad, {"B": "id"}, "u")]
    results = C.evaluate(checks)
    assert {r.check_name: r.status for r in results.collect()} == {"A": "PASS", "B": "ERROR"}
    assert C.summarise(results).first().verdict == "FAILED"


def test_summary_and_gate(spark):
    def results(*statuses):
        return spark.createDataFrame([(f"c{i}", "k", "t", 1, 0, s) for i, s in enumerate(statuses)], C.RESULT_SCHEMA)

    row = C.summarise(results("PASS", "PASS", "WARNING", "SKIPPED")).first()
    assert (row.total, row.passed, row.failed, row.warnings, row.success_rate) == (4, 2, 0, 1, 50.0)
    assert row.verdict == "PASSED WITH WARNINGS"
    C.gate(results("PASS", "WARNING"))
    with pytest.raises(C.QualityGateError, match="c1"):
        C.gate(results("PASS", "FAIL"))
    empty = C.summarise(results()).first()
    assert (empty.success_rate, empty.verdict) == (0.0, "FAILED")
    with pytest.raises(C.QualityGateError):
        C.gate(results())
    with pytest.raises(ValueError):
        C.run_suite([])


def test_checks_from_a_declaration(spark):
    tables = {
        DIM_CHARACTERS.name: spark.createDataFrame(CHARACTERS, IDS),
        DIM_EPISODES.name: spark.createDataFrame(EPISODES, IDS),
        BRIDGE.name: spark.createDataFrame([*LINKS, (7, 1)], PAIRS),
    }
    names = [c.name for c in C.checks_for(BRIDGE, tables)]
    assert names[0] == "PK_BRIDGE_CHARACTER_EPISODES_UNIQUE" and len(names) == 5
    assert not_passed(C.checks_for(BRIDGE, tables)) == {"FK_BRIDGE_CHARACTER_EPISODES_TO_DIM_CHARACTERS": (1, "FAIL")}
