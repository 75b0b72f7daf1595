import json
import os

import pytest

from docfold.operators.checks import QualityGateError
from docfold.plans.series_run import IncompleteInputError, SeriesRun
from docfold.sources.tables import scan
from tests.conftest import rows
from tests.test_landing import BROKEN
from tests.series_data import CHARACTERS, EPISODES, write_envelope, write_pages

EXPECTED_PAIRS = sorted({(c["id"], int(u.rsplit("/", 1)[1])) for c in CHARACTERS for u in c["episode"]})


def test_enveloped_files_to_checked_model(spark, tmp_path):
    write_envelope(tmp_path, "characters", CHARACTERS, "1", 1000)
    write_envelope(tmp_path, "episodes", EPISODES, "1", 1000)
    run = SeriesRun(spark, str(tmp_path), raw_database="raw1", model_database="model1")
    results = run.run()
    assert results.count() == 15 and {r.status for r in results.collect()} == {"PASS"}
    pairs = scan(spark, "model1", "bridge_character_episodes")
    assert rows(pairs.select("character_id", "episode_id")) == EXPECTED_PAIRS
    people = scan(spark, "model1", "dim_characters").orderBy("id").collect()
    assert (people[1].origin_name, people[0].origin_name, people[0].origin_url) == (None, "Earth", "")
    assert str(people[0].created) == "2017-11-04 18:48:46.250000"
    assert rows(run.verify_raw()) == [
        ("characters", "characters_1.json", 5, 5, "PASS"),
        ("episodes", "episodes_1.json", 4, 4, "PASS"),
    ]
    steps = {r.step: r.n_rows for r in run.run_metrics().collect()}
    assert steps["load-raw"] == 9 and steps["transform"] == 9 + len(EXPECTED_PAIRS)

    first_stamp = {(r.character_id, r.episode_id): r.created_at for r in pairs.collect()}
    changed = [{**CHARACTERS[0], "status": None, "episode": []}, *CHARACTERS[1:], {**CHARACTERS[0], "id": 6}]
    write_envelope(tmp_path, "characters", changed, "0", 2000)
    again = SeriesRun(spark, str(tmp_path), raw_database="raw1", model_database="model1")
    for step in ("load-raw", "transform", "transform"):
        again.run(step)
    people = {r.id: r for r in scan(spark, "model1", "dim_characters").collect()}
    assert people[1].status is None and len(people) == 6
    after = {(r.character_id, r.episode_id): r.created_at for r in scan(spark, "model1", "bridge_character_episodes").collect()}
    assert first_stamp.items() <= after.items() and len(after) == len(first_stamp) + len(CHARACTERS[0]["episode"])
    assert again.run("quality").count() == 15


def test_record_that_left_the_source_fails_the_count(spark, tmp_path):
    write_envelope(tmp_path, "characters", CHARACTERS, "1", 1000)
    write_envelope(tmp_path, "episodes", EPISODES, "1", 1000)
    run = SeriesRun(spark, str(tmp_path), raw_database="raw2", model_database="model2")
    run.run()
    write_envelope(tmp_path, "characters", CHARACTERS[:4], "2", 2000)
    run.run("load-raw")
    run.run("transform")
    with pytest.raises(QualityGateError, match="ROW_COUNT_CHARACTERS"):
        run.run("quality")
    run.run("setup-model")
    run.run("transform")
    assert run.run("quality").count() == 15


def test_pages_are_landed_as_lines(spark, tmp_path):
    write_pages(tmp_path / "pages", "characters", CHARACTERS)
    write_pages(tmp_path / "pages", "episodes", EPISODES)
    run = SeriesRun(spark, str(tmp_path / "landing"), pages=str(tmp_path / "pages"), raw_database="raw3", model_database="model3")
    assert {r.status for r in run.run().collect()} == {"PASS"}
    assert rows(scan(spark, "model3", "bridge_character_episodes").select("character_id", "episode_id")) == EXPECTED_PAIRS
    assert [(r.entity, r.declared, r.stored, r.status) for r in run.verify_raw().orderBy("entity").collect()] == [
        ("characters", 5, 5, "PASS"),
        ("episodes", 4, 4, "PASS"),
    ]


def test_reference_without_number_is_rejected_and_the_rest_kept(spark, tmp_path):
    odd = {**CHARACTERS[0], "episode": ["https://h/episode/1", "https://h/episode/next"]}
    write_envelope(tmp_path, "characters", [odd], "1", 1000)
    write_envelope(tmp_path, "episodes", EPISODES, "1", 1000)
    run = SeriesRun(spark, str(tmp_path), raw_database="raw4", model_database="model4")
    assert run.run().count() == 15
    assert [(r.character_id, r.episode_id) for r in run.rejects.collect()] == [(1, None)]


def test_large_envelopes_are_read_by_splits(spark, tmp_path):
    write_envelope(tmp_path, "characters", CHARACTERS, "1", 1000)
    write_envelope(tmp_path, "episodes", EPISODES, "1", 1000)
    run = SeriesRun(spark, str(tmp_path), raw_database="raw8", model_database="model8", split_above=0)
    assert {r.status for r in run.run().collect()} == {"PASS"}
    assert rows(scan(spark, "model8", "bridge_character_episodes").select("character_id", "episode_id")) == EXPECTED_PAIRS
    assert run.written == {"characters": 5, "episodes": 4, "dim_characters": 5, "dim_episodes": 4, "bridge_character_episodes": len(EXPECTED_PAIRS)}


@pytest.mark.parametrize("fault", ["first", "middle", "last", "repeated", "error page", "early end", "skipping link", "link back", "no number"])
def test_incomplete_pages_fail_the_ingest(spark, tmp_path, fault):
    for entity, records in (("characters", CHARACTERS), ("episodes", EPISODES)):
        write_pages(tmp_path / "pages", entity, records, size=1)
    folder = tmp_path / "pages" / "characters"
    page = lambda n: folder / f"characters_page_{n}.json"
    if fault in ("first", "middle", "last"):
        os.remove(page({"first": 1, "middle": 3, "last": 5}[fault]))
    elif fault == "repeated":
        (folder / "again_page_2.json").write_text(page(2).read_text())
    elif fault in ("skipping link", "link back", "no number"):
        follow = {"skipping link": "https://h/api?page=4", "link back": "https://h/api?page=1", "no number": "https://h/api?page=next"}[fault]
        page(2).write_text(json.dumps({"info": {"next": follow}, "results": [CHARACTERS[1]]}))
    elif fault == "error page":
        page(2).write_text(json.dumps({"error": "busy", "info": {"next": "x"}}))
    else:
        page(2).write_text(json.dumps({"info": {"next": None}, "results": [CHARACTERS[1]]}))
    run = SeriesRun(spark, str(tmp_path / "landing"), pages=str(tmp_path / "pages"), raw_database="raw5", model_database="model5")
    with pytest.raises(IncompleteInputError, match="characters"):
        run.run("ingest")
    assert [(m[0], m[1]) for m in run.metrics] == [("ingest", 0)]


def test_announced_total_gates_the_run(spark, tmp_path):
    write_envelope(tmp_path, "characters", CHARACTERS[:1], "1", 1000, total=826)
    write_envelope(tmp_path, "episodes", EPISODES, "1", 1000)
    run = SeriesRun(spark, str(tmp_path), raw_database="raw6", model_database="model6")
    with pytest.raises(QualityGateError, match="TOTAL_CHARACTERS") as failed:
        run.run()
    assert failed.value.results.count() == run.results.count() == 15
    assert [(r.declared, r.stored) for r in run.violations("TOTAL_CHARACTERS").collect()] == [(826, 1)]
    assert run.summary().count() >= 1
    assert run.metrics[-1][:2] == ("quality", 15)


def test_envelope_without_data_is_no_empty_snapshot(spark, tmp_path):
    path = write_envelope(tmp_path, "characters", CHARACTERS, "1", 1000)
    write_envelope(tmp_path, "episodes", EPISODES, "1", 1000)
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"ingested_at": "1", "source": "s", "total_records": 0}, f)
    run = SeriesRun(spark, str(tmp_path), raw_database="raw7", model_database="model7")
    with pytest.raises(BROKEN, match="holds no data"):
        run.run()


def test_unknown_step_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="trasnform"):
        SeriesRun(spark, str(tmp_path)).run("trasnform")
