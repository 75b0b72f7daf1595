"""The pipeline stage by stage against brute force, and on edge rows."""

import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from docfold.llm import tokens, toxicity
from docfold.llm.decontaminate import words
from tests.llm.test_line_dedup import brute_deleted
from tests.llm.test_near_duplicates import brute_groups
from tests.llm.test_text_models import brute_overlaps
from tests.llm.test_tokens import check_pieces

FOLDER = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


def texts(frame):
    return sorted((r["doc_id"], r["text"]) for r in frame.collect())


def test_stages_over_given_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    columns = docs.dtypes
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    before = texts(docs)

    model = toxicity.train(docs, labels.where(toxicity.fold(labels, 5) != 0))
    docs = STAGE["toxicity"](spark, docs, FOLDER).cache()
    assert docs.dtypes == columns
    want = [(i, t) for (i, t), s in zip(before, model.scores([t for _, t in before])) if s < 0.5]
    assert texts(docs) == want

    docs = STAGE["line_dedup"](spark, docs, FOLDER).cache()
    assert docs.dtypes == columns and all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    deleted = brute_deleted(want, 50, {(i, t): (i, 0) for i, t in want})
    want = sorted((i, left) for (i, t), (left, n) in deleted.items() if left.strip() or not n)
    assert texts(docs) == want

    docs = STAGE["near_duplicates"](spark, docs, FOLDER).cache()
    assert docs.dtypes == columns
    kept = {i for i, _, _, k in brute_groups(want) if k}
    want = [(i, t) for i, t in want if i in kept]
    assert texts(docs) == want

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    docs = STAGE["decontamination"](spark, docs, FOLDER).cache()
    assert docs.dtypes == columns
    hit = {i for i, _, n, *_ in brute_overlaps(want, items) if n}
    found = texts(docs)
    assert [r for r in found if r[0] not in hit] == [r for r in want if r[0] not in hit]
    assert hit and not any(n for _, _, n, *_ in brute_overlaps(found, items))
    was = dict(want)
    assert all(len(words(t)) < len(words(was[i])) for i, t in found if i in hit)

    check_pieces(Tokenizer.from_file(tokens.default_path()), found, STAGE["packing"](spark, docs, FOLDER).collect())


EDGES = [(1, None), (2, ""), (3, " \n "), (4, "x " * 9000), (None, "no id"), (5, "same row"), (5, "same row"), (5, "other text"), (6, "passage " * 60), (7, "passage " * 60), (None, None)]


@pytest.mark.parametrize("rows", [EDGES, []])
def test_stages_on_edge_rows(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1.0, 2, ("x",), "k") for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, toxicity double, Toxicity_ int, about struct<`a b`: string>, k1 string")
    columns = docs.dtypes
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.dtypes == columns, name
    left = [(r["doc_id"], r["text"]) for r in docs.collect()]
    if rows:
        assert sorted(left, key=repr) == sorted([(1, None), (2, ""), (3, " \n "), (4, "x " * 9000), (None, "no id"), (5, "same row"), (5, "other text"), (6, "passage " * 60), (None, None)], key=repr)
    assert STAGE["packing"](spark, docs, FOLDER).count() >= len(left)


def test_run_equals_its_stages(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert found.count() > 100 and corpus_pipeline.ORACLE_SQL is None
    assert [re.fullmatch("[a-z_]+", name) is not None for name, _ in corpus_pipeline.STAGES] == [True] * 5
