"""Later copies of line runs against a search of all runs."""

import hashlib
import random

import pytest

from docfold.llm.line_dedup import delete_repeated_lines
from docfold.llm.queries import QUERIES


def brute_texts(rows, min_words):
    """Text after deletion of each distinct (doc_id, text), by looking up every run of enough words."""
    docs, runs = [], {}
    for doc_id, text in dict.fromkeys(rows):
        own = [(at, line.strip(" \t\n\r\x0b\x0c")) for at, line in enumerate((text or "").split("\n"))]
        docs.append((doc_id, text, [(at, line) for at, line in own if line]))
    for k, (_, _, own) in enumerate(docs):
        for i in range(len(own)):
            words = 0
            for j in range(i, len(own)):
                words += len(own[j][1].split())
                if words >= min_words:
                    runs.setdefault(tuple(line for _, line in own[i : j + 1]), []).append((k, i))
    return docs, runs


def brute_deleted(rows, min_words, order):
    docs, runs = brute_texts(rows, min_words)
    gone = [set() for _ in docs]
    for run, places in runs.items():
        first = min(places, key=lambda p: (order[docs[p[0]][:2]], p[1]))
        for k, i in places:
            if (k, i) != first:
                gone[k].update(at for at, _ in docs[k][2][i : i + len(run)])
    return {(d, t): (t if not g else "\n".join(line for at, line in enumerate(t.split("\n")) if at not in g), len(g)) for (d, t, _), g in zip(docs, gone)}


def check(spark, rows, min_words):
    frame = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id bigint, text string, k1 int, lines int, `at` string")
    hashed = {(r[0], r[1]): r[2] for r in frame.selectExpr("doc_id", "text", "xxhash64(coalesce(text, ''))").collect()}
    order = {key: (-(1 << 63) if key[0] is None else key[0], h) for key, h in hashed.items()}
    want = brute_deleted(rows, min_words, order)
    found = delete_repeated_lines(frame, min_words).collect()
    assert sorted(((r["doc"]["doc_id"], r["doc"]["text"]) for r in found), key=repr) == sorted(rows, key=repr)
    for r in found:
        assert (r["text"], r["n_deleted"]) == want[r["doc"]["doc_id"], r["doc"]["text"]], r["doc"]
        assert r["n_lines"] == (r["doc"]["text"] or "").count("\n") + 1
    return want


def made(seed, n, vocabulary):
    rng = random.Random(seed)
    return [(rng.randrange(100), "\n".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 14)))) for _ in range(n)]


@pytest.mark.parametrize("min_words", [1, 3, 7])
def test_against_all_runs(spark, min_words):
    rows = made(min_words, 25, ["a", "b c", " a ", "", "  ", "d e f", "g h i j", "k"])
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, "a\nb c"), (None, "z"), rows[0], rows[0], (203, "q\n" * 40), (204, "é x\t\ny"), (205, "y\né x")]
    want = check(spark, rows, min_words)
    assert any(n for _, n in want.values())


def test_passages_across_documents(spark):
    rng = random.Random(9)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage, short = [line(20), line(25), line(12)], line(13)
    rows = [(i, "\n".join([line(30), short, *passage, line(40)])) for i in range(8)] + [(50 + i, "\n".join([line(60), short])) for i in range(5)] + [(90, line(3) + "\n" + line(3))]
    want = check(spark, rows, 50)
    assert sorted(n for _, n in want.values()) == [0] * 7 + [4] * 7
    for (_, text), (left, n) in want.items():
        assert n or left == text


def test_no_documents(spark):
    assert delete_repeated_lines(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query_over_a_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_deleted(rows, 50, {key: (key[0], 0) for key in rows})
    found = {r["doc_id"]: (r["text_sha256"], r["n_deleted"]) for r in QUERIES["op5_line_dedup"](spark, folder).collect()}
    assert found == {d: (hashlib.sha256(t.encode()).hexdigest(), n) for (d, _), (t, n) in want.items()}
    assert any(n for _, n in found.values())
