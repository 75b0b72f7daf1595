"""Periodic runs against comparing all words at all distances."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from docfold.llm.periodic_runs import find_runs, periodic_runs
from docfold.llm.queries import op13_periodic_runs

FOLDER = "/root/testdata/sf0.001"


def brute_runs(words):
    """``start, length, period`` by start, then period, from every distance."""
    numbers = {}
    w = np.array([numbers.setdefault(x, len(numbers)) for x in words], np.int64)
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]]).view(np.int8)
        for s, e in zip(np.flatnonzero(np.diff(same) == 1).tolist(), np.flatnonzero(np.diff(same) == -1).tolist()):
            if e - s >= q:
                found.setdefault((s, e + q), q)  # a stretch's least period comes first
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(12, 2 * q))


def brute_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return (text or "").encode().split()


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is None or h % 10 or not words:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def strings(seed):
    rng = random.Random(seed)
    fib = ["a", "ab"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    thue = "a"
    while len(thue) < 600:
        thue += thue.translate(str.maketrans("ab", "ba"))
    root = lambda k, letters: "".join(rng.choice(letters) for _ in range(k))
    yield fib[-1]
    yield thue
    for letters in ("ab", "abc", "abcdefgh"):
        for _ in range(12):
            yield root(rng.randint(0, 300), letters)
            part = root(rng.randint(1, 60), letters)
            yield root(30, letters) + part * rng.randint(2, 9) + part[: rng.randint(0, len(part))] + root(30, letters)
    for _ in range(30):  # runs of a small period that touch, within runs of a large one
        small = root(rng.randint(1, 4), "ab")
        a, b = small * rng.randint(2, 20), small * rng.randint(2, 20)
        piece = a + small[: rng.randint(0, len(small))] + b + root(rng.randint(0, 3), "abc")
        yield piece * rng.randint(1, 6) + root(rng.randint(0, 9), "ab")
    yield "a" * 500
    yield "a" * 200 + "b" + "a" * 200 + "b" + "a" * 77


@pytest.mark.parametrize("seed", range(4))
def test_all_runs_are_found(seed):
    texts = list(strings(seed))
    found = find_runs([np.array([ord(c) for c in t], np.int64) for t in texts])
    for text, runs in zip(texts, found):
        assert [tuple(r) for r in runs.tolist()] == brute_runs(text), text


def test_edge_rows(spark):
    long = " ".join(str(i % 700) for i in range(30_000))
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t", "x"), (4, "a " * 50, "x"), (4, "a " * 50, "x"), (None, "a b " * 6, "x"), (5, long, "x"), (6, "one two", "x"), (7, "\x85 " * 12, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string")
    found = sorted(([r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed] for r in periodic_runs(docs).collect()), key=repr)
    want = []
    for doc_id, text, _ in rows:
        words = [w.decode() for w in words_of(text)]
        runs = brute_runs(words) if doc_id != 5 else [(0, 30_000, 700)]
        want.append([doc_id, len(words), runs, brute_collapsed(words, runs)])
    assert found == sorted(want, key=repr)
    assert periodic_runs(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r for r in op13_periodic_runs(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    some = 0
    for doc_id, text in docs:
        words = [w.decode() for w in planted(doc_id, words_of(text))]
        runs = brute_runs(words)
        some += bool(runs)
        main = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        milli = 1000 * main[1] // main[2] if runs else None
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want = (doc_id, len(runs), *main, milli, sha(listed), sha(brute_collapsed(words, runs)))
        assert tuple(rows[doc_id]) == want
    assert some >= 10 and len(rows) == len(docs)
