"""Near duplicates against all pairs, components against a plain search."""

import random
import re

import pytest

from docfold.llm import near_duplicates
from docfold.llm.components import components
from docfold.llm.near_duplicates import near_duplicate_groups
from docfold.llm.queries import QUERIES


def brute_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute_groups(rows):
    """Rows of (doc_id, text) to (doc_id, n, component, kept)."""
    sets = [brute_set(t) for _, t in rows]
    holders = {}
    for i, own in enumerate(sets):
        for s in own:
            holders.setdefault(s, set()).add(i)
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, own in enumerate(sets):
        for j in {j for s in own for j in holders[s] if j > i}:
            common = len(own & sets[j])
            if 100 * common >= 75 * (len(own) + len(sets[j]) - common) and None not in (rows[i][0], rows[j][0]):
                up[root(j)] = root(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(s), d if d is None else least[root(i)], d is None or d == least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def groups(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def made_rows(seed, families=12, copies=9):
    rng, rows = random.Random(seed), []
    for f in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(6, 120))]
        for _ in range(rng.randrange(1, copies)):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 25)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(own))
    rows += [None, "", " \n ", "one two", "One TWO", "one  two three", "É é", "é É", "a " * 5000, "a " * 5001, "b c d e f g h i j k " * 600]
    rng.shuffle(rows)
    return [(i * 3 - 10, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("small, levels", [(near_duplicates.SMALL, near_duplicates.LEVELS), (1, 2)])
def test_groups_against_all_pairs(spark, small, levels, monkeypatch):
    default = near_duplicates.linked_classes
    monkeypatch.setattr(near_duplicates, "linked_classes", lambda d, s: default(d, s, small, levels))
    rows = made_rows(1, 6 if small == 1 else 14)
    rows += [(rows[3][0], rows[3][1]), (rows[4][0], "another text under a used id"), (None, rows[5][1]), (None, None)]
    frame = spark.createDataFrame([(i, t, 1, "x", False) for i, t in rows], "doc_id bigint, text string, n int, v string, kept boolean")
    assert groups(near_duplicate_groups(frame)) == brute_groups(rows)


def test_large_group_of_near_copies(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        own = list(base)
        own[rng.randrange(200)] = f"y{i}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(base)) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert groups(near_duplicate_groups(frame)) == brute_groups(rows)


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_duplicate_groups(empty).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(35)] + [(7, 7)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    up = {v: v for pair in links for v in pair}
    for _ in links:
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    want = {v: m for v, m in up.items() if any(v in p and p[0] != p[1] for p in links)}
    assert {r["v"]: r["label"] for r in components(frame).collect()} == want


def test_query_over_a_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert groups(QUERIES["op2_near_duplicates"](spark, folder)) == brute_groups(rows)
