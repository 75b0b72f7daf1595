"""Single near-threshold links between classes that share large nodes with hundreds of unlinked ones."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from docfold.llm import near_duplicates
from docfold.llm.near_duplicates import LEVELS, _branched, _deep, linked_classes, signatures
from docfold.session import written
from tests.llm.test_near_duplicates import brute_groups


def planted(seed, classes, words=220, far=8, near=6):
    """Texts in twos: all share a base at about 0.5, the two of a pair differ in ``near`` words and reach 0.75 or a little more."""
    rng, rows = random.Random(seed), []
    base = [f"w{i}" for i in range(words)]

    def edited(text, places, name):
        text = list(text)
        for place in places:
            text[place] = f"{name}_{place}"
        return text

    spots = list(range(2, words - 2, 5))
    for i in range(classes):
        own = rng.sample(spots, far)
        one = edited(base, own, f"a{i}")
        two = edited(one, rng.sample([s for s in spots if s not in own], near), f"b{i}")
        rows += [(2 * i, " ".join(one)), (2 * i + 1, " ".join(two))]
    return rows


def similarity(x, y):
    x, y = ({tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in (x, y))
    return len(x & y) / len(x | y)


def test_links_survive_all_levels(spark):
    """As if every node were large: the two of a pair still share a node at the deepest level."""
    rows = planted(7, 300)
    rng = random.Random(1)
    assert min(similarity(rows[2 * i][1], rows[2 * i + 1][1]) for i in range(300)) >= 0.75
    assert max(similarity(rows[2 * i][1], rows[2 * j][1]) for i, j in (rng.sample(range(300), 2) for _ in range(300))) < 0.75
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    signed = signatures(docs).cache()
    deep = _deep(docs, signed.select("v", "doc_id"), False).cache()
    nodes = signed.select("v", "n", F.explode("nodes").alias("node"))
    for level in range(1, LEVELS):
        nodes = _branched(nodes, deep, level)
    pair = signed.select("v", F.floor(F.col("doc_id") / 2).alias("pair"))
    met = nodes.join(pair, "v").groupBy("node", "pair").count().where("count = 2").select("pair").distinct().count()
    assert met == 300


def test_recall_at_the_deepest_level_as_coded():
    """Every token is equal with probability 0.75; each node picks its children's tokens by its path."""
    rng, pairs, missed = np.random.default_rng(5), 100_000, 0
    for _ in range(5):
        equal = rng.random((pairs, near_duplicates.DEEP)) < 0.75
        met = np.zeros(pairs, bool)
        for _ in range(near_duplicates.TREES):
            nodes = np.flatnonzero((rng.random(pairs) < 0.75**near_duplicates.FIRST) & ~met)
            for children in near_duplicates.CHILDREN:
                nodes = np.repeat(nodes, children)
                nodes = nodes[equal[nodes, rng.integers(0, near_duplicates.DEEP, len(nodes))]]
            met[nodes] = True
        missed += int((~met).sum())
    assert missed <= 20  # once in 80,000 would be 6 of these 500,000


def test_links_of_a_block_grow_with_its_classes():
    """A block gives fewer links than it has classes, whatever the size of its groups, and they connect what is similar."""
    for size in (50, 400):
        rng, base = random.Random(size), [f"w{i}" for i in range(120)]
        rows = []
        for i in range(size):
            places = rng.sample(range(2, 118, 5), 2)  # two are similar if they share a place
            rows.append((i, " ".join(f"z{i}_{k}" if k in places else w for k, w in enumerate(base))))
        sets = [near_duplicates.Shingles().of(t) for _, t in rows]
        deep = [near_duplicates._mixed(near_duplicates.minwise(x, near_duplicates._DEEP_SEEDS, near_duplicates._DEEP_FACTORS)).astype("<u2").tobytes() for x in sets]
        same = [True] * size
        columns = {"v": list(range(size)), "n": [len(x) for x in sets], "label": list(range(size)), "outer": same, "left": same, "right": same, "deep": deep}
        block = pa.table(columns | {"shingles": pa.array([x.view(np.int64) for x in sets])})
        links = near_duplicates._forest(block).to_pylist()
        parent = list(range(size))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for link in links:
            assert root(link["a"]) != root(link["b"])  # a forest
            parent[root(link["b"])] = root(link["a"])
        groups: dict[int, set] = {}
        for i in range(size):
            groups.setdefault(root(i), set()).add(i)
        want: dict[int, set] = {}
        for i, _, component, _ in brute_groups(rows):
            want.setdefault(component, set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_one_large_component_beside_outsiders(spark, monkeypatch):
    """Each outsider of a large node is linked by one late comparison; the number of rounds does not grow with the component."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join([*base[:60], f"c{i}", *base[61:]])) for i in range(400)]
    for i in range(40):
        places = rng.sample(range(10, 145, 12), 7)
        own = [f"o{i}_{k}" if k in places else w for k, w in enumerate(base)]
        rows += [(1000 + 2 * i, " ".join(own)), (1001 + 2 * i, " ".join([*own[:146], f"p{i}", *own[147:]]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    rounds = []
    one = near_duplicates._pairs
    monkeypatch.setattr(near_duplicates, "_pairs", lambda *a: rounds.append(1) or one(*a))
    monkeypatch.setattr(near_duplicates, "BLOCK", 64)
    signed = written(signatures(docs), "signatures")
    labels = {r["v"]: r["label"] for r in linked_classes(docs, signed, 1, 1).collect()}
    found = {r["doc_id"]: labels.get(r["v"], r["v"]) for r in signed.select("doc_id", "v").collect()}
    parent = {d: d for d, _ in rows}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    sets = [(d, {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}) for d, t in rows]
    for k, (d, x) in enumerate(sets):
        for e, y in sets[k + 1 :]:
            if 4 * len(x & y) >= 3 * len(x | y):
                parent[root(e)] = root(d)
    groups, want = {}, {}
    for d, _ in rows:
        groups.setdefault(found[d], set()).add(d)
        want.setdefault(root(d), set()).add(d)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert len(want) > 20 and len(rounds) == 2
