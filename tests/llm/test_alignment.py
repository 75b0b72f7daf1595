"""Token alignment against whole texts through both libraries, and counts against a dictionary."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from docfold.llm import alignment, tokens
from docfold.llm.queries import op12_tokenizer_alignment

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(tokens.default_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.piece_path())


def brute_links(libraries, text):
    """Token ids, groups as text, and all overlapping pairs by comparing every token with every other."""
    a, b = libraries
    if not text:
        return [], [], "", []
    names = {c: v for v, c in tokens._byte_names().items()}
    ours, theirs = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    x = [bytes(names[c] for c in a.id_to_token(i)) for i in ours]
    y = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in theirs]
    if not b"".join(x) == b"".join(y) == (" " + text).encode():
        return [], [], "", []
    ends = [np.cumsum([0, *map(len, z)]) for z in (x, y)]
    links = [(q, p) for i, p in enumerate(ours) for j, q in enumerate(theirs) if ends[0][i] < ends[1][j + 1] and ends[1][j] < ends[0][i + 1]]
    groups, cuts = [], sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    for low, high in zip(cuts, cuts[1:]):
        own = [",".join(str(t) for t, e in zip(ids, z[1:]) if low < e <= high) for ids, z in zip((ours, theirs), ends)]
        groups.append("|".join(own))
    return ours, theirs, ";".join(groups), links


def brute_rows(libraries, docs):
    found = [(i, *brute_links(libraries, t)) for i, t in docs]
    counts = Counter(pair for *_, links in found for pair in links)
    highest = defaultdict(int)
    for (b, _), n in counts.items():
        highest[b] = max(highest[b], n)
    rows = []
    for i, ours, theirs, groups, links in found:
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        n_best = sum(counts[p] == highest[p[0]] for p in links)
        rows.append((i, len(ours), len(theirs), groups.count(";") + 1 if groups else 0, len(links), n_best, sum(counts[p] for p in links), sha))
    return sorted(rows, key=repr), counts, highest


def random_texts(seed, n):
    rng = random.Random(seed)
    parts = ["a", "the", " ", "  ", "\n", " \n ", "\t", "\x85 ", "\xa0", "é", "é", "中文", "🙂", "▁", "12", "<|endoftext|>", "<s>", "'s", "...", "\x1c ", "\x00", "Ａ", "word", "ﬁ"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(n)]


def test_chunks_equal_whole_texts(libraries):
    known = alignment.Aligner(tokens.default_path(), alignment.piece_path())
    assert known.by_chunks
    texts = random_texts(3, 3000)
    for text, own in zip(texts, known.chunks(texts)):
        ours, theirs, groups, links = brute_links(libraries, text)
        chunks = np.array(own, np.int64)
        found = [known.groups[c] for c in own]
        if None in found:
            assert not links
            continue
        assert ";".join(found) == groups
        assert known.sizes[chunks].sum(0).tolist() == [len(ours), len(theirs), groups.count(";") + 1 if groups else 0, len(links)]
        assert [(x >> 32, x & 0xFFFFFFFF) for x in known.links(chunks).tolist()] == sorted(links, key=links.index) or Counter((x >> 32, x & 0xFFFFFFFF) for x in known.links(chunks).tolist()) == Counter(links)


EDGES = [(1, None), (2, ""), (3, " \n "), (4, "the same row"), (4, "the same row"), (None, "no id"), (None, None), (5, "a▁b"), (6, "x" * 5000), (7, "the cat " * 2000), (8, "\x00")]


def test_edge_rows_through_all_levels_of_the_tree(spark, libraries):
    rows = EDGES + [(100 + i, t) for i, t in enumerate(random_texts(4, 150))]
    want, counts, highest = brute_rows(libraries, rows)
    docs = spark.createDataFrame([(i, t, 0, b"x") for i, t in rows], "doc_id bigint, text string, run int, pairs binary").repartition(5)
    for settings in ({}, {"run_links": 60, "radices": 3, "fan": 4}):
        found, spill = alignment.align(docs, **settings)
        assert sorted(map(tuple, found.collect()), key=repr) == want
        listed = alignment.pair_counts(spill, settings.get("fan", alignment.FAN)).collect()
        assert {(r.b, r.a): (r.n, r.best) for r in listed} == {p: (n, n == highest[p[0]]) for p, n in counts.items()} and len(listed) == len(counts)
    assert spill.where("radix is not null").select("run").distinct().count() > 16  # more than one level
    empty, spill = alignment.align(docs.limit(0))
    assert empty.count() == 0 and alignment.pair_counts(spill).count() == 0
    nothing = alignment.align(docs.where("doc_id <= 2"))[0]
    assert sorted(map(tuple, nothing.collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query(spark, libraries):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    short = [(i, t) for i, t in docs if len(t or "") < 3000]
    rows = {r.doc_id: tuple(r) for r in op12_tokenizer_alignment(spark, FOLDER).collect()}
    assert len(rows) == len(docs)
    brute, *_ = brute_rows(libraries, short)
    assert {r[0]: r[:5] + r[7:] for r in brute} == {i: rows[i][:5] + rows[i][7:] for i, _ in short}
    assert sum(r[5] > 0 for r in rows.values()) > 100
