"""Exact-complement packing: ids against the library, plans against their bounds, pieces against the texts."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from docfold.llm import word_tokens
from docfold.llm.exact_fit import least_plan, pack_whole
from docfold.llm.queries import op11_exact_fit

FOLDER = "/root/testdata/sf0.001"


def test_ids_equal_the_library(spark):
    tokenizer = Tokenizer.from_file(word_tokens.default_path())
    encoder = word_tokens.WordEncoder(word_tokens.default_path())
    assert encoder.by_words
    rng = random.Random(5)
    letters = "aB'sé́ \t\n\x0b\x0c\r\x1c\x85\xa0 가Σς1٣-.,中🙂ſİ"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)] + ["", "a <|endoftext|> b", "it's we're"]
    texts += ["".join(rng.choices("abcéüßÑçÀñ.,$%&'9²ªøĲŉǅɐ", k=rng.randint(1, 6))) for _ in range(3000)]
    texts += [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect() if r.text]
    for part in (texts[:1500], texts[1500:3003], texts[3003:], texts):
        ids, counts = encoder.encode(part)
        want = [e.ids for e in tokenizer.encode_batch(part, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def checked(counts, size):
    """The plan's sequences, after checking that every piece lies in exactly one place and no sequence has a hole."""
    plan = least_plan(np.array(counts))
    ranks, held = defaultdict(list), defaultdict(list)
    for length, first, last, sequence, offset in plan.rows:
        ranks[length].append((first, last))
        for k in range(last - first):
            held[sequence + k].append((offset, length))
    for length in range(1, size + 1):
        at = 0
        for first, last in sorted(ranks[length]):
            assert first == at
            at = last
        assert at == counts[length]
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(held) == list(range(plan.sequences))
    return plan


def first_fit(counts, size):
    room = []
    for length in range(size, 0, -1):
        for _ in range(counts[length]):
            for k, r in enumerate(room):
                if r >= length:
                    room[k] -= length
                    break
            else:
                room.append(size - length)
    return len(room)


@pytest.mark.parametrize("seed", range(6))
def test_plans(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(5, 70))
    for _ in range(40):
        counts = np.append(0, rng.integers(0, rng.integers(1, 12), size) * (rng.random(size) < rng.random()))
        plan = checked(counts, size)
        least = -(-int((counts * np.arange(size + 1)).sum()) // size)
        assert least <= plan.sequences <= first_fit(counts, size) + 1
    counts = np.zeros(2049, np.int64)
    counts[[1, 2, 700, 2048]] = [10**12, 10**11, 10**12 + 1, 5]
    plan = least_plan(counts)
    assert plan.sequences == 5 + (10**12 + 2) // 2 and len(plan.rows) < 50_000  # two of length 700 in each
    assert sum(last - first for _, first, last, *_ in plan.rows) == counts.sum()


def check_pieces(docs, rows, sequence=2048, end_id=0):
    tokenizer = Tokenizer.from_file(word_tokens.default_path())
    want = defaultdict(int)
    for doc_id, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id], "<u4")
        for piece, start in enumerate(range(0, len(ids), sequence)):
            own = ids[start : start + sequence]
            want[(doc_id, piece, start, len(own), zlib.crc32(own.tobytes()))] += 1
    held = defaultdict(list)
    for r in rows:
        want[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] -= 1
        held[r.sequence_id].append((r.offset, r.length))
    assert not any(want.values())
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= sequence
    total = sum(r.length for r in rows)
    return len(held), -(-total // sequence)


def test_query(spark):
    rows = op11_exact_fit(spark, FOLDER).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    used, least = check_pieces(docs, rows)
    assert used <= least + 1


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "word " * 5000), (4, "word " * 5000), (None, "no id"), (None, None), (7, "z" * 9000)]
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id bigint, text string, piece int, length int, part string").repartition(3)
    found = pack_whole(docs).collect()
    check_pieces(rows, found)
    ids = {r.doc_id: np.frombuffer(r.ids, "<u2").tolist() for r in found if r.doc_id in (1, 2)}
    assert ids == {1: [0], 2: [0]}
    check_pieces(rows, pack_whole(docs, sequence=7).collect(), sequence=7)
    assert pack_whole(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pack_whole(docs, sequence=0)
