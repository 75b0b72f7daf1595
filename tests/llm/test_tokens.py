"""Encoder, wavelet shards and packing against the tokenizers library and plain arrays."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from docfold.llm import tokens
from docfold.llm.packing import curve_keys, hilbert_keys, pack, with_checksums
from docfold.llm.queries import QUERIES
from docfold.llm.wavelet import WaveletShard, read_shards, shard_documents, write_shards

PARTS = [" ", "  ", "\n", " \n", "\n ", "a", "Word", "é", "ñó", ".", ",", "!", "'s", "'ll", "1", "23", "²", " ", " ",
         "　", "\x1c", "\t", "日本", "😀", "_", "-", "\x00", "ʼ", "the", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.default_path())


def test_encoder_equals_the_library(library):
    random.seed(7)
    own = tokens.TextEncoder(tokens.default_path())
    for r in range(120):
        parts = PARTS if r % 3 == 0 else PARTS[:-1]
        texts = ["".join(random.choice(parts) for _ in range(random.randrange(40))) for _ in range(20)]
        ids, counts = own.encode(texts)
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_encoder_with_a_full_table_and_pool(library, monkeypatch):
    monkeypatch.setattr(tokens, "SLOT_BITS", 3)
    monkeypatch.setattr(tokens, "POOL_LIMIT", 50)
    own = tokens.TextEncoder(tokens.default_path())
    for r in range(5):
        texts = [f"word{r} other.Thing {i} averyveryverylongwordindeed{r}" * 3 for i in range(20)]
        ids, _ = own.encode(texts)
        assert ids.tolist() == [i for e in library.encode_batch(texts, add_special_tokens=False) for i in e.ids]


@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 513, 3000])
def test_wavelet_answers(n):
    ids = np.random.default_rng(n).integers(0, 40, n).astype(np.uint16)
    lengths = [n] if n else []
    shard = WaveletShard.of_bytes(WaveletShard.of_ids(ids, [5] * len(lengths), lengths).to_bytes())
    assert shard.all_ids().tolist() == ids.tolist() and shard.doc_ids.tolist() == [5] * len(lengths)
    for i in range(0, n, 97):
        assert shard.access(i) == ids[i]
        assert shard.rank(int(ids[i]), i) == (ids[:i] == ids[i]).sum()
    for token in (0, 3, 39, 40, 1000):
        places = np.flatnonzero(ids == token).tolist()
        assert shard.count(token) == len(places)
        assert shard.occurrences(token) == places
        assert shard.count(token, n // 3, n // 2) == sum(n // 3 <= p < n // 2 for p in places)


ROWS = [(3, "b c.\nd"), (1, None), (2, ""), (3, "b c.\nd"), (None, "x"), (-4, "long " * 3000), (9, "é😀")]


def want_ids(library, text, end):
    return [*library.encode(text or "", add_special_tokens=False).ids, end]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, 1, "s", 2) for i, t in rows], "doc_id bigint, text string, n_tokens int, ids string, key int")


def check_shards(library, rows, found):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for doc_id, text in order:
        ids = want_ids(library, text, 2)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(found, key=lambda r: r[1]) == want


@pytest.mark.parametrize("shard_tokens", [1, 100, 1 << 20])
def test_shards_round_trip(spark, library, shard_tokens):
    shards = read_shards(spark, write_shards(frame(spark), 2, shard_tokens=shard_tokens))
    check_shards(library, ROWS, [tuple(r) for r in shard_documents(shards).collect()])


def test_shards_of_nothing(spark):
    assert shard_documents(read_shards(spark, write_shards(frame(spark, []), 2))).count() == 0


def check_pieces(library, rows, found, sequence=2048):
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    wanted = {}
    for doc_id, text in rows:
        wanted.setdefault(doc_id, []).append(want_ids(library, text, 1))
    assert by_doc.keys() == wanted.keys()
    for doc_id, copies in wanted.items():
        assert sum(r["length"] for r in by_doc[doc_id]) == sum(map(len, copies))
        for r in by_doc[doc_id]:
            options = [c for c in copies if len(c) == r["doc_tokens"]]
            crcs = {zlib.crc32(np.array(c[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) for c in options}
            assert r["ids_crc32"] in crcs and r["length"] > 0
    for pieces in by_sequence.values():
        end = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= sequence and (end == sequence or end & (end - 1) == 0)


def test_pieces(spark, library):
    check_pieces(library, ROWS, with_checksums(pack(frame(spark))).collect())
    check_pieces(library, ROWS, with_checksums(pack(frame(spark), sequence=64)).collect(), 64)
    assert with_checksums(pack(frame(spark, []))).count() == 0


def test_curve_neighbours_touch():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(1 << dims * bits))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_like_documents_have_like_keys():
    ids = np.array([5, 6, 7, 8] * 50 + [5, 6, 7, 8] * 50 + [900, 901] * 100, np.uint16)
    a, b, c = curve_keys(ids, np.array([200, 200, 200]), 1000).tolist()
    assert a == b != c
    assert curve_keys(ids[:0], np.array([0]), 1000).shape == (1,)


def test_queries_over_given_tables(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    check_shards(library, rows, [tuple(r) for r in QUERIES["op6_wavelet_shards"](spark, folder).collect()])
    check_pieces(library, rows, QUERIES["op10_curve_packing"](spark, folder).collect())
