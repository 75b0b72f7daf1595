"""Packs documents into sequences along a space-filling curve.

A document's vector is the sum of fixed random directions, one per token id (a hashed bag of
tokens), scaled by the root of its length; the vector's few coordinates are cut into cells, and the place of the cell on a
Hilbert curve is the key. Documents are dealt and sorted by that key, so neighbours in a sequence use like tokens, and
each range is cut into full sequences. What remains at the end of a range is cut at powers of two, so nothing is padded.

A null or empty text holds the end id alone. Equal keys are ordered by ``doc_id``, then token ids; repeated rows are packed
each. Extra columns are ignored. An empty table gives no piece.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm.common import doc_columns, slices
from docfold.llm.tokens import default_path, encoder
from docfold.llm.wavelet import id_type
from docfold.session import written

SEQUENCE = 2048
DIMENSIONS = 4
CELL_BITS = 12


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (whole numbers below 2**bits, one column per dimension).

    Skilling's transform: undo the rotations from the highest bit down, Gray-encode, interleave.
    """
    x = cells.astype(np.uint64).T.copy()
    dims, one = len(x), np.uint64(1)
    for shift in range(bits - 1, 0, -1):
        q = np.uint64(1 << shift)
        below = q - one
        for i in range(dims):
            turned = (x[i] & q) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(turned, below, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for shift in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & np.uint64(1 << shift) != 0, np.uint64((1 << shift) - 1), np.uint64(0))
    x ^= flip
    keys = np.zeros_like(x[0])
    for shift in range(bits - 1, -1, -1):
        for i in range(dims):
            keys = keys << one | (x[i] >> np.uint64(shift)) & one
    return keys.astype(np.int64)


@functools.lru_cache(maxsize=4)
def _directions(size: int, dims: int) -> np.ndarray:
    return np.random.default_rng(20).standard_normal((size, dims)).astype(np.float32)


def curve_keys(ids: np.ndarray, counts: np.ndarray, vocabulary: int, dims: int = DIMENSIONS, bits: int = CELL_BITS) -> np.ndarray:
    """Hilbert key of each document; ``counts`` says how many of ``ids`` are its own. Without ids, the middle of the space."""
    sums = np.zeros((len(counts), dims))
    ends = np.cumsum(counts)
    some = np.flatnonzero(counts)
    if len(some):
        sums[some] = np.add.reduceat(_directions(vocabulary, dims)[ids], (ends - counts)[some], axis=0)
        sums[some] /= np.sqrt(counts[some])[:, None]
    cells = np.floor((np.tanh(sums / 4) + 1) / 2 * (1 << bits)).astype(np.int64)
    return hilbert_keys(np.clip(cells, 0, (1 << bits) - 1), bits)


def encode_with_keys(docs: DataFrame, end_id: int, path: str | None = None) -> DataFrame:
    """``doc_id, key, ids`` of each row."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_encoder = encoder(path)
        size = text_encoder.tokenizer.get_vocab_size()
        for batch in batches:
            for part in slices(batch):
                ids, counts = text_encoder.encode(part.column("text").to_pylist())
                end = np.array([end_id], ids.dtype).tobytes()
                data, ends = ids.tobytes(), np.cumsum(counts) * ids.itemsize
                whole = [data[e - c * ids.itemsize : e] + end for e, c in zip(ends.tolist(), counts.tolist())]
                yield pa.record_batch([part.column("doc_id"), pa.array(curve_keys(ids, counts, size)), pa.array(whole, pa.binary())], names=["doc_id", "key", "ids"])

    return doc_columns(docs).mapInArrow(run, "doc_id bigint, key bigint, ids binary")


PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, `offset` bigint"


def pack(docs: DataFrame, end_id: int = 1, sequence: int = SEQUENCE, path: str | None = None) -> DataFrame:
    """Pieces of documents in sequences of ``sequence`` ids: each row's ids from ``start`` lie at ``offset`` of a sequence.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers. Only sequences at the end of a range are
    shorter, each a power of two.
    """
    path = path or default_path()
    if sequence < 1:
        raise ValueError("a sequence holds one id at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = id_type(path)
        number, open_pieces, filled = TaskContext.get().partitionId() << 40, [], 0
        for batch in batches:
            rows: list = []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                ids = np.frombuffer(data, kind).astype("<u4")
                at = 0
                while at < len(ids):
                    length = min(len(ids) - at, sequence - filled)
                    open_pieces.append((doc_id, at, length, ids[at : at + length].tobytes(), len(ids), number, filled))
                    at, filled = at + length, filled + length
                    if filled == sequence:
                        rows += open_pieces
                        number, open_pieces, filled = number + 1, [], 0
            if rows:
                yield _batch(rows)
        if open_pieces:
            yield _batch(_powers(open_pieces, filled, number))

    keyed = written(encode_with_keys(docs, end_id, path), "packing")
    near = keyed.repartitionByRange("key", "doc_id", F.xxhash64("ids")).sortWithinPartitions("key", "doc_id", "ids")
    return near.select("doc_id", "ids").mapInArrow(run, PIECES)


def _powers(pieces: list, filled: int, number: int) -> list:
    """The pieces of an unfinished sequence, cut anew into sequences whose lengths are the powers of two in ``filled``."""
    rows, limits = [], [1 << b for b in range(filled.bit_length() - 1, -1, -1) if filled >> b & 1]
    offset = 0
    for doc_id, start, length, data, total, _, _ in pieces:
        while length:
            take = min(length, limits[0] - offset)
            rows.append((doc_id, start, take, data[: 4 * take], total, number, offset))
            start, length, data, offset = start + take, length - take, data[4 * take :], offset + take
            if offset == limits[0]:
                limits, number, offset = limits[1:], number + 1, 0
    return rows


def _batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def with_checksums(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
