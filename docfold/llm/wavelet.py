"""Token shards as wavelet matrices: one compressed file holds the ids and answers access, rank, select and counts.

A shard keeps, for each bit of the ids from the highest, the plane of that bit over all positions; ids with bit 0 then go
before those with bit 1, in stable order, to the next plane. Ones are counted before each block of 512 positions, so
every question takes one step per plane. Planes are compressed singly and opened when first asked for.

Order and shards: documents in ascending ``doc_id`` (null first; equal ids by their token ids), dealt by range; inside a
range a shard ends with the document that brings it to ``shard_tokens``. A shard holds whole documents, so memory is
bounded by ``shard_tokens`` or one document. A null or empty text holds the end id alone; repeated rows are all written.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm.common import doc_columns, slices
from docfold.llm.tokens import default_path, encoder
from docfold.session import shared_folder, written

MAGIC = b"WVM1"
BLOCK = 512
SHARD_TOKENS = 1 << 20
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class WaveletShard:
    """Ids of one shard. Build with ``of_ids`` or open with ``of_bytes``."""

    def __init__(self, n: int, zeros: np.ndarray, planes: list, doc_ids: np.ndarray, lengths: np.ndarray):
        self.n, self.zeros, self.doc_ids, self.lengths = n, zeros, doc_ids, lengths
        self._planes, self._ranks = planes, [None] * len(planes)

    @classmethod
    def of_ids(cls, ids: np.ndarray, doc_ids, lengths) -> WaveletShard:
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        zeros, planes = np.zeros(width, np.int64), []
        for level in range(width):
            ones = (ids >> ids.dtype.type(width - 1 - level)) & ids.dtype.type(1) != 0
            planes.append(np.packbits(ones))
            low = ids[~ones]
            zeros[level] = len(low)
            ids = np.concatenate([low, ids[ones]])
        return cls(int(len(ids)), zeros, planes, np.asarray(doc_ids, np.int64), np.asarray(lengths, np.int64))

    def to_bytes(self) -> bytes:
        """Magic, numbers of ids, planes and documents, then each part with its size: zeros, documents, planes."""
        pack = zstandard.ZstdCompressor(level=1).compress
        directory = np.diff(self.doc_ids, prepend=0).astype("<i8").tobytes() + self.lengths.astype("<i8").tobytes()
        parts = [self.zeros.astype("<i8").tobytes(), pack(directory)]
        parts += [pack(self._plane(level).tobytes()) for level in range(len(self._planes))]
        head = MAGIC + struct.pack("<QII", self.n, len(self._planes), len(self.doc_ids))
        return head + b"".join(struct.pack("<Q", len(p)) + p for p in parts)

    @classmethod
    def of_bytes(cls, data: bytes) -> WaveletShard:
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        n, width, docs = struct.unpack_from("<QII", data, 4)
        parts, at = [], 20
        for _ in range(width + 2):
            (size,) = struct.unpack_from("<Q", data, at)
            parts.append(data[at + 8 : at + 8 + size])
            at += 8 + size
        directory = np.frombuffer(zstandard.ZstdDecompressor().decompress(parts[1]), "<i8") if docs else np.zeros(0, np.int64)
        return cls(n, np.frombuffer(parts[0], "<i8"), parts[2:], np.cumsum(directory[:docs]), directory[docs:])

    def _plane(self, level: int) -> np.ndarray:
        plane = self._planes[level]
        if isinstance(plane, bytes):
            plane = self._planes[level] = np.frombuffer(zstandard.ZstdDecompressor().decompress(plane) if self.n else b"", np.uint8)
        return plane

    def _ones_before(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        plane = self._plane(level)
        if self._ranks[level] is None:
            counts = _ONES[np.append(plane, np.zeros(-len(plane) % (BLOCK // 8), np.uint8))].reshape(-1, BLOCK // 8).sum(1)
            self._ranks[level] = np.concatenate([[0], np.cumsum(counts)])
        block = i // BLOCK
        found = int(self._ranks[level][block]) + int(_ONES[plane[block * BLOCK // 8 : i // 8]].sum())
        return found + (int(_ONES[plane[i // 8] >> (8 - i % 8)]) if i % 8 else 0)

    def _bit(self, level: int, i: int) -> int:
        return int(self._plane(level)[i >> 3] >> (7 - (i & 7))) & 1

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(len(self._planes)):
            bit, ones = self._bit(level, i), self._ones_before(level, i)
            value = value << 1 | bit
            i = int(self.zeros[level]) + ones if bit else i - ones
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the ids equal to ``token`` of positions [start, end) stand below the last plane."""
        width = len(self._planes)
        if token < 0 or token >> width:
            return 0, 0
        for level in range(width):
            first, last = self._ones_before(level, start), self._ones_before(level, end)
            if token >> (width - 1 - level) & 1:
                start, end = int(self.zeros[level]) + first, int(self.zeros[level]) + last
            else:
                start, end = start - first, end - last
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often ``token`` stands in positions [start, end)."""
        first, last = self._range(token, start, self.n if end is None else end)
        return last - first

    def rank(self, token: int, i: int) -> int:
        """How often ``token`` stands before position ``i``."""
        return self.count(token, 0, i)

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th ``token``, from 0."""
        first, last = self._range(token, 0, self.n)
        if not 0 <= k < last - first:
            raise IndexError(k)
        i, width = first + k, len(self._planes)
        for level in range(width - 1, -1, -1):
            one = token >> (width - 1 - level) & 1
            target = i - int(self.zeros[level]) if one else i
            low, high = 0, self.n  # the first position with more than ``target`` such bits up to it
            while low < high:
                middle = (low + high) // 2
                ones = self._ones_before(level, middle + 1)
                if (ones if one else middle + 1 - ones) > target:
                    high = middle
                else:
                    low = middle + 1
            i = low
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def all_ids(self) -> np.ndarray:
        """All ids, by undoing the partitions from the last plane upwards."""
        ids, width = np.zeros(self.n, np.uint32), len(self._planes)
        for level in range(width - 1, -1, -1):
            ones = np.unpackbits(self._plane(level), count=self.n).view(bool)
            above = np.empty_like(ids)
            above[~ones] = ids[: self.zeros[level]]
            above[ones] = ids[self.zeros[level] :] | np.uint32(1 << (width - 1 - level))
            ids = above
        return ids


def encode_documents(docs: DataFrame, end_id: int, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` of each row: the ids of its whole text and the end id, as little-endian bytes of the file's id width."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_encoder = encoder(path)
        for batch in batches:
            for part in slices(batch):
                yield pa.record_batch([part.column("doc_id"), pa.array(with_end(text_encoder, part, end_id), pa.binary())], names=["doc_id", "ids"])

    return doc_columns(docs).mapInArrow(run, "doc_id bigint, ids binary")


def with_end(text_encoder, part: pa.RecordBatch, end_id: int) -> list[bytes]:
    ids, counts = text_encoder.encode(part.column("text").to_pylist())
    end = np.array([end_id], ids.dtype).tobytes()
    data, ends = ids.tobytes(), np.cumsum(counts) * ids.itemsize
    return [data[e - c * ids.itemsize : e] + end for e, c in zip(ends.tolist(), counts.tolist())]


def id_type(path: str | None = None) -> str:
    return f"<u{encoder(path or default_path()).dtype.itemsize}"


def build_shards(encoded: DataFrame, shard_tokens: int = SHARD_TOKENS, path: str | None = None) -> DataFrame:
    """Shard files in document order: ``part, shard, before`` (ids earlier in the part), ``n_tokens, n_docs, file``."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, before, kind = TaskContext.get().partitionId(), 0, 0, id_type(path)
        held: list = []
        size = 0

        def shut() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(x[1] for x in held), kind)
            lengths = [len(x[1]) // ids.itemsize for x in held]
            file = WaveletShard.of_ids(ids, [x[0] if x[0] is not None else -1 << 63 for x in held], lengths).to_bytes()
            row = {"part": part, "shard": shard, "before": before, "n_tokens": len(ids), "n_docs": len(held), "file": file}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("n_docs", pa.int64()), ("file", pa.binary())])
        for batch in batches:
            for row in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                held.append(row)
                size += len(row[1]) // int(kind[2:])
                if size >= shard_tokens:
                    yield shut()
                    shard, before, held, size = shard + 1, before + size, [], 0
        if held:
            yield shut()

    ordered = encoded.repartitionByRange("doc_id", F.xxhash64("ids")).sortWithinPartitions("doc_id", F.xxhash64("ids"), "ids")
    return ordered.mapInArrow(run, "part int, shard int, before bigint, n_tokens bigint, n_docs bigint, file binary")


def write_shards(docs: DataFrame, end_id: int, folder: str | None = None, shard_tokens: int = SHARD_TOKENS, path: str | None = None) -> str:
    """Encodes ``docs`` and writes the shard files to ``folder`` (the shared folder if not given); returns it.

    One Parquet row carries one shard file, so Spark's writers commit them whole wherever the folder is.
    """
    folder = folder or f"{shared_folder(docs.sparkSession)}/docfold/{uuid.uuid4().hex}/shards"
    build_shards(written(encode_documents(docs, end_id, path), "token_ids"), shard_tokens, path).write.parquet(folder)
    return folder


def read_shards(spark, folder: str) -> DataFrame:
    """``start, n_tokens, n_docs, file`` of each shard; ``start`` counts the ids of all shards before it.

    Only one total per part, of which there are as many as shuffle partitions, is summed over the whole.
    """
    shards = spark.read.parquet(folder)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    totals = parts.agg(F.array_sort(F.collect_list(F.struct("part", "total"))).alias("parts"))
    earlier = totals.select(
        F.explode(
            F.transform("parts", lambda p: F.struct(p["part"].alias("part"), F.aggregate(F.filter("parts", lambda q: q["part"] < p["part"]), F.lit(0).cast("bigint"), lambda s, q: s + q["total"]).alias("earlier")))
        ).alias("p")
    ).select("p.*")
    return shards.join(earlier, "part").select((F.col("earlier") + F.col("before")).alias("start"), "n_tokens", "n_docs", "file")


def shard_documents(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, file in zip(batch.column("start").to_pylist(), batch.column("file").to_pylist()):
                shard = WaveletShard.of_bytes(file)
                data, ends = shard.all_ids().astype("<u4").tobytes(), np.cumsum(shard.lengths)
                crcs = [zlib.crc32(data[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), shard.lengths.tolist())]
                ids = pa.array(shard.doc_ids, pa.int64(), mask=shard.doc_ids == -1 << 63)
                yield pa.record_batch([ids, pa.array(start + ends - shard.lengths), pa.array(shard.lengths), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("start", "file").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
