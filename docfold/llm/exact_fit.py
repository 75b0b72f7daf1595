"""Packs documents whole into as few sequences as possible, by exact complements.

Only how many pieces there are of each length matters, and there are no more lengths than a sequence has places; so the plan is
made from a histogram of at most ``sequence`` numbers, whatever the corpus. Three tables hold in how many ways a sum arises from one, two or
three available lengths. From the longest length down, the gap that a piece leaves in its sequence is looked up there;
a combination that fills it exactly is used as often as availability allows, so each use takes one length out of the tables: single
complements first, then pairs, then triples. What has no exact complement is placed best-fit: longest first, into the fullest sequences that still have room, many alike at once.

The plan says which ranks among the pieces of one length go to which sequences. A piece's rank is its place among pieces of that
length in its partition, plus how many the partitions before hold; so pieces find their place by one equi-join with a small table, and
no task sees more than its own pieces.

A document is cut only if it is longer than a sequence, into whole sequences and a rest. A null or empty text holds the end id
alone. Repeated rows and null ids are packed each. Extra columns are ignored. An empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docfold.llm.common import doc_columns, slices
from docfold.llm.word_tokens import default_path, word_encoder
from docfold.session import written

SEQUENCE = 2048


class Plan:
    """Where pieces go: rows ``length, first, last, sequence_id, offset``: ranks ``first`` to ``last`` (exclusive) of a length lie at
    ``offset`` of as many sequences from ``sequence_id`` on."""

    def __init__(self, counts: np.ndarray, most: int = 3):
        """``counts[n]`` pieces of length ``n``; the last index is the length of a sequence. A gap is filled by at most ``most`` pieces."""
        self.size = len(counts) - 1
        self.left = np.array(counts, np.int64)
        self.used = np.zeros(len(counts), np.int64)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.one = (self.left > 0).astype(np.int64)
        self.two = np.convolve(self.one, self.one)[: self.size + 1]
        self.three = np.convolve(self.two, self.one)[: self.size + 1]
        for others in range(most + 1):
            for length in range(self.size, 0, -1):
                self._exactly(length, others)
        self._best_fit()

    def _place(self, length: int, times: int, sequence: int, offset: int) -> None:
        first = int(self.used[length])
        self.rows.append((length, first, first + times, sequence, offset))
        self.used[length] += times
        self.left[length] -= times
        if not self.left[length]:
            self._forget(length)

    def _forget(self, length: int) -> None:
        """Takes a length out of the tables of sums."""
        moved = lambda table, by: np.append(np.zeros(min(by, self.size + 1), np.int64), table)[: self.size + 1]
        self.three += 3 * moved(self.one, 2 * length) - 3 * moved(self.two, length)
        self.two -= 2 * moved(self.one, length)
        for table, of in ((self.three, -3), (self.two, 2)):
            at = length * abs(of)
            if at <= self.size:
                table[at] += 1 if of > 0 else -1
        self.one[length] = 0

    def _combinations(self, gap: int, pieces: int) -> Iterator[tuple[int, ...]]:
        """So many available lengths that add up to ``gap``, the longest first."""
        if pieces == 0 and not gap:
            yield ()
        elif pieces == 1 and self.one[gap]:
            yield (gap,)
        elif pieces == 2 and self.two[gap]:
            longer = np.arange(gap - 1, (gap - 1) // 2, -1)
            for x in longer[(self.one[longer] > 0) & (self.one[gap - longer] > 0)].tolist():
                yield x, gap - x
        elif pieces == 3 and self.three[gap]:
            longest = np.arange(gap - 2, (gap - 1) // 3, -1)
            for x in longest[(self.one[longest] > 0) & (self.two[gap - longest] > 0)].tolist():
                rest = gap - x
                longer = np.arange(min(x, rest - 1), (rest - 1) // 2, -1)
                for y in longer[(self.one[longer] > 0) & (self.one[rest - longer] > 0)].tolist():
                    yield x, y, rest - y

    def _exactly(self, length: int, pieces: int) -> None:
        """Uses a length up as far as so many other pieces fill its gap exactly."""
        while self.left[length]:
            for others in self._combinations(self.size - length, pieces):
                lengths = (length, *others)
                times = min(int(self.left[n]) // k for n, k in Counter(lengths).items())
                if times:
                    break
            else:
                return
            offset = 0
            for n in lengths:
                self._place(n, times, self.sequences, offset)
                offset += n
            self.sequences += times

    def _best_fit(self) -> None:
        room: dict[int, list[tuple[int, int]]] = {}  # gap: first sequence and number of sequences that have it
        for length in np.flatnonzero(self.left)[::-1].tolist():
            while self.left[length]:
                left = int(self.left[length])
                gap = min((g for g in room if g >= length), default=0)
                if gap:
                    first, many = room[gap].pop()
                    if not room[gap]:
                        del room[gap]
                    times = min(many, left)
                    self._place(length, times, first, self.size - gap)
                    if gap > length:
                        room.setdefault(gap - length, []).append((first, times))
                    if many > times:
                        room.setdefault(gap, []).append((first + times, many - times))
                    continue
                copies = min(self.size // length, left)
                times = left // copies
                for k in range(copies):
                    self._place(length, times, self.sequences, k * length)
                if self.size > copies * length:
                    room.setdefault(self.size - copies * length, []).append((self.sequences, times))
                self.sequences += times


def least_plan(counts: np.ndarray) -> Plan:
    """The plan of fewest sequences of those that fill gaps exactly by up to three pieces, two, one, or none.

    Where short pieces are rare, combinations of three can use them up; of equal plans, the one of most pieces counts.
    """
    return min((Plan(counts, most) for most in (3, 2, 1, 0)), key=lambda plan: plan.sequences)


def _encoded(docs: DataFrame, end_id: int, sequence: int, path: str) -> DataFrame:
    """Each piece with its ``part``ition and its ``place`` among those of its length there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = word_encoder(path), TaskContext.get().partitionId()
        before = np.zeros(sequence + 1, np.int64)
        for batch in batches:
            for part in slices(batch):
                ids, counts = encoder.encode(part.column("text").to_pylist())
                total = counts + 1
                ends = np.cumsum(total)
                whole = np.full(int(ends[-1]) if len(ends) else 0, end_id, ids.dtype)
                inner = np.ones(len(whole), bool)
                inner[ends - 1] = False
                whole[inner] = ids
                pieces = -(-total // sequence)
                doc = np.repeat(np.arange(len(total)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * sequence
                length = np.minimum(total[doc] - start, sequence)
                at = (ends - total)[doc] + start
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                place = np.empty(len(doc), np.int64)
                place[order] = before[ranked] + np.arange(len(doc)) - np.searchsorted(ranked, ranked)
                before += np.bincount(length, minlength=sequence + 1)
                wide = whole.astype("<u4")
                own = [(whole[a : a + n].tobytes(), zlib.crc32(wide[a : a + n].tobytes())) for a, n in zip(at.tolist(), length.tolist())]
                columns = [
                    part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                    pa.array([x[1] for x in own], pa.int64()), pa.array([x[0] for x in own], pa.binary()),
                    pa.array(np.full(len(doc), number), pa.int32()), pa.array(place),
                ]
                yield pa.record_batch(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "part", "place"])

    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, part int, place bigint"
    return doc_columns(docs).mapInArrow(run, kinds)


def pack_whole(docs: DataFrame, end_id: int = 0, sequence: int = SEQUENCE, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset`` of each piece.

    ``ids`` are little-endian, 2 bytes each if the vocabulary allows, else 4; the checksum is of 4-byte ids. What a caller does not select
    is not shuffled.
    """
    if sequence < 1:
        raise ValueError("a sequence holds one id at least")
    spark = docs.sparkSession
    pieces = written(_encoded(docs, end_id, sequence, path or default_path()), "pieces")
    spread = written(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = np.zeros(sequence + 1, np.int64)
    for row in spread.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``sequence`` rows
        counts[row["length"]] = row["n"]
    plan = spark.createDataFrame(least_plan(counts).rows, "length bigint, first bigint, last bigint, sequence_id bigint, `offset` bigint")
    # one row for each partition of a length
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    held = spread.select("length", "part", "n", F.coalesce(before, F.lit(0)).alias("before"))
    # rows of the plan: a few for each length, however large the corpus
    cut = held.join(F.broadcast(plan), "length").where("first < before + n and last > before")
    low = F.greatest("first", "before")
    cells = cut.select("length", "part", (low - F.col("before")).alias("low"), (F.least(F.col("last"), F.col("before") + F.col("n")) - F.col("before")).alias("high"), (F.col("sequence_id") + low - F.col("first")).alias("base"), "offset")
    placed = pieces.join(cells, ["length", "part"]).where("place >= low and place < high")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", (F.col("base") + F.col("place") - F.col("low")).alias("sequence_id"), "offset")
