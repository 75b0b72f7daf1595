"""Periodic runs of words in texts, by string synchronising sets.

A run is a longest stretch of words in which words ``q`` apart are identical, ``q`` is the least such number, and the stretch has
at least ``2 * q`` words. At each scale ``t`` = 1, 2, 4, ... a set of positions is selected by hashes of the ``t`` words from a position
on: a position is selected if the least hash within the next ``t`` is its own or the last one's. The choice depends on the
``2 * t`` words from the position on alone, so it is the same wherever these words are the same. Blocks with a period of ``t / 3`` or less are left
out of the choice; they lie in runs of small period that smaller scales have found. Two selected positions with the same context
of ``2 * t`` words, ``3 * t`` to ``6 * t`` words apart, propose their distance as a period; there are at most 18 such partners of a position.
The proposal is extended both ways as far as words that far apart are equal, by binary search over prefix hashes, and checked word by word.

Highly periodic regions hold no selected position, so what they hold is supplied separately: periods 1 and 2 by comparing
neighbours, and a period whose repeated part is itself periodic with a small ``q`` by the place where two runs of ``q``
touch; the periods possible there are known up to a multiple of ``q``. With both, every run is found.

Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no words and no runs. Repeated rows and equal or null ids are each
treated by themselves, since a result depends on its own text alone. Extra columns are ignored. An empty table gives no row.
Texts are handled whole; memory for one is some hundred bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm.common import doc_columns, slices

LEAST_LENGTH = 12
_BASE = 0x9E3779B97F4A7C15  # odd, so that powers can be undone
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_NEVER = np.uint64((1 << 64) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


class _Words:
    """Words of several texts as numbers in one array; behind each text stands a number that occurs nowhere else."""

    def __init__(self, texts: list[np.ndarray]):
        ends = [np.array([-1 - k], np.int64) for k in range(len(texts))]
        self.words = np.concatenate([x for pair in zip(texts, ends) for x in pair])
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.n = len(self.words)
        with np.errstate(over="ignore"):
            powers = np.full(self.n + 1, _BASE, np.uint64)
            powers[0] = 1
            self.powers = np.multiply.accumulate(powers)
            self.prefix = np.append(np.uint64(0), np.add.accumulate(_mixed(self.words.view(np.uint64)) * self.powers[:-1]))

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each position on; equal for equal words, wherever they stand."""
        ends = np.minimum(at + size, self.n)
        return _mixed((self.prefix[ends] - self.prefix[at]) * self.powers[self.n - at])

    def _equal(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.prefix[i + size] - self.prefix[i]) * self.powers[j - i] == self.prefix[j + size] - self.prefix[j]

    def _longest(self, most: np.ndarray, equal) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = equal(middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low

    def extended(self, i: np.ndarray, period: np.ndarray) -> np.ndarray:
        """``start, end, period`` of the longest stretches around ``i`` and ``i + period``; those of less than two periods are left out."""
        j = i + period
        ahead = self._longest(self.n - j, lambda size: self._equal(i, j, size))
        back = self._longest(i.copy(), lambda size: self._equal(i - size, j - size, size))
        found = np.stack([i - back, j + ahead, period], 1)[back + ahead >= period]
        return np.unique(found, axis=0)

    def checked(self, runs: np.ndarray) -> np.ndarray:
        """The runs, each compared word by word; one that a hash had made too long is measured again from its middle."""
        out = []
        for start, end, period in runs.tolist():
            same = self.words[start : end - period] == self.words[start + period : end]
            if not same.all():
                middle = len(same) // 2
                before, after = np.flatnonzero(~same[:middle]), np.flatnonzero(~same[middle:])
                end = start + middle + int(after[0]) + period if len(after) else end
                start = start + int(before[-1]) + 1 if len(before) else start
            if end - start >= 2 * period:
                out.append((start, end, period))
        return np.array(out, np.int64).reshape(-1, 3)


def _neighbours(words: np.ndarray, period: int) -> np.ndarray:
    """``start, end, period`` of all longest stretches of a period, by comparing words that far apart."""
    same = np.concatenate([[False], words[:-period] == words[period:], [False]]).view(np.int8)
    starts, ends = (np.flatnonzero(np.diff(same) == step) for step in (1, -1))
    long = ends - starts >= period
    return np.stack([starts[long], ends[long] + period, np.full(long.sum(), period)], 1)


def _least_periods(runs: np.ndarray) -> np.ndarray:
    """One row for each stretch, with its least period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    return runs[first]


def _touching(words: np.ndarray, runs: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and periods, ``3 * scale`` to ``6 * scale``, proposed where two runs of one small period touch."""
    small = runs[(runs[:, 2] * 3 <= scale) & (runs[:, 1] - runs[:, 0] >= 3 * scale)]
    small = small[np.lexsort((small[:, 0], small[:, 2]))]
    pairs = np.flatnonzero((small[1:, 2] == small[:-1, 2]) & (small[:-1, 1] >= small[1:, 0])) if len(small) > 1 else []
    at, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in pairs:
        (x1, y1, q), (x2, y2, _) = small[k].tolist(), small[k + 1].tolist()
        root, place = words[x2 : x2 + q].tobytes(), -1
        text = words[x1 : x1 + 2 * q - 1].tobytes()
        while True:  # the place of the second run's beginning in a period of the first
            place = text.find(root, place + 1)
            if place < 0 or place % 8 == 0:
                break
        if place < 0:
            continue
        step = np.arange((x2 - x1 - place // 8) % q, min(6 * scale, y1 - x1 + 1, y2 - x2 + 1), q)
        step = step[step >= 3 * scale]
        anchor = np.maximum(x1, x2 - step)
        fits = (anchor < y1) & (anchor + step < y2)
        at.append(anchor[fits])
        periods.append(step[fits])
    return np.concatenate(at), np.concatenate(periods)


def _selected(text: _Words, runs: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the synchronising set of a scale, in texts long enough for it, and the hashes of their contexts."""
    long = text.sizes >= 6 * scale
    begins, sizes = text.begins[long], text.sizes[long]
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    offset = np.cumsum(sizes) - sizes
    at = np.repeat(begins - offset, sizes) + np.arange(total)
    inner = np.repeat(begins + sizes, sizes) - at >= 2 * scale  # the context ends within the text
    own = text.hashes(at, scale) >> np.uint64(1)
    periodic = runs[(runs[:, 2] * 3 <= scale) & (runs[:, 1] - runs[:, 0] >= scale)]
    if len(periodic):
        steps = np.zeros(text.n + 2, np.int64)
        np.add.at(steps, periodic[:, 0], 1)
        np.add.at(steps, periodic[:, 1] - scale + 1, -1)
        own[np.cumsum(steps)[at] > 0] = _NEVER
    least = own
    width = 1
    while width < scale:
        least = np.minimum(least, np.append(least[width:], np.full(min(width, len(least)), _NEVER)))
        width *= 2
    last = np.append(own[scale:], np.full(min(scale, len(own)), _NEVER))
    least = np.minimum(least, last)
    chosen = inner & (least != _NEVER) & ((own == least) | (last == least))
    at = at[chosen]
    return at, text.hashes(at, 2 * scale)


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """``start, length, period`` of the runs of each text (words as numbers from 0 on), by start, then period."""
    if not texts:
        return []
    text = _Words(texts)
    with np.errstate(over="ignore"):
        runs = np.concatenate([_neighbours(text.words, p) for p in (1, 2) if text.n > p] or [np.zeros((0, 3), np.int64)])
        runs = _least_periods(runs)
        scale = 1
        while 6 * scale <= text.sizes.max():
            at, periods = _touching(text.words, runs, scale)
            proposed = [(at, periods)]
            chosen, context = _selected(text, runs, scale)
            order = np.argsort(context, kind="stable")
            chosen, context = chosen[order], context[order]
            for step in range(1, len(chosen)):
                far = chosen[step:] - chosen[:-step]
                near = (context[step:] == context[:-step]) & (far < 6 * scale)
                if not near.any():
                    break
                near &= far >= 3 * scale
                proposed.append((chosen[:-step][near], far[near]))
            at, periods = (np.concatenate(c) for c in zip(*proposed))
            if len(at):
                runs = _least_periods(np.concatenate([runs, text.checked(text.extended(at, periods))]))
            scale *= 2
    runs = runs[runs[:, 1] - runs[:, 0] >= LEAST_LENGTH]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    bounds = np.searchsorted(runs[:, 0], np.append(text.begins, text.n))
    out = []
    for k, begin in enumerate(text.begins.tolist()):
        own = runs[bounds[k] : bounds[k + 1]]
        out.append(np.stack([own[:, 0] - begin, own[:, 1] - own[:, 0], own[:, 2]], 1))
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words but those of a run after its first period, joined by one blank."""
    if not len(runs):
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


FOUND = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of each row: its runs by start, then period, and its words without repetitions."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                split = [t.encode("utf-8", "surrogatepass").split() for t in part.column("text").to_pylist()]
                numbers: dict[bytes, int] = {}
                texts = [np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64) for words in split]
                found = find_runs(texts)
                flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
                offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], ["start", "length", "period"]))
                kept = pa.array([collapsed(words, r).decode("utf-8", "surrogatepass") for words, r in zip(split, found)], pa.string())
                yield pa.record_batch([part.column("doc_id"), pa.array([len(w) for w in split], pa.int64()), runs.cast(kind), kept], names=["doc_id", "n_words", "runs", "collapsed"])

    return doc_columns(docs).mapInArrow(run, FOUND)


def runs_digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (of equals the first, then that of least period), and SHA-256 of all runs and of the collapsed text."""
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period")))
    found = found.withColumn("main", F.array_min(order))
    length = -F.col("main.size")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("main.start").alias("start"),
        length.alias("length"),
        F.col("main.period").alias("period"),
        F.expr("(-main.size * 1000) div main.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where one text in ten, chosen by the CRC-32 of its id, ends in repeats of a part of itself."""
    doc = doc_columns(docs)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    own = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    doc = doc.withColumn("g", F.floor(h / 10)).withColumn("own", F.when(h % 10 == 0, own))
    doc = doc.withColumn("n", F.size("own").cast("bigint"))
    doc = doc.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    doc = doc.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    changed = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.get(F.col("own"), place(i).cast("int")))
    return doc.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))
