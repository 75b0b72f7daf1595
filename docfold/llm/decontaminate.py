"""Finds passages of benchmark items in documents, and takes them out.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z: letters, digits, and everything beyond
ASCII. A window is ``n`` consecutive words of an item; an item of fewer words, but not none, is one window. The windows
go to every executor as a hash set in blocks of at most ``block_chars`` characters of items (or one item), so the size of
a broadcast does not depend on the size of the benchmark; each block is one pass. A hit in the set is checked word by word.

Null and empty texts have no words, and items without words no windows. Repeated rows are each scanned. An item id that
is null marks words but is not listed; an item id given twice stands for both texts. An empty benchmark hits nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm.common import slices
from docfold.session import written

WINDOW = 10
BLOCK_CHARS = 16 << 20
_FOLD = bytes(b if chr(b).isdigit() and b < 128 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_STEP = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Windows:
    """The windows of some items, by length; words are numbered from 1, and 0 stands for any other word."""

    def __init__(self, items: list[tuple[int | None, str | None]], n: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[bytes, set] = {}
        for item_id, text in items:
            own = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)], np.uint32)
            size = min(n, len(own))
            for i in range(len(own) - size + 1 if size else 0):
                owners.setdefault(own[i : i + size].tobytes(), set()).add(item_id)
        self.owners = owners
        self.hashes = {}
        for size in sorted({len(k) // 4 for k in owners}):
            keys = np.frombuffer(b"".join(k for k in owners if len(k) == 4 * size), np.uint32)
            self.hashes[size] = np.unique(_rolling(keys, size)[::size])

    def scan(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], set]]:
        """Of each text: number of words, hit spans of words (merged, end exclusive), and the items."""
        split = [words(t) for t in texts]
        begins, ids = [], [0]
        number = self.numbers.get
        for own in split:
            begins.append(len(ids))
            ids += [number(w, 0) for w in own]
            ids.append(0)  # so that no window reaches over two texts
        array = np.array(ids, np.uint32)
        known = array != 0
        last_other = np.maximum.accumulate(np.where(known, 0, np.arange(len(array))))
        run = np.arange(len(array)) - last_other  # known words up to here
        begin = np.array(begins)
        found: list = [(len(own), [], set()) for own in split]
        for size, hashes in self.hashes.items():
            ends = np.flatnonzero(run >= size)
            if not len(ends):
                continue
            at = ends - size + 1
            sums = _rolling(array, size)[at]
            near = np.minimum(np.searchsorted(hashes, sums), len(hashes) - 1)
            for i in at[hashes[near] == sums].tolist():
                owners = self.owners.get(array[i : i + size].tobytes())
                if owners:
                    k = int(np.searchsorted(begin, i, "right")) - 1
                    found[k][1].append((i - begins[k], i - begins[k] + size))
                    found[k][2].update(owners)
        return [(n, merged(spans), owners) for n, spans, owners in found]


def _rolling(ids: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(max(0, len(ids) - size + 1), np.uint64)
    factor = 1
    for i in range(size):
        factor = factor * _STEP & 0xFFFFFFFFFFFFFFFF
        total += ids[i : i + len(total)] * np.uint64(factor)
    return total


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list]:
    items = benchmark.select(benchmark["item_id"].cast("bigint").alias("item_id"), benchmark["text"].alias("text")).where("text is not null").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // block_chars))  # one empty block of an empty benchmark
    for k in range(count):
        block = items if count == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield [tuple(row) for row in block.toLocalIterator()]


FOUND = "n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<bigint>"


def find_overlaps(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, n_words, spans, items`` of each document: hit words as merged spans of word positions, items ascending."""
    spark = docs.sparkSession
    empty = F.from_json(F.lit("{}"), FOUND)
    at = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    at = at.select("doc_id", "text", F.lit(0).cast("bigint").alias("n_words"), empty["spans"].alias("spans"), empty["items"].alias("items"))
    for k, block in enumerate(_blocks(benchmark, block_chars)):
        known = spark.sparkContext.broadcast(Windows(block, n))

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    yield _merge(part, known.value)

        at = (written(at, "overlaps") if k else at).mapInArrow(run, f"doc_id bigint, text string, {FOUND}")
    return at.select("doc_id", "n_words", "spans", "items")


def _merge(part: pa.RecordBatch, known: Windows) -> pa.RecordBatch:
    """The part with what this block adds to the spans and items found by earlier ones."""
    found = known.scan(part.column("text").to_pylist())
    spans, items = [], []
    for (_, own, owners), had, listed in zip(found, part.column("spans").to_pylist(), part.column("items").to_pylist()):
        every = merged(own + [(s["start"], s["end"]) for s in had or []])
        spans.append([{"start": a, "end": b} for a, b in every])
        items.append(sorted({*(o for o in owners if o is not None), *(listed or [])}))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    columns = [part.column("doc_id"), part.column("text"), pa.array([f[0] for f in found], pa.int64()), pa.array(spans, kind), pa.array(items, pa.list_(pa.int64()))]
    return pa.record_batch(columns, names=["doc_id", "text", "n_words", "spans", "items"])


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between words of one span."""
    places = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join(kept) + text[at:]


def remove_overlaps(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with benchmark passages cut out of ``text`` until none is left; other rows and columns stay as they are.

    What is cut can make neighbours of words that were apart, so a changed text is scanned again, by the same block at once and
    by all blocks if there are several, until a whole round changes nothing.
    """
    spark, columns = docs.sparkSession, docs.columns
    mark = "changed"
    while mark in columns:
        mark += "_"
    unsettled, done = docs.withColumn(mark, F.lit(False)), []
    while True:
        out, several = unsettled, False
        for k, block in enumerate(_blocks(benchmark, block_chars)):
            known = spark.sparkContext.broadcast(Windows(block, n))

            def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for part in slices(batch):
                        yield _cut(part, mark, known.value)

            several = k > 0
            out = (written(out, "overlaps") if k else out).mapInArrow(run, out.schema)
        if not several:
            done.append(out.select(columns))
            break
        out = written(out, "overlaps")
        done.append(out.where(~F.col(mark)).select(columns))
        unsettled = out.where(F.col(mark)).withColumn(mark, F.lit(False))
        if not unsettled.take(1):
            break
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionAll(more)
    return whole


def _cut(part: pa.RecordBatch, mark: str, known: Windows) -> pa.RecordBatch:
    """The part without passages of this block; ``mark`` is set in rows that it has changed."""
    texts = part.column("text").to_pylist()
    changed = {}
    for i, (_, spans, _) in enumerate(known.scan(texts)):
        while spans:
            changed[i] = cut_words(changed.get(i, texts[i]), spans)
            spans = known.scan([changed[i]])[0][1]
    if not changed:
        return part
    values = {"text": [changed.get(i, t) for i, t in enumerate(texts)], mark: [i in changed or was for i, was in enumerate(part.column(mark).to_pylist())]}
    for name, value in values.items():
        where = part.schema.get_field_index(name)
        part = part.set_column(where, part.schema.field(where), pa.array(value, part.schema.field(where).type))
    return part


def overlap_digest(found: DataFrame) -> DataFrame:
    """Numbers of words, hit words and items of each document, and the SHA-256 of its item ids as sorted strings."""
    hits = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (hits > 0).alias("contaminated"))
