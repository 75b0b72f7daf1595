"""Aligns the tokens of two tokenizers over each text and counts which pairs of token ids share bytes, by external spill counting.

A text is cut before each blank that follows something other than white space and isn't its last character; both tokenizers end a token there, so ids of a text
are the ids of these chunks one after another, and so are its groups (stretches of bytes at whose end both have a token end). Chunks repeat:
each is encoded and aligned once per worker. The result equals encoding whole texts.

Counting: a task gathers links (pairs of overlapping tokens) of whole documents up to ``RUN_LINKS``, sorts them by pair and document, and
spills them as one run: for each of ``RADICES`` radix partitions of the second tokenizer's id, the run's pairs with their number of links,
and the documents of each pair, compressed with zstd. The spill is a table in the shared folder. The runs of a partition are merged through a heap in
the order of the second id, so all counts of one such id are there at once and so is their highest. The same pass streams the
contributions back: for each run, the count of each of its pairs and whether it is the highest. More than ``FAN`` runs are merged in
a tree, upwards with totals and downwards with counts. Last, each run adds up what its documents get.

A pair that very many documents hold is one number in each run, so no task grows with it: a task holds the pairs of ``FAN`` runs
of one partition, or one run, which is ``RUN_LINKS`` links of at most
``RUN_DOCS`` documents, or one text.

Null and empty texts, and texts that one of the tokenizers does not give back byte by byte, have no tokens and no links. Repeated rows
each count. A null ``doc_id`` stays null. Extra columns are ignored. An empty table gives no row.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm.common import doc_columns, slices
from docfold.llm.tokens import _byte_names as byte_names
from docfold.llm.tokens import default_path
from docfold.session import written

RUN_LINKS = 1 << 21
RADICES = 128
FAN = 256
#: Chunks that are aligned at once.
LEARNED_CHUNKS = 50_000
#: Documents of a run, and chunks and characters of chunks that a worker remembers.
RUN_DOCS = 1 << 17
KNOWN_CHUNKS, KNOWN_CHARS = 200_000, 1 << 23
_CUT = re.compile(r"(?<=\S) (?!\Z)")
#: Letters up to U+023F, then ASCII punctuation but the apostrophe: two parts of the byte-level pattern at most.
_SIMPLE = re.compile("([A-Za-z\xc0-\u023f]+)([!-&(-/:-@\\[-`{-~]*)")


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class _Numbers(dict):
    """Numbers chunks in the order they are met; ``fresh`` lists those met since it was emptied."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.fresh.append(chunk)
        return number


class Aligner:
    """Alignment of chunks, remembered. A chunk stands for itself with a blank before."""

    def __init__(self, byte_path: str, model_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        named = {c: b for b, c in byte_names().items()}
        size = self.a.get_vocab_size()
        self.a_bytes = [bytes(named.get(c, 63) for c in self.a.id_to_token(i) or "") for i in range(size)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        numbers = range(max(len(self.a_bytes), len(self.b_bytes)))
        self.listed, self.barred, self.ended = (np.array([f"{i}{mark}" for i in numbers], object) for mark in ",|;")
        self.names = byte_names()
        self.tail = functools.lru_cache(10_000)(self._tail)
        said = json.loads(self.a.to_str())
        split = said.get("pre_tokenizer") or {}
        # no token of either may reach over the cut
        self.by_chunks = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not said.get("normalizer")
            and not any("▁" in p.lstrip("▁") for p in pieces)
        )
        self._reset()

    def _reset(self) -> None:
        self.numbers, self.chars = _Numbers(), 0
        self.groups: list[str | None] = []  # None where bytes are not given back
        self.sizes = np.zeros((0, 4), np.int64)  # a tokens, b tokens, groups, links
        self.offset = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint64)  # links as b << 32 | a

    def chunks(self, texts: list[str | None]) -> list[list[int]]:
        """Numbers of the chunks of each text; none for null and empty texts."""
        if len(self.numbers) > KNOWN_CHUNKS or self.chars > KNOWN_CHARS:
            self._reset()
        split = (_CUT.split(t) if self.by_chunks else [t] for t in (x or "" for x in texts))
        found = [[self.numbers[c] for c in own] if own != [""] else [] for own in split]
        self._learn()
        return found

    def _encode_a(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk with a blank before. A word is one part of the pattern and merged without a search for parts."""
        found: list = [None] * len(chunks)
        others = []
        merge, names, tail = self.a.model.tokenize, self.names, self.tail
        for i, chunk in enumerate(chunks):
            match = _SIMPLE.fullmatch(chunk) if self.by_chunks else None
            if match and match[1].isalpha():
                found[i] = [t.id for t in merge((" " + match[1]).encode().decode("latin-1").translate(names))] + tail(match[2])
            else:
                others.append(i)
        for i, e in zip(others, self.a.encode_batch([" " + chunks[i] for i in others], add_special_tokens=False)):
            found[i] = e.ids
        return found

    def _tail(self, punctuation: str) -> list[int]:
        return self.a.encode(punctuation, add_special_tokens=False).ids if punctuation else []

    def _learn(self) -> None:
        fresh, self.numbers.fresh = self.numbers.fresh, []
        for at in range(0, len(fresh), LEARNED_CHUNKS):
            part = fresh[at : at + LEARNED_CHUNKS]
            self.chars += sum(map(len, part))
            groups, links, sizes = self._align(part, self._encode_a(part), self.b.encode(part, num_threads=1))
            self.groups += groups
            self.offset = np.append(self.offset, len(self.pool) + np.cumsum(sizes[:, 3]) - sizes[:, 3])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.pool = np.append(self.pool, links)

    def _align(self, chunks: list[str], ours: list[list[int]], theirs: list[list[int]]) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """Groups of each chunk as text, None where bytes differ; all links, chunk by chunk; numbers of tokens, groups and links.

        Two tokens overlap if they hold the byte before an end of either, so there is one link for each place at which one of them ends.
        """
        raw = [(" " + c).encode("utf-8", "surrogatepass") for c in chunks]
        for k, whole in enumerate(raw):
            if not (b"".join(map(self.a_bytes.__getitem__, ours[k])) == whole == b"".join(map(self.b_bytes.__getitem__, theirs[k]))):
                ours[k], theirs[k], raw[k] = [], [], b""
        sizes = np.zeros((len(chunks), 4), np.int64)
        sizes[:, 0], sizes[:, 1] = list(map(len, ours)), list(map(len, theirs))
        a, b = (np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(n)) for ids, n in zip((ours, theirs), sizes.sum(0)[:2]))
        ends_a, ends_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        borders = np.cumsum([len(r) for r in raw])
        for column, places in ((3, ends), (2, both)):
            sizes[:, column] = np.diff(np.searchsorted(places, borders, "right"), prepend=0)
        links = b[at_b].astype(np.uint64) << np.uint64(32) | a[at_a].astype(np.uint64)
        # tokens group by group, ours first; behind the last of a group a bar or a semicolon, behind others a comma
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        last_a, last_b = ends_a == both[group_a], ends_b == both[group_b]
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        words = np.concatenate([np.where(last_a, self.barred[a], self.listed[a]), np.where(last_b, self.ended[b], self.listed[b])])[order].tolist()
        stops = np.cumsum(sizes[:, 0] + sizes[:, 1]).tolist()
        groups = ["".join(words[i:j])[:-1] if j > i else None for i, j in zip([0, *stops], stops)]
        return groups, links, sizes

    def links(self, chunks: np.ndarray) -> np.ndarray:
        """The links of chunks, in order."""
        count = self.sizes[chunks, 3]
        ends = np.cumsum(count)
        return self.pool[np.repeat(self.offset[chunks] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)]


@functools.lru_cache(maxsize=1)
def aligner(byte_path: str, model_path: str) -> Aligner:
    """One per worker process."""
    return Aligner(byte_path, model_path)


def _squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block."""
    head = np.array([len(arrays), *(len(x) for x in arrays)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(x.astype("<u8" if x.dtype.itemsize == 8 else "<u4").tobytes() for x in arrays))


def _opened(block: bytes, kinds: str) -> list[np.ndarray]:
    """What :func:`_squeezed` was given; ``kinds`` has 8 or 4, the bytes of a number, for each array."""
    data, out = zstandard.ZstdDecompressor().decompress(block), []
    sizes = np.frombuffer(data, "<i8", 1 + len(kinds))[1:]
    at = 8 * (1 + len(kinds))
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(data, f"<u{kind}", size, at))
        at += size * int(kind)
    return out


def _pairs_block(pairs: np.ndarray, totals: np.ndarray) -> bytes:
    return _squeezed(np.diff(pairs, prepend=np.uint64(0)), totals.astype(np.uint64))


def _pairs(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, totals = _opened(block, "88")
    return np.add.accumulate(steps), totals.astype(np.int64)


SPILL = "run bigint, radix int, pairs binary, records binary, doc_id bigint, pos int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_SPILL = pa.schema([
    ("run", pa.int64()), ("radix", pa.int32()), ("pairs", pa.binary()), ("records", pa.binary()), ("doc_id", pa.int64()), ("pos", pa.int32()),
    ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _SPILL)


def _run_rows(run: int, links: list[np.ndarray], docs: list[np.ndarray], radices: int) -> Iterator[dict]:
    """One sorted run, by radix partition."""
    link, doc = np.concatenate(links), np.concatenate(docs)
    order = np.lexsort((doc, link)) if len(link) and int(link.max() >> np.uint64(32)) >= 1 << 20 else None
    if order is None:  # ids of 20 bits and positions of 24 fit one number, which sorts faster
        key = (link >> np.uint64(32)) << np.uint64(44) | (link & np.uint64(0xFFFFF)) << np.uint64(24) | doc
        key.sort()
        link, doc = key >> np.uint64(44) << np.uint64(32) | key >> np.uint64(24) & np.uint64(0xFFFFF), key & np.uint64(0xFFFFFF)
    else:
        link, doc = link[order], doc[order]
    new = np.ones(len(link), bool)
    new[1:] = (link[1:] != link[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(link)))
    link, doc = link[at], doc[at]
    first = np.flatnonzero(np.append(True, link[1:] != link[:-1])) if len(link) else np.zeros(0, np.int64)
    pairs, held = link[first], np.diff(np.append(first, len(link)))
    totals = np.add.reduceat(times, first) if len(first) else times
    radix = (pairs >> np.uint64(32)) % np.uint64(radices)
    of_record = np.repeat(radix, held)
    for r in np.unique(radix).tolist():
        mine, own = radix == r, of_record == r
        yield {"run": run, "radix": r, "pairs": _pairs_block(pairs[mine], totals[mine]), "records": _squeezed(held[mine].astype(np.uint32), doc[own].astype(np.uint32), times[own].astype(np.uint32))}


def spilled(docs: DataFrame, byte_path: str, model_path: str, run_links: int = RUN_LINKS, radices: int = RADICES) -> DataFrame:
    """Rows of documents (``radix`` null) and of radix partitions of runs; ``pos`` is a document's number in its run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(byte_path, model_path)
        number, links, positions, held, pos = TaskContext.get().partitionId() << 32, [], [], 0, 0
        for batch in batches:
            for part in slices(batch):
                found, rows = known.chunks(part.column("text").to_pylist()), []
                for doc_id, own in zip(part.column("doc_id").to_pylist(), found):
                    texts = list(map(known.groups.__getitem__, own))
                    if None in texts:
                        own = texts = []
                    chunks = np.array(own, np.int64)
                    n_a, n_b, n_groups, n_links = known.sizes[chunks].sum(0).tolist()
                    sha = hashlib.sha256(";".join(texts).encode()).hexdigest() if n_links else ""
                    rows.append({"run": number, "doc_id": doc_id, "pos": pos, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": sha})
                    if n_links:
                        links.append(known.links(chunks))
                        positions.append(np.full(n_links, pos, np.uint64))
                        held += n_links
                    pos += 1
                    if held >= run_links or pos == RUN_DOCS:
                        yield _batch(rows)
                        rows = []
                        yield from map(_batch, ([r] for r in _run_rows(number, links, positions, radices))) if held else ()
                        number, links, positions, held, pos = number + 1, [], [], 0, 0
                if rows:
                    yield _batch(rows)
        if held:
            yield from map(_batch, ([r] for r in _run_rows(number, links, positions, radices)))

    return doc_columns(docs).mapInArrow(run, SPILL)


def heap_merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, np.ndarray]]]]:
    """For each second id in ascending order: its pairs, their totals over all runs, and ``run, from, to, places`` of its parts.

    ``places`` are the places of the part's pairs among the pairs of that id.
    """
    bounds = []
    for pairs, _ in runs:
        second = pairs >> np.uint64(32)
        bounds.append(np.append(np.flatnonzero(np.append(True, second[1:] != second[:-1])), len(pairs)) if len(pairs) else np.zeros(1, np.int64))
    heap = [(int(runs[k][0][0] >> np.uint64(32)), k, 0) for k in range(len(runs)) if len(runs[k][0])]
    heapq.heapify(heap)
    while heap:
        second, parts = heap[0][0], []
        while heap and heap[0][0] == second:
            _, k, n = heap[0]
            low, high = int(bounds[k][n]), int(bounds[k][n + 1])
            parts.append((k, low, high))
            if high < len(runs[k][0]):
                heapq.heapreplace(heap, (int(runs[k][0][high] >> np.uint64(32)), k, n + 1))
            else:
                heapq.heappop(heap)
        every = np.concatenate([runs[k][0][low:high] for k, low, high in parts])
        pairs, place = np.unique(every, return_inverse=True)
        totals = np.zeros(len(pairs), np.int64)
        np.add.at(totals, place, np.concatenate([runs[k][1][low:high] for k, low, high in parts]))
        ends = np.cumsum([high - low for _, low, high in parts])
        yield pairs, totals, [(k, low, high, place[end - (high - low) : end]) for (k, low, high), end in zip(parts, ends.tolist())]


def _by_run(table: pa.Table) -> tuple[list[int], list[tuple[np.ndarray, np.ndarray]]]:
    rows = sorted(zip(table["run"].to_pylist(), table["pairs"].to_pylist()))
    return [r for r, _ in rows], [_pairs(block) for _, block in rows]


COUNTS = "run bigint, radix int, counts binary"


def _counts_table(radix: int, names: list[int], counts: list[np.ndarray], best: list[np.ndarray]) -> pa.Table:
    blocks = [_squeezed(c.astype(np.uint64), b.astype(np.uint32)) for c, b in zip(counts, best)]
    return pa.table([pa.array(names, pa.int64()), pa.array([radix] * len(names), pa.int32()), pa.array(blocks, pa.binary())], ["run", "radix", "counts"])


def _count(table: pa.Table) -> pa.Table:
    """Counts of each run's pairs, and whether they are the highest of their second id."""
    names, runs = _by_run(table)
    counts, best = [np.zeros(len(p), np.int64) for p, _ in runs], [np.zeros(len(p), bool) for p, _ in runs]
    for _, totals, parts in heap_merged(runs):
        highest = totals == totals.max()
        for k, low, high, place in parts:
            counts[k][low:high], best[k][low:high] = totals[place], highest[place]
    return _counts_table(table["radix"][0].as_py(), names, counts, best)


def _merge(table: pa.Table) -> pa.Table:
    """One run of the next level out of several."""
    _, runs = _by_run(table)
    merged = [(pairs, totals) for pairs, totals, _ in heap_merged(runs)]
    block = _pairs_block(*(np.concatenate(c) for c in zip(*merged)))
    return pa.table([table["above"].slice(0, 1), table["radix"].slice(0, 1), pa.array([block], pa.binary())], ["run", "radix", "pairs"])


def _hand_down(table: pa.Table, above: pa.Table) -> pa.Table:
    """Counts of several runs out of those of the run that they were merged into."""
    names, runs = _by_run(table)
    every = np.unique(np.concatenate([pairs for pairs, _ in runs]))
    counts, best = _opened(above["counts"][0].as_py(), "84")
    places = [np.searchsorted(every, pairs) for pairs, _ in runs]
    return _counts_table(table["radix"][0].as_py(), names, [counts[p].astype(np.int64) for p in places], [best[p] for p in places])


def counted(pairs: DataFrame, runs: int, fan: int = FAN) -> DataFrame:
    """``run, radix, counts`` from ``run, radix, pairs``; there are ``runs`` runs."""
    if runs <= fan:
        return pairs.groupBy("radix").applyInArrow(_count, COUNTS)
    fewer = -(-runs // (fan // 2))  # dealt by hash, so a merged run has about half of what it may have
    up = pairs.withColumn("above", F.pmod(F.xxhash64("run"), F.lit(fewer)))
    merged = written(up.groupBy("radix", "above").applyInArrow(_merge, "run bigint, radix int, pairs binary"), "merged")
    above = counted(merged, fewer, fan).select(F.col("run").alias("above"), "radix", "counts")
    return up.groupBy("radix", "above").cogroup(above.groupBy("radix", "above")).applyInArrow(_hand_down, COUNTS)


ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _add_up(run: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one run with what the counts of their pairs add up to."""
    docs = run.filter(pa.compute.is_null(run["radix"]))
    pos = docs["pos"].to_numpy()
    sums = np.zeros((int(pos.max()) + 1 if len(pos) else 0, 2), np.int64)
    found = dict(zip(counts["radix"].to_pylist(), counts["counts"].to_pylist()))
    records = run.filter(pa.compute.is_valid(run["radix"]))
    for radix, block in zip(records["radix"].to_pylist(), records["records"].to_pylist()):
        held, doc, times = _opened(block, "444")
        count, best = _opened(found[radix], "84")
        times = times.astype(np.int64)
        np.add.at(sums[:, 0], doc, times * np.repeat(best, held))
        np.add.at(sums[:, 1], doc, times * np.repeat(count.astype(np.int64), held))
    columns = [docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    return pa.table([*columns, pa.array(sums[pos, 0]), pa.array(sums[pos, 1]), docs["groups_sha256"]], [f.split()[0] for f in ALIGNED.split(", ")])


def align(docs: DataFrame, byte_path: str | None = None, model_path: str | None = None, run_links: int = RUN_LINKS, radices: int = RADICES, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """What each document's links add up to, and the spill.

    The first has ``doc_id``, the numbers of tokens, groups and links, ``n_best`` (links whose count is the highest of their second id), ``count_sum``
    and ``groups_sha256``; :func:`pair_counts` gives the counts themselves from the second.
    """
    spill = written(spilled(docs, byte_path or default_path(), model_path or piece_path(), run_links, radices), "spill")
    runs = spill.where("radix is not null")
    found = counted(runs.select("run", "radix", "pairs"), runs.select("run").distinct().count(), fan)
    own = spill.drop("pairs").groupBy("run")
    return own.cogroup(found.groupBy("run")).applyInArrow(_add_up, ALIGNED), spill


def pair_counts(spill: DataFrame, fan: int = FAN) -> DataFrame:
    """``b, a, n, best`` of each pair of ids that shares bytes anywhere: its links, and whether ``b`` has no pair with more."""

    def listed(table: pa.Table) -> pa.Table:
        _, runs = _by_run(table)
        rows = [(pairs, totals, totals == totals.max()) for pairs, totals, _ in heap_merged(runs)]
        pairs, totals, best = (np.concatenate(c) for c in zip(*rows))
        return pa.table([pa.array((pairs >> np.uint64(32)).astype(np.int64)), pa.array((pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(totals), pa.array(best)], ["b", "a", "n", "best"])

    runs = spill.where("radix is not null").select("run", "radix", "pairs")
    number = runs.select("run").distinct().count()
    while number > fan:
        number = -(-number // (fan // 2))
        runs = runs.withColumn("above", F.pmod(F.xxhash64("run"), F.lit(number)))
        runs = written(runs.groupBy("radix", "above").applyInArrow(_merge, "run bigint, radix int, pairs binary"), "merged")
    return runs.groupBy("radix").applyInArrow(listed, "b bigint, a bigint, n bigint, best boolean")
