"""I-Match fingerprints: hashes of the distinct terms within a band of inverse document frequency.

Terms are the lower-cased words (letters and digits) of a text. Document frequencies are counted over all documents; terms
found in ``LOW`` to ``HIGH`` of the documents form the lexicon. Each document of a corpus adds its number of distinct terms
to the sum of all frequencies, so the lexicon has at most (mean number of distinct terms) / ``LOW`` terms, however
large the corpus: that bounds the broadcast. A text without a term of the lexicon keeps all its terms.

The sorted terms of a text are hashed whole, and once more for each of several random sub-lexicons: a hash is the sum of one
mixed number per term of the sub-lexicon. A sub-lexicon of rate r holds each term with probability r; rates fall by four
from scale to scale, so that for short and long texts alike some scale holds a few terms of the text. Two fingerprints
are alike by the share of equal hashes among the sub-lexicons that hold a term of either, at their best scale.

Null texts count as empty; texts without terms have empty hashes and are alike only if equal. Equal texts have equal
fingerprints.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docfold.llm.common import doc_columns, slices
from docfold.session import written

LOW, HIGH = 0.0005, 0.2
SCALES, SUBSETS = 5, 24
FLUSH_TERMS = 400_000
_FOLD = bytes(b if chr(b).isdigit() and b < 128 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SEEDS = np.random.default_rng(7).integers(1, 1 << 63, SCALES * SUBSETS).astype(np.uint64)
_LIMITS = np.repeat(np.array([(1 << 64) // 4 ** (s + 1) for s in range(SCALES)], np.uint64), SUBSETS)


def terms(text: str | None) -> set[bytes]:
    return set((text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split())


def term_hashes(text: str | None) -> np.ndarray:
    """Signed 64-bit hashes of the distinct terms, ascending."""
    own = terms(text)
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own)).view(np.int64))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Hashes of the terms within the band, ascending; counted over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            keys = pa.array(np.fromiter(seen.keys(), np.int64, len(seen)))
            out = pa.record_batch([keys, pa.array(np.fromiter(seen.values(), np.int64, len(seen)))], names=["term", "n"])
            seen.clear()
            return out

        hashed: dict = {}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                own = terms(text)
                for t in own:
                    if t not in hashed:
                        hashed[t] = (xxhash.xxh3_64_intdigest(t) + (1 << 63)) % (1 << 64) - (1 << 63)  # as a signed number
                seen.update(map(hashed.__getitem__, own))
                if len(seen) > FLUSH_TERMS or len(hashed) > FLUSH_TERMS:
                    hashed.clear()
                    yield flush()
        if seen:
            yield flush()

    rows = doc_columns(docs)
    total = rows.count()
    counted = rows.select("text").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    band = counted.where(F.col("n").between(low * total, max(1.0, high * total))).select("term").toArrow()
    return np.sort(band.column("term").to_numpy())


def fingerprint(text: str | None, lexicon_terms: np.ndarray) -> str:
    """Whole hash (16 hexadecimal digits), then one hash of 4 digits per sub-lexicon, ``0000`` if it holds no term."""
    own = term_hashes(text)
    if len(own) and len(lexicon_terms):
        near = np.minimum(np.searchsorted(lexicon_terms, own), len(lexicon_terms) - 1)
        kept = own[lexicon_terms[near] == own]
        own = kept if len(kept) else own
    whole = hashlib.blake2b(own.astype("<i8").tobytes(), digest_size=8).hexdigest() if len(own) else "0" * 16
    sums = np.zeros(len(_SEEDS), np.uint64)
    for part in np.array_split(own.view(np.uint64), max(1, len(own) // 2000)):
        mixed = (part[:, None] ^ _SEEDS) * _A
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _B
        mixed ^= mixed >> np.uint64(29)
        chosen = mixed < _LIMITS
        sums += np.where(chosen, mixed * _A | np.uint64(1) << np.uint64(63), np.uint64(0)).sum(0, dtype=np.uint64)
        sums = np.where(chosen.any(0) & (sums == 0), np.uint64(1), sums)
    short = ((sums ^ (sums >> np.uint64(31))) * _B >> np.uint64(48)).astype(np.uint32)
    short = np.where(sums == 0, 0, np.maximum(short, 1)).astype(">u2")
    return whole + short.tobytes().hex()


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f[16:]), ">u2").reshape(SCALES, SUBSETS) for f in (a, b))
    held = ((x != 0) | (y != 0)).sum(1)
    same = ((x == y) & (x != 0)).sum(1)
    return float((same / (held + 1)).max())


def fingerprints(docs: DataFrame, lexicon_terms: np.ndarray) -> DataFrame:
    """``doc_id, fingerprint`` of each row."""
    known = docs.sparkSession.sparkContext.broadcast(lexicon_terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [fingerprint(t, known.value) for t in part.column("text").to_pylist()]
                yield pa.record_batch([part.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    return doc_columns(docs).mapInArrow(run, "doc_id bigint, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COMPARED = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_edits(docs: DataFrame, lexicon_terms: np.ndarray) -> DataFrame:
    """Fingerprint of each text and of its edited text, which ends as the next document by descending ``doc_id`` begins.

    Documents are dealt by range of ``doc_id`` and sorted, so the next one is the next row; texts travel compressed. Of each
    range, the first text is also kept for the row that ends the range before it; after the last comes the first.
    Equal ids are ordered by text, null ids come last.
    """
    known = docs.sparkSession.sparkContext.broadcast(lexicon_terms)

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = [pack(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("tie"), pa.array(packed, pa.binary())], names=["doc_id", "tie", "packed"])

    def row(doc_id, text: str, own: str, following: str, next_print: str) -> tuple:
        changed = edited(text, following)
        print_ = fingerprint(changed, known.value)
        digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return doc_id, len(text), digest, own, print_, likeness(own, print_), likeness(own, next_print)

    fields = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def table(rows: list) -> list[pa.Array]:
        return [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(fields), fields)]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows but the last of the range; its first and last text go on their own (``side`` 0 and 1) for the neighbours."""
        unpack, part, held = zstandard.ZstdDecompressor().decompress, TaskContext.get().partitionId(), None
        more = ["part", "side", "packed"]

        def end(side: int, doc_id, packed: bytes) -> pa.RecordBatch:
            columns = [pa.array([doc_id], pa.int64()), *(pa.nulls(1, k) for k in fields[1:]), pa.array([part], pa.int32()), pa.array([side], pa.int32()), pa.array([packed], pa.binary())]
            return pa.record_batch(columns, names=[*names, *more])

        for batch in batches:
            for cut in slices(batch, "packed"):
                rows = []
                for doc_id, packed in zip(cut.column("doc_id").to_pylist(), cut.column("packed").to_pylist()):
                    text = unpack(packed).decode("utf-8", "surrogatepass")
                    own = fingerprint(text, known.value)
                    if held is None:
                        yield end(0, doc_id, packed)
                    else:
                        rows.append(row(*held[:3], text, own))
                    held = doc_id, text, own, packed
                n = len(rows)
                yield pa.record_batch([*table(rows), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=[*names, *more])
        if held is not None:
            yield end(1, held[0], held[3])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for doc_id, packed, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "following"))):
                text, after = (unpack(p).decode("utf-8", "surrogatepass") for p in (packed, following))
                rows.append(row(doc_id, text, fingerprint(text, known.value), after, fingerprint(after, known.value)))
            yield pa.record_batch(table(rows), names=names)

    source = doc_columns(docs).select("doc_id", F.xxhash64("text").alias("tie"), "text").mapInArrow(squeeze, "doc_id bigint, tie bigint, packed binary")
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie"), F.col("packed")]
    dealt = source.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select("doc_id", "packed")
    found = written(dealt.mapInArrow(pairs, f"{COMPARED}, part int, side int, packed binary"), "fingerprints")
    # one row per range from here on: as many as shuffle partitions
    firsts = found.where("side = 0").select("part", F.col("packed").alias("following"))
    lasts = found.where("side = 1").select("doc_id", "part", "packed")
    steps = firsts.select("part", F.lead("part").over(Window.orderBy("part")).alias("next"), F.min("part").over(Window.partitionBy()).alias("first"))
    steps = steps.select("part", F.coalesce("next", "first").alias("next"))
    meeting = lasts.join(steps, "part").join(firsts.withColumnRenamed("part", "next"), "next").select("doc_id", "packed", "following")
    return found.where("side is null").select(*names).unionAll(meeting.mapInArrow(across, COMPARED))
