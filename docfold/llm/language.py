"""Languages of a text as a mixture, by expectation-maximisation over n-gram likelihoods.

Training counts the hashed letter trigrams of all texts of each language; words are set off by one blank, and trigrams
without a letter are left out. A text's trigrams are then taken as drawn from a mixture of the languages. The language set
starts with all of them and loses the least one (at first all below ``FAINT`` together) as long as the log-likelihood less
half the logarithm of the number of trigrams per language grows; each set's shares come from expectation-maximisation. The largest share names the text.

A null text, or one without a letter, is ``und`` with share 0; so is every text if nothing was learned. Ties go to the language
that sorts first. Texts of any length are counted whole. The model holds 2**``BITS`` numbers for each language.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm.common import slices

BITS = 15
MAX_LANGUAGES = 1000
ROUNDS = 12
SMOOTHING = 0.1
FAINT = 0.02
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(text: str | None) -> np.ndarray:
    """Hashed trigrams of a text, in order; empty without a letter."""
    codes = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    keep = letter | np.append(True, letter[:-1])  # of other characters, the first after a letter stays, as a blank
    codes, letter = np.where(letter, codes, 32)[keep].astype(np.uint64), letter[keep]
    mixed = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[2:] * np.uint64(0x165667B19E3779F9)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)[letter[:-2] | letter[1:-1] | letter[2:]]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    likelihood: np.ndarray  # one row per trigram place, one column per language

    def mixture(self, text: str | None) -> dict[str, float]:
        """Shares of the chosen languages; empty if nothing can be said."""
        grams = trigrams(text)
        if not len(grams) or not self.languages:
            return {}
        counts = np.bincount(grams, minlength=1 << BITS)
        seen = np.flatnonzero(counts)
        counts, p = counts[seen].astype(np.float64), self.likelihood[seen]
        n, chosen = counts.sum(), np.arange(len(self.languages))
        share, gain = _shares(p, counts, np.full(len(chosen), 1 / len(chosen)))
        together = share < FAINT  # all faint ones at first, then one by one
        while len(chosen) > 1:
            out = together if together.any() else np.arange(len(share)) == np.argmin(share)
            other, reached = _shares(p[:, chosen[~out]], counts, share[~out] / share[~out].sum())
            if reached + 0.5 * np.log(n) * out.sum() >= gain:
                chosen, share, gain = chosen[~out], other, reached
            elif not together.any():
                break
            together = np.zeros(len(share), bool)
        return {self.languages[i]: float(s) for i, s in zip(chosen, share)}


def _shares(p: np.ndarray, counts: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares after expectation-maximisation, and the log-likelihood reached."""
    n, share = counts.sum(), start
    if p.shape[1] == 1:
        return np.ones(1), float(counts @ np.log(p[:, 0]))
    for _ in range(ROUNDS):
        new = share * ((counts / (p @ share)) @ p) / n
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(counts @ np.log(p @ share))


def train(docs: DataFrame) -> Model:
    """Trigram likelihoods from ``text`` and ``lang`` of all rows in which both are given."""
    rows = docs.select(docs["text"].alias("text"), docs["lang"].alias("lang")).where("text is not null and lang is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if lang not in totals:
                    totals[lang] = np.zeros(1 << BITS, np.int64)
                totals[lang] += np.bincount(trigrams(text), minlength=1 << BITS)
        for lang, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.record_batch([pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["lang", "place", "n"])

    counted = rows.mapInArrow(run, "lang string, place int, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    of_language = counted.groupBy("lang").agg(F.collect_list(F.struct("place", "n")).alias("places")).limit(MAX_LANGUAGES + 1).collect()
    if len(of_language) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    of_language.sort(key=lambda r: r["lang"])
    counts = np.full((1 << BITS, len(of_language)), SMOOTHING)
    for k, row in enumerate(of_language):
        for place, n in row["places"]:
            counts[place, k] += n
    return Model([r["lang"] for r in of_language], counts / counts.sum(0) if len(of_language) else counts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, mixture`` of each row; the mixture maps the chosen languages to their shares."""
    known = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_LANGUAGES columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [known.value.mixture(t) for t in part.column("text").to_pylist()]
                best = [max(m.items(), key=lambda x: x[1]) if m else (UNKNOWN, 0.0) for m in found]
                columns = [part.column("doc_id"), pa.array([b[0] for b in best], pa.string()), pa.array([min(1.0, b[1]) for b in best], pa.float64()), pa.array([list(m.items()) for m in found], pa.map_(pa.string(), pa.float64()))]
                yield pa.record_batch(columns, names=["doc_id", "lang_pred", "score", "mixture"])

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double, mixture map<string, double>")
