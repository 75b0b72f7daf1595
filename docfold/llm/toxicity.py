"""Toxicity from confirmed toxic examples and unlabelled text: non-negative positive-unlabelled learning.

A text is the set of its words (letters and digits, lower-cased), hashed to 2**``BITS`` places. A linear classifier is trained
with numpy on the risk of positive-unlabelled learning with class prior p: p times the loss of the positives as positive,
plus the loss of the unlabelled as negative less p times the loss of the positives as negative, where the latter two together
are kept from falling below zero. Labels of negatives are never used: the unlabelled rows are labelled rows with the label laid
aside, for which the prior is the share of positives.

The classifier is fitted on at most ``sample_rows`` rows of each kind, the first by a hash of their id, so the model does not depend on the order or
partitioning of the labels; the prior is counted over all rows. A word
place gets a weight if it occurs in ``MIN_ROWS`` sampled rows and its share among the positives exceeds that among the
unlabelled by ``MIN_SHARE`` and by ``MIN_SPREADS`` times what chance would spread. Null and empty texts are scored by the bias alone. Rows
with a null label count as unlabelled text that nobody looked at and are not drawn. Without positives every score is 0.
Labels repeated for one document count each towards the prior; labels without a document are not drawn.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.llm.common import doc_columns, slices

BITS = 18
MIN_ROWS = 10
MIN_SHARE = 0.005
MIN_SPREADS = 5.0
SAMPLE_ROWS = 8000
EPOCHS = 300
RATE = 0.05
RIDGE = 5e-5
TOLERANCE = 0.02
_FOLD = bytes(b if chr(b).isdigit() and b < 128 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def places(text: str | None) -> np.ndarray:
    """Places of the distinct words of a text, ascending."""
    own = set((text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split())
    return np.unique(np.fromiter(map(zlib.crc32, own), np.uint32, len(own)) & np.uint32((1 << BITS) - 1))


@dataclass(frozen=True)
class Classifier:
    weights: np.ndarray
    bias: float

    def logits(self, texts: list[str | None]) -> np.ndarray:
        return np.array([self.weights[places(t)].sum() for t in texts], np.float64) + self.bias

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return _sigmoid(self.logits(texts))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Rows:
    """Sparse rows of ones."""

    def __init__(self, rows: list[np.ndarray], column: np.ndarray):
        kept = [column[r] for r in rows]
        kept = [k[k >= 0] for k in kept]
        self.n = len(rows)
        self.row = np.repeat(np.arange(self.n), [len(k) for k in kept])
        self.col = np.concatenate([*kept, np.zeros(0, np.int64)]).astype(np.int64)

    def dot(self, w: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n) + bias

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.col, g[self.row], size)


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Classifier:
    """Adam over the whole sample, logistic loss; where the negative part of the risk falls below -TOLERANCE, it is raised again."""
    size = 1 << BITS
    if not positive or not unlabelled or prior <= 0:
        return Classifier(np.zeros(size, np.float32), -30.0)
    seen = np.bincount(np.concatenate([*positive, *unlabelled, np.zeros(0, np.uint32)]).astype(np.int64), minlength=size)
    shares = [np.bincount(np.concatenate([*rows, np.zeros(0, np.uint32)]).astype(np.int64), minlength=size) / len(rows) for rows in (positive, unlabelled)]
    excess, chance = shares[0] - shares[1], np.sqrt(np.maximum(shares[1], 1 / len(unlabelled)) / len(positive))
    used = np.flatnonzero((seen >= MIN_ROWS) & (excess >= MIN_SHARE) & (excess >= MIN_SPREADS * chance))
    column = np.full(size, -1, np.int64)
    column[used] = np.arange(len(used))
    p, u = _Rows(positive, column), _Rows(unlabelled, column)
    w = np.zeros(len(used) + 1)  # the last one is the bias
    w[-1] = np.log(prior / (1 - prior)) if prior < 1 else 0.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, EPOCHS + 1):
        zp, zu = p.dot(w[:-1], w[-1]), u.dot(w[:-1], w[-1])
        up, uu = _sigmoid(zp), _sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = -prior * (1 - up) / p.n, np.zeros(u.n)
        if negative >= -TOLERANCE:
            gp, gu = gp - prior * up / p.n, uu / u.n
        else:
            gp, gu = prior * up / p.n, -uu / u.n
        grad = np.append(p.back(gp, len(used)) + u.back(gu, len(used)) + RIDGE * w[:-1], gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(size, np.float32)
    weights[used] = w[:-1]
    return Classifier(weights, float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """A classifier from ``labels`` (``doc_id, toxic``) and the texts of ``docs``."""
    known = labels.select(labels["doc_id"].cast("bigint").alias("doc_id"), (labels["toxic"] == 1).alias("positive")).where("doc_id is not null and positive is not null")
    both = known.agg(F.count(F.lit(1)).alias("n"), F.count_if("positive").alias("positives")).first()
    if not both["positives"]:
        return fit([], [], 0.0)

    def drawn(rows: DataFrame, count: int, seed: int) -> DataFrame:
        """The first ``sample_rows`` rows by a hash of their id, whatever their order; only somewhat more than those are sorted."""
        share, place = min(1.0, 1.5 * sample_rows / count + 0.001), F.xxhash64("doc_id", F.lit(seed))
        return rows.where(F.pmod(place, F.lit(1 << 20)) <= int(share * (1 << 20))).orderBy(F.pmod(place, F.lit(1 << 20)), place, "doc_id").limit(sample_rows)

    chosen = drawn(known.where("positive"), both["positives"], 1).select("doc_id", F.lit(True).alias("positive"))
    chosen = chosen.unionAll(drawn(known, both["n"], 2).select("doc_id", F.lit(False).alias("positive")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [places(t).astype("<u4").tobytes() for t in part.column("text").to_pylist()]
                yield pa.record_batch([part.column("doc_id"), part.column("positive"), pa.array(found, pa.binary())], names=["doc_id", "positive", "places"])

    # ``chosen`` has at most twice ``sample_rows`` rows; of several texts under one id, one is taken
    found = doc_columns(docs).join(F.broadcast(chosen.distinct()), "doc_id").select("doc_id", "positive", "text")
    rows = found.mapInArrow(run, "doc_id bigint, positive boolean, places binary").groupBy("doc_id", "positive").agg(F.min("places").alias("places"))
    sample = sorted((r["positive"], r["doc_id"], bytes(r["places"])) for r in rows.collect())
    kept: dict[bool, list] = {True: [], False: []}
    for positive, _, found in sample:
        kept[positive].append(np.frombuffer(found, "<u4"))
    return fit(kept[True], kept[False], both["positives"] / both["n"])


def score(docs: DataFrame, classifier: Classifier, name: str = "toxicity") -> DataFrame:
    """``docs`` with the double column ``name``; a column of that name is replaced."""
    model = docs.sparkSession.sparkContext.broadcast(classifier)  # 2**BITS weights, whatever the data
    docs = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                scores = model.value.scores(part.column("text").to_pylist())
                yield pa.record_batch([*part.columns, pa.array(scores)], names=[*part.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def fold(df: DataFrame, folds: int):
    """Remainder of the CRC-32 of ``doc_id`` as text."""
    return F.pmod(F.crc32(df["doc_id"].cast("bigint").cast("string").cast("binary")), F.lit(folds))
