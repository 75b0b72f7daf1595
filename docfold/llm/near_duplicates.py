"""Near duplicates by a chosen-path set similarity join over minwise tokens.

A text's set holds its distinct runs of five words, hashed to 64 bits. Texts with one set are one class, and only classes are
compared. Each of ``TREES`` trees branches classes by the least of their tokens under the tree's hash functions: classes
that share four such tokens in order share a node. Classes already in one component need no comparison any more, so the size
of a node is the number of its pairs across components. A node of at most ``SMALL`` pairs is compared exhaustively. In a larger
one a class, the pivot, is compared with all (the least one, so that its links are a finished component), so a large group of near copies is done at once. What stays apart then is compared
exhaustively too, if it has at most ``WIDE`` pairs: the classes outside the largest component with all, in blocks of about ``BLOCK`` by
``BLOCK`` classes and ``BLOCK_SHINGLES`` shingles each way, so no task has a node as a whole. A block confirms on full sets and gives a forest: a pair
that the labels or earlier links of the block already connect is not looked at, so the links of a block are fewer than its classes.
Still larger nodes branch on by tokens of their own: the path to a node says which, into four children at the first of these levels, and
into two at the others. At level ``LEVELS`` all nodes are compared in blocks, however large. Candidates need as many equal later tokens as all
but one in ten million pairs at the threshold have, and are then confirmed on the full sets.

Two classes at similarity s meet in one of the trees at the first level with probability 1 - (1 - s**4)**TREES, and miss each
other once in 90,000 times for s = 0.75. If all the nodes they meet in are large at every level, they miss each other about once in
80,000 times at the deepest (68 of 6,000,000 simulated as coded; ``tests/llm/test_near_links.py`` repeats a part). Tokens below the first level are made from
the texts of the classes in large nodes only.

Texts without words, null ones included, have no set and stay alone. Repeated rows are of one class. A null ``doc_id`` never
represents others. Equal ids with different texts are different members of their classes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm.common import doc_columns, slices
from docfold.llm.components import components
from docfold.session import written

SHINGLE = 5
PERCENT = 75
TREES, FIRST, POOL, LEVELS = 30, 4, 48, 4
#: Children of a large node at each level below the first; which of the ``DEEP`` tokens they use depends on the node.
CHILDREN = (4, 2, 2)
DEEP = 240
#: Pairs across components of a node that are listed in one row, and that are compared in blocks of ``BLOCK`` by ``BLOCK`` classes.
SMALL, WIDE, BLOCK = 512, 1 << 22, 2048
BLOCK_SHINGLES = 1 << 20
#: Of ``POOL`` tokens, each equal with probability 0.75 or more, fewer are equal in one of ten million pairs.
EQUAL_TOKENS = 19
#: The same for ``DEEP`` tokens.
EQUAL_DEEP = 143
_KNOWN_WORDS = 400_000
_RNG = np.random.default_rng(11)
_ORDER = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_MIX_A, _MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SEEDS = _RNG.integers(1, 1 << 63, TREES * FIRST + POOL).astype(np.uint64)
_FACTORS = _RNG.integers(1, 1 << 63, TREES * FIRST + POOL).astype(np.uint64) | np.uint64(1)
_DEEP_SEEDS = _RNG.integers(1, 1 << 63, DEEP).astype(np.uint64)
_DEEP_FACTORS = _RNG.integers(1, 1 << 63, DEEP).astype(np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX_A
    x = (x ^ (x >> np.uint64(33))) * _MIX_B
    return x ^ (x >> np.uint64(33))


class Shingles:
    """Sets of hashed word runs; hashes of words are kept for a while."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, text: str) -> np.ndarray:
        """Ascending; empty without words. A text of fewer than five words has its whole sequence."""
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > _KNOWN_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        own = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(SHINGLE, len(own))
        total = np.full(len(own) - size + 1, size, np.uint64)
        for i in range(size):
            total += own[i : i + len(total)] * _ORDER[i]
        return np.unique(_mixed(total))


def set_id(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def minwise(shingles: np.ndarray, seeds: np.ndarray = _SEEDS, factors: np.ndarray = _FACTORS) -> np.ndarray:
    least = np.full(len(seeds), (1 << 64) - 1, np.uint64)
    for part in np.array_split(shingles, max(1, len(shingles) // 2000)):
        least = np.minimum(least, ((part[:, None] ^ seeds) * factors).min(0))
    return least


def node_keys(least: np.ndarray) -> np.ndarray:
    """Node of each tree at the first level; the last five bits are the tree."""
    keys = _mixed((least[: TREES * FIRST].reshape(TREES, FIRST) * _ORDER[:FIRST]).sum(1, dtype=np.uint64))
    return ((keys & ~np.uint64(31)) | np.arange(TREES, dtype=np.uint64)).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, k, n, v, nodes, later``: hash of a row's text, size and id of its set, its first nodes, 16 bits of each later token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            for part in slices(batch):
                rows: list = []
                for text in part.column("text").to_pylist():
                    own = shingles.of(text)
                    if not len(own):
                        rows.append((0, None, None, None))
                        continue
                    least = minwise(own)
                    later = _mixed(least[TREES * FIRST :]).astype(np.uint16)
                    rows.append((len(own), set_id(own), node_keys(least), later.astype("<u2").tobytes()))
                n, v, nodes, later = zip(*rows)
                yield pa.record_batch([part.column("doc_id"), part.column("k"), pa.array(n, pa.int64()), pa.array(v, pa.int64()), pa.array(nodes, pa.list_(pa.int64())), pa.array(later, pa.binary())], names=["doc_id", "k", "n", "v", "nodes", "later"])

    return doc_columns(docs).withColumn("k", F.xxhash64("text")).mapInArrow(run, "doc_id bigint, k bigint, n bigint, v bigint, nodes array<bigint>, later binary")


def _of_classes(docs: DataFrame, wanted: DataFrame, repeated: bool, name: str, kind: str, made: Callable[[np.ndarray], object]) -> DataFrame:
    """``v`` and what ``made`` gives for the set of each class in ``wanted`` (``v, doc_id``), from their texts."""
    schema = f"v bigint, {name} {kind}"
    arrow = {"binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            for part in slices(batch):
                found = [(v, own) for v, own in zip(part.column("v").to_pylist(), map(shingles.of, part.column("text").to_pylist())) if len(own) and set_id(own) == v]
                yield pa.record_batch([pa.array([v for v, _ in found], pa.int64()), pa.array([made(own) for _, own in found], arrow)], names=["v", name])

    out = doc_columns(docs).join(wanted, "doc_id").select("v", "text").mapInArrow(run, schema)
    return out.dropDuplicates(["v"]) if repeated else out


def _sets(docs: DataFrame, wanted: DataFrame, repeated: bool) -> DataFrame:
    """``v, shingles`` of the classes in ``wanted``."""
    return _of_classes(docs, wanted, repeated, "shingles", "array<bigint>", lambda own: own.view(np.int64))


def _deep(docs: DataFrame, wanted: DataFrame, repeated: bool) -> DataFrame:
    """``v, deep`` of the classes in ``wanted``: 16 bits of each token below the first level."""
    return _of_classes(docs, wanted, repeated, "deep", "binary", lambda own: _mixed(minwise(own, _DEEP_SEEDS, _DEEP_FACTORS)).astype("<u2").tobytes())


def _confirmed(pairs: DataFrame, classes: DataFrame, signed: DataFrame, docs: DataFrame, repeated: bool) -> DataFrame:
    """Those pairs ``a, b`` whose full sets are similar enough."""
    tokens = _tokens(signed, pairs.select(F.col("a").alias("v")).unionAll(pairs.select(F.col("b").alias("v"))))
    both = pairs.join(tokens.select(F.col("v").alias("a"), F.col("later").alias("x")), "a").join(tokens.select(F.col("v").alias("b"), F.col("later").alias("y")), "b")
    token = lambda c, i: F.substring(F.col(c), i * 2 + 1, F.lit(2))
    equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(POOL - 1)), lambda i: token("x", i) == token("y", i)))
    pairs = written(both.where(equal >= EQUAL_TOKENS).select("a", "b"), "near_pairs")
    needed = pairs.select(F.col("a").alias("v")).unionAll(pairs.select(F.col("b").alias("v"))).distinct()
    sets = written(_sets(docs, classes.join(needed, "v").select("v", "doc_id"), repeated), "sets")
    both = pairs.join(sets.select(F.col("v").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("v").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(100 * common >= PERCENT * (F.size("x") + F.size("y") - common)).select("a", "b")


def _tokens(signed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``v, later`` of the wanted classes, once each."""
    tokens = signed.where("v is not null and doc_id is not null").select("v", "later")
    return written(tokens.join(wanted.distinct(), "v", "left_semi").distinct(), "tokens")


def _pairs(nodes: DataFrame, small: int, wide: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidate pairs ``a, b`` of the nodes (``node, v, n, label``), members of nodes of ``small`` to ``wide`` pairs, members of larger ones with their pivot."""
    of_label = nodes.groupBy("node", "label").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.min(F.struct("v", "n")).alias("one"))
    of_node = of_label.groupBy("node").agg(
        F.count(F.lit(1)).alias("labels"), F.sum("size").alias("size"), F.sum("weight").alias("weight"),
        F.sum(F.col("size") * F.col("size")).alias("squares"), F.max_by(F.struct("size", "label", "one", "weight"), F.struct("size", -F.col("label"))).alias("pivot"),
    )
    cross = ((F.col("size") * F.col("size") - F.col("squares")) / 2).alias("cross")
    pivot = F.struct(F.col("pivot.label").alias("label"), F.col("pivot.one.v").alias("v"), F.col("pivot.one.n").alias("n")).alias("pivot")
    parts = lambda size, weight: F.ceil(F.greatest(size / BLOCK, weight / BLOCK_SHINGLES)).cast("bigint")
    every = parts(F.col("size"), F.col("weight")).alias("parts")
    outside = parts(F.col("size") - F.col("pivot.size"), F.col("weight") - F.col("pivot.weight")).alias("outer_parts")
    joined = written(nodes.join(of_node.where("labels > 1").select("node", every, outside, cross, pivot), "node"), "nodes")
    near = lambda x, y: (100 * F.least(x, y) >= PERCENT * F.greatest(x, y))
    # a node of two components or more has at most one member more than pairs across them
    members = joined.where(F.col("cross") <= small).groupBy("node").agg(F.collect_list(F.struct("v", "n", "label")).alias("m"))
    others = lambda x: F.filter("m", lambda y: (y["v"] > x["v"]) & (y["label"] != x["label"]) & near(x["n"], y["n"]))
    each = members.select(F.explode(F.flatten(F.transform("m", lambda x: F.transform(others(x), lambda y: F.struct(x["v"].alias("a"), y["v"].alias("b")))))).alias("p")).select("p.*")
    blocks = joined.where((F.col("cross") > small) & (F.lit(wide is None) | (F.col("cross") <= (wide or 0))))
    large = joined.where((F.col("cross") > max(small, wide)) if wide is not None else F.lit(False))
    star = large.where((F.col("label") != F.col("pivot.label")) & near(F.col("n"), F.col("pivot.n"))).select(F.least("v", "pivot.v").alias("a"), F.greatest("v", "pivot.v").alias("b"))
    blocks = blocks.select("node", "v", "n", "label", (F.col("label") != F.col("pivot.label")).alias("outer"), "parts", "outer_parts")
    return written(each.unionAll(star).distinct(), "pairs"), blocks, large.select("node", "v", "n", F.col("pivot.v").alias("pivot"))


def _forest(table: pa.Table) -> pa.Table:
    """Links ``a, b`` that connect what is similar enough in one block: ``left`` rows are compared with ``right`` ones of other labels."""
    left, right = (table.filter(table[side]) for side in ("left", "right"))
    number = lambda rows, name: rows[name].to_numpy()
    sketch = lambda rows: np.frombuffer(b"".join(rows["deep"].to_pylist()), "<u2").reshape(-1, DEEP).astype(np.uint8).T.copy()
    sets = lambda rows: [x.values.to_numpy() for x in rows["shingles"]]
    links: list[tuple[int, int]] = []
    if len(left) and len(right):
        v, n, outer, y, theirs = number(right, "v"), number(right, "n"), right["outer"].to_numpy(zero_copy_only=False), sketch(right), sets(right)
        own_v, own_n, x, ours = number(left, "v"), number(left, "n"), sketch(left), sets(left)
        label, own_label = number(right, "label").copy(), number(left, "label").copy()
        for at in range(0, len(own_v), 128):
            part = slice(at, at + 128)
            a, size = own_v[part, None], own_n[part, None]
            fits = (own_label[part, None] != label) & (100 * np.minimum(size, n) >= PERCENT * np.maximum(size, n)) & (~outer | (v > a))
            if not fits.any():
                continue
            equal = np.zeros(fits.shape, np.uint8)
            for mine, other in zip(x[:, part], y):
                equal += mine[:, None] == other
            for i in range(at, at + len(fits)):
                near = np.flatnonzero(fits[i - at] & (equal[i - at] >= EQUAL_DEEP))
                near = near[np.argsort(-equal[i - at][near].astype(np.int64), kind="stable")]
                while len(near := near[label[near] != own_label[i]]):  # what a link has joined need not be compared any more
                    j, near = near[0], near[1:]
                    common = len(np.intersect1d(ours[i], theirs[j], assume_unique=True))
                    if 100 * common >= PERCENT * (own_n[i] + n[j] - common):
                        links.append((int(own_v[i]), int(v[j])))
                        gone, stays = label[j], own_label[i]
                        label[label == gone], own_label[own_label == gone] = stays, stays
    return pa.table([pa.array([f(p) for p in links], pa.int64()) for f in (min, max)], ["a", "b"])


def _block_links(blocks: DataFrame, deep: DataFrame, classes: DataFrame, docs: DataFrame, repeated: bool) -> DataFrame:
    """Links ``a, b`` across the components of each node: the classes outside its largest one with all, block by block."""
    sets = written(_sets(docs, classes.join(blocks.select("v").distinct(), "v").select("v", "doc_id"), repeated), "sets")
    dealt = lambda parts, seed: F.pmod(F.xxhash64("v", F.lit(seed)), F.col(parts))
    every = lambda parts: F.sequence(F.lit(0).cast("bigint"), F.col(parts) - 1)
    rows = blocks.withColumn("row", dealt("outer_parts", 1)).withColumn("column", dealt("parts", 2))
    cell = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    across = F.when(F.col("outer"), F.transform(every("parts"), lambda j: cell(F.col("row"), j))).otherwise(F.array().cast("array<struct<i: bigint, j: bigint>>"))
    down = F.transform(every("outer_parts"), lambda i: cell(i, F.col("column")))
    rows = rows.withColumn("cell", F.explode(F.array_union(across, down)))
    rows = rows.select("node", "cell.i", "cell.j", "v", "n", "label", "outer", (F.col("outer") & (F.col("cell.i") == F.col("row"))).alias("left"), (F.col("cell.j") == F.col("column")).alias("right"))
    return rows.join(deep, "v").join(sets, "v").groupBy("node", "i", "j").applyInArrow(_forest, "a bigint, b bigint")


def linked_classes(docs: DataFrame, signed: DataFrame, small: int = SMALL, levels: int = LEVELS, wide: int = WIDE) -> DataFrame:
    """``v, label`` of every class that is linked with another one; ``signed`` are the written :func:`signatures`."""
    classes = signed.where("v is not null").groupBy("v").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"))
    repeated = bool(signed.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").take(1))
    nodes = signed.where("v is not null and doc_id is not null").select("v", "n", F.explode("nodes").alias("node")).distinct()
    nodes = nodes.select("node", "v", "n", F.col("v").alias("label"))
    labels, deep, level = None, None, 0
    while True:
        # first only with a pivot, so that most pairs of large nodes lie within components; at last whatever is left
        pairs, blocks, rest = _pairs(nodes, small, small if level == 0 else wide if level < levels else None)
        found = _confirmed(pairs, classes, signed, docs, repeated)
        if deep is not None and blocks.take(1):
            found = found.unionAll(_block_links(blocks, deep, classes, docs, repeated))
        if labels is not None:  # the components so far are links as well
            found = found.unionAll(labels.select(F.col("v").alias("a"), F.col("label").alias("b")))
        labels = written(components(found), "labels")
        if not rest.take(1):
            return labels
        if deep is None:
            deep = written(_deep(docs, classes.join(rest.select("v").distinct(), "v").select("v", "doc_id"), repeated), "deep")
        if level > 0:
            rest = _branched(rest, deep, level)
        else:  # the pivot is done with: all others of its node have met it
            rest = rest.where("v != pivot").select("node", "v", "n")
        nodes = rest.join(labels, "v", "left").select("node", "v", "n", F.coalesce("label", "v").alias("label"))
        level += 1


def _branched(rest: DataFrame, deep: DataFrame, level: int) -> DataFrame:
    """The members of large nodes in the nodes of the next level; a node's name holds its path, and says which tokens branch it."""

    def child(step: int):
        place = F.pmod(F.xxhash64("node", F.lit(level), F.lit(step)), F.lit(DEEP))
        token = F.substring(F.col("deep"), (place * 2 + 1).cast("int"), F.lit(2))
        return F.xxhash64("node", token, F.lit(step))

    children = F.array(*map(child, range(CHILDREN[level - 1])))
    return rest.join(deep, "v").select("v", "n", F.explode(children).alias("node"))


def _grouped(docs: DataFrame) -> DataFrame:
    signed = written(signatures(docs), "signatures")
    labels = linked_classes(docs, signed)
    classes = signed.where("v is not null").groupBy("v").agg(F.min("doc_id").alias("first")).join(labels, "v", "left").select("v", "first", F.coalesce("label", "v").alias("label"))
    least = classes.groupBy("label").agg(F.min("first").alias("component"))
    of_class = classes.join(least, "label").select("v", "label", "component")
    alone = F.col("v").isNull() | F.col("doc_id").isNull()
    out = signed.select("doc_id", "k", "n", "v").join(of_class, "v", "left")
    return out.select("doc_id", "k", "n", "label", alone.alias("alone"), F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component"))


def near_duplicate_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row; the least ``doc_id`` of a component is kept."""
    kept = F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True))
    return _grouped(docs).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` of which one stays for each component: the least by ``doc_id``, then by hash of the text.

    Rows without words or without ``doc_id`` all stay. Rows equal in ``doc_id`` and text are copies, so one of them stays.
    """
    grouped = written(_grouped(docs), "groups")
    stay = grouped.where("not alone").groupBy("label").agg(F.min(F.struct("doc_id", "k")).alias("s")).select("s.*")
    stay = stay.unionAll(grouped.where("alone and doc_id is not null").select("doc_id", "k").distinct())
    doc_id, k = docs["doc_id"].cast("bigint"), F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), doc_id.alias("doc_id"), k.alias("k"))
    found = keyed.join(stay, ["doc_id", "k"], "left_semi")
    worded = F.col("doc.text").cast("string").rlike("[^\\x20\\x09-\\x0D]")
    if grouped.where("not alone").groupBy("doc_id", "k").count().where("count > 1").take(1):
        found = found.where(~F.coalesce(worded, F.lit(False))).unionAll(found.where(worded).dropDuplicates(["doc_id", "k"]))
    return found.select("doc").unionAll(keyed.where("doc_id is null").select("doc")).select("doc.*")
