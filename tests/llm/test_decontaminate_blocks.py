"""Passages of several blocks of a benchmark."""

import random

from docfold.llm import decontaminate


def test_windows_made_by_later_blocks_are_cut(spark):
    """An item inside another one's passage goes, whichever of their blocks comes first; the result is that of one block."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**9)}"
    items, docs = [], []
    for i in range(12):
        outer, inner = [word() for _ in range(12)], [word() for _ in range(12)]
        items += [(2 * i, " ".join(outer)), (2 * i + 1, " ".join(inner))]
        docs.append((2 * i, " ".join(["a", *outer[:5], *inner, *outer[5:], "b"])))
        docs.append((2 * i + 1, " ".join(["c", *inner[:6], *outer, *inner[6:], "d"])))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    one, many = (sorted(map(tuple, decontaminate.remove_overlaps(frame, bench, block_chars=c).collect())) for c in (16 << 20, 500))
    assert many == one
    assert all(len(t.split()) == 2 for _, t in many)
    assert not any(r["items"] for r in decontaminate.find_overlaps(spark.createDataFrame(many, frame.schema), bench).collect())


def test_blocks_are_read_one_by_one_and_repeated_items_once(spark, monkeypatch):
    seen, blocks, init = [], decontaminate._blocks, decontaminate.Windows.__init__

    def logged(*args):
        for block in blocks(*args):
            seen.append("read")
            yield block

    monkeypatch.setattr(decontaminate, "_blocks", logged)
    monkeypatch.setattr(decontaminate.Windows, "__init__", lambda *a: seen.append("made") or init(*a))
    items = [(i, " ".join(f"w{i}_{k}" for k in range(12))) for i in range(12)]
    bench = spark.createDataFrame(items + items[:1] * 40, "item_id bigint, text string")
    docs = spark.createDataFrame([(i, t) for i, t in items], "doc_id bigint, text string")
    found = decontaminate.find_overlaps(docs, bench, block_chars=300)
    assert len(seen) > 2 and seen == ["read", "made"] * (len(seen) // 2)
    assert sorted(r["items"] for r in found.collect()) == [[i] for i in range(12)]
    assert sum(len(b) for b in blocks(bench, 300)) == 12
