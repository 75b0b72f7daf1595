"""Decontamination, toxicity, language and fingerprints: brute force, edge rows, held-out figures."""

import hashlib
import random
import re

import numpy as np
import pytest

from docfold.llm import decontaminate, fingerprints, language, toxicity
from docfold.llm.queries import QUERIES

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def fold_case(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute_overlaps(docs, items, n=10):
    windows = {}
    for item, text in items:
        own = WORD.findall(fold_case(text))
        size = min(n, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(item)
    found = []
    for doc_id, text in docs:
        own = WORD.findall(fold_case(text))
        hit, owners = set(), set()
        for window, ids in windows.items():
            for i in range(len(own) - len(window) + 1):
                if tuple(own[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    owners |= ids
        owners = sorted(str(o) for o in owners if o is not None)
        digest = hashlib.sha256(",".join(owners).encode()).hexdigest()
        found.append((doc_id, len(own), len(hit), len(owners), digest, bool(hit)))
    return sorted(found, key=repr)


def overlap_rows(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


def made(rng, n, words="abcd"):
    return " ".join(rng.choice(words) for _ in range(n))


def overlap_fixture():
    rng = random.Random(3)
    items = [(1, made(rng, 30)), (2, made(rng, 12)), (10, "x y"), (3, None), (4, ""), (None, "only null id"), (5, "É, Ü-2!"), (2, "second text of two"), (6, made(rng, 14))]
    docs = [(i, made(rng, rng.randrange(60))) for i in range(40)]
    docs += [(50, None), (51, ""), (52, "A, " + items[0][1].upper() + "! x-Y" + items[1][1]), (52, "X;y"), (None, "x y x y"), (53, "é ü 2 É ü 2"), (54, "ONLY null ID"), (55, "second Text of two")]
    docs.append((56, (items[0][1] + " q ") * 400))
    return docs, items


@pytest.mark.parametrize("block_chars", [1 << 20, 40])
def test_overlaps_against_brute_force(spark, block_chars):
    docs, items = overlap_fixture()
    frame = spark.createDataFrame([(i, t, 5, "q") for i, t in docs], "doc_id bigint, text string, spans int, items string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, n int")
    found = decontaminate.find_overlaps(frame, bench, block_chars=block_chars)
    assert overlap_rows(decontaminate.overlap_digest(found)) == brute_overlaps(docs, items)
    cleaned = decontaminate.remove_overlaps(frame, bench, block_chars=block_chars)
    assert cleaned.columns == frame.columns and cleaned.count() == frame.count()
    kept = [(r["doc_id"], r["text"]) for r in cleaned.collect()]
    assert not any(r[5] for r in brute_overlaps(kept, items))
    before = {(r[0], r[4], r[5]) for r in brute_overlaps(docs, items) if not r[5]}
    assert len(before) > 3
    clean = {t for i, t in docs if not brute_overlaps([(i, t)], items)[0][5]}
    assert clean <= {t for _, t in kept}


def test_overlaps_with_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert overlap_rows(decontaminate.overlap_digest(decontaminate.find_overlaps(docs, bench))) == brute_overlaps([(1, "a b")], [])
    assert decontaminate.find_overlaps(docs.limit(0), bench).count() == 0
    assert decontaminate.remove_overlaps(docs, bench).collect() == docs.collect()


def test_overlap_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    windows = brute_overlaps(docs[:60], items)
    found = overlap_rows(QUERIES["op8_decontamination"](spark, SMALL))
    assert len(found) == len(docs) and set(windows) <= set(found) and any(r[5] for r in found)


def auc(truth, scores):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    positives = np.sum(truth)
    return (ranks[np.array(truth) == 1].sum() - positives * (positives + 1) / 2) / (positives * (len(truth) - positives))


def test_toxicity_held_out(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    found = QUERIES["op4_toxicity"](spark, LARGER).collect()
    assert len(found) == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    seen = [(labels[r["doc_id"]], r["score"]) for r in found if r["held_out"] and r["doc_id"] in labels]
    truth, scores = zip(*seen)
    assert auc(truth, np.array(scores)) > 0.95
    flagged = [t for t, s in seen if s >= 0.5]
    assert sum(flagged) > 0.75 * sum(truth) and len(flagged) - sum(flagged) < 0.01 * len(truth)


def test_toxicity_edge_rows(spark):
    rows = [(i, "you utter fool " + "word " * (i % 5) if i % 3 == 0 else "a fine day " + "word " * (i % 7)) for i in range(60)]
    docs = spark.createDataFrame([(i, t, 9.0) for i, t in [*rows, (60, None), (61, ""), (None, "fool"), (0, "a fine day")]], "doc_id bigint, text string, toxicity double")
    labels = spark.createDataFrame([*((i, int(i % 3 == 0)) for i in range(60)), (61, None), (999, 1), (None, 1), (3, 1)], "doc_id bigint, toxic int")
    classifier = toxicity.train(docs, labels)
    found = {(r["doc_id"], r["text"]): r["toxicity"] for r in toxicity.score(docs, classifier).collect()}
    assert len(found) == 64 and found[0, rows[0][1]] > 0.5 > found[0, "a fine day"] and found[60, None] == found[61, ""] < 0.5
    assert toxicity.score(docs.limit(0), classifier).count() == 0
    nothing = toxicity.train(docs, labels.where("toxic = 0"))
    assert max(r["toxicity"] for r in toxicity.score(docs, nothing).collect()) < 1e-9
    assert toxicity.train(docs.limit(0), labels).bias == toxicity.train(docs, labels.limit(0)).bias == -30


def test_non_negative_risk_learns_without_negative_labels():
    rng = np.random.default_rng(1)
    signal = lambda toxic: np.array(sorted({*rng.choice(50, 12).tolist(), *([1000 + int(rng.integers(5))] if toxic else [])}), np.uint32)
    model = toxicity.fit([signal(True) for _ in range(300)], [signal(rng.random() < 0.2) for _ in range(2000)], 0.2)
    logit = lambda row: model.weights[row].sum() + model.bias
    assert min(logit(signal(True)) for _ in range(100)) > 0 > max(logit(signal(False)) for _ in range(100))


def test_language_held_out(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL[:-5]}0.01/documents.parquet").collect()}
    found = QUERIES["op3_language_mixture"](spark, f"{SMALL[:-5]}0.01").collect()
    assert len(found) == len(langs)
    held = [r for r in found if r["held_out"]]
    assert 0.15 < len(held) / len(found) < 0.35
    assert np.mean([langs[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97


def test_language_edge_rows(spark):
    english, german = "the quick brown fox jumps over the lazy dog and runs home", "der schnelle braune fuchs springt über den faulen hund nach hause"
    train = spark.createDataFrame([(english, "en"), (german, "de"), (None, "fr"), ("le petit chat", None)], "text string, lang string")
    model = language.train(train)
    assert model.languages == ["de", "en"]
    texts = [(1, None), (2, ""), (3, "123 !?"), (4, english * 200), (5, german), (5, german), (None, "dog"), (7, (english + " " + german + " ") * 5), (8, "ж")]
    docs = spark.createDataFrame([(i, t, "x", 2.0) for i, t in texts], "doc_id bigint, text string, lang_pred string, score double")
    found = sorted((tuple(r) for r in language.predict(docs, model).collect()), key=repr)
    by = {r[0]: r for r in found}
    assert len(found) == 9 and all(by[i][1:3] == ("und", 0.0) for i in (1, 2, 3))
    assert by[4][1] == "en" and by[5][1] == "de" and by[5][2] == 1.0 and set(by[7][3]) == {"de", "en"} and 0.3 < by[7][2] < 0.7
    assert all(0 <= r[2] <= 1 for r in found)
    assert {r["lang_pred"] for r in language.predict(docs, language.train(train.limit(0))).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0


def brute_compare(rows):
    order = sorted(rows, key=lambda r: -r[0])
    for k, (doc_id, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1] or ""
        text = text or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        yield doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), text, changed, following


def test_fingerprints_against_neighbours(spark):
    rng = random.Random(5)
    rows = [(i * 7 - 20, made(rng, rng.randrange(80), ["é", "b", "w😀", "no", "yes", "it"])) for i in range(60)] + [(1000, None), (1001, ""), (1002, "z" * 5000), (1003, rng.choice("ab") * 3)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, packed string").repartition(5)
    known = fingerprints.lexicon(docs)
    found = {r["doc_id"]: r for r in fingerprints.compare_with_edits(docs, known).collect()}
    assert len(found) == len(rows)
    for doc_id, n_chars, digest, text, changed, following in brute_compare(rows):
        r, own = found[doc_id], fingerprints.fingerprint(text, known)
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (n_chars, digest, own, fingerprints.fingerprint(changed, known))
        assert r["near_edited"] == fingerprints.likeness(own, fingerprints.fingerprint(changed, known))
        assert r["near_next"] == fingerprints.likeness(own, fingerprints.fingerprint(following, known))


def test_fingerprints_edge_tables(spark):
    one = spark.createDataFrame([(1, "abcd")], "doc_id bigint, text string")
    r = fingerprints.compare_with_edits(one, fingerprints.lexicon(one)).collect()
    assert len(r) == 1 and r[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and r[0]["near_next"] == 1.0
    assert fingerprints.compare_with_edits(one.limit(0), fingerprints.lexicon(one.limit(0))).count() == 0
    ties = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (1, "d"), (None, None)], "doc_id bigint, text string")
    assert fingerprints.compare_with_edits(ties, fingerprints.lexicon(ties)).count() == 5


def test_lexicon_keeps_the_band(spark):
    docs = spark.createDataFrame([(i, f"the own{i} " + ("mid" if i % 10 == 0 else "")) for i in range(100)], "doc_id bigint, text string")
    assert fingerprints.lexicon(docs, 0.05, 0.5).tolist() == fingerprints.term_hashes("Mid").tolist()


def test_edits_stay_near(spark):
    found = QUERIES["op7_imatch_fingerprints"](spark, f"{SMALL[:-5]}0.01").collect()
    assert len(found) == 1000
    assert np.mean([r["near_edited"] > r["near_next"] for r in found]) > 0.9


def test_classifier_does_not_depend_on_the_order_of_labels(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choices(["bad", "worse"] if i % 4 == 0 else ["good", "fine", "bad"], k=6))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = [(i, int(i % 4 == 0)) for i, _ in rows]
    models = []
    for seed in range(3):
        random.Random(seed).shuffle(labels)
        given = spark.createDataFrame(labels, "doc_id bigint, toxic int").repartition(seed + 1)
        models.append(toxicity.train(docs, given, sample_rows=100))
    assert len({m.bias for m in models}) == 1 and all((m.weights == models[0].weights).all() for m in models)
