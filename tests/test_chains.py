"""Page chains against walking along every link."""

import random

import pytest

from docfold.operators.chains import chain_faults, page_chain
from docfold.operators.keys import looked_up
from tests.conftest import rows


def walked(links):
    """``{(entity, page): steps}``, None where the walk never ends."""
    out = {}
    for (entity, page) in links:
        steps, at, seen = 0, page, set()
        while at not in seen and links[entity, at] is not None and (entity, links[entity, at]) in links:
            seen.add(at)
            at, steps = links[entity, at], steps + 1
        out[entity, page] = None if at in seen else steps
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_links(spark, seed):
    rng = random.Random(seed)
    links = {}
    for entity in ("a", "b", None):
        n = rng.randint(1, 40)
        for page in range(1, n + 1):
            links[entity, page] = rng.choice([None, page + 1, page + 1, page + 1, rng.randint(1, n + 2)])
    for page in range(1, 66):  # a long chain, and a star
        links["long", page] = page + 1 if page < 65 else None
        links["star", page] = 1 if page > 1 else None
    links = {k: v for k, v in links.items() if k[0] is not None}
    pages = spark.createDataFrame([(e, p, n) for (e, p), n in links.items()] + [("a", None, 1)], "entity string, page bigint, next bigint")
    chain = page_chain(pages, ["entity"], "page", "next")
    assert {(r.entity, r.page): r.steps for r in chain.collect()} == walked(links)
    faults = {r.entity: r for r in chain_faults(chain, ["entity"], "page").collect()}
    fine = dict.fromkeys(("heads", "ends", "merged", "dangling", "cyclic", "misnumbered", "repeated", "conflicting"), 0)
    assert faults["long"].asDict() == {"entity": "long", "pages": 65, "chain_length": 65, "first_page": 1, **fine}
    assert (faults["star"].heads, faults["star"].merged, faults["star"].misnumbered) == (64, 63, 64)


@pytest.mark.parametrize(
    ("links", "fault"),
    [
        ([(1, 2), (2, 1)], {"cyclic": 2, "ends": 1, "misnumbered": 1}),
        ([(1, 3), (2, 3), (3, None)], {"heads": 1, "merged": 1, "misnumbered": 1}),
        ([(1, 2), (2, 9)], {"dangling": 1, "ends": 1, "misnumbered": 1}),
        ([(1, None), (2, None)], {"heads": 1, "ends": 1}),
        ([(1, 2), (1, 2), (2, None)], {"repeated": 1}),
        ([(1, 2), (1, None), (2, None)], {"repeated": 1, "conflicting": 1}),
        ([(1, None)], {}),
    ],
)
def test_faults(spark, links, fault):
    pages = spark.createDataFrame(links, "page bigint, next bigint")
    found = chain_faults(page_chain(pages, [], "page", "next"), [], "page").drop("pages", "chain_length", "first_page").first().asDict()
    assert {k: v for k, v in found.items() if v} == fault


def test_no_pages(spark):
    pages = spark.createDataFrame([], "e string, page bigint, next bigint")
    assert chain_faults(page_chain(pages, ["e"], "page", "next"), ["e"], "page").count() == 0


def test_look_up_matches_hot_keys_by_broadcast(spark):
    left = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 0), (2, 1), (3, 0), (None, 5)], "k int, x int")
    right = spark.createDataFrame([(1, "a"), (3, "c"), (4, "d")], "k int, v string")
    want = sorted([(1, i, "a") for i in range(30)] + [(2, 0, None), (2, 1, None), (3, 0, "c")])
    for hot in (1, 2, 100):
        found = rows(looked_up(left, right, ["k"], hot))
        assert found[0] == (None, 5, None) and found[1:] == want
