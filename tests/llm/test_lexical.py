"""Ranked search against plain scoring of every document, and the bounds of the trees."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from loginwatch.llm import lexical
from loginwatch.llm.lexical import BallTree, Best, Vectors, ranked_documents

from .cases import PROSE, bag, documents, odd_documents, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def slow_ranking(docs, items, top=50):
    """``docs`` and ``items``: (id, text) pairs; the rows of the query."""
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    N, L = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc_id, c in held:
            m = 50 + (50 * sum(c.values()) * N) // L
            score = sum(
                math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k + 1, s[-1], -s[0]) for k, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def pairs(frame, key):
    return [(r[key], r["text"]) for r in frame.select(key, "text").collect()]


COLUMNS = ("item_id", "rank", "doc_id", "score")


def test_given_table_equals_plain_scoring(spark):
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    want = slow_ranking(pairs(docs, "doc_id"), pairs(bench, "item_id"))
    assert bag(ranked_documents(docs, bench), *COLUMNS) == want


def test_rounds_and_blocks_change_nothing(spark, monkeypatch):
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    want = slow_ranking(pairs(docs, "doc_id"), pairs(bench, "item_id"), 5)
    assert lexical._shares(200, 3) == [1 / 256, 1 / 16, 1]
    assert bag(ranked_documents(docs, bench, top=5, first=3), *COLUMNS) == want
    assert bag(ranked_documents(docs, bench, top=5, block=200), *COLUMNS) == want


def test_odd_rows(spark):
    docs = odd_documents(spark).unionByName(documents(spark, [PROSE] * 30 + ["FOX fox Fox", "É é É9", "it's fox-like"], first=100))
    items = spark.createDataFrame(
        [(1, "The FOX jumps"), (1, "over me"), (None, "é"), (2, None), (3, "..."), (4, "nowhere"), (5, "x"), (5, "x"), (6, "id z café")],
        "item_id long, text string",
    )
    want = slow_ranking(pairs(docs, "doc_id"), pairs(items, "item_id"))
    clashing = docs.selectExpr("*", "1 AS score", "2 AS rank", "3 AS item_id", "'q' AS term")
    assert bag(ranked_documents(clashing, items.selectExpr("*", "9 AS doc_id")), *COLUMNS) == want
    assert {w[0] for w in want} == {1, None, 5, 6}
    assert ranked_documents(docs.where("false"), items).count() == 0
    assert ranked_documents(docs, items.where("false")).count() == 0
    got = ranked_documents(docs, items)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_ties_keep_the_smallest_ids(spark):
    docs = documents(spark, [(i, PROSE, "en", "a", 0) for i in random.Random(1).sample(range(1000), 400)])
    items = spark.createDataFrame([(7, "lazy dog")], "item_id long, text string")
    # All alike: every document holds every term, whose weight is then floor(1000 ln(802/801)) = 1.
    got = ranked_documents(docs, items, first=20).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in docs.collect())[:50]
    assert len({r["score"] for r in got}) == 1


def random_vectors(seed, rows=700, width=300, copies=200, top=10**9):
    rng = np.random.default_rng(seed)
    parts = [np.sort(rng.choice(width, rng.integers(1, 40), replace=False)) for _ in range(rows - copies)]
    values = [rng.integers(1, top, len(p)) for p in parts]
    parts, values = parts + [parts[0]] * copies, values + [values[0]] * copies
    return Vectors(
        list(range(rows)), np.concatenate([[0], np.cumsum([len(p) for p in parts])]),
        np.concatenate(parts).astype(np.int32), np.concatenate(values),
    ), parts, values


@pytest.mark.parametrize("seed, top", [(1, 10**9), (2, 3), (3, 2**55)])
def test_bounds_hold_and_search_is_exact(seed, top):
    vectors, parts, values = random_vectors(seed, top=top)
    tree = BallTree(vectors, leaf=16)
    dense = [dict(zip(p.tolist(), v.tolist())) for p, v in zip(parts, values)]

    def below(node):
        return list(tree.members[node]) if tree.members[node] is not None else [r for c in tree.children[node] for r in below(c)]

    assert sorted(below(0)) == list(range(700))
    rng = np.random.default_rng(seed)
    for _ in range(12):
        terms = np.sort(rng.choice(330, 20, replace=False)).astype(np.int32)
        scores = [sum(d.get(int(t), 0) for t in terms) for d in dense]
        at = np.searchsorted(tree.columns, terms)
        bounds = tree.bounds(np.array([a for a, t in zip(at, terms) if a < tree.width and tree.columns[a] == t]))
        for node in range(len(tree.radii)):
            assert bounds[node] >= max(scores[r] for r in below(node))
        best = Best(10)
        tree.search(terms, best)
        want = sorted(((s, -i) for i, s in enumerate(scores) if s), reverse=True)[:10]
        assert sorted(best.heap, reverse=True) == want
        # What must be beaten is given: nothing more is found, and less is looked at.
        again = Best(10, want[-1])
        tree.search(terms, again)
        assert sorted(again.heap, reverse=True) == want[:-1]


def test_subtrees_are_pruned():
    """Two far-off clusters: the search for one does not score the other."""
    rng = np.random.default_rng(5)
    parts = [np.arange(0, 20) if i % 2 else np.arange(100, 120) for i in range(512)]
    values = [np.full(20, 1000) + rng.integers(0, 9, 20) for _ in parts]
    tree = BallTree(Vectors(list(range(512)), np.arange(0, 20 * 513, 20), np.concatenate(parts).astype(np.int32), np.concatenate(values)), leaf=8)
    best = Best(3)
    assert tree.search(np.arange(0, 20, dtype=np.int32), best) < 256
    sums = sorted(((int(v.sum()), -i) for i, v in enumerate(values) if i % 2), reverse=True)
    assert sorted(best.heap, reverse=True) == sums[:3]
