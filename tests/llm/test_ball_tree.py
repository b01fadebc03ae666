"""Ranked search against brute force: ties, repeated ids and items, nulls, empty and long texts, hash clashes, empty tables."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from panelkit.llm import ball_tree

DOCS = "doc_id long, text string, id string, terms long, score string"
ITEMS = "item_id long, text string, number long"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, c, n in held:
            m = 100 - 90 + 90 * n * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scores.append((-s, i is not None, i or 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores)[:top])]
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def prose(r, n):
    return " ".join(r.choice(["the", "of", "Und", "größe", "中文字", "x1", "a_b", "it's"] + [f"w{k}" for k in range(200)], n))


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(5)
    docs = [(i, prose(r, int(r.integers(1, 80)))) for i in range(600)]
    docs += [(1000 + i, "the W7 of größe") for i in range(40)] + [(7, "the w7 of größe")] * 12  # copies, and an id that repeats
    docs += [(None, "w7 w8 w9"), (None, None), (2000, ""), (2001, " !?\n"), (2002, prose(r, 30_000)), (2003, "w" * 300_000 + " w9"), (-4, "w9")]
    items = [(k, prose(r, 12)) for k in range(30)]
    items += [(50, "w7"), (51, "nothing like it"), (52, None), (53, ""), (None, "w9 THE"), (54, "the"), (54, "w3"), (55, "W" * 300_000), (56, "the of und w1 w2 w3 größe 中文字")]
    return docs, items


def frames(spark, rows):
    return (spark.createDataFrame([(*d, "x", 1, "y") for d in rows[0]], DOCS).repartition(5),
            spark.createDataFrame([(*i, 9) for i in rows[1]], ITEMS))


@pytest.mark.parametrize("params", [{}, {"pairs": 40}, {"top": 3}])
def test_ranked(spark, rows, params):
    got = ball_tree.ranked(*frames(spark, rows), **params)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(*rows, params.get("top", 10)), key=key)


def test_small_trees_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(ball_tree, "TREE_ROWS", 50)
    r = np.random.default_rng(1)
    docs, _ = rows
    ids, texts = zip(*[d for d in docs if d[0] is not None])
    terms = ball_tree.Terms([f"w{k}" for k in range(200)])
    assert terms.most == 1
    vectors = [sorted(set(r.integers(0, 300, r.integers(1, 40)).tolist())) for _ in range(500)]
    ptr = np.append(0, np.cumsum([len(v) for v in vectors]))
    vals = r.integers(1, 10**9, ptr[-1])
    tree = ball_tree.BallTree(ptr, np.concatenate(vectors), vals, leaf=8)
    for _ in range(40):
        asked = np.unique(r.integers(0, 320, 9))
        full = np.array([vals[a:b][np.isin(v, asked)].sum() for v, a, b in zip(vectors, ptr, ptr[1:])])
        bounds = tree.bounds(tree.columns(asked))
        for node, bound in enumerate(bounds):
            assert full[tree.order[tree.low[node]:tree.high[node]]].max() <= bound
        seen = np.full(500, -1)
        tree.search(asked, lambda: 1, lambda rows, scores: seen.__setitem__(rows, scores))
        assert (seen[seen >= 0] == full[seen >= 0]).all() and full[seen < 0].max(initial=0) == 0


def test_subtrees_are_left_out():
    """Documents in clear groups: a query for one group opens its leaves only."""
    r = np.random.default_rng(2)
    vectors = [np.sort(r.choice(50, 30, replace=False) + 50 * (k % 20)) for k in range(4000)]
    ptr = np.append(0, np.cumsum([len(v) for v in vectors]))
    tree = ball_tree.BallTree(ptr, np.concatenate(vectors), np.full(ptr[-1], 1000), leaf=32)
    best = ball_tree.Best(10)
    import pyarrow as pa
    ids = pa.array(range(4000))
    opened = tree.search(np.arange(50), lambda: best.least, lambda rows, scores: best.offer(scores, ids, rows))
    leaves = sum(not c for c in tree.child)
    assert opened < leaves / 4 and len(best.rows) == 10


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(ball_tree, "span_hash", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    terms = ball_tree.Terms(["ab", "abc", "xy", "zz"])
    text = np.frombuffer(b"xy ab q zz abc abd", np.uint8)
    starts, ends, _ = ball_tree.word_bounds(text, np.array([0, len(text)]))
    word, term = terms.find(text, starts, ends)
    assert sorted(zip(word, term)) == [(0, 2), (1, 0), (3, 3), (4, 1)]


def test_nothing(spark, rows):
    docs, items = frames(spark, rows)
    assert ball_tree.ranked(docs.limit(0), items).collect() == []
    assert ball_tree.ranked(docs, items.limit(0)).collect() == []
