"""Ranked search against plain scores of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import lexical
from tallyspark.llm.common import ship_package

from .helpers import documents, empty

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, rank int, doc_id string"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    """{item: [(score, doc_id)]} by the formula, all documents scored."""
    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    df = Counter(t for _, c in counts for t in c)
    found = {}
    for item, own in asked.items():
        scores = []
        for doc_id, c in counts:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0, doc_id))
        found[item] = [(-s, d) for s, _, _, d in sorted(scores)[:k]]
    return {i: f for i, f in found.items() if f}


def items(spark):
    rows = [
        (1, "w3 W4 w5 don't"), (2, "passage of two; other tail"), (3, None), (4, ""), (5, "nowhere"),
        (6, "ΣΑΣ 日本 é"), (6, "one"), (None, "lost w1"), (7, "u1 u2 u399 A,b"), (7, "u1 u2 u399 A,b"),
    ]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], ITEMS)


@pytest.mark.parametrize("limits", [{}, {"block": 2}, {"block": 3, "block_postings": 5, "item_terms": 4}])
def test_ranks_equal_plain_scores(spark, limits):
    docs, asked = documents(spark), items(spark)
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in asked.collect()])
    got = {}
    for r in sorted(lexical.ranked(docs, asked, **limits).collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(got.setdefault(r["item_id"], [])) + 1
        got[r["item_id"]].append((r["score"], r["doc_id"]))
    assert got == want


def test_long_text_in_slices(spark, monkeypatch):
    long = " ".join(f"t{i % 5000},x" for i in range(700_000))  # over four MiB
    docs = spark.createDataFrame([(1, long), (2, "t1 t2")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "t1 t2 x")], "item_id long, text string")
    got = [(r["score"], r["doc_id"]) for r in lexical.ranked(docs, asked).orderBy("rank").collect()]
    assert got == plain([(1, long), (2, "t1 t2")], [(1, "t1 t2 x")])[1]


def test_empty_tables(spark):
    assert lexical.ranked(empty(spark), items(spark)).count() == 0
    assert lexical.ranked(documents(spark), spark.createDataFrame([], ITEMS)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 12))
def test_intervals_lose_nothing(seed, size, k):
    rng = np.random.default_rng(seed)
    pairs = sorted({(int(p), int(t)) for p, t in rng.integers(0, [size, 9], (4 * size, 2))})
    place, term = np.array([p for p, _ in pairs]), np.array([t for _, t in pairs])
    impact = rng.integers(0, 5, len(pairs)) * (1 + term)
    block = lexical.Block(place, term, impact, size, 9)
    wanted = [rng.choice(9, rng.integers(1, 9), replace=False) for _ in range(5)]
    score = lambda w, p: int(impact[np.isin(term, w) & (place == p)].sum())
    best = [sorted(((score(w, p), p) for p in range(size)), key=lambda x: (-x[0], x[1])) for w in wanted]
    for bars in (np.zeros(5, np.int64), np.array([b[min(k, size) - 1][0] for b in best])):
        found = [set() for _ in wanted]
        for item, at, scores in block.search(wanted, bars, k):
            for i, p, s in zip(item.tolist(), at.tolist(), scores.tolist()):
                found[i].add((s, p))
        for i, want in enumerate(best):
            assert found[i] <= set(want)
            assert {x for x in want[:k] if x[0] > 0} <= found[i]


def test_most_documents_are_never_scored():
    rng = np.random.default_rng(5)
    size, terms_ = 4000, 300
    place, term = np.nonzero(rng.random((size, terms_)) < 1 / (2 + np.arange(terms_)))
    impact = (1 + term) * rng.integers(50, 100, len(term))
    block = lexical.Block(place, term, impact, size, terms_)
    wanted = [np.array([3, 40, 150, 250])]
    for _ in block.search(wanted, np.zeros(1, np.int64), 10):
        pass
    assert 10 <= block.scored < size / 2
    first = block.scored
    for _ in block.search(wanted, np.array([np.sort(np.bincount(place, np.where(np.isin(term, wanted[0]), impact, 0)))[-10]], np.int64), 10):
        pass
    assert block.scored - first <= first  # with a bar to start from
