"""Ranked lexical search against the definition, term by term."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from saleskeep.llm import dual_tree

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_rank(documents, items, k=10):
    docs = [(i, Counter(terms(t))) for i, t in documents]
    many = sum(1 for _, c in docs if c)
    total = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    weight = {t: math.floor(1000 * math.log((2 * many + 2) / (2 * n + 1))) for t, n in df.items()}
    expected = {}
    for item in {i for i, t in items if i is not None and t is not None}:
        asked = terms(min((t for i, t in items if i == item and t is not None), key=str.encode))
        scores = []
        for doc, counts in docs:
            if doc is None:
                continue
            m = 25 + (75 * sum(counts.values()) * many) // total if total else 0
            score = sum(weight[t] * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m)) for t in asked if t in counts)
            if score > 0:
                scores.append((-score, doc))
        expected |= {(item, rank): (doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:k], 1)}
    return expected


def found_rank(frame):
    return {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in frame.collect()}


def corpus(seed, documents, items):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{int(rng.zipf(1.3)) % 200}"
    text = lambda n: " ".join(word() for _ in range(n))
    docs = [(n, text(int(rng.integers(1, 60)))) for n in range(documents)]
    docs += [(documents + n, docs[n][1]) for n in range(30)]  # ties
    return docs, [(n, text(int(rng.integers(1, 25)))) for n in range(items)]


@pytest.mark.parametrize("block_terms,cells", [(32_768, 4_000_000), (40, 3_000)])
def test_rank(spark, workspace, block_terms, cells):
    documents, items = corpus(1, 700, 45)
    documents += [(5000, None), (5001, ""), (5002, ",.;"), (None, "w1 w2 w3"), (3, documents[3][1]), (5003, "w1 " * 20_000), (5004, "ÉcoLE Ÿ w1")]
    items += [(100, None), (101, ""), (102, "unheard of"), (None, "w1"), (7, "w1 w1"), (103, "école ÉcOLE w1")]
    docs = spark.createDataFrame([(*d, "x", 1) for d in documents], "doc_id long, text string, item_id string, n int").repartition(5)
    benchmark = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id int")
    found = dual_tree.rank(docs, benchmark, workspace, block_terms=block_terms, cells=cells)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert found_rank(found) == brute_rank(documents, items)


def test_empty_tables(spark, workspace):
    docs, benchmark = (spark.createDataFrame([(1, "a b")], f"{n} long, text string") for n in ("doc_id", "item_id"))
    assert found_rank(dual_tree.rank(docs.limit(0), benchmark, workspace)) == {}
    assert found_rank(dual_tree.rank(docs, benchmark.limit(0), workspace)) == {}
    nothing = spark.createDataFrame([(1, None), (2, "..")], "doc_id long, text string")
    assert found_rank(dual_tree.rank(nothing, benchmark, workspace)) == {}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 90), st.integers(1, 30), st.integers(1, 12), st.integers(0, 2**31))
def test_trees_bound_what_is_below(documents, items, width, seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, 50, (documents, width)) * (rng.random((documents, width)) < 0.5)
    asked = rng.integers(1, 9, (items, width)) * (rng.random((items, width)) < 0.6)
    asked[:, 0] += 1
    sparse = [(np.flatnonzero(r), r[r > 0]) for r in asked]
    tree = dual_tree.DocumentTree(rows, np.arange(documents), np.ones(width, np.int64))
    below = lambda t, n: range(t.first[n], t.last[n]) if n >= t.leaves else [r for c in range(t.first[n], t.last[n]) for r in below(t, c)]
    assert sorted(below(tree, 0)) == list(range(documents))
    search = dual_tree.Search(sparse, 3)
    assert sorted(below(search.items, 0)) == list(range(items))
    for node in range(len(tree.first)):
        assert (tree.maxima[node] == tree.rows[list(below(tree, node))].max(axis=0)).all()
    for node in range(len(search.items.first)):
        places, values = search.items.maxima[node]
        dense = np.zeros(width, np.int64)
        dense[places] = values
        assert (dense == asked[[search.items.order[n] for n in below(search.items, node)]].max(axis=0)).all()
    order = rng.permutation(documents)
    for part in np.array_split(order, 3):
        search.add(rows[part], part, np.ones(width, np.int64))
    exact = asked @ rows.T
    got = dict()
    for item, doc, score in zip(*search.result(np.arange(items))):
        got.setdefault(item, []).append((-score, doc))
    for item in range(items):
        assert got.get(item, []) == sorted((-s, d) for d, s in enumerate(exact[item]) if s > 0)[:3]


def test_pairs_are_pruned():
    """Documents that fall into groups with terms of their own: far from all pairs are scored."""
    rng = np.random.default_rng(0)
    groups, width = 40, 400
    rows = np.zeros((4000, width), np.int64)
    for n, row in enumerate(rows):
        row[(n % groups) * 10 + rng.integers(0, 10, 5)] = rng.integers(1, 100, 5)
        row[rng.integers(0, width, 3)] += 1
    items = [(np.arange(g * 10, g * 10 + 10), np.full(10, 7)) for g in range(groups)]
    search = dual_tree.Search(items, 10)
    search.add(rows, np.arange(4000), np.ones(width, np.int64))
    assert search.scored < 0.25 * 4000 * groups


def test_large_numbers_stay_exact():
    big = 2**40
    left, right = np.array([[big, big - 1]]), np.array([[big // 2**20, 3]])
    assert dual_tree.product(left, right).tolist() == [[big * (big // 2**20) + 3 * (big - 1)]]
