"""Placement, exact search and decontamination against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleskeep.llm import decontamination as dec
from saleskeep.llm import sharding, topk


def test_table_is_even_and_changes_little():
    names = [f"s{n}" for n in range(7)]
    full, less = sharding.lookup_table(names, 1_009), sharding.lookup_table(names[:-1], 1_009)
    counts = Counter(full)
    assert max(counts.values()) - min(counts.values()) <= 1
    moved = sum(a != b for a, b in zip(full, less) if a != 6)
    assert moved < 0.25 * len(full)


def test_table_follows_the_preferences():
    """The definition with whole preference lists instead of running positions."""
    names, slots = ["a", "b", "c"], 13
    lists = []
    for name in names:
        offset = sharding._hash(name, "offset") % slots
        step = sharding._hash(name, "step") % (slots - 1) + 1
        lists.append([(offset + n * step) % slots for n in range(slots)])
    owner = {}
    while len(owner) < slots:
        for shard, wishes in enumerate(lists):
            if len(owner) < slots:
                owner[next(w for w in wishes if w not in owner)] = shard
    assert sharding.lookup_table(names, slots) == [owner[n] for n in range(slots)]


@pytest.mark.parametrize("names,slots", [([], 13), (["a", "a"], 13), (["a"], 12), (list("abc"), 2)])
def test_bad_tables(names, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(names, slots)


def test_placement(spark, tmp_path):
    rows = spark.createDataFrame([(n % 50, "s") for n in range(200)] + [(None, "t")], "doc_id long, shard string")
    placed = sharding.place(rows)
    found = placed.collect()
    assert placed.columns == ["doc_id", "slot", "shard"] and len(found) == 201
    owner = sharding.lookup_table()
    assert all(r["shard"] == sharding.SHARDS[owner[r["slot"]]] for r in found)
    assert len({(r["doc_id"], r["shard"]) for r in found}) == 51
    sharding.write_shards(placed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 201
    assert sharding.place(rows.limit(0)).count() == 0


def brute_topk(rows, asked, k):
    usable = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    expected = {}
    for query in {i for i, _ in usable if asked(i)}:
        vector = min(v for i, v in usable if i == query)
        scores = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in usable if i != query)
        for rank, (score, i) in enumerate(scores[:k], 1):
            expected[query, rank] = (i, -score)
    return expected


@pytest.mark.parametrize("round_queries,block", [(16_384, 256), (3, 4)])
def test_search_equals_brute_force(spark, workspace, monkeypatch, round_queries, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    draw = np.random.default_rng(5)
    rows = [(n, [float(x) for x in draw.normal(size=6).round(1)]) for n in range(150)]
    rows += [(n, rows[3][1]) for n in range(200, 230)]  # one very common vector, ties
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf"), 0.0]), (None, [1.0])]
    rows += [(304, []), (305, [0.5]), (306, [1e12] * 6), (10, rows[10][1]), (10, rows[11][1])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, score int")
    found = topk.search(df, F.col("vec_id") % 5 == 0, workspace, round_queries=round_queries)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found.collect()}
    assert got == brute_topk(rows, lambda i: i % 5 == 0, 5)


def test_search_of_few_and_no_rows(spark, workspace):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.search(df, F.lit(True), workspace).orderBy("query_id").collect()] == [
        (0, 1, 1, 131072), (1, 1, 0, 131072)
    ]
    assert topk.search(df.limit(0), F.lit(True), workspace).count() == 0


def test_bounds_spare_blocks():
    rows = np.repeat(np.eye(8, dtype=np.int64) * 100, 300, axis=0)
    best = topk.Best(np.array([-1]), np.eye(8, dtype=np.int64)[:1], 5)
    assert best.scan(np.arange(len(rows)), rows) < len(rows) / topk.BLOCK_ROWS / 2
    assert best.result()[1].tolist() == [0, 1, 2, 3, 4]


def split(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_hits(documents, items, window):
    wanted = defaultdict(set)
    for item, text in items:
        w = split(text)
        size = min(window, len(w))
        for n in range(len(w) - size + 1 if size else 0):
            wanted[tuple(w[n : n + size])].add(item)
    found = {}
    for doc, text in documents:
        w, hit, names = split(text), set(), set()
        for part, owners in wanted.items():
            for n in range(len(w) - len(part) + 1):
                if tuple(w[n : n + len(part)]) == part:
                    hit |= set(range(n, n + len(part)))
                    names |= owners
        found[doc] = (len(w), len(hit), sorted(map(str, names)))
    return found


@pytest.mark.parametrize("window,block_words", [(10, 4_000_000), (4, 4_000_000), (4, 5)])
def test_hits_equal_brute_force(spark, window, block_words):
    draw = np.random.default_rng(2)
    text = lambda n: " ".join(draw.choice(["a", "B", "çé", "d1", "the"], n))
    items = [(n, text(int(draw.integers(1, 16)))) for n in range(25)] + [(30, "a a a a a a"), (31, ""), (31, "Z"), (10, "x-y")]
    documents = [(n, text(int(draw.integers(1, 60)))) for n in range(60)]
    documents += [(100, None), (101, ""), (102, " .,! "), (103, "x y z" * 3), (104, f"q {items[3][1]} q")]
    df = spark.createDataFrame([(i, t, "m") for i, t in documents], "doc_id long, text string, matches string")
    bench = spark.createDataFrame(items + [(None, "the"), (40, None)], "item_id long, text string")
    found = dec.hits(dec.find_matches(df, bench, window, block_words)).collect()
    expected = brute_hits(documents, items, window)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in found} == expected


def test_longest_matches_and_removal(spark):
    item = " ".join(f"w{n}" for n in range(40))
    documents = [(1, f"x y {item} z"), (2, "clean text"), (3, " ".join(f"w{n}" for n in range(5, 20))), (3, "twice")]
    df = spark.createDataFrame(documents, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    found = {r["doc_id"]: [tuple(m) for m in r["matches"]] for r in dec.find_matches(df, bench).collect() if r["matches"]}
    assert found == {1: [(2, 40, 7, 0)], 3: [(0, 15, 7, 5)]}
    assert sorted(map(tuple, dec.remove_affected(df, bench).collect())) == [(2, "clean text"), (3, "twice")]


def test_no_benchmark_and_no_documents(spark):
    df = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_words"], r["matches"]) for r in dec.find_matches(df, none).collect()] == [(3, [])]
    assert dec.find_matches(df.limit(0), none).count() == 0
