"""Near copies, passages, language-model scores and the pipeline against brute force."""

import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import database
from saleskeep.llm import context_mixing as lm
from saleskeep.llm import decontamination, jaccard_tree, passages, queries
from saleskeep.llm.common import held_out
from saleskeep.llm.graph import components
from saleskeep.llm.shingles import word_hashes

SF_DIR = "/root/testdata/sf0.001"


def words(text):
    return (text or "").encode().lower().split()


def brute_components(rows):
    """(id, set size, smallest id reached, links) by counting the common shingles of all pairs."""
    sets, holders, parent, links = [], defaultdict(list), list(range(len(rows))), Counter()

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for n, (_, text) in enumerate(rows):
        w = words(text)
        found = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
        common = Counter(m for s in found for m in holders[s])
        for m, count in common.items():
            if 100 * count >= 80 * (len(found) + len(sets[m]) - count):
                parent[top(n)] = top(m)
                links.update((n, m))
        for s in found:
            holders[s].append(n)
        sets.append(found)
    least = {}
    for n, (i, _) in enumerate(rows):
        least[top(n)] = min(i, least.get(top(n), i))
    return sorted((i, len(sets[n]), least[top(n)], links[n]) for n, (i, _) in enumerate(rows))


def near_copies_of(seed, count):
    draw = np.random.default_rng(seed)
    base = [f"w{n}" for n in draw.integers(0, 5_000, 120)]
    for _ in range(count):
        copy = list(base)
        for place in draw.integers(0, len(copy), int(draw.integers(0, 5))):
            copy[place] = f"x{draw.integers(0, 10**6)}"
        yield " ".join(copy)


@pytest.mark.parametrize("unit", [2_000_000, 2_000])
def test_components_equal_brute_force(spark, workspace, monkeypatch, unit):
    monkeypatch.setattr(jaccard_tree, "UNIT_TOKENS", unit)
    texts = [t for seed in range(4) for t in near_copies_of(seed, 30)] + ["one two three four five six " * 20] * 9
    texts += ["a b c d", "A b  C\td", "a b c", "", " ", "lone"] + [t + " common line of five more words" for t in near_copies_of(9, 6)]
    rows = [(n * 3 % 1009, t) for n, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, rep string")
    found = jaccard_tree.near_copies(df, workspace).collect()
    columns = ("doc_id", "n_shingles", "component_id", "n_links")
    assert sorted(tuple(r[c] for c in columns) for r in found) == brute_components(rows)


def test_links_of_rows_that_share_an_id(spark, workspace):
    one, other = (" ".join(f"{c}{n}" for n in range(60)) for c in "wv")
    rows = [(7, one), (7, other), (8, one + " more"), (9, other + " more"), (7, one)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r["doc_id"], r["component_id"], r["n_links"]) for r in jaccard_tree.near_copies(df, workspace).collect())
    assert found == {(7, 7, 2): 2, (7, 7, 1): 1, (8, 7, 2): 1, (9, 7, 1): 1}


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 150), st.booleans())
def test_join_of_a_block(seed, count, halved):
    """The weights are those of all pairs, and the links connect the same sets."""
    draw = np.random.default_rng(seed)
    bases = [np.unique(draw.integers(0, 2**63, int(n)).astype(np.uint64)) for n in draw.integers(2, 60, 4)]
    sets, seen = [], set()
    for _ in range(count):
        s = bases[int(draw.integers(0, 4))].copy()
        s[draw.random(len(s)) < 0.06] += np.uint64(1)
        s = np.unique(s)
        if s.tobytes() not in seen:
            seen.add(s.tobytes())
            sets.append(s)
    side = draw.integers(1, 3, len(sets)) if halved else np.zeros(len(sets), int)
    weights = draw.integers(1, 5, len(sets))
    links, weight = jaccard_tree.join_block(sets, side, weights)
    wanted, edges = np.zeros(len(sets), int), []
    for i in range(len(sets)):
        for j in range(i):
            common = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            if (not halved or side[i] != side[j]) and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                wanted[i] += weights[j]
                wanted[j] += weights[i]
                edges.append((i, j))
    assert weight.tolist() == wanted.tolist()

    def parts(pairs):
        label = list(range(len(sets)))
        for _ in label:
            for i, j in pairs:
                label[i] = label[j] = min(label[i], label[j])
        return label

    assert parts(links) == parts(edges)


def test_overlaps_in_strips(monkeypatch):
    monkeypatch.setattr(jaccard_tree, "STRIP", 7)
    draw = np.random.default_rng(2)
    one, other = ([np.unique(draw.integers(0, 60, 30).astype(np.uint64)) for _ in range(k)] for k in (5, 3))
    assert jaccard_tree.overlaps(one, other).tolist() == [[len(np.intersect1d(a, b)) for b in other] for a in one]


def test_memory_of_a_bucket():
    """A bucket is counted in a few times its own size."""
    draw = np.random.default_rng(9)
    slices, held, settled = [], defaultdict(set), np.arange(2**31, 2**31 + 10, dtype=np.uint32)
    for n in range(20):
        owners = [draw.bytes(16) for _ in range(500)] + ([b"c" * 16] if n < 2 else [])
        tokens = [draw.choice(2**31, 40, replace=False).astype(np.uint32) for _ in owners]
        if n < 2:
            tokens[-1] = np.arange(2**31 + 20, 2**31 + 60, dtype=np.uint32)
        elif n == 2:
            tokens[0][:10] = settled
        for owner, some in zip(owners, tokens):
            for token in some.tolist():
                held[token].add(owner)
        counts = np.full(len(owners), 40, np.uint32).tobytes()
        slices.append((b"".join(owners), counts, np.concatenate(tokens).tobytes(), settled.tobytes() if n == 3 else b""))
    table = pa.table({c: pa.array([s[n] for s in slices], pa.binary()) for n, c in enumerate(("owners", "counts", "tokens", "settled"))})
    tracemalloc.start()
    found = jaccard_tree._unique_counts(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    alone = Counter(next(iter(who)) for token, who in held.items() if len(who) == 1 and token not in set(settled.tolist()))
    assert dict(zip(found.column("digest").to_pylist(), found.column("n").to_pylist())) == alone
    assert alone[b"c" * 16] == 40 and peak < 40 * 400_000
    assert jaccard_tree._unique_counts(table.slice(0, 0)).num_rows == 0


def test_texts_come_in_small_batches(spark, workspace, monkeypatch):
    """Whatever the session's limit, near_copies writes with its own, and gives it back."""
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}
    before, keep = spark.conf.get(name), workspace.keep

    def noted(df, to):
        seen[to] = spark.conf.get(name)
        return keep(df, to)

    monkeypatch.setattr(workspace, "keep", noted)
    jaccard_tree.near_copies(spark.createDataFrame([(1, "a b"), (2, "a b")], "doc_id long, text string"), workspace)
    assert max(int(seen["signatures"]), int(seen["sets"])) <= 4 << 20 and spark.conf.get(name) == before


def test_components_of_odd_rows(spark, workspace):
    text = " ".join(f"w{n}" for n in range(30))
    df = spark.createDataFrame([(5, text), (5, text), (3, text), (None, text), (9, None), (9, "x")], "doc_id long, text string")
    found = Counter(map(tuple, jaccard_tree.near_copies(df, workspace).collect()))
    assert found == {
        (5, 26, 3, 3, 2): 2, (3, 26, 3, 3, 2): 1, (None, 26, None, None, None): 1, (9, 0, 9, 1, 0): 1, (9, 1, 9, 1, 0): 1,
    }
    kept = jaccard_tree.keep_first(df, workspace).collect()
    assert Counter(r["doc_id"] for r in kept) == {3: 1, 9: 1, None: 1}
    assert jaccard_tree.near_copies(df.limit(0), workspace).count() == 0


def test_graph_components(spark, workspace):
    edges = [(n, n + 1) for n in range(100, 140)] + [(7, 3), (3, 7), (5, 5), (900, 120)]
    found = components(spark.createDataFrame(edges, "a long, b long"), workspace)
    assert {tuple(r) for r in found.collect()} == {(n, 100) for n in (*range(100, 141), 900)} | {(3, 3), (7, 3)}


def passage_rows():
    draw = np.random.default_rng(8)
    own = lambda n: [f"t{x}" for x in draw.integers(0, 10**6, n)]
    shared, other = own(70), own(60)
    fuzzy = [w if n % 25 else "changed" for n, w in enumerate(other, 1)]
    rows = [(1, own(40) + shared + own(40)), (2, own(30) + shared), (3, own(200)), (4, other + own(9)), (5, own(50) + fuzzy + own(50))]
    rows += [(6, own(20) + shared[:30] + own(20)), (7, ["and"] * 90), (8, own(10) + ["and"] * 80)]
    return [(i, " ".join(w)) for i, w in rows] + [(9, None), (10, ""), (11, "short text")]


def test_first_copies_keep_columns_of_any_kind(spark, workspace):
    text, other = (" ".join(f"{c}{n}" for n in range(30)) for c in "wv")
    rows = [(1, text), (2, text), (3, other), (3, "b"), (3, "b"), (4, None), (4, "c d"), (None, text)]
    df = spark.createDataFrame([(i, t, {"k": str(i)}, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, `a.b` map<string,string>, row int")
    kept = jaccard_tree.keep_first(df, workspace)
    assert kept.columns == df.columns
    found = sorted(((r["doc_id"], r["text"], r["a.b"]["k"]) for r in kept.collect()), key=str)
    assert found == sorted([(1, text, "1"), (3, "b", "3"), (4, None, "4"), (None, text, "None")], key=str)


def test_passages(spark, workspace):
    df = spark.createDataFrame([(i, t, "s") for i, t in passage_rows()], "doc_id long, text string, spans string")
    found = {(r["doc_id"], r["source_id"]): tuple(r) for r in passages.find_passages(df, workspace).collect()}
    assert set(found) == {(2, 1), (5, 4), (8, 7)}
    assert found[2, 1] == (2, 30, 100, 1, 40, 110, 70)
    assert found[5, 4][1] == 50 and 105 <= found[5, 4][2] <= 110 and found[5, 4][6] >= 55
    cut = {r["doc_id"]: r for r in passages.remove_passages(df, workspace).collect()}
    texts = dict(passage_rows())
    assert {n: cut[n]["text"] for n in (1, 3, 4, 6, 7, 9, 10, 11)} == {n: texts[n] for n in (1, 3, 4, 6, 7, 9, 10, 11)}
    assert cut[2]["text"].split() == texts[2].split()[:30] and cut[2]["spans"] == "s"
    assert len(cut[5]["text"].split()) < 106
    assert passages.find_passages(df.limit(0), workspace).count() == 0


def test_rows_that_share_an_id_come_last(spark, workspace):
    text, other = (" ".join(f"{c}{n}" for n in range(90)) for c in "wv")
    rows = [(1, text), (1, "else"), (2, text), (None, text), (None, other), (1, other), (3, None), (1, None), (4, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in passages.find_passages(df, workspace).collect()]
    assert {r[0] for r in found if r[3] == 2} == {1, None} and {r[0] for r in found} <= {1, None}
    assert len(found) == 3 and all(r[1:3] == (0, 90) and r[6] == 90 for r in found)
    left = [(r["doc_id"], r["text"]) for r in passages.remove_passages(df, workspace).collect()]
    assert len(left) == len(rows)
    assert [t for _, t in left].count(text) == 1 and (2, text) in left and [t for _, t in left].count(other) == 1
    assert (1, "else") in left and (3, None) in left and (1, None) in left


def test_common_keys_refer_to_their_slice(spark, workspace, monkeypatch):
    """The same passages, whether a slice sends all places of a common key or refers to the first."""
    draw = np.random.default_rng(5)
    line = [f"c{n}" for n in range(70)]
    docs = [(n, " ".join([f"o{n}_{x}" for x in draw.integers(0, 9**9, 20)] + line + [f"p{n}_{x}" for x in draw.integers(0, 9**9, 20)])) for n in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = passages.find_passages(df, workspace).collect()
    assert {r["doc_id"] for r in found} == set(range(1, 80)) and len(found) == 79
    assert all((r["start_word"], r["end_word"]) == (20, 90) and r["source_id"] < r["doc_id"] for r in found)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 12)), max_size=14))
def test_fewest_spans(drawn):
    spans = [(a, a + n) for a, n in drawn]
    held = lambda some: {w for a, b in some for w in range(a, b)}
    found = passages.fewest(spans)
    assert held(found) == held(spans) and set(found) <= set(spans)
    assert all(held(found[:n] + found[n + 1 :]) != held(spans) for n in range(len(found)))


def test_chains_that_cover():
    one = lambda source, *x: (source, np.array(x), np.array(x))
    long, inside, beside, far = one(1, 0, 15, 30, 45), one(2, 10, 20), one(3, 60, 70), one(4, 500)
    assert [c[0] for c in passages.cover([inside, far, long, beside])] == [1, 3, 4]
    gap = one(5, 0, 10, 200, 210)
    assert [c[0] for c in passages.cover([gap, one(6, 100, 120)])] == [5, 6]


def test_verbatim_repeats_whose_parts_occur_elsewhere(spark, workspace):
    """Every word of a verbatim repeat is in a passage, whichever documents held its parts first."""
    draw = np.random.default_rng(21)
    rows = []
    for n in range(12):
        text = [f"t{n}_{x}" for x in draw.integers(0, 10**6, 65)]
        rows += [(n, 1, text[:45]), (n, 2, text[20:]), (n, 5, text), (n, 9, text)]
    own = lambda: [f"o{x}" for x in draw.integers(0, 10**9, 30)]
    docs = {n + 100 * k: own() + w + own() for n, k, w in rows}
    parts = [[f"p{m}_{x}" for x in draw.integers(0, 10**6, 25)] for m in range(8)]
    docs |= {2000 + n: sum((parts[m] for m in draw.integers(0, 8, 5)), own()) for n in range(60)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    covered = {(r["doc_id"], p) for r in passages.find_passages(df, workspace).collect() for p in range(r["start_word"], r["end_word"])}
    first, repeated = {}, set()
    for i in sorted(docs):
        for p in range(len(docs[i]) - 49):
            if first.setdefault(tuple(docs[i][p : p + 50]), i) != i:
                repeated |= {(i, p + k) for k in range(50)}
    assert len(repeated) > 1_000 and not repeated - covered


def test_fuzzy_repeats_whose_seeds_stand_first_elsewhere(spark, workspace):
    """Each seed of a changed copy stands in some document before the one that it copies."""
    draw = np.random.default_rng(17)
    own = lambda: [f"o{x}" for x in draw.integers(0, 10**9, 70)]
    docs, whole = {}, []
    for k in range(6):
        text = [f"t{k}_{n}" for n in range(120)]
        copy = [f"x{k}_{n}" if n % 15 == 14 else w for n, w in enumerate(text)]
        docs |= {100 * k + n: own() + text[15 * n : 15 * n + 14] + own() for n in range(8)}
        docs[100 * k + 50], docs[100 * k + 60] = own() + text + own(), own() + copy + own()
        whole.append(100 * k + 60)
    # A line in many documents, with nothing in common around it.
    line = [f"line{n}" for n in range(12)]
    docs |= {1000 + n: own() + line + own() for n in range(300)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    found = [tuple(r) for r in passages.find_passages(df, workspace).collect()]
    assert {(r[0], r[3]) for r in found} == {(i, i - 10) for i in whole}
    covered = Counter(i for i, p in {(r[0], p) for r in found for p in range(r[1], r[2])})
    assert all(70 <= r[1] and r[2] <= 190 for r in found) and min(covered.values()) >= 104


def test_pairs_of_a_seed_in_parts(spark, workspace, monkeypatch):
    """The same pairs, in however many units the places of a seed are compared."""
    draw = np.random.default_rng(4)
    words = [[f"w{x}" for x in draw.integers(0, 12, 200)] for _ in range(6)]
    rows = []
    for n in range(60):
        text = list(words[n % 6])
        for place in draw.integers(0, 200, 40):
            text[place] = f"v{n}_{place}"
        rows.append((n, " ".join(text[:96] + ["s"] * 8 + text[104:])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hits = spark.createDataFrame([(n, 96, 0, 96, 7) for n in range(60)], passages.HITS)
    nothing = spark.createDataFrame([], passages.PASSAGES)
    around = [Counter(t.split()[4:196]) for _, t in rows]
    expected = {(n, m) for n in range(60) for m in range(n) if (around[n] & around[m]).total() >= 40}
    for part in (128, 7):
        monkeypatch.setattr(passages, "PART", part)
        pairs = passages._open_pairs(df, hits, nothing, workspace).collect()
        assert sorted((r["doc_id"], r["source"]) for r in pairs) == sorted(expected)


def covered_words(found):
    return {(r["doc_id"], p) for r in found.collect() for p in range(r["start_word"], r["end_word"])}


def test_only_pairs_that_may_make_a_passage(spark, workspace):
    """Common words around a common line are not enough, and no word of a passage is lost."""
    draw = np.random.default_rng(6)
    base = [[f"w{x}" for x in draw.integers(0, 12, 200)] for _ in range(6)]
    rows = []
    for n in range(60):
        text = list(base[n % 6])
        for place in draw.integers(0, 200, 20):
            text[place] = f"v{n}_{place}"
        rows.append((n, " ".join(text[:96] + [f"s{k}" for k in range(8)] + text[104:])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hits = spark.createDataFrame([(n, 96, 0, 96, 7) for n in range(60)], passages.HITS)
    nothing = spark.createDataFrame([], passages.PASSAGES)
    every, some = (workspace.keep(passages._open_pairs(df, hits, nothing, workspace, every=e), "pairs") for e in (True, False))
    assert every.count() == 60 * 59 // 2
    pairs = {(r["doc_id"], r["source"]) for r in some.collect()}
    assert 0 < len(pairs) <= 6 * 10 * 9 // 2 and all((a - b) % 6 == 0 for a, b in pairs)
    found = [covered_words(passages._chained(df, passages._chain_rows(p, every=True), workspace)) for p in (every, some)]
    assert found[0] == found[1] and len({d for d, _ in found[0]}) > 20


@pytest.mark.parametrize("part", [4096, 9])
def test_passages_of_all_pairs_of_runs(spark, workspace, monkeypatch, part):
    """Of changed copies no word is lost that all pairs find. Texts of runs of one word have many
    chains of equal score, whose choice depends on the pairs there are: a few words differ."""
    draw = np.random.default_rng(12)
    docs = {}
    for n in range(90):
        text = []
        for _ in range(6):
            text += [f"r{draw.integers(0, 9)}"] * int(draw.integers(25, 60))
            text += [f"o{x}" for x in draw.integers(0, 10**9, draw.integers(0, 4))]
        docs[n] = text
    line = [f"c{k}" for k in range(12)]
    for n in range(90, 130):
        text = [f"t{n % 4}_{k}" if draw.random() > 0.07 else f"x{n}_{k}" for k in range(90)]
        docs[n] = text[:30] + line + text[30 : 30 + int(draw.integers(20, 60))] + [f"y{n}_{k}" for k in range(30)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    monkeypatch.setattr(passages, "PART", part)
    found = covered_words(passages.find_passages(df, workspace))
    all_pairs = passages._open_pairs
    monkeypatch.setattr(passages, "_open_pairs", lambda *args, every: all_pairs(*args, every=True))
    expected = covered_words(passages.find_passages(df, workspace))
    lost = expected - found
    assert len(lost) < 0.005 * len(expected) and not [d for d, _ in lost if d >= 90]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.lists(st.sampled_from(list(b" \t\n\r\v\f\x1c\x85\x00AZbz\xc3\xa9")), max_size=14).map(bytes), max_size=6))
def test_word_hashes(texts):
    found, lengths = word_hashes(texts)
    split = [(t or b"").lower().split() for t in texts]
    assert found.tolist() == [xxhash.xxh3_64_intdigest(w) for s in split for w in s] and lengths.tolist() == list(map(len, split))


def test_cut():
    assert passages.cut(b" a  b c\nd e ", [(1, 3)]) == b" a  d e "
    assert passages.cut(b"a b c", [(0, 2), (1, 3)]) == b""
    assert passages.cut(b"a b c", [(2, 3)]) == b"a b"


def test_chains_are_best():
    """The Fenwick tree finds the chain that trying all predecessors finds."""
    draw = np.random.default_rng(3)
    for _ in range(30):
        x = np.sort(draw.choice(200, 12, replace=False))
        y = draw.integers(0, 200, 12)
        best = []
        for n in range(12):
            before = [best[m] - passages.GAP * (x[n] - x[m] + y[n] - y[m]) for m in range(n) if y[m] < y[n]]
            best.append(passages.MATCH + max([0, *before]))
        chain = max(passages.chains(x, y), key=len)
        strict = [c for c in passages.chains(x, y) if len(c) > 1 and (np.diff(y[c]) > 0).all()]
        scores = [len(c) * passages.MATCH - passages.GAP * (x[c[-1]] - x[c[0]] + y[c[-1]] - y[c[0]]) for c in strict]
        assert not strict or math.isclose(max(scores), max(best)) or max(best) == passages.MATCH
        assert chain


def test_base_scores_and_model(spark, workspace):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = lm.score_texts(documents, ~held_out("doc_id", 7, 2), workspace).collect()
    texts = {r["doc_id"]: [*words(r["text"]), None] for r in documents.collect()}
    counts = Counter()
    for i, w in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(w)
    total, distinct = sum(counts.values()), len(counts)
    for r in found:
        w = texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(counts[x] > 0 for x in w), total)
        assert math.isclose(r["base_score"], sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w), rel_tol=1e-9)
    assert len(found) == len(texts)
    assert all(0 < r["bits_per_byte"] < 8 for r in found if r["n_tokens"] > 30)


def test_scores_are_probabilities():
    """Spelled over all short words of a few letters, the mass stays below one."""
    odds = np.random.default_rng(1).normal(size=(len(lm.ORDERS), 1 << lm.TABLE_BITS)).astype(np.float32)
    weights = lm.mix(odds, [b"ab", b"ba", b"a"])
    every = [bytes([a]) for a in range(256) if a not in b" \t\n\r\v\f"] + [lm.END]
    every += [bytes([a, b]) for a in range(97, 123) for b in range(97, 123)]
    assert 0 < np.exp(lm.spelling(every, odds, weights)).sum() <= 1


def test_decisions_are_mixed_a_few_bytes_at_a_time():
    """By the definition, and without tables of eight numbers for every byte of the words beside what
    is returned."""
    spelled = [b"w%d" % (n * n) for n in range(3_000)] + [lm.END]
    tracemalloc.start()
    slots, bits, gates, starts = lm.decisions(spelled)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.6 * sum(found.nbytes for found in (slots, bits, gates, starts))
    for n in (0, 17, 2_999, 3_000):
        word = spelled[n] if spelled[n] == lm.END else spelled[n] + lm.CLOSE
        for place, byte in enumerate(word):
            for depth in range(8):
                at = starts[n] + 8 * place + depth
                assert (bits[at], gates[at]) == (byte >> 7 - depth & 1, 8 * min(place, 3) + depth)
                for k, order in enumerate(lm.ORDERS):
                    code = np.full(1, order + 1, np.uint64)
                    for back in range(1, order + 1):
                        code = lm._mixed(code + np.uint64(word[place - back] + 1 if back <= place else 0))
                    node = np.uint64((256 | byte) >> 8 - depth)
                    code = lm._mixed(code + node * np.full(1, 0x9E3779B97F4A7C15, np.uint64))
                    assert slots[k, at] == code[0] >> np.uint64(64 - lm.TABLE_BITS)


def test_counts_of_decisions():
    spelled = [b"w%d" % n for n in range(lm.SPELL_WORDS + 10)]
    table = np.zeros((len(lm.ORDERS), 2, 1 << lm.TABLE_BITS), np.uint32)
    lm.add_counts(table, spelled)
    slots, bits, _, _ = lm.decisions(spelled)
    for k in range(len(lm.ORDERS)):
        for bit in (0, 1):
            assert np.array_equal(table[k, bit], np.bincount(slots[k, bits == bit], minlength=table.shape[2]))


def test_tables_hold_every_word_as_often_as_it_stands_there(spark):
    buckets = [{b"red": 1, b"read": 7}, {}, {b"reed": 1 << 33}]
    rows = [(b" ".join(b), np.array([*b.values()], np.int64).tobytes()) for b in buckets]
    odds = lm._tables(spark.createDataFrame(rows, "words binary, counts binary").repartition(2))
    counts = np.zeros((len(lm.ORDERS), 2, 1 << lm.TABLE_BITS))
    for word, times in (pair for b in buckets for pair in b.items()):
        slots, bits, _, _ = lm.decisions([word])
        for k in range(len(lm.ORDERS)):
            np.add.at(counts[k], (bits, slots[k]), times)
    assert np.allclose(odds, np.log((counts[:, 1] + lm.PRIOR) / (counts[:, 0] + lm.PRIOR)), rtol=1e-5)


@pytest.mark.parametrize("buckets", [1, 7])
def test_pairs_are_counted_over_all_training_texts(spark, workspace, monkeypatch, buckets):
    monkeypatch.setattr(lm, "SLICE", 60)
    rows = [(n, " ".join("abcde"[(n * k) % 5] * (1 + k % 2) for k in range(n))) for n in range(30)] + [(30, None), (31, "")]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    slices = lm._slices(documents, F.col("doc_id") % 3 != 0, workspace)
    found = lm._pair_counts(slices, buckets, workspace).collect()
    want, texts = Counter(), {i: [None, *words(t), lm.END] for i, t in rows}
    for i, text in texts.items():
        want.update(zip(text, text[1:]) if i % 3 else ())
    assert len(slices.collect()) > 3
    for row in slices.collect():
        pairs = {p for i in row["doc_id"] for p in zip(texts[i], texts[i][1:])}
        tokens = sorted({w for p in pairs for w in p if w})
        at = {w: n for n, w in enumerate([*tokens, None])}
        hashes = lm.token_hashes(tokens)
        codes = {int(lm.pair_codes(hashes, np.array([at[w]]), np.array([at[b]]))[0]): want[b, w] for b, w in pairs}
        parts = sorted((r["bucket"], r["counts"]) for r in found if r["number"] == row["slice"])
        assert [b for b, _ in parts] == sorted({code * buckets >> 64 for code in codes})
        assert lm.from_planes([c for _, c in parts], np.int64).tolist() == [codes[c] for c in sorted(codes)]


def test_word_order_counts_across_texts(spark, workspace):
    """Words that followed each other in other texts are likelier than the same words in another order."""
    told = [f"w{n} v{n} u{n}" for n in range(40)]
    rows = [(n, text, True) for n, text in enumerate(told * 3)] + [(200, " ".join(told), False), (201, " ".join(" ".join(told).split()[::-1]), False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    score = {r["doc_id"]: r["score"] for r in lm.score_texts(df, F.col("learn"), workspace).collect()}
    assert score[200] > score[201] + 20


def test_weights_come_from_every_word(spark):
    """Also from those beyond any number of words of a bucket."""
    odds = np.random.default_rng(2).normal(size=(len(lm.ORDERS), 1 << lm.TABLE_BITS)).astype(np.float32)
    buckets = [[b"w%d" % n for n in range(low, high)] for low, high in ((0, 1_500), (1_500, 1_600), (1_600, 1_601))]
    vocabulary = spark.createDataFrame([(b" ".join(b), len(b)) for b in buckets] + [(b"", 0)], "words binary, distinct long")
    ordered = [sorted(b, key=lambda w: (zlib.crc32(w[::-1]), w)) for b in buckets]
    want = np.average([lm.mix(odds, b) for b in ordered], axis=0, weights=[len(b) for b in buckets])
    assert np.allclose(lm._weights(vocabulary, odds), want)
    assert not np.allclose(lm.mix(odds, ordered[0]), lm.mix(odds, ordered[0][:512]))


def test_scores_of_odd_rows(spark, workspace):
    df = spark.createDataFrame([(1, None, 1), (1, "", 2), (None, "A b a", 3), (2, "new " * 9000, 4)], "doc_id long, text string, score int")
    found = lm.score_texts(df, F.col("doc_id") == 2, workspace).collect()
    assert sorted(r["n_tokens"] for r in found) == [1, 1, 4, 9001]
    assert {r["train_tokens"] for r in found} == {9001} and all(r["score"] < 0 for r in found)
    none = lm.score_texts(df, F.lit(False), workspace).collect()
    assert {r["n_known"] for r in none} == {0}
    assert lm.score_texts(df.limit(0), F.lit(True), workspace).count() == 0


def test_pipeline(spark):
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.columns == ["doc_id", "n_tokens", "ids"] and 0 < result.count()


def test_stages_keep_columns_and_take_effect(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("score", F.lit(1.5)).withColumn("spans", F.lit("x"))
    extra = spark.createDataFrame([(10**6, "12 34 !", "en", "s", 7, 1.5, "x")], documents.schema)
    docs = documents.unionByName(extra)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF_DIR)
        assert found.columns == docs.columns, name
        assert found.filter(f"doc_id = {10**6}").count() == (0 if name == "language_id" else 1), name
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    kept = corpus_pipeline.ngram_jaccard_join(spark, documents, SF_DIR)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c, _ in brute_components(rows)})
    left = corpus_pipeline.benchmark_decontamination(spark, documents, SF_DIR)
    assert decontamination.find_matches(left, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).filter("size(matches) > 0").count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    frame = queries.QUERIES[name](spark, SF_DIR)
    names = sorted(frame.columns)
    relation = database(SF_DIR).sql(queries.ORACLES[name])
    expected = Counter(relation.project(", ".join(names)).fetchall())
    assert expected and Counter(tuple(r) for r in frame.select(*names).collect()) == expected
