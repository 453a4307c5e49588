"""Packing: ids as the tokenizer's, whole pieces, gapless sequences, exchanges that empty bins."""

import zlib
from collections import defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from saleskeep.llm import packing
from saleskeep.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE, OWN = Tokenizer.from_file(PATH), packing.Tokenizer(PATH)
MIXED = st.text(st.one_of(
    st.sampled_from(list("aAbBzZ'stlvd0189 \n\t.,!?_-<|>éÉñÑßÿÞ×÷ªº²Σσς\x1c\x85\xa0́ İKﬁ中")), st.characters(exclude_categories=["Cs"])
), max_size=40)


def ids_of(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(MIXED)
def test_ids_are_the_tokenizers(text):
    assert np.frombuffer(OWN.ids(text.encode()), "<u4").tolist() == ids_of(text)


@pytest.mark.parametrize("text", [
    None, "", " ", "It's we'll I'D 'tis !'s", "a<|endoftext|>b", "<|ENDOFTEXT|> x", "x <|startoftext|>", "ΑΣ Σ", "Ét́", "a" * 500, "\x1c\x1d a",
])
def test_ids_of_odd_texts(text):
    assert np.frombuffer(OWN.ids(text and text.encode()), "<u4").tolist() == ids_of(text or "")


def test_the_memo_starts_anew(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 3)
    own = packing.Tokenizer(PATH)
    texts = ["one two, three!", "four five six", "one " + "x" * 70]
    assert [np.frombuffer(own.ids(t.encode()), "<u4").tolist() for t in texts * 2] == [ids_of(t) for t in texts * 2]


def check_bins(lengths, bins, capacity):
    assert sorted(p for b in bins for p in b) == list(range(len(lengths)))
    assert all(lengths[b].sum() <= capacity for b in bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=40))
def test_groups_are_packed_whole(lengths):
    lengths = np.array(lengths)
    bins, first = packing.pack_group(lengths, 30), packing.best_fit(lengths, 30)
    check_bins(lengths, bins, 30)
    check_bins(lengths, first, 30)
    assert packing.fewest(lengths, 30) <= len(bins) <= len(first)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=7))
def test_the_lower_bound_holds(lengths):
    def used(order):
        bins, room = 0, 0
        for n in order:
            if n > room:
                bins, room = bins + 1, 12
            room -= n
        return bins

    assert packing.fewest(np.array(lengths), 12) <= min(map(used, permutations(lengths)))


@pytest.mark.parametrize("bins,lengths,expected", [
    ([[0], [1]], [3, 6], 1),                              # a move
    ([[0, 1], [2, 3], [4, 5]], [4, 4, 3, 5, 2, 2], 2),    # 4 for 3, then 2 and 2
    ([[0, 1], [2, 3], [4]], [5, 4, 6, 3, 2], 2),          # fits as a move and an exchange
    ([[0, 1, 2], [3, 4], [5]], [2, 3, 3, 4, 5, 3], 2),    # two for one
])
def test_exchanges_empty_bins(bins, lengths, expected):
    search = packing.Search(np.array(lengths), bins, 10)
    found = search.run(packing.fewest(np.array(lengths), 10))
    check_bins(np.array(lengths), found, 10)
    assert len(found) == expected


def test_every_step_raises_the_squares():
    lengths = np.random.default_rng(3).integers(30, 90, 120)
    search = packing.Search(lengths, packing.best_fit(lengths, 200), 200)
    squares = lambda: sum(int(lengths[b].sum()) ** 2 for b in [*search.bins.values(), *search.full])
    before, steps = squares(), 0
    for source in sorted(search.bins, key=lambda n: search.fills[n]):
        while source in search.bins and search.step(source):
            assert squares() > before
            before, steps = squares(), steps + 1
    assert steps


def test_search_saves_bins():
    lengths = np.random.default_rng(0).integers(300, 900, 600)
    assert len(packing.pack_group(lengths)) < len(packing.best_fit(lengths))


def check_sequences(rows, capacity):
    by = defaultdict(list)
    for row in rows:
        by[row["sequence_id"]].append((row["offset"], row["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("group", [8, 4096])
def test_pack(spark, workspace, group):
    sizes = [int(n) for n in np.random.default_rng(1).integers(1, 101, 300)] + [100] * 5
    rows = spark.createDataFrame([(n, s, f"k{n}") for n, s in enumerate(sizes)], "`key` int, length long, `a.b` string")
    placed = packing.pack(rows, workspace, 100, group)
    assert placed.columns == ["key", "length", "a.b", "sequence_id", "offset"]
    found = placed.collect()
    assert sorted((r["key"], r["length"], r["a.b"]) for r in found) == sorted(tuple(r) for r in rows.collect())
    used = check_sequences(found, 100)
    least = packing.fewest(np.array(sizes), 100)
    assert used <= least + (2 if group == 4096 else 6)
    assert packing.pack(rows.limit(0), workspace, 100).count() == 0
    with pytest.raises(Exception, match="length has to be"):
        packing.pack(spark.createDataFrame([(101,)], "length int"), workspace, 100).collect()


def test_documents_to_sequences(spark, workspace):
    long = " ".join(f"word{n}" for n in range(1500))
    rows = [(1, "One two three.", 5), (2, None, 5), (3, "", 5), (4, long, 5), (4, long, 5), (None, "x y", 5)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, length int")
    placed = packing.pack(packing.pieces(documents, capacity=256), workspace, 256)
    found = placed.collect()
    check_sequences(found, 256)
    texts = {1: "One two three.", 2: "", 3: "", 4: long, None: "x y"}
    for doc, copies in ((1, 1), (2, 1), (3, 1), (4, 2), (None, 1)):
        expected = [*ids_of(texts[doc]), packing.END]
        parts = sorted((r["piece"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in found if r["doc_id"] == doc)
        cuts = [(n, n * 256, expected[n * 256 : (n + 1) * 256]) for n in range(-(-len(expected) // 256))]
        assert parts == sorted(cuts * copies)
    whole = packing.sequences(placed).collect()
    by = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in whole}
    assert all(by[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == np.frombuffer(r["ids"], "<u4").tolist() for r in found)
    assert sum(map(len, by.values())) == sum(r["length"] for r in found)
    assert sum(len(r["spans"]) for r in whole) == len(found)


def test_query(spark):
    found = QUERIES["op11_bestfit_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    used = check_sequences(found, 2048)
    by = defaultdict(list)
    for r in found:
        by[r["doc_id"]].append(r)
    assert by.keys() == texts.keys()
    for doc, parts in by.items():
        ids = [*ids_of(texts[doc] or ""), 0]
        for n, r in enumerate(sorted(parts, key=lambda r: r["piece"])):
            cut = np.array(ids[n * 2048 : (n + 1) * 2048], "<u4")
            assert (r["piece"], r["start"], r["length"], r["ids_crc32"]) == (n, n * 2048, len(cut), zlib.crc32(cut.tobytes()))
        assert sum(r["length"] for r in parts) == len(ids)
    assert used <= packing.fewest(np.array([r["length"] for r in found])) + 1
