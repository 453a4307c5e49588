"""Token counts, encoding and decoding against plain dynamic programming."""

import random

import numpy as np
import pytest

from saleskeep.llm import sentencepiece_scan as scan
from saleskeep.llm import vocabulary as voc
from saleskeep.llm.token_counts import count_tokens

TEXTS = [
    None, "", " ", "a", "hello world  foo\n\tbar", "literal ▁ mark", "\x00 nul", "日本語 text é", "\n \n", "aaaa" * 30,
    "-" * 90 + "x" * 33 + " " * 40, "日本" * 60 + "a b", "the quick brown fox " * 30,
]


@pytest.fixture(scope="module")
def vocabulary():
    return voc.load()


def plain_best(text, vocabulary):
    """Best score by the textbook recursion over the whole text."""
    best = [0]
    for end in range(1, len(text) + 1):
        options = []
        for start in range(max(0, end - vocabulary.longest), end):
            weight = vocabulary.weights.get(text[start:end])
            if weight is None and end - start == 1:
                weight = vocabulary.of_character(text[start])
            if weight is not None:
                options.append(best[start] + weight)
        best.append(max(options))
    return best[-1]


def score_of(ids, vocabulary):
    of_bytes = set(vocabulary.byte_ids)
    return sum(
        vocabulary.byte_weight if i in of_bytes else vocabulary.weights[vocabulary.texts[i].decode()] for i in ids
    )


def frame(spark, texts):
    rows = [(n, text, n * 2, "x") for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids int, n_tokens string")


def test_shared_prefixes_give_the_scores_of_single_words(vocabulary):
    draw = random.Random(3)
    words = sorted({"".join(draw.choices("abé -t", k=draw.randint(1, 12))).replace(" ", "") or "a" for _ in range(400)})
    for word, (score, ids) in zip(words, voc.segment(words, vocabulary)):
        assert score == plain_best(word, vocabulary)
        assert score == score_of(np.frombuffer(ids, "<i4"), vocabulary)


@pytest.mark.parametrize("size", [16, 23, 64])
def test_chunks_give_the_best_score_of_the_whole(vocabulary, size):
    encoder = scan.Encoder(vocabulary)
    for text in filter(None, TEXTS):
        parts = scan.split(voc.PREFIX + text, size, vocabulary.longest - 1)
        matrices = [scan.transfer(*part, vocabulary) for part in parts]
        states = scan.boundary_states(matrices)
        ids = b"".join(scan.backtrace(*p, i, j, encoder) for p, i, j in zip(parts, states, states[1:]))
        ids = np.frombuffer(ids, "<i4")
        assert score_of(ids, vocabulary) == plain_best(voc.PREFIX + text, vocabulary)
        assert b"".join(vocabulary.texts[i] for i in ids)[1:].decode() == text


def test_products_are_associative(vocabulary):
    parts = scan.split(" ab" * 40 + "日本" * 40, 30, vocabulary.longest - 1)
    a, b, c = [scan.transfer(*part, vocabulary) for part in parts[:3]]
    left, right = scan.combine(scan.combine(a, b), c), scan.combine(a, scan.combine(b, c))
    assert np.array_equal(left, right)


def test_round_trip_of_whole_and_chunked_texts(spark, workspace, vocabulary):
    texts = TEXTS + ["giant words and more " * 200, "x" * 999]
    for chunk in (32_768, 64):
        encoded = scan.encode(frame(spark, texts), workspace, chunk=chunk)
        found = {r["doc_id"]: r for r in scan.decode(encoded).collect()}
        assert [found[n]["decoded"] for n in range(len(texts))] == [t or "" for t in texts]
        for row in encoded.collect():
            want = plain_best(voc.PREFIX + row["text"], vocabulary) if row["text"] else 0
            assert score_of(row["ids"], vocabulary) == want


def test_counts_equal_the_encoding(spark, workspace):
    documents = frame(spark, TEXTS + TEXTS)
    ids = {r["doc_id"]: len(r["ids"]) for r in scan.encode(documents, workspace).collect()}
    counts = count_tokens(documents)
    assert counts.columns == ["doc_id", "n_pretokens", "n_tokens"]
    assert {r["doc_id"]: r["n_tokens"] for r in counts.collect()} == ids


def test_empty_table(spark, workspace):
    empty = frame(spark, [])
    assert count_tokens(empty).count() == 0
    assert scan.decode(scan.encode(empty, workspace)).count() == 0


def test_pieces_across_words_are_refused():
    with pytest.raises(ValueError):
        voc.vocabulary([(0, "a b")], list(range(1, 257)))
