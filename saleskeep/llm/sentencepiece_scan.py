"""Encoding into pieces, and back, with a max-plus parallel scan for giant documents.

Ordinary texts are encoded where they lie, pre-token by pre-token. A giant text is split into
chunks that different tasks take. The state at a chunk's boundary is how many characters the
piece across it reaches into the next chunk, so a chunk is a matrix over (state before, state
after) that holds the best score of the characters between. Matrices combine by the max-plus
product, which is associative: products from the right give the best score of the rest of the
text from each boundary state, and so the state the best path has at each boundary. Every chunk
is then backtraced on its own between its two states. Scores are whole numbers, so the result
scores exactly what one pass over the whole text would. Where equally good paths differ at a
boundary, the smaller overhang is taken; a boundary beside a pre-token's start has no choice.
"""

from __future__ import annotations

from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleskeep.llm import vocabulary as voc
from saleskeep.llm.common import SLICE_BYTES, lists, map_texts, record_batch
from saleskeep.workspace import Workspace

#: Characters above which a text is split, and of a chunk.
CHUNK = 32_768
#: Pre-tokens a task remembers.
MEMO_WORDS = 200_000
#: A score no path reaches.
NEVER = -(1 << 62)


class Encoder(dict):
    """Pre-token to the little-endian ids of its best segmentation, filled as words come."""

    def __init__(self, vocabulary: voc.Vocabulary) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> bytes:
        """A word alone, kept by nobody: `learn` keeps those of a whole slice."""
        return next(voc.segment([word], self.vocabulary))[1]

    def learn(self, texts: list[list[str]]) -> None:
        if len(self) > MEMO_WORDS:
            self.clear()
        new = sorted(set().union(*texts).difference(self))
        for word, (_, ids) in zip(new, voc.segment(new, self.vocabulary)):
            self[word] = ids

    def ids(self, words: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, words))


def path_scores(text: str, states: int, vocabulary: voc.Vocabulary) -> np.ndarray:
    """Best score from each of the first `states` positions to each position."""
    weights, reach, size = vocabulary.weights, vocabulary.reach, len(text)
    best = np.full((size + 1, states), NEVER, np.int64)
    for start in range(size):
        if start < states:
            best[start, start] = max(best[start, start], 0)
        row, first = best[start], text[start]
        reached = row > NEVER
        for end in range(start + 1, min(size, start + reach.get(first, 1)) + 1):
            weight = weights.get(text[start:end])
            if weight is None:
                if end > start + 1:
                    continue
                weight = vocabulary.of_character(first)
            np.maximum(best[end], np.where(reached, row + weight, NEVER), out=best[end])
    if size < states:
        best[size, size] = max(best[size, size], 0)
    return best


def transfer(chunk: str, ahead: str, vocabulary: voc.Vocabulary) -> np.ndarray:
    """Best score from state i (the chunk starts at its character i) to state j (the last piece
    reaches j characters into `ahead`). Between the first and last pre-token that start in the
    chunk every path has the same boundaries, so that part is scored once for all states."""
    states, size = vocabulary.longest, len(chunk)
    text = chunk + ahead
    cuts = [m.start() for m in voc.PRE_TOKEN.finditer(text) if states <= m.start() <= size]
    first, last = (cuts[0], cuts[-1]) if cuts else (0, 0)
    if cuts:
        head = path_scores(text[:first], states, vocabulary)[first]
        words = Counter(voc.PRE_TOKEN.findall(text[first:last]))
        order = sorted(words)
        between = sum(words[w] * score for w, (score, _) in zip(order, voc.segment(order, vocabulary)))
        tail = path_scores(text[last:], 1, vocabulary)[:, 0]
        ends = tail[size - last : size - last + states]
        result = np.where(head[:, None] > NEVER, head[:, None], NEVER // 4) + between + np.where(ends > NEVER, ends, NEVER // 4)
    else:
        result = path_scores(text, states, vocabulary)[size : size + states].T
        ends = result[0]
    matrix = np.full((states, states), NEVER, np.int64)
    matrix[:, : len(ends)] = np.where(result > NEVER // 8, result, NEVER)
    return matrix


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The max-plus product, associative."""
    a, b = left[:, :, None], right[None, :, :]
    possible = (a > NEVER) & (b > NEVER)
    return np.where(possible, np.where(possible, a, 0) + np.where(possible, b, 0), NEVER).max(axis=1)


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """The state before each chunk and after the last, which ends the text in state 0."""
    rest = list(accumulate(reversed(matrices), lambda right, left: combine(left, right)))[::-1]
    rest = [m[:, 0] for m in rest] + [np.where(np.arange(len(matrices[0])) == 0, 0, NEVER)]
    states = [0]
    for matrix, after in zip(matrices, rest[1:]):
        row = matrix[states[-1]]
        possible = (row > NEVER) & (after > NEVER)
        states.append(int(np.argmax(np.where(possible, row + np.where(possible, after, 0), NEVER))))
    return states


def backtrace(chunk: str, ahead: str, start: int, end: int, encoder: Encoder) -> bytes:
    """The ids of a chunk's best path between two boundary states."""
    words = voc.PRE_TOKEN.findall((chunk + ahead)[start : len(chunk) + end])
    encoder.learn([words])
    return encoder.ids(words)


def split(text: str, size: int, ahead: int) -> list[tuple[str, str]]:
    """Chunks of `size` characters at least, with the characters that follow each."""
    count = max(1, len(text) // max(size, ahead))
    cuts = [len(text) * n // count for n in range(count + 1)]
    return [(text[a:b], text[b : b + ahead]) for a, b in zip(cuts, cuts[1:])]


def _encode_whole(rows: DataFrame, shared, schema: StructType) -> DataFrame:
    """The columns of `rows` that `schema` names, and ids."""

    def make():
        encoder = Encoder(shared.value)

        def encode(batch: pa.RecordBatch) -> list:
            words = [voc.pre_tokens(text) for text in batch.column("text").to_pylist()]
            encoder.learn(words)
            found = list(map(encoder.ids, words))
            ids = np.frombuffer(b"".join(found), "<i4")
            return [*(batch.column(c) for c in schema.names[:-1]), lists(ids, np.array([len(x) // 4 for x in found]))]

        return encode

    return map_texts(rows, make, schema, limit=SLICE_BYTES // 2)


def _encode_giant(rows: DataFrame, shared, chunk: int, workspace: Workspace, columns: list[str]) -> DataFrame:
    """`columns` of `rows` with their ids, by the scan over chunks."""
    numbered = workspace.keep(rows.withColumn("key", F.monotonically_increasing_id()), "giant")
    kept = numbered.select("key", *columns)
    chunk_schema = StructType.fromDDL("key long, chunk int, text string, ahead string")
    matrix_schema = StructType.fromDDL("key long, chunk int, matrix binary")
    state_schema = StructType.fromDDL("key long, chunk int, before int, after int")
    ids_schema = StructType.fromDDL("key long, chunk int, ids array<int>")

    def cut(batches):
        longest = shared.value.longest
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                parts = split(voc.PREFIX + text, chunk, longest - 1)
                yield record_batch(chunk_schema, [[key] * len(parts), list(range(len(parts))), *map(list, zip(*parts))])

    def matrices(batches):
        for batch in batches:
            found = [transfer(c, a, shared.value) for c, a in zip(batch.column("text").to_pylist(), batch.column("ahead").to_pylist())]
            yield record_batch(matrix_schema, [batch.column("key"), batch.column("chunk"), [m.tobytes() for m in found]])

    def states(batches):
        for batch in batches:
            for key, group in zip(batch.column("key").to_pylist(), batch.column("found").to_pylist()):
                side = shared.value.longest
                path = boundary_states([np.frombuffer(x["matrix"], np.int64).reshape(side, side) for x in group])
                yield record_batch(state_schema, [[key] * len(group), [x["chunk"] for x in group], path[:-1], path[1:]])

    def trace(batches):
        encoder = Encoder(shared.value)
        for batch in batches:
            names = ("text", "ahead", "before", "after")
            found = [backtrace(*row, encoder) for row in zip(*(batch.column(n).to_pylist() for n in names))]
            ids = lists(np.frombuffer(b"".join(found), "<i4"), np.array([len(x) // 4 for x in found]))
            yield record_batch(ids_schema, [batch.column("key"), batch.column("chunk"), ids])

    chunks = workspace.keep(
        numbered.select("key", "text").mapInArrow(cut, chunk_schema).repartition("key", "chunk"), "chunks"
    )
    found = chunks.mapInArrow(matrices, matrix_schema).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "matrix"))).alias("found")
    )
    path = found.mapInArrow(states, state_schema)
    traced = chunks.join(path, ["key", "chunk"]).mapInArrow(trace, ids_schema)
    whole = traced.groupBy("key").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids")
    )
    return kept.join(whole, "key").select(*columns, "ids")


def encode(
    documents: DataFrame,
    workspace: Workspace,
    path: str = voc.PIECES,
    chunk: int = CHUNK,
    keep: tuple[str, ...] = ("doc_id", "text"),
) -> DataFrame:
    """`keep` and `ids`, one row per row of `documents`, repeated rows included. Texts that are
    NULL or empty have an empty list."""
    shared = documents.sparkSession.sparkContext.broadcast(voc.load(path))
    columns = documents.select(*keep).columns
    rows = documents.select(*columns, *([] if "text" in columns else ["text"]))
    schema = rows.select(*columns, F.expr("array(0)").alias("ids")).schema
    giant = F.coalesce(F.length("text") > chunk, F.lit(False))
    ordinary = _encode_whole(rows.filter(~giant), shared, schema)
    scanned = _encode_giant(rows.filter(giant), shared, chunk, workspace, columns)
    return ordinary.unionByName(scanned)


def decode(encoded: DataFrame, path: str = voc.PIECES, name: str = "decoded") -> DataFrame:
    """`encoded` without `ids`, with the text its ids stand for; no ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(voc.load(path))
    kept = [c for c in encoded.columns if c not in ("ids", name)]
    schema = encoded.select(*kept, F.lit("").alias(name)).schema

    def run(batches):
        piece = shared.value.texts.__getitem__
        for batch in batches:
            made = []
            for row in batch.column("ids"):
                ids = row.values.to_numpy().tolist() if row.is_valid else []
                made.append(b"".join(map(piece, ids))[1:].decode())
            yield record_batch(schema, [*(batch.column(c) for c in kept), made])

    return encoded.select(*kept, "ids").mapInArrow(run, schema)
