"""Benchmark decontamination with suffix arrays over shards of the training texts.

The words of the benchmark get numbers; any other word of a document, and the end of a document,
breaks a text, as no match can run across it. A task takes its documents in shards. The shard's
runs of numbered words, as long as the shortest window or longer, get a suffix array by prefix
doubling, sorted to the depth of a window. Every suffix of every benchmark item is then looked up
by binary search, all of them at a time; the suffixes that begin with the item's window are a
range of the array, and so give every place where the window occurs. Windows that follow each
other in a document and in an item join into the longest verbatim matches.

Nothing is shuffled. The benchmark goes to the tasks in blocks of BLOCK_WORDS words at most (or a
single longer item), one search after the other over the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from saleskeep.llm.common import map_texts, put_back, set_aside

WINDOW = 10
#: Words of benchmark text that are sent to every task at a time.
BLOCK_WORDS = 4_000_000
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: Letters A-Z to lower case, every separator to a space, all else as it is.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b in _SEPARATORS else b for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


@dataclass(frozen=True)
class Windows:
    """A block of the benchmark: each distinct window once, with the places that hold it."""

    vocabulary: dict[bytes, int]
    shortest: int
    by_length: dict[int, tuple[np.ndarray, np.ndarray]]  # length: (windows x words, numbers)
    first_place: np.ndarray  # of each window number, into the next two
    item: np.ndarray  # place to item's index
    position: np.ndarray  # place to position in all items, a gap between items
    starts: np.ndarray  # item's index to its first position
    item_ids: np.ndarray


def windows(items: list[tuple[int, bytes]], length: int) -> Windows:
    vocabulary: dict[bytes, int] = {}
    places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    starts, ids, at = [], [], 0
    for index, (item_id, text) in enumerate(items):
        numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)]
        starts.append(at)
        ids.append(item_id)
        size = min(length, len(numbers))
        for n in range(len(numbers) - size + 1 if size else 0):
            places.setdefault(tuple(numbers[n : n + size]), []).append((index, at + n))
        at += len(numbers) + 1
    every = list(places)
    sizes = np.array([len(w) for w in every], np.int64)
    counts = np.array([len(places[w]) for w in every], np.int64)
    flat = np.array([p for w in every for p in places[w]], np.int64).reshape(-1, 2)
    return Windows(
        vocabulary, int(sizes.min(initial=length)),
        {int(s): (np.array([w for w in every if len(w) == s], np.int32), np.flatnonzero(sizes == s)) for s in np.unique(sizes)},
        np.concatenate([[0], np.cumsum(counts)]), flat[:, 0], flat[:, 1],
        np.array(starts, np.int64), np.array(ids, np.int64),
    )


def suffix_array(numbers: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by their first `depth` numbers at least."""
    rank, step = numbers.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while step < depth:
        following = np.zeros_like(rank)
        following[:-step] = rank[step:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + following
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        fresh = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        rank = np.empty_like(rank)
        rank[order] = fresh
        if fresh[-1] + 1 == len(rank):
            break
        step *= 2
    return order


def search(numbers: np.ndarray, order: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of `wanted` the range of `order` whose suffixes begin with it."""
    size = wanted.shape[1]
    padded = np.concatenate([numbers, np.full(size, -1, numbers.dtype)])
    steps = np.arange(size)

    def bound(after: bool) -> np.ndarray:
        low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(order), np.int64)
        while (going := low < high).any():
            middle = (low + high) >> 1
            found = padded[order[np.minimum(middle, len(order) - 1)][:, None] + steps]
            differs = found != wanted
            at = differs.argmax(axis=1)[:, None]
            less = np.take_along_axis(found, at, 1)[:, 0] < np.take_along_axis(wanted, at, 1)[:, 0]
            below = np.where(differs.any(axis=1), less, after)
            low, high = np.where(going & below, middle + 1, low), np.where(going & ~below, middle, high)
        return low

    return bound(False), bound(True)


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, one range after the other."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def matches(texts: list[list[bytes]], block: Windows) -> list[np.ndarray]:
    """Longest verbatim matches: document's index, first word, words, item's index, item's word."""
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    numbers = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
    found = np.fromiter(
        (n for t in texts for n in map(block.vocabulary.get, t, repeat(0))), np.int32, int((sizes - 1).sum())
    )
    numbers[ranges(ends - sizes, ends - 1)] = found
    inside = np.diff(np.concatenate([[0], (numbers > 0).astype(np.int8), [0]]))
    begins, stops = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
    long = stops - begins >= block.shortest
    begins, stops = begins[long], stops[long]
    none = [np.zeros(0, np.int64)] * 5
    if not len(begins) or not block.by_length:
        return none
    place = ranges(begins, stops + 1)  # each run with the break after it
    runs = numbers[place]
    runs[np.cumsum(stops + 1 - begins) - 1] = 0
    order = suffix_array(runs, max(block.by_length))
    hits = []
    for size, (wanted, which) in block.by_length.items():
        low, high = search(runs, order, wanted)
        at = place[order[ranges(low, high)]]
        number = np.repeat(which, high - low)
        places = block.first_place[number + 1] - block.first_place[number]
        where = ranges(block.first_place[number], block.first_place[number + 1])
        hits.append(np.stack([np.repeat(at, places), block.position[where], np.full(len(where), size), block.item[where]]))
    at, position, size, item = np.concatenate(hits, axis=1)
    by = np.lexsort((at, at - position))
    at, position, size, item = at[by], position[by], size[by], item[by]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (at[1:] - position[1:] != at[:-1] - position[:-1]) | (item[1:] != item[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return none
    last = np.concatenate([first[1:], [len(at)]]) - 1
    document = np.searchsorted(ends, at[first], side="right")
    start = at[first] - (ends - sizes)[document]
    return [document, start, at[last] - at[first] + size[last], item[first], position[first] - block.starts[item[first]]]


MATCHES = "array<struct<start:long,words:long,item_id:long,item_start:long>>"


def find_matches(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    keep: tuple[str, ...] = ("doc_id", "text"),
) -> DataFrame:
    """`keep` (with text) and n_words, matches: one row per row of `documents`.

    A match is a longest run of words that a document and a benchmark item share, of `window`
    words or the whole item. Texts that are NULL or hold no word have no words and match
    nothing. Items without an id or words take no part; repeated items are reported each."""
    rows = documents.select(*keep)
    schema = StructType([
        *rows.schema.fields, StructField("n_words", LongType()),
        *StructType.fromDDL(f"matches {MATCHES}").fields,
    ])
    item_kind = schema["matches"].dataType
    rows = rows.select("*", F.lit(0).cast("long").alias("n_words"), F.array().cast(item_kind).alias("matches"))
    for items in _blocks(benchmark, block_words):
        rows = _search_block(rows, schema, windows(items, window))
    return rows


def hits(found: DataFrame) -> DataFrame:
    """`found` with n_hit (document words inside any match) and item_ids (distinct, sorted as
    text) in place of `text`."""
    end = lambda m: m["start"] + m["words"]
    covered = F.aggregate(
        F.array_sort("matches"),
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total")),
        lambda seen, m: F.struct(
            F.greatest(seen["end"], end(m)).alias("end"),
            (seen["total"] + F.greatest(F.lit(0), end(m) - F.greatest(seen["end"], m["start"]))).alias("total"),
        ),
        lambda seen: seen["total"],
    )
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"].cast("string"))))
    return found.drop("text").withColumn("n_hit", covered).withColumn("item_ids", items)


def remove_affected(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that hold no window of the benchmark."""
    found = find_matches(set_aside(documents), benchmark, window, keep=("doc_id", "text", "rest"))
    return put_back(found.filter(F.size("matches") == 0), documents.columns)


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[int, bytes]]]:
    """Items in blocks of a bounded size, streamed through the driver."""
    chosen = benchmark.select(F.col("item_id").cast("long"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    block, size = [], 0
    for item_id, text in chosen.toLocalIterator():
        raw = text.encode()
        count = len(words(raw))
        if block and size + count > limit:
            yield block
            block, size = [], 0
        block.append((item_id, raw))
        size += count
    yield block


def _search_block(rows: DataFrame, schema: StructType, block: Windows) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def make():
        def run(batch: pa.RecordBatch) -> list:
            texts = [words(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            document, start, size, item, item_start = matches(texts, shared.value)
            by = np.lexsort((item_start, item, start, document))
            new = pa.StructArray.from_arrays(
                [pa.array(x[by]) for x in (start, size, shared.value.item_ids[item], item_start)],
                names=["start", "words", "item_id", "item_start"],
            )
            counts = np.bincount(document, minlength=len(texts))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(offsets), new)
            earlier = batch.column("matches")
            if len(earlier.flatten()):
                found = pa.array([(a or []) + (b or []) for a, b in zip(earlier.to_pylist(), found.to_pylist())], found.type)
            others = [batch.column(i) for i in range(batch.num_columns - 2)]
            return [*others, [len(t) for t in texts], found]

        return run

    return map_texts(rows, make, schema)
