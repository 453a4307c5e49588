"""Exact ranked lexical search with two trees.

Terms are the words of `decontamination.words`. A first pass numbers each document's terms that an
item asks for, counts what the ranking needs (documents with terms, all terms, documents per term)
and writes the numbered documents. The score of a document for an item is then the product of two
vectors that are never negative: the item's weights times repeats, and the document's impacts.

A second pass builds, in every task, trees over its documents, and one over the items. A node holds
the largest value of each coordinate below it, so the product of two nodes' maxima bounds every
score of a document below the one and an item below the other. Pairs of nodes are visited from the
roots, best bounds first; a pair whose bound is under the weakest k-th best score of its items is
dropped with everything below it. Pairs of leaves are scored through whole matrices. Only the k
best of each item leave a task.

Items go to the tasks in blocks with a bounded number of different terms, one search each.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleskeep.llm.common import columns, lists, map_texts, raw_texts, record_batch
from saleskeep.llm.decontamination import words
from saleskeep.workspace import Workspace

K = 10
#: Different terms of a block of items, and (item, term) pairs of it.
BLOCK_TERMS, BLOCK_PAIRS = 32_768, 2_000_000
#: Documents and items of a leaf, children of a node.
LEAF_DOCUMENTS, LEAF_ITEMS, CHILDREN = 32, 8, 4
#: Cells (documents times terms) of a tree over documents.
TREE_CELLS = 4_000_000
#: Whole numbers up to here are exact in double precision.
EXACT = 2**53
NOBODY = np.iinfo(np.int64).max

#: The coordinates above 0 of a vector: rising places and their values.
Sparse = tuple[np.ndarray, np.ndarray]


def weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1)))"""
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * frequencies.astype(np.float64) + 1))).astype(np.int64)


def impacts(times: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Of a term's occurrences in a document with the norm m."""
    return 1_000_000_000 * times // (1000 * times + 8 * norm)


def norms(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of documents by their number of terms; whole numbers of any size in between."""
    return np.array([100 - 75 + 75 * n * documents // total for n in lengths.tolist()], np.int64)


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T in whole numbers, through doubles where that is exact."""
    most = float(left.max(initial=0)) * float(right.max(initial=0)) * max(1, left.shape[-1])
    if most < EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def _levels(leaves: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """From the root down: the children of each node, as numbers within the next level."""
    levels, size = [], leaves
    while size > 1:
        first = np.arange(0, size, CHILDREN)
        levels.append((first, np.minimum(first + CHILDREN, size)))
        size = len(first)
    return levels[::-1]


def _numbered_levels(levels: list[tuple[np.ndarray, np.ndarray]], rows: int, leaf: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The children (of leaves: rows) of all nodes, the root first, and the first leaf."""
    cuts = np.arange(0, rows, leaf)
    starts = np.cumsum([0, *(len(f) for f, _ in levels)])
    first = [f + s for (f, _), s in zip(levels, starts[1:])] + [cuts]
    last = [e + s for (_, e), s in zip(levels, starts[1:])] + [np.append(cuts[1:], rows)]
    return np.concatenate(first), np.concatenate(last), int(starts[-1])


class DocumentTree:
    """Documents (impacts, documents x terms) with the like ones together. `maxima[n]` is the
    largest of each coordinate below node n; `first[n]` to `last[n]` are its children or, of the
    nodes from `leaves` on, its rows. Node 0 is the root."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, weighed: np.ndarray) -> None:
        order = np.lexsort(_heaviest(rows * weighed).T[::-1])
        self.rows, self.ids = rows[order], ids[order]
        levels = _levels(-(-len(rows) // LEAF_DOCUMENTS))
        self.first, self.last, self.leaves = _numbered_levels(levels, len(rows), LEAF_DOCUMENTS)
        maxima = [np.maximum.reduceat(self.rows, self.first[self.leaves :], axis=0)]
        for first, _ in reversed(levels):
            maxima.append(np.maximum.reduceat(maxima[-1], first, axis=0))
        self.maxima = np.concatenate(maxima[::-1])


def _heaviest(rows: np.ndarray, count: int = 3) -> np.ndarray:
    """Places of each row's largest values, falling."""
    if rows.shape[1] <= count:
        return np.argsort(-rows, axis=1, kind="stable")
    some = np.argpartition(-rows, count, axis=1)[:, :count]
    return np.take_along_axis(some, np.lexsort((some, -np.take_along_axis(rows, some, 1)), axis=1), 1)


class ItemTree:
    """Items (weights times repeats) with the like ones together. Nodes hold only coordinates above
    0: `maxima[n]` those of node n, `leaf_rows` the matrix of a leaf's items over these. Their
    numbers are those of `DocumentTree`; `order` leads to the items as they were given."""

    def __init__(self, items: list[Sparse]) -> None:
        heaviest = [tuple(t[np.lexsort((t, -v))[:3]].tolist()) for t, v in items]
        self.order = sorted(range(len(items)), key=heaviest.__getitem__)
        levels = _levels(-(-len(items) // LEAF_ITEMS))
        self.first, self.last, self.leaves = _numbered_levels(levels, len(items), LEAF_ITEMS)
        self.maxima: list[Sparse] = [None] * len(self.first)
        self.leaf_rows: dict[int, np.ndarray] = {}
        self.parent = np.zeros(len(self.first), np.int64)
        for node in range(len(self.first) - 1, -1, -1):
            below = range(int(self.first[node]), int(self.last[node]))
            if node >= self.leaves:
                parts = [items[self.order[n]] for n in below]
                terms, _ = self.maxima[node] = _maxima(parts)
                self.leaf_rows[node] = np.zeros((len(parts), len(terms)), np.int64)
                for row, (t, v) in zip(self.leaf_rows[node], parts):
                    row[np.searchsorted(terms, t)] = v
            else:
                self.parent[self.first[node] : self.last[node]] = node
                self.maxima[node] = _maxima([self.maxima[n] for n in below])


def _maxima(parts: list[Sparse]) -> Sparse:
    terms, values = (np.concatenate(x) for x in zip(*parts))
    by = np.argsort(terms, kind="stable")
    terms, values = terms[by], values[by]
    first = np.flatnonzero(np.append(True, terms[1:] != terms[:-1]))
    return terms[first], np.maximum.reduceat(values, first)


class Search:
    """The k best documents of each item, over as many trees of documents as come."""

    def __init__(self, items: list[Sparse], k: int) -> None:
        self.items, self.k = ItemTree(items), k
        self.scores = np.zeros((len(items), k), np.int64)  # falling; 0 is no document
        self.ids = np.full((len(items), k), NOBODY, np.int64)
        #: Of each node of the items the least of their k-th best scores.
        self.weakest = np.zeros(len(self.items.first), np.int64)
        self.scored = 0

    def _raise(self, node: int) -> None:
        """Let a leaf, and the nodes above it, know of better scores."""
        tree = self.items
        self.weakest[node] = self.scores[tree.first[node] : tree.last[node], -1].min()
        while node:
            node = int(tree.parent[node])
            least = self.weakest[tree.first[node] : tree.last[node]].min()
            if least == self.weakest[node]:
                break
            self.weakest[node] = least

    def _score(self, leaf: int, documents: DocumentTree, node: int) -> None:
        """All documents of a leaf for all items of a leaf."""
        mine = slice(self.items.first[leaf], self.items.last[leaf])
        theirs = slice(documents.first[node], documents.last[node])
        scores = product(self.items.leaf_rows[leaf], documents.rows[theirs][:, self.items.maxima[leaf][0]])
        self.scored += scores.size
        better = (scores > 0) & (scores >= self.scores[mine, -1:])
        if not better.any():
            return
        every = np.concatenate([self.scores[mine], np.where(better, scores, 0)], axis=1)
        names = np.concatenate([self.ids[mine], np.where(better, documents.ids[theirs], NOBODY)], axis=1)
        order = np.lexsort((names, -every), axis=1)[:, : self.k]
        self.scores[mine] = np.take_along_axis(every, order, 1)
        self.ids[mine] = np.take_along_axis(names, order, 1)
        self._raise(leaf)

    def _bounds(self, node: int, documents: DocumentTree, others: np.ndarray) -> list[int]:
        """Of a node of the items with each of some nodes of the documents."""
        terms, values = self.items.maxima[node]
        return product(values[None, :], documents.maxima[others][:, terms])[0].tolist()

    def add(self, rows: np.ndarray, ids: np.ndarray, weighed: np.ndarray) -> None:
        """Search some documents: impacts, documents x terms; `weighed` are the terms' weights."""
        if not len(rows) or not len(self.items.order):
            return
        documents = DocumentTree(rows, ids, weighed)
        waiting = [(-bound, 0, 0) for bound in self._bounds(0, documents, np.zeros(1, np.int64)) if bound > 0]
        while waiting:
            bound, one, other = heapq.heappop(waiting)
            if -bound < self.weakest[one]:
                continue
            leaf, last = one >= self.items.leaves, other >= documents.leaves
            if leaf and last:
                self._score(one, documents, other)
                continue
            ones = [one] if leaf else range(int(self.items.first[one]), int(self.items.last[one]))
            others = np.array([other]) if last else np.arange(documents.first[other], documents.last[other])
            for a in ones:
                for b, bound in zip(others.tolist(), self._bounds(a, documents, others)):
                    if bound > 0 and bound >= self.weakest[a]:
                        heapq.heappush(waiting, (-bound, a, b))

    def result(self, item_ids: np.ndarray) -> list[np.ndarray]:
        found = self.scores > 0
        return [np.repeat(item_ids[self.items.order], found.sum(axis=1)), self.ids[found], self.scores[found]]


@dataclass(frozen=True)
class Items:
    """A block of items: numbers of their terms, and of each item its terms and their repeats."""

    ids: np.ndarray
    terms: dict[bytes, int]
    repeats: list[Sparse]


def _blocks(benchmark: DataFrame, most_terms: int) -> Iterator[Items]:
    """Items with terms, in blocks of a bounded size, streamed through the driver."""
    chosen = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id IS NOT NULL")
    chosen = chosen.groupBy("item_id").agg(F.min("text").alias("text")).filter("text IS NOT NULL")
    ids, numbers, repeats, pairs = [], {}, [], 0
    for item_id, text in chosen.toLocalIterator():
        counts = Counter(words(text.encode()))
        if not counts:
            continue
        if ids and (len(counts.keys() | numbers.keys()) > most_terms or pairs + len(counts) > BLOCK_PAIRS):
            yield Items(np.array(ids, np.int64), numbers, repeats)
            ids, numbers, repeats, pairs = [], {}, [], 0
        found = sorted((numbers.setdefault(word, len(numbers)), times) for word, times in counts.items())
        ids.append(item_id)
        repeats.append(tuple(np.array(found, np.int64).T))
        pairs += len(counts)
    if ids:
        yield Items(np.array(ids, np.int64), numbers, repeats)


def _numbered(documents: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms of the text), terms and times: the numbers of those terms that are in
    `terms`, and how often the text has them."""
    shared = documents.sparkSession.sparkContext.broadcast(terms)
    schema = StructType.fromDDL("doc_id long, n long, terms array<int>, times array<int>")

    def make():
        def run(batch: pa.RecordBatch) -> list:
            known = shared.value
            split = [words(t) for t in raw_texts(batch.column("text"))]
            counted = [np.unique([n for n in map(known.get, t) if n is not None], return_counts=True) for t in split]
            sizes = np.array([len(n) for n, _ in counted], np.int64)
            numbers, times = (lists(np.concatenate(x).astype(np.int32), sizes) for x in zip(*counted))
            return [batch.column("doc_id"), [len(t) for t in split], numbers, times]

        return run

    return map_texts(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, schema)


def _search_block(numbered: DataFrame, items: Items, documents: int, total: int, k: int, cells: int) -> DataFrame:
    """item_id, doc_id, score: the k best documents of each task for each item of a block."""
    seen = numbered.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row per term of the block
    frequencies = np.zeros(len(items.terms), np.int64)
    for term, count in seen:
        frequencies[term] = count
    weighed = weights(frequencies, documents)
    shared = numbered.sparkSession.sparkContext.broadcast((items, weighed))
    schema, size = columns("item_id long, doc_id long, score long"), max(LEAF_DOCUMENTS, cells // len(weighed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weighed = shared.value
        above = [(t, v * weighed[t]) for t, v in items.repeats]
        search = Search([(t[v > 0], v[v > 0]) for t, v in above], k)
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                counts = part.column("terms").value_lengths().to_numpy()
                norm = np.repeat(norms(part.column("n").to_numpy(), documents, total), counts)
                rows = np.zeros((part.num_rows, len(weighed)), np.int32)
                place = np.repeat(np.arange(part.num_rows), counts), part.column("terms").flatten().to_numpy()
                rows[place] = impacts(part.column("times").flatten().to_numpy().astype(np.int64), norm)
                search.add(rows, part.column("doc_id").to_numpy(), weighed)
        yield record_batch(schema, search.result(items.ids))

    return numbered.filter("doc_id IS NOT NULL AND size(terms) > 0").mapInArrow(run, schema)


def rank(
    documents: DataFrame,
    benchmark: DataFrame,
    workspace: Workspace,
    k: int = K,
    block_terms: int = BLOCK_TERMS,
    cells: int = TREE_CELLS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents with the highest scores above 0 for each item,
    fewer if there are fewer, equal scores by rising doc_id.

    NULL and empty texts have no terms: such items get no rows, such documents count nowhere. Rows
    without a doc_id count in the statistics and are never ranked; rows that share one are ranked
    each. Items without an id take no part; an id on several rows is answered once, for its
    smallest text. Empty tables give an empty result."""
    spark = documents.sparkSession
    schema, path = columns("item_id long, doc_id long, score long"), workspace.path("found")
    statistics, written = None, False
    for items in _blocks(benchmark, block_terms):
        numbered = workspace.keep(_numbered(documents, items.terms), "numbered")
        if statistics is None:
            counts = numbered.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
            statistics = int(counts[0]), int(counts[1])
        _search_block(numbered, items, *statistics, k, cells).write.mode("append").parquet(path)
        written = True
    found = spark.read.schema(schema).parquet(path) if written else spark.createDataFrame([], schema)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
