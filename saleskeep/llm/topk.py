"""Exact top-k inner products, block at a time.

Vectors become whole numbers. Every block, a range of rows, holds the largest and smallest value
of each component (the terms) and its rows as a forward index. For a query the bound of a block
is the sum over the terms of the larger product. Each query visits the blocks by falling bound,
scores all rows of a block through the forward index, and stops when the bound falls below its
k-th best score. Queries are a stated set: they go to the blocks in rounds of a fixed size, and
only the k best of each query leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleskeep.llm.common import record_batch
from saleskeep.workspace import Workspace

BLOCK_ROWS = 256
#: Queries of a round, on average: what is sent to every task at a time.
ROUND_QUERIES = 16_384
#: A sum of products up to here is exact in double precision.
EXACT = 2**52
LOWEST = np.iinfo(np.int64).min


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; NULL where a vector takes no part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def matrix(vectors: pa.ListArray, width: int | None = None) -> np.ndarray:
    """Rows of equal width; components that a vector lacks are 0, those beyond `width` meet none."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0)) if width is None else width
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    result = np.zeros((len(lengths), width), np.int64)
    inside = column < width
    result[row[inside], column[inside]] = values[inside]
    return result


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T in whole numbers, through doubles where that is exact."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if most < EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.own, self.queries, self.k = ids, queries, k
        self.scores = np.full((len(ids), k), LOWEST, np.int64)
        self.ids = np.full((len(ids), k), np.iinfo(np.int64).max, np.int64)
        self.found = np.zeros(len(ids), np.int64)

    def add(self, who: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Score a block for some queries."""
        scores = products(self.queries[who], rows)
        usable = ids[None, :] != self.own[who][:, None]
        self.found[who] += usable.sum(axis=1)
        every = np.concatenate([self.scores[who], np.where(usable, scores, LOWEST)], axis=1)
        names = np.where(usable, ids[None, :], np.iinfo(np.int64).max)
        names = np.concatenate([self.ids[who], names], axis=1)
        order = np.lexsort((names, -(every + 1)), axis=1)[:, : self.k]
        self.scores[who] = np.take_along_axis(every, order, 1)
        self.ids[who] = np.take_along_axis(names, order, 1)

    def scan(self, ids: np.ndarray, rows: np.ndarray) -> int:
        """Search some rows; the number of (query, block) pairs that were scored."""
        starts = np.arange(0, len(ids), BLOCK_ROWS)
        top, bottom = np.maximum.reduceat(rows, starts), np.minimum.reduceat(rows, starts)
        bounds = products(np.maximum(self.queries, 0), top) + products(np.minimum(self.queries, 0), bottom)
        order, scored = np.argsort(-bounds, axis=1, kind="stable"), 0
        alive = np.arange(len(self.own))
        for place in range(len(starts)):
            block = order[alive, place]
            going = (bounds[alive, block] >= self.scores[alive, -1]) | (self.found[alive] < self.k)
            alive, block = alive[going], block[going]
            if not len(alive):
                break
            for b in np.unique(block):
                part = slice(starts[b], starts[b] + BLOCK_ROWS)
                self.add(alive[block == b], ids[part], rows[part])
            scored += len(alive)
        return scored

    def result(self) -> list[np.ndarray]:
        count = np.minimum(self.found, self.k)
        kept = np.arange(self.k)[None, :] < count[:, None]
        return [np.repeat(self.own, count), self.ids[kept], self.scores[kept]]


def search(
    embeddings: DataFrame,
    queries: Column,
    workspace: Workspace,
    k: int = 5,
    scale: int = 256,
    id_column: str = "vec_id",
    vector: str = "embedding",
    round_queries: int = ROUND_QUERIES,
) -> DataFrame:
    """query_id, rank, the id column and score: for each row that the condition `queries` picks
    the k largest inner products with the other rows, fewer if there are fewer, ties to the
    smaller id.

    Rows without an id, and vectors that are NULL or hold a NULL or non-finite component, take
    no part. Missing components of shorter vectors count as 0. Rows with equal ids are
    candidates each, never of their own id; as a query an id is answered once, for its smallest
    vector."""
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("id"), scaled(F.col(vector), scale).alias("v"), queries.alias("asks")
    ).filter("id IS NOT NULL AND v IS NOT NULL")
    asked = workspace.keep(rows.filter("asks").groupBy("id").agg(F.min("v").alias("v")), "queries")
    rounds = -(-asked.count() // round_queries)
    found = StructType.fromDDL("query_id long, id long, score long")
    results = workspace.path("found")
    for number in range(rounds):
        picked = asked.filter(F.pmod(F.xxhash64("id"), F.lit(rounds)) == number).toArrow()
        column = picked.column("v").combine_chunks()
        shared = spark.sparkContext.broadcast((picked.column("id").to_numpy(), matrix(column)))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, wanted = shared.value
            best = Best(ids, wanted, k)
            for batch in batches:
                if batch.num_rows:
                    best.scan(batch.column("id").to_numpy(), matrix(batch.column("v"), wanted.shape[1]))
            yield record_batch(found, best.result())

        blocks = rows.select("id", "v").mapInArrow(scan, found)
        if rounds == 1:
            return _ranked(blocks, k, id_column)
        blocks.write.mode("append").parquet(results)
    if not rounds:
        return _ranked(spark.createDataFrame([], found), k, id_column)
    return _ranked(spark.read.schema(found).parquet(results), k, id_column)


def _ranked(found: DataFrame, k: int, id_column: str) -> DataFrame:
    """The k best of what each task found for a query: k rows a task at most."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column), "score")
