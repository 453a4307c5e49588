"""A quality classifier from positive and unlabelled texts.

Trusted positives and unlabelled web text train a small network that minimises the non-negative
unbiased risk: with the class prior p, p * risk of positives as positive + max(0, risk of
unlabelled as negative - p * risk of positives as negative). The prior is estimated first: a
plain positive-against-unlabelled model is fitted on one half of the rows (by a hash of the id)
and scores every text of both kinds in the other half; the prior is the share of unlabelled texts above a threshold over the share of positives above it, at the
threshold where this ratio, with an allowance for small counts, is least. Known negatives are
not used.

Every text becomes one row of features of its whole length: shares of byte classes and of
pairs of neighbouring classes, repetition of words and lines, lengths, and hashed words.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleskeep.llm.common import lists, map_texts, raw_texts, record_batch
from saleskeep.workspace import Workspace

#: The bounded sample that models are fitted to: so many positives and so many unlabelled rows.
SAMPLE_POSITIVES, SAMPLE_UNLABELLED = 6_000, 12_000
HASHED = 128
HIDDEN, EPOCHS, BATCH, RATE = 32, 20, 512, 3e-3
#: Bins of the scores that the class prior is read from, and its uncertainty allowance.
BINS, DELTA = 1_000, 0.1
_CLASSES = np.array(
    [
        0 if 0x61 <= b <= 0x7A else 1 if 0x41 <= b <= 0x5A else 2 if 0x30 <= b <= 0x39 else 3 if b == 0x20
        else 4 if b in b"\n\r\t\v\f" else 5 if b in b".,;:'\"-?" else 6 if b < 0x80 else 7
        for b in range(256)
    ],
    np.int64,
)
STATISTICS = 11
WIDTH = 8 + 64 + STATISTICS + HASHED


def text_features(texts: list[bytes | None]) -> np.ndarray:
    """One row per text; all zero for NULL and empty texts."""
    result = np.zeros((len(texts), WIDTH), np.float32)
    sizes = np.array([len(t or b"") for t in texts], np.int64)
    every = np.frombuffer(b"".join(t or b"" for t in texts), np.uint8)
    owner = np.repeat(np.arange(len(texts)), sizes)
    kinds = _CLASSES[every]
    scale = 1 / np.maximum(sizes, 1)[:, None]
    result[:, :8] = np.sqrt(np.bincount(owner * 8 + kinds, minlength=len(texts) * 8).reshape(-1, 8) * scale)
    same = owner[1:] == owner[:-1]
    pairs = (owner[1:] * 64 + kinds[:-1] * 8 + kinds[1:])[same]
    result[:, 8:72] = np.sqrt(np.bincount(pairs, minlength=len(texts) * 64).reshape(-1, 64) * scale)
    for row, text in zip(result, texts):
        words = text.split() if text else []
        if not words:
            continue
        lines, count = text.split(b"\n"), len(words)
        seen = Counter(words)
        letters = sum(map(len, words))
        most = max(seen.values())
        row[72 : 72 + STATISTICS] = (
            math.log1p(len(text)) / 10, math.log1p(count) / 10, letters / count / 10, len(seen) / count,
            math.log1p(len(seen)) / math.log1p(count), most / count, sum(map(eq, words, words[1:])) / count,
            len(set(lines)) / len(lines), math.log1p(len(text) / len(lines)) / 10,
            max(map(len, lines)) / len(text), sum(map(bytes.isupper, words)) / count,
        )
        hashed = np.bincount(np.fromiter(map(crc32, seen), np.int64, len(seen)) % HASHED, minlength=HASHED)
        row[72 + STATISTICS :] = np.sqrt(hashed / len(seen))
    return result


@dataclass(frozen=True)
class Network:
    """One hidden layer; the output's logistic is the probability of a positive."""

    centre: np.ndarray
    spread: np.ndarray
    parameters: tuple[np.ndarray, ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        first, bias, second, last = self.parameters
        z = np.tanh(((x - self.centre) / self.spread) @ first + bias) @ second + last
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_network(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int = 0) -> Network:
    """Minimise the non-negative risk under `prior`, or, without one, tell the two kinds apart."""
    every = np.concatenate([positive, unlabelled]).astype(np.float64)
    centre, spread = every.mean(axis=0), every.std(axis=0) + 1e-2
    positive, unlabelled = (positive - centre) / spread, (unlabelled - centre) / spread
    draw = np.random.default_rng(seed)
    width = every.shape[1]
    parameters = [
        draw.normal(0, 1 / math.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN),
        draw.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN), np.zeros(()),
    ]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    step = 0
    rounds = max(1, -(-len(unlabelled) // BATCH))
    for _ in range(EPOCHS):
        p_order, u_order = draw.permutation(len(positive)), draw.permutation(len(unlabelled))
        for n in range(rounds):
            p, u = positive[p_order[n::rounds]], unlabelled[u_order[n::rounds]]
            if not len(p) or not len(u):
                continue
            x = np.concatenate([p, u])
            hidden = np.tanh(x @ parameters[0] + parameters[1])
            z = np.clip(hidden @ parameters[2] + parameters[3], -30, 30)
            chance = 1 / (1 + np.exp(-z))
            loss = np.log1p(np.exp(z))  # of taking a row for a negative
            is_p = np.arange(len(x)) < len(p)
            in_p, in_u = is_p / len(p), ~is_p / len(u)
            if prior is None:
                slope = 0.5 * (in_p * (chance - 1) + in_u * chance)
            else:
                negative = (in_u - prior * in_p) @ loss
                apart = (in_u - prior * in_p) * chance
                # below zero the risk of negatives is fitted noise: climb back
                slope = prior * in_p * (chance - 1) + apart if negative >= 0 else -apart
            back = np.outer(slope, parameters[2]) * (1 - hidden**2)
            slopes = [x.T @ back, back.sum(axis=0), hidden.T @ slope, slope.sum()]
            step += 1
            for k, gradient in enumerate(slopes):
                gradient = gradient + 1e-4 * parameters[k]
                a, b = moments[k]
                a, b = 0.9 * a + 0.1 * gradient, 0.999 * b + 0.001 * gradient**2
                moments[k] = a, b
                parameters[k] = parameters[k] - RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return Network(centre, spread, tuple(parameters))


def class_prior(positives: np.ndarray, unlabelled: np.ndarray) -> float:
    """From the counts of scores by bin, low to high, of both kinds."""
    n_p, n_u = positives.sum(), unlabelled.sum()
    above_p, above_u = positives[::-1].cumsum()[::-1] / n_p, unlabelled[::-1].cumsum()[::-1] / n_u
    allowance = math.sqrt(math.log(4 / DELTA) / 2) * (1 / math.sqrt(n_p) + 1 / math.sqrt(n_u))
    usable = above_p > allowance
    if not usable.any():
        return 0.5
    least = int(np.argmin(np.where(usable, (above_u + allowance) / np.maximum(above_p, 1e-12), np.inf)))
    return float(np.clip(above_u[least] / above_p[least], 0.01, 0.99))



def _features(documents: DataFrame, learnable: Column) -> DataFrame:
    rows = documents.select("doc_id", learnable.alias("learnable"), "text")
    schema = rows.select("doc_id", "learnable", F.array(F.lit(0).cast("float")).alias("x")).schema

    def make():
        def run(batch: pa.RecordBatch) -> list:
            x = text_features(raw_texts(batch.column("text")))
            return [batch.column("doc_id"), batch.column("learnable"), lists(x.ravel(), np.full(len(x), WIDTH))]

        return run

    return map_texts(rows, make, schema)


def _scored(features: DataFrame, network: Network | None, name: str) -> DataFrame:
    kept = [c for c in features.columns if c != "x"]
    if network is None:
        return features.select(*kept, F.lit(0.5).alias(name))
    shared = features.sparkSession.sparkContext.broadcast(network)
    schema = features.select(*kept, F.lit(0.0).alias(name)).schema

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            yield record_batch(schema, [*(batch.column(c) for c in kept), shared.value.scores(x)])

    return features.select(*kept, "x").mapInArrow(run, schema)


def _sample(features: DataFrame, ids: DataFrame, rows: int) -> np.ndarray:
    """Features of the `rows` ids with the smallest hashes, in that order; one row of each id."""
    chosen = ids.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = features.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"))
    ordered = found.orderBy(F.xxhash64("doc_id"), "doc_id").select("x").toArrow().column("x").combine_chunks()
    return ordered.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def score_quality(
    documents: DataFrame,
    labels: DataFrame,
    learnable: Column,
    workspace: Workspace,
    positives: int = SAMPLE_POSITIVES,
    unlabelled: int = SAMPLE_UNLABELLED,
) -> DataFrame:
    """doc_id and score, the probability that a text is of quality; one row per row.

    Learns from the rows where `learnable` holds: those whose `labels.quality` is 1 are the
    trusted positives (an id with several labels is one if any is 1), those without a quality
    label the unlabelled ones. With too little of either kind for both halves every score is 0.5. NULL and empty
    texts are scored like any other, by features that are all zero."""
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("trusted")
    )
    features = workspace.keep(_features(documents, learnable), "features")
    kinds = features.filter("learnable AND doc_id IS NOT NULL").select("doc_id").distinct()
    half = F.pmod(F.xxhash64(F.concat(F.lit("half "), F.col("doc_id"))), F.lit(2))
    kinds = workspace.keep(kinds.join(marks, "doc_id", "left").withColumn("half", half), "kinds")
    trusted, plain = kinds.filter("trusted"), kinds.filter("trusted IS NULL")
    positive, web = _sample(features, trusted, positives), _sample(features, plain, unlabelled)
    fitted = [_sample(features, x.filter("half = 0"), n) for x, n in ((trusted, positives), (plain, unlabelled))]
    if not len(positive) or not len(web):
        return _scored(features.select("doc_id", "x"), None, "score")
    if not all(map(len, fitted)):
        fitted = [positive, web]
    apart = _scored(features.filter("learnable").select("doc_id", "x"), fit_network(*fitted, None), "apart")
    bins = F.least(F.floor(F.col("apart") * BINS), F.lit(BINS - 1)).alias("bin")
    told = apart.join(kinds.filter("half = 1"), "doc_id").filter("trusted IS NULL OR trusted")
    table = np.zeros((2, BINS))
    for trusted, place, count in told.groupBy(F.col("trusted").isNotNull().cast("int"), bins).count().collect():
        table[trusted, place] = count
    if not table.any(axis=1).all():
        return _scored(features.select("doc_id", "x"), None, "score")
    network = fit_network(positive, web, class_prior(table[1], table[0]))
    return _scored(features.select("doc_id", "x"), network, "score")
