"""Language-model scores by logistic context mixing.

Tokens are words (A-Z in lower case) and one end per text. A token is spelled in bytes and a
closing byte, every byte in eight binary decisions. Predictors of several orders look a decision
up by a hash of the bytes before it in the word and the bits already known; each holds counts of ones
and zeros over every word of all training texts, as often as it stands there. Their log-odds are added with weights that a gate (bit and place
in the word) chooses and that online gradient steps learn. The product of a token's decisions is
its spelling probability.

While a text is read its score is refined: each token's probability is a mixture of its share
among all training tokens, its share among those that stand after the token before anywhere in the
training texts, its spelling probability, its share in the text so far, and that share after the
token before. The weights, gated by the kind of the token before, follow the text in steps of BLOCK
tokens. No part sums to more than one over all tokens, so scores are log-probabilities of the whole text; bits per byte follow from them.

Counts come from the whole corpus. Texts are cut into slices, written once. Each slice sends the hashes
of its distinct pairs of tokens that follow each other, with their counts in training texts, to
buckets by ranges of the hash; a bucket adds them up and answers every slice. Each slice sends its
distinct words with their training counts to buckets, packed; a word that every text holds is one
entry per slice. A bucket adds up its words, and each task over them adds the distinct ones, times their
counts, to the predictors' tables. Weights are learned from all these words: the online steps run over each
bucket's words apart, and the buckets' weights are averaged, each by its number of words. With the
weights known, a bucket spells each of its words once and answers every slice; the answers meet the
slices again by their numbers.
"""

from __future__ import annotations

from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleskeep.llm.common import columns, record_batch, small_batches, text_slices
from saleskeep.llm.shingles import _MIX, _mixed, coded_words
from saleskeep.workspace import Workspace, shuffles_dropped

ORDERS = (0, 1, 2, 3, 4, 6)
#: Slots of each predictor, as a power of two, and the count added to ones and zeros.
TABLE_BITS, PRIOR = 19, 0.1
TABLE_PARTS = 16
#: Bytes of text whose distinct words a bucket takes, on average.
BUCKET_BYTES = 16 << 20
GATES, RATE, STEP = 32, 0.1, 64
BLOCK, ADAPT = 32, 0.1
#: Of the sources of a token: the training tokens, its spelling, its text, its text after the
#: token before, the training tokens after the token before.
FIRST_WEIGHTS = (2.0, -0.5, -0.5, -2.0, 0.0)
END, CLOSE = b"\n", b" "
SPELL_WORDS, SPELL_BYTES = 4_000, 2_048
#: Of each byte its bits, and before each bit the bits known, a 1 in front, spread over 64 bits.
_BYTES, _DEPTH = np.arange(256, dtype=np.uint64)[:, None], np.arange(8, dtype=np.uint64)
BITS = ((_BYTES >> np.uint64(7) - _DEPTH) & np.uint64(1)).astype(np.uint8)
NODES = ((_BYTES | np.uint64(256)) >> np.uint64(8) - _DEPTH) * np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text in a slice.
SLICE = 2 << 20
#: Bytes of slices that are written, and read again, at a time.
ROW_GROUP = 8 << 20
#: How written tables are packed.
PACKING = {"compression": "zstd"}


def decisions(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all bits of all words: the slot in each predictor's table, the bit, the gate; and where
    each word's bits begin."""
    spelled = [w if w == END else w + CLOSE for w in words]
    sizes = np.array([len(w) for w in spelled], np.int64)
    data = np.frombuffer(b"".join(spelled), np.uint8)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    slots = np.empty((len(ORDERS), len(data) * 8), np.int32)
    contexts = []
    for order in ORDERS:
        context = np.full(len(data), np.uint64(order + 1))
        for back in range(1, order + 1):
            before = np.zeros(len(data), np.uint64)
            before[back:] = data[:-back] if len(data) > back else 0
            context = _mixed(context + np.where(place >= back, before + np.uint64(1), np.uint64(0)))
        contexts.append(context)
    # Few bytes at a time, so that what is mixed stays in the processor's cache.
    for at in range(0, len(data), SPELL_BYTES):
        spread = NODES[data[at : at + SPELL_BYTES]].ravel()
        shifted = np.empty_like(spread)
        for k, context in enumerate(contexts):
            mixed = np.repeat(context[at : at + SPELL_BYTES], 8)  # from here on as _mixed, in place
            mixed += spread
            mixed ^= np.right_shift(mixed, np.uint64(31), out=shifted)
            mixed *= _MIX
            mixed ^= np.right_shift(mixed, np.uint64(29), out=shifted)
            mixed >>= np.uint64(64 - TABLE_BITS)
            slots[k, at * 8 : at * 8 + len(mixed)] = mixed
    gates = np.minimum(place, 3)[:, None] * 8 + np.arange(8)
    return slots, BITS[data].ravel(), gates.ravel(), starts * 8


def add_counts(table: np.ndarray, words: list[bytes], times: np.ndarray | None = None) -> None:
    """Add the decisions of words, each as often as `times` says, to the (predictor, bit, slot) counts."""
    for at in range(0, len(words), SPELL_WORDS):
        slots, bits, _, starts = decisions(words[at : at + SPELL_WORDS])
        ones = bits * np.int32(table.shape[2])
        count = table.dtype.type(1)
        if times is not None:
            count = np.repeat(times[at : at + SPELL_WORDS], np.diff(np.append(starts, len(bits)))).astype(table.dtype)
        for k in range(len(ORDERS)):
            np.add.at(table[k].reshape(-1), slots[k] + ones, count)


def mix(odds: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Weights (gate, predictor), by online gradient steps over words."""
    weights = np.full((GATES, len(ORDERS)), 1 / 3)
    for low in range(0, len(words), SPELL_WORDS):
        slots, bits, gates, starts = decisions(words[low : low + SPELL_WORDS])
        every = np.stack([odds[k, slots[k]] for k in range(len(ORDERS))])
        cuts = np.append(starts[::STEP], len(bits))
        for at, end in zip(cuts, cuts[1:]):
            inputs, gate = every[:, at:end], gates[at:end]
            total = inputs[0] * weights[gate, 0]
            for k in range(1, len(ORDERS)):
                total += inputs[k] * weights[gate, k]
            chance = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            error = bits[at:end] - chance
            size = np.maximum(np.bincount(gate, minlength=GATES), 1)
            for k in range(len(ORDERS)):
                weights[:, k] += RATE * np.bincount(gate, error * inputs[k], GATES) / size
    return weights


def spelling(words: list[bytes], odds: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Natural logarithm of each word's spelling probability."""
    found, weights = [], weights.astype(np.float32)
    for at in range(0, len(words), SPELL_WORDS):
        slots, bits, gates, starts = decisions(words[at : at + SPELL_WORDS])
        total = np.zeros(len(bits), np.float32)
        for k in range(len(ORDERS)):
            total += odds[k, slots[k]] * weights[gates, k]
        found.append(-np.add.reduceat(np.logaddexp(0, np.where(bits == 1, -total, total)).astype(np.float64), starts))
    return np.concatenate(found) if found else np.zeros(0)


def earlier(keys: np.ndarray) -> np.ndarray:
    """How often each key stands before its place."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(keys)]
    start = np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))
    found = np.empty(len(keys), np.int64)
    found[order] = np.arange(len(keys)) - start
    return found


def recalled(index: np.ndarray, lengths: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities of the tokens from their own text so far: the share of earlier tokens
    that are the same, and that share after the same token as now. -inf where never, NaN where
    there is nothing to go by yet."""
    text = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(index)) - (np.cumsum(lengths) - lengths)[text]
    same = text * words + index
    count = earlier(same)
    before = np.concatenate([[0], index[:-1]])
    paired = earlier(same * words + before)
    seen = np.concatenate([[0], count[:-1]])
    with np.errstate(divide="ignore", invalid="ignore"):
        one = np.log(count / np.where(place > 0, place, np.nan))
        two = np.log(np.minimum(paired / np.where((place > 0) & (seen > 0), seen, np.nan), 1.0))
    return one, two


def token_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def tokens_before(index: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """The token before each one in its text; `start` for the first of a text."""
    before = np.concatenate([[start], index[:-1]])
    before[(np.cumsum(lengths) - lengths)] = start
    return before


def pair_codes(hashes: np.ndarray, index: np.ndarray, before: np.ndarray) -> np.ndarray:
    """A hash of each token and the one before it, which is `len(hashes)` at the start of a text."""
    first = _mixed(np.append(hashes, np.uint64(0)) + np.uint64(1))
    return _mixed(first[before] + hashes[index])


def pair_bounds(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of sorted codes begins, and the end: buckets are ranges of the code."""
    starts = [-(-(n << 64) // buckets) for n in range(1, buckets)]
    inner = np.searchsorted(codes, np.array(starts, np.uint64)) if starts else []
    return np.concatenate([[0], inner, [len(codes)]]).astype(np.int64)


def adaptive(parts: np.ndarray, kinds: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log-probability of each text. `parts` holds log-probabilities of its tokens from several
    sources, NaN where a source cannot tell; they are mixed by weights that follow the text.
    `kinds` of the tokens gate the weights of the token after them."""
    order = np.argsort(-lengths, kind="stable")
    starts = np.cumsum(lengths) - lengths
    sources = range(len(FIRST_WEIGHTS))
    logits = np.tile(np.array(FIRST_WEIGHTS), (len(lengths), 4, 1))
    totals = np.zeros(len(lengths))
    before = np.concatenate([[3], kinds[:-1]])
    before[starts] = 3
    able = ~np.isnan(parts)
    chances = np.where(able, np.exp(parts), 0)
    # Where every source can tell, nothing is masked.
    masked = [s for s in sources if not able[s].all()]
    for at in range(0, int(lengths.max(initial=0)), BLOCK):
        alive = order[: np.searchsorted(-lengths[order], -at, side="left")]
        step = at + np.arange(BLOCK)
        real = step < lengths[alive][:, None]
        index = np.where(real, starts[alive][:, None] + step, 0)
        gate = before[index]
        cell = 4 * np.arange(len(alive))[:, None] + gate
        steps = np.exp(logits[alive]).reshape(-1, len(FIRST_WEIGHTS))
        weight = [steps[cell, s] for s in sources]
        for s in masked:
            weight[s] *= able[s][index]
        whole = sum(weight[1:], weight[0])
        weight = [w / whole for w in weight]
        given = [w * chances[s][index] for s, w in zip(sources, weight)]
        both = sum(given[1:], given[0])
        totals[alive] += np.where(real, np.log(both), 0).sum(axis=1)
        felt = real & (both > 0)
        cell, over = cell[felt], both[felt]
        pull = [np.bincount(cell, given[s][felt] / over - weight[s][felt], 4 * len(alive)) for s in sources]
        moved = logits[alive] + ADAPT * np.stack(pull, axis=1).reshape(len(alive), 4, -1)
        logits[alive] = np.clip(moved, -8, 8)
    return totals


def _slices(documents: DataFrame, learnable: Column, workspace: Workspace) -> DataFrame:
    """One row per slice of the corpus: its number, and the ids, flags and texts of its rows."""
    schema = StructType.fromDDL("slice long, doc_id array<long>, learnable array<boolean>, text array<binary>")

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                ends = pa.array([0, part.num_rows], pa.int32())
                texts = part.column("text").cast(pa.binary())
                lists = [pa.ListArray.from_arrays(ends, c) for c in (part.column("doc_id"), part.column("learnable"), texts)]
                yield record_batch(schema, [[number], *lists])
                number += 1

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), learnable.alias("learnable"), "text")
    return workspace.keep(rows.mapInArrow(run, schema), "slices", {"parquet.block.size": ROW_GROUP, **PACKING})


def in_planes(numbers: np.ndarray) -> bytes:
    """Whole numbers, all first bytes in a row, then all second ones: as most are small, the later bytes
    take next to nothing once they are compressed."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def from_planes(packed: list[bytes], kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    parts = [np.frombuffer(part, np.uint8).reshape(size, -1).T for part in packed]
    return np.concatenate([np.zeros((0, size), np.uint8), *parts]).view(kind).ravel()


def _with_ends(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of the texts and the end, the places among them of all tokens in a row, and
    the number of tokens of each text."""
    words, coded, lengths = coded_words(texts)
    index = np.insert(coded, np.cumsum(lengths), len(words))
    return [*words, END], index, lengths + 1


def _pair_counts(slices: DataFrame, buckets: int, workspace: Workspace) -> DataFrame:
    """For every slice and bucket of pairs, how often each distinct pair of the slice stands in all
    training texts, in the order of their codes."""
    posted = columns("bucket int, slice long, codes binary, counts binary")
    answered = columns("number long, bucket int, counts binary")

    def post(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                number, flags, texts = (batch.column(c)[row].as_py() for c in ("slice", "learnable", "text"))
                words, index, lengths = _with_ends(texts)
                codes = pair_codes(token_hashes(words), index, tokens_before(index, lengths, len(words)))
                distinct, places = np.unique(codes, return_inverse=True)
                learned = np.repeat(np.array([bool(flag) for flag in flags]), lengths)
                counts = np.bincount(places[learned], minlength=len(distinct)).astype(np.uint32)
                bounds = pair_bounds(distinct, buckets)
                held = np.flatnonzero(np.diff(bounds))
                spans = [slice(bounds[n], bounds[n + 1]) for n in held]
                cut = [distinct[s].tobytes() for s in spans], [in_planes(counts[s]) for s in spans]
                yield record_batch(posted, [held.tolist(), [number] * len(held), *cut])

    def add_up(table: pa.Table) -> pa.Table:
        codes = [np.frombuffer(c, np.uint64) for c in table.column("codes").to_pylist()]
        counts = from_planes(table.column("counts").to_pylist(), np.uint32)
        distinct, places = np.unique(np.concatenate(codes), return_inverse=True)
        sums = np.bincount(places, counts, len(distinct)).astype(np.int64)[places]
        parts = [in_planes(part) for part in np.split(sums, np.cumsum([len(c) for c in codes])[:-1])]
        return pa.Table.from_batches([record_batch(answered, [table.column("slice").combine_chunks(), table.column("bucket").combine_chunks(), parts])])

    pairs = slices.select("slice", "learnable", "text").mapInArrow(post, posted)
    return workspace.keep(pairs.groupBy("bucket").applyInArrow(add_up, answered), "pair_counts", PACKING)


def _by_bucket(words, buckets: int) -> list[list[bytes]]:
    found: list[list[bytes]] = [[] for _ in range(buckets)]
    for word in sorted(words):
        found[crc32(word) % buckets].append(word)
    return found


def _postings(slices: DataFrame, buckets: int, workspace: Workspace) -> DataFrame:
    """One row per slice and bucket: the slice's distinct words of the bucket, packed, and how
    often its training texts hold each."""
    schema = columns("bucket int, slice long, words binary, counts binary")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                number, flags, texts = (batch.column(c)[row].as_py() for c in ("slice", "learnable", "text"))
                distinct, index, lengths = _with_ends(texts)
                learned = np.repeat(np.array([bool(flag) for flag in flags]), lengths)
                seen = dict(zip(distinct, np.bincount(index[learned], minlength=len(distinct)).tolist()))
                rows = [[], [], [], []]
                for bucket, words in enumerate(_by_bucket(seen, buckets)):
                    if words:
                        counts = in_planes(np.array([seen[w] for w in words], np.uint32))
                        for column, value in zip(rows, (bucket, number, b" ".join(words), counts)):
                            column.append(value)
                yield record_batch(schema, rows)

    return workspace.keep(slices.select("slice", "learnable", "text").mapInArrow(run, schema), "postings", PACKING)


def _added_up(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Of the postings of a bucket: its distinct words, their counts, the place of each posted
    word among them and the number of words of each posting."""
    split = pc.split_pattern(table.column("words").combine_chunks(), b" ")
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    coded = pc.dictionary_encode(split.flatten())
    places = coded.indices.to_numpy(zero_copy_only=False)
    counts = from_planes(table.column("counts").to_pylist(), np.uint32)
    return coded.dictionary, np.bincount(places, counts, len(coded.dictionary)).astype(np.int64), places, lengths


def _vocabulary(postings: DataFrame, workspace: Workspace) -> DataFrame:
    """One row per bucket: its words of training texts and their counts, packed, the counts' sum and the
    words' number."""
    schema = columns("bucket int, words binary, counts binary, total long, distinct long")

    def add_up(table: pa.Table) -> pa.Table:
        words, counts, _, _ = _added_up(table)
        learned = words.filter(pa.array(counts > 0)).to_pylist()
        times = counts[counts > 0].tobytes()
        row = [table.column("bucket")[0].as_py(), b" ".join(learned), times, int(counts.sum()), len(learned)]
        return pa.Table.from_batches([record_batch(schema, [[value] for value in row])])

    return workspace.keep(postings.groupBy("bucket").applyInArrow(add_up, schema), "vocabulary", PACKING)


def _tables(vocabulary: DataFrame) -> np.ndarray:
    """The predictors' log-odds, a table of fixed size."""
    schema = columns("number int, some int, payload binary")

    def count(batches):
        grown = None
        for batch in batches:
            for row in range(batch.num_rows):
                words = batch.column("words")[row].as_py()
                if words:
                    grown = np.zeros((len(ORDERS), 2, 1 << TABLE_BITS), np.uint64) if grown is None else grown
                    add_counts(grown, words.split(b" "), np.frombuffer(batch.column("counts")[row].as_py(), np.int64))
        if grown is not None:
            some = TaskContext.get().partitionId() % TABLE_PARTS
            for number, piece in enumerate(np.split(grown, TABLE_PARTS, axis=2)):
                yield record_batch(schema, [[number], [some], [piece.tobytes()]])

    def add_up(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                number = batch.column("number")[row].as_py()
                piece = np.frombuffer(batch.column("payload")[row].as_py(), np.uint64)
                total = found.setdefault(number, np.zeros(len(piece), np.uint64))
                total += piece
        for number, total in found.items():
            yield record_batch(schema, [[number], [0], [total.tobytes()]])

    # Pieces are added up in groups first, as every task sends all of them.
    some = vocabulary.select("words", "counts").mapInArrow(count, schema).repartition("number", "some").mapInArrow(add_up, schema)
    counts = np.zeros((TABLE_PARTS, len(ORDERS), 2, (1 << TABLE_BITS) // TABLE_PARTS), np.float32)
    for number, _, payload in some.repartition("number").mapInArrow(add_up, schema).collect():
        counts[number] = np.frombuffer(payload, np.uint64).reshape(counts.shape[1:])
    odds = np.log((counts[:, :, 1] + np.float32(PRIOR)) / (counts[:, :, 0] + np.float32(PRIOR)))
    return np.ascontiguousarray(odds.transpose(1, 0, 2)).reshape(len(ORDERS), -1)


def _weights(vocabulary: DataFrame, odds: np.ndarray) -> np.ndarray:
    """The weights that online steps over a bucket's words lead to, in the order of their hashes,
    averaged over all buckets by their numbers of words."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(odds)
    schema = StructType.fromDDL("distinct long, weights array<double>")

    def learn(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                words = batch.column("words")[row].as_py()
                if words:
                    ordered = sorted(words.split(b" "), key=lambda w: (crc32(w[::-1]), w))
                    yield record_batch(schema, [[len(ordered)], [mix(shared.value, ordered).ravel().tolist()]])

    learned = vocabulary.select("words").mapInArrow(learn, schema).select("distinct", F.posexplode("weights").alias("at", "weight"))
    mean = F.sum(F.col("weight") * F.col("distinct")) / F.sum("distinct")
    weights = np.full(GATES * len(ORDERS), 1 / 3)
    for at, value in learned.groupBy("at").agg(mean).collect():
        weights[at] = value
    return weights.reshape(GATES, len(ORDERS))


def _replies(postings: DataFrame, model) -> DataFrame:
    """For every posting, the corpus counts of its words and their spelling probabilities, each
    word of a bucket spelled once."""
    schema = columns("number long, bucket int, counts binary, spelled binary")

    def answer(table: pa.Table) -> pa.Table:
        words, counts, places, lengths = _added_up(table)
        spelled = spelling(words.to_pylist(), *model.value).astype(np.float32)
        ends = np.cumsum(lengths)[:-1]
        found = [[pack(part) for part in np.split(values[places], ends)] for values, pack in ((counts, in_planes), (spelled, np.ndarray.tobytes))]
        return pa.Table.from_batches([record_batch(schema, [table.column("slice").combine_chunks(), table.column("bucket").combine_chunks(), *found])])

    return postings.groupBy("bucket").applyInArrow(answer, schema)


SCORES = columns(
    "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
)


def score_texts(documents: DataFrame, learnable: Column, workspace: Workspace) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte: one row per row.

    Learns from the rows where `learnable` holds, repeated rows as often as they stand there.
    base_score is that of the smoothed word model, score the model's; both are base-10
    logarithms of the probability of the whole text with its end. A NULL text is an empty one,
    an end alone. With nothing to learn from, no token is known and every decision is even."""
    spark = documents.sparkSession
    with small_batches(spark):
        slices = _slices(documents, learnable, workspace)
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(2 * spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))
    with small_batches(spark):
        pairs = _pair_counts(slices, buckets, workspace)
        postings = _postings(slices, buckets, workspace)
        vocabulary = _vocabulary(postings, workspace)
    train_tokens, distinct = (x or 0 for x in vocabulary.agg(F.sum("total"), F.sum("distinct")).first())
    with shuffles_dropped(spark):
        odds = _tables(vocabulary)
    with small_batches(spark):
        weights = _weights(vocabulary, odds)
    model = spark.sparkContext.broadcast((odds, weights))

    def run(own: pa.Table, replies: pa.Table) -> pa.Table:
        ids, texts = (list(chain.from_iterable(own.column(c).to_pylist())) for c in ("doc_id", "text"))
        distinct_words, coded, lengths = _with_ends(texts)
        parts = sorted(zip(*(replies.column(c).to_pylist() for c in ("bucket", "counts", "spelled"))), key=lambda p: p[0])
        of_words, of_pairs = ([p for p in parts if (p[2] is None) == paired] for paired in (False, True))
        count = from_planes([p[1] for p in of_words], np.int64).astype(np.float64)
        spelled = np.frombuffer(b"".join(p[2] for p in of_words), np.float32).astype(np.float64)
        paired = from_planes([p[1] for p in of_pairs], np.int64).astype(np.float64)
        words = list(chain.from_iterable(_by_bucket(distinct_words, buckets)))
        place = {w: n for n, w in enumerate(words)}
        place_of = np.fromiter(map(place.__getitem__, distinct_words), np.int64, len(distinct_words))
        starts = np.cumsum(lengths) - lengths
        index = place_of[coded]
        before = tokens_before(index, lengths, len(words))
        places = np.unique(pair_codes(token_hashes(words), index, before), return_inverse=True)[1]
        known = count > 0
        # Every training token but an end has one after it, and every training text one at its start.
        led = np.append(np.where(np.arange(len(words)) == place[END], np.nan, count), count[place[END]])
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.log(count / max(train_tokens, 1))
            after = np.log(paired[places] / led[before])
        size_of = np.array([len(w) for w in words])
        kind = np.where(~known, 2, np.where(size_of > 5, 1, 0))
        sources = [share[index], spelled[index], *recalled(index, lengths, len(words)), after]
        total = adaptive(np.stack(sources), kind[index], lengths)
        score = total / np.log(10)
        base = np.add.reduceat(np.log10(count + 1)[index], starts) - lengths * np.log10(train_tokens + distinct + 1)
        letters = np.add.reduceat((size_of + 1)[index], starts)
        return pa.Table.from_batches([record_batch(SCORES, [
            ids, lengths, np.add.reduceat(known[index].astype(np.int64), starts), np.full(len(ids), train_tokens),
            base, score, -score * np.log2(10) / letters,
        ])])

    # A slice and its replies meet as one group, so no task holds more than a slice at a time.
    asked = pairs.select("number", "bucket", "counts", F.lit(None).cast("binary").alias("spelled"))
    replies = _replies(postings, model).unionByName(asked).groupBy("number")
    return slices.select("slice", "doc_id", "text").groupBy("slice").cogroup(replies).applyInArrow(run, SCORES)
