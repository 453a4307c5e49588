"""Language identification with a linear-chain conditional random field over words.

Each word of a text has a label, its language. Its emission score adds up the weights of hashed
features: prefixes and suffixes, character n-grams, and, for words of a lexicon learned with the
model, the word itself; transitions between neighbouring labels are learned as well. Training
texts are labelled as wholes, so training sequences are spliced from pieces of texts in several
languages, as in code-switched text; weights climb the conditional log-likelihood, whose
gradient the forward-backward recursion gives.

To label, the recursion runs over all segments of SEGMENT words of many documents side by side:
each segment is first reduced to one matrix, the matrices of a document give the messages at the
segments' ends, and these start the recursions inside. This is exact and as fast for one very
long text as for many short ones.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleskeep.frames import small_frame
from saleskeep.llm.common import map_texts, put_back, set_aside

UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
#: The bounded sample the model is fitted to: so many different texts of each language, drawn by
#: the hashes of the texts, and up to so many characters of each.
SAMPLE_ROWS, SAMPLE_CHARACTERS = 300, 50_000
BUCKETS = 1 << 18
LEXICON_MINIMUM = 3
SPLICE = (6, 40)
SEQUENCE, SEGMENT = 64, 64
ROUNDS, RATE, DECAY = 40, 0.1, 1e-6
#: Training sequences whose label probabilities are held at once.
TOGETHER = 512
MEMO_WORDS = 500_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return WORD.findall(text.lower()) if text else []


def features(distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of words and of the features they hold, without the lexicon's."""
    sizes = np.array([len(w) + 2 for w in distinct], np.int64)
    letters = np.frombuffer("".join(f"\x02{w}\x03" for w in distinct).encode("utf-32-le"), "<u4").astype(np.uint64)
    ends = np.cumsum(sizes)
    word = np.repeat(np.arange(len(distinct)), sizes)
    place = np.arange(len(letters)) - (ends - sizes)[word]
    found = []
    code = np.zeros(len(letters), np.uint64)
    for size in range(1, 5):
        shifted = np.zeros_like(code)
        shifted[: len(code) - size + 1] = letters[size - 1 :]
        code = (code ^ (shifted + np.uint64(size))) * _MIX
        code ^= code >> np.uint64(29)
        fits = place + size <= sizes[word]
        if size in (2, 3):
            found.append((word[fits], code[fits]))
        prefix = fits & (place == 1) & (size + 1 < sizes[word])
        suffix = fits & (place + size == sizes[word] - 1) & (place > 0)
        for kind, mask in enumerate((prefix, suffix), 1):
            found.append((word[mask], (code[mask] + np.uint64(kind)) * _MIX))
    which = np.concatenate([w for w, _ in found])
    return which, (np.concatenate([c for _, c in found]) >> np.uint64(46)).astype(np.int64) % BUCKETS


@dataclass(frozen=True)
class Model:
    languages: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray  # (features, languages): hashed ones, then the lexicon's words
    transitions: np.ndarray
    start: np.ndarray

    def emissions(self, distinct: list[str]) -> np.ndarray:
        return emissions(distinct, self.lexicon, self.weights)


def with_lexicon(distinct: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    word, feature = features(distinct)
    known = [(n, lexicon[w]) for n, w in enumerate(distinct) if w in lexicon]
    extra = np.array(known, np.int64).reshape(-1, 2)
    return np.concatenate([word, extra[:, 0]]), np.concatenate([feature, extra[:, 1] + BUCKETS])


def emissions(distinct: list[str], lexicon: dict[str, int], weights: np.ndarray) -> np.ndarray:
    if not distinct or not weights.shape[1]:
        return np.zeros((len(distinct), weights.shape[1]))
    word, feature = with_lexicon(distinct, lexicon)
    return np.stack([np.bincount(word, weights[feature, k], len(distinct)) for k in range(weights.shape[1])], axis=1)


def splice(texts: list[list[str]], labels: list[int], seed: int) -> tuple[list[str], np.ndarray]:
    """All words, in pieces of random lengths that change places."""
    draw = np.random.default_rng(seed)
    pieces = []
    for text, label in zip(texts, labels):
        at = 0
        while at < len(text):
            size = int(draw.integers(*SPLICE))
            pieces.append((text[at : at + size], label))
            at += size
    order = draw.permutation(len(pieces))
    line = [w for n in order for w in pieces[n][0]]
    gold = np.repeat([pieces[n][1] for n in order], [len(pieces[n][0]) for n in order])
    return line, gold.astype(np.int64)


def train(texts: list[list[str]], labels: list[str], seed: int = 0) -> Model:
    """Fit by Adam on the whole sample; `labels` hold one language per text."""
    languages = sorted(set(labels))
    count = len(languages)
    number = {name: k for k, name in enumerate(languages)}
    seen = Counter(w for text in texts for w in set(text))
    lexicon = {w: n for n, w in enumerate(sorted(w for w, c in seen.items() if c >= LEXICON_MINIMUM))}
    parameters = [np.zeros((BUCKETS + len(lexicon), count)), np.zeros((count, count)), np.zeros(count)]
    if count < 2 or not any(texts):
        return Model(languages, lexicon, *parameters)
    line, gold = splice(texts, [number[name] for name in labels], seed)
    distinct = sorted(set(line))
    place = {w: n for n, w in enumerate(distinct)}
    ids = np.fromiter(map(place.__getitem__, line), np.int64, len(line))
    total = -(-len(line) // SEQUENCE) * SEQUENCE
    padded = np.zeros(total, np.int64)
    padded[: len(line)] = ids
    real = (np.arange(total) < len(line)).reshape(-1, SEQUENCE)
    padded = padded.reshape(-1, SEQUENCE)
    word, feature = with_lexicon(distinct, lexicon)
    inner = np.arange(1, len(line)) % SEQUENCE > 0  # pairs of words of one sequence
    gold_pairs = np.bincount((gold[:-1] * count + gold[1:])[inner], minlength=count**2).reshape(count, count)
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, ROUNDS + 1):
        weights, transitions, start = parameters
        score = np.stack([np.bincount(word, weights[feature, k], len(distinct)) for k in range(count)], axis=1)
        by_word, expected, firsts = np.zeros((len(distinct), count)), np.zeros((count, count)), np.zeros(count)
        for at in range(0, len(padded), TOGETHER):
            part = slice(at, at + TOGETHER)
            posterior, pairs = _posteriors(score[padded[part]], real[part], transitions, start)
            error = np.where(real[part][:, :, None], -posterior, 0.0)
            own = gold[at * SEQUENCE : (at + TOGETHER) * SEQUENCE]
            error.reshape(-1, count)[np.arange(len(own)), own] += 1
            for k in range(count):
                by_word[:, k] += np.bincount(padded[part].ravel(), error[:, :, k].ravel(), len(distinct))
            expected += pairs
            firsts += error[:, 0].sum(axis=0)
        slope = np.stack([np.bincount(feature, by_word[word, k], len(weights)) for k in range(count)], axis=1)
        slopes = [slope, gold_pairs - expected, firsts]
        for n, gradient in enumerate(slopes):
            gradient = gradient / len(line) - DECAY * parameters[n]
            first[n] = 0.9 * first[n] + 0.1 * gradient
            second[n] = 0.99 * second[n] + 0.01 * gradient**2
            parameters[n] = parameters[n] + RATE * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-10)
    return Model(languages, lexicon, parameters[0].astype(np.float32), parameters[1], parameters[2])


def _posteriors(score: np.ndarray, real: np.ndarray, transitions: np.ndarray, start: np.ndarray):
    """Label probabilities, and expected label pairs, of sequences of one length."""
    lengths = score.shape[1]
    likely = np.exp(score - score.max(axis=2, keepdims=True))
    step = np.exp(transitions - transitions.max())
    ahead, behind = np.empty_like(likely), np.empty_like(likely)
    state = likely[:, 0] * np.exp(start - start.max())
    for t in range(lengths):
        if t:
            state = np.where(real[:, t, None], (state @ step) * likely[:, t], state)
        state = state / state.sum(axis=1, keepdims=True)
        ahead[:, t] = state
    state = np.ones_like(state)
    for t in range(lengths - 1, -1, -1):
        behind[:, t] = state
        state = np.where(real[:, t, None], (likely[:, t] * state) @ step.T, state)
        state = state / state.sum(axis=1, keepdims=True)
    posterior = ahead * behind
    posterior /= posterior.sum(axis=2, keepdims=True)
    after = likely[:, 1:] * behind[:, 1:]
    norm = np.einsum("nti,ij,ntj->nt", ahead[:, :-1], step, after)
    share = np.where(real[:, 1:], 1 / norm, 0)
    pairs = np.einsum("nti,ntj->ij", ahead[:, :-1] * share[:, :, None], after) * step
    return posterior, pairs


def label_mass(score: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, start: np.ndarray, marginals: bool = False):
    """Sum of the label probabilities of each text's words (texts have one word at least), or
    the probabilities of each word."""
    count = score.shape[1]
    segments = -(-lengths // SEGMENT)
    owner = np.repeat(np.arange(len(lengths)), segments)
    begins = np.cumsum(segments) - segments
    index = np.arange(len(owner)) - begins[owner]
    text_start = np.cumsum(lengths) - lengths
    at = (text_start[owner] + index * SEGMENT)[:, None] + np.arange(SEGMENT)
    real = (index * SEGMENT)[:, None] + np.arange(SEGMENT) < lengths[owner][:, None]
    at = np.where(real, at, 0)
    likely = np.exp(score - score.max(axis=1, keepdims=True)).astype(np.float32)[at]
    step = np.exp(transitions - transitions.max()).astype(np.float32)
    initial = np.exp(start - start.max()).astype(np.float32)

    whole = np.broadcast_to(np.eye(count, dtype=np.float32), (len(owner), count, count))
    for t in range(SEGMENT):
        enter = whole @ step
        if t == 0:  # a text begins without a transition
            enter = np.where((index == 0)[:, None, None], whole, enter)
        moved = enter * likely[:, t, None, :]
        whole = np.where(real[:, t, None, None], moved / moved.max(axis=(1, 2), keepdims=True), whole)

    ahead, behind = np.empty((len(owner), count), np.float32), np.empty((len(owner), count), np.float32)
    state = np.tile(initial, (len(lengths), 1))
    order = np.argsort(-segments, kind="stable")
    alive = np.searchsorted(-segments[order], -np.arange(1, segments.max() + 1), side="right")
    for n, size in enumerate(alive):
        texts = order[:size]
        part = begins[texts] + n
        ahead[part] = state[texts]
        moved = np.einsum("ni,nij->nj", state[texts], whole[part])
        state[texts] = moved / moved.sum(axis=1, keepdims=True)
    state = np.ones_like(state)
    for n in range(len(alive) - 1, -1, -1):
        texts = order[: alive[n]]
        part = begins[texts] + n
        behind[part] = state[texts]
        moved = np.einsum("nij,nj->ni", whole[part], state[texts])
        state[texts] = moved / moved.sum(axis=1, keepdims=True)

    forward = np.empty_like(likely)
    state = ahead
    for t in range(SEGMENT):
        enter = state @ step
        if t == 0:
            enter = np.where((index == 0)[:, None], state, enter)
        moved = enter * likely[:, t]
        state = np.where(real[:, t, None], moved / moved.sum(axis=1, keepdims=True), state)
        forward[:, t] = state
    state = behind
    total = np.zeros((len(owner), count))
    each = np.empty_like(likely) if marginals else None
    for t in range(SEGMENT - 1, -1, -1):
        joint = forward[:, t] * state
        joint /= joint.sum(axis=1, keepdims=True)
        total += np.where(real[:, t, None], joint, 0)
        if marginals:
            each[:, t] = joint
        moved = (likely[:, t] * state) @ step.T
        state = np.where(real[:, t, None], moved / moved.sum(axis=1, keepdims=True), state)
    if marginals:
        return each[real]
    return np.add.reduceat(total, begins, axis=0)


class Labeller:
    """Applies a model; remembers the emissions of words it has met."""

    def __init__(self, model: Model) -> None:
        self.model, self.memo = model, {}
        self.table = np.zeros((0, len(model.languages)))

    def _ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.table = {}, self.table[:0]
        new = sorted(set().union(*texts).difference(self.memo))
        letters = [w for w in new if w.isalpha() or any(map(str.isalpha, w))]
        self.memo.update((w, -1) for w in set(new).difference(letters))
        self.memo.update(zip(letters, range(len(self.table), len(self.table) + len(letters))))
        self.table = np.concatenate([self.table, self.model.emissions(letters)])
        found = [np.fromiter(map(self.memo.__getitem__, t), np.int64, len(t)) for t in texts]
        return [x[x >= 0] for x in found]

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its share of each text; (`und`, 0) without letters or languages."""
        ids = self._ids([words(t) for t in texts])
        full = [n for n, x in enumerate(ids) if len(x) and self.model.languages]
        names, shares = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        limit = max(SEGMENT, (1 << 24) // max(1, len(self.model.languages) ** 2) * SEGMENT)
        for part in _groups(full, [len(ids[n]) for n in full], limit):
            lengths = np.array([len(ids[n]) for n in part])
            score = self.table[np.concatenate([ids[n] for n in part])]
            share = label_mass(score, lengths, self.model.transitions, self.model.start) / lengths[:, None]
            for n, best, row in zip(part, share.argmax(axis=1), share):
                names[n], shares[n] = self.model.languages[best], min(1.0, float(row[best]))
        return names, shares

    def label_words(self, text: str) -> list[tuple[str, str]]:
        """Each word of a text with its likeliest language."""
        found = [w for w in words(text) if any(map(str.isalpha, w))]
        if not found or not self.model.languages:
            return [(w, UNDETERMINED) for w in found]
        ids = self._ids([found])[0]
        each = label_mass(self.table[ids], np.array([len(ids)]), self.model.transitions, self.model.start, marginals=True)
        return [(w, self.model.languages[k]) for w, k in zip(found, each.argmax(axis=1))]


def _groups(items: list[int], sizes: list[int], limit: int):
    """Consecutive items of about `limit` words."""
    part, size = [], 0
    for item, words_of_item in zip(items, sizes):
        if part and size + words_of_item > limit:
            yield part
            part, size = [], 0
        part.append(item)
        size += words_of_item
    if part:
        yield part


def fit(documents: DataFrame, learnable: Column, rows: int = SAMPLE_ROWS, characters: int = SAMPLE_CHARACTERS) -> Model:
    """A model of the languages in `lang`, from `rows` learnable texts of each, or all if there
    are fewer: of its different texts those with the smallest hashes. Of a text of more than
    `characters` only so many are read, from its first letter on."""
    labelled = documents.select("text", "lang", learnable.alias("learnable")).filter(
        "learnable AND lang IS NOT NULL AND text IS NOT NULL"
    )
    begin = F.when(F.length("text") > characters, F.regexp_instr("text", F.lit(r"\p{L}"))).otherwise(1)
    labelled = labelled.filter(F.col("text").rlike(r"\p{L}")).select("lang", F.col("text").substr(begin, F.lit(characters)).alias("text"))
    hashed = labelled.select("lang", F.xxhash64("text").alias("hash"))
    counts = {r["lang"]: r["n"] for r in hashed.distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return train([], [])
    # Twice the share that `rows` are, so that chance does not leave too few.
    share = F.create_map(*(F.lit(x) for name, n in counts.items() for x in (name, min(1.0, 2 * rows / n))))
    near = hashed.filter(F.pmod("hash", F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)).distinct().collect()
    chosen = {name: [] for name in counts}
    for name, code in sorted(near, key=lambda r: (r["hash"] % (1 << 30), r["hash"])):
        if len(chosen[name]) < rows:
            chosen[name].append(code)
    wanted = [(name, code) for name, codes in chosen.items() for code in codes]
    listed = small_frame(documents.sparkSession, wanted, hashed.schema)
    picked = labelled.withColumn("hash", F.xxhash64("text")).join(F.broadcast(listed), ["lang", "hash"])
    sample = sorted(map(tuple, picked.select("lang", "text").distinct().collect()))
    return train([words(text) for _, text in sample], [name for name, _ in sample])


def identify(documents: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, lang_pred and score: the language with most of the probability of a text's words,
    and its share. Texts that are NULL or hold no letter are `und` with score 0; so is every
    text when there was nothing to learn from. One row per row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(*keep, *(["text"] if "text" not in keep else []))
    kept = [n for n, c in enumerate(rows.columns) if c in keep]
    schema = rows.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def make():
        labeller = Labeller(shared.value)

        def run(batch: pa.RecordBatch) -> list:
            names, shares = labeller.label(batch.column("text").to_pylist())
            return [*(batch.column(n) for n in kept), names, shares]

        return run

    return map_texts(rows, make, schema)


def keep_identified(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents that have letters and one language with a share of `least` of their words."""
    found = identify(set_aside(documents), model, ("doc_id", "text", "rest"))
    kept = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return put_back(kept, documents.columns)
