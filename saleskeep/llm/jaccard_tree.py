"""Exact Jaccard join of shingle sets with signature trees.

1. Texts with equal sets are one class, which gets a number (`key`) in a written table. Copies
   are never compared, and rows of different texts that share an id are never mixed up.
2. A set can only be linked if enough of its shingles (80 of 100) occur in other classes.
   Shingles go to buckets of a fixed size, packed: a shingle that two classes of one slice of
   the input hold is settled there and sent once. Each bucket counts the shingles that a class
   has to itself; most classes fall out here.
3. Of the sets left, linked pairs share one of their rarest shingles (the prefix that a pair
   below the threshold may miss, and one more). Sets that share such a shingle, directly or
   through others, are a block. A block too large for one task is cut into parts, and each pair
   of parts is a unit of work of bounded size; a block of some size has a unit to itself.
4. In a unit the sets form a signature tree. A node holds the union of the token bitmaps of its
   sets, the range of their sizes and the most tokens that fell on taken bits. Two trees are
   traversed together: a pair of nodes is left when its largest possible overlap, the common
   bits and taken ones, cannot reach the threshold for its smallest sizes. Pairs of leaves are
   compared by their bitmaps, then exactly, all pairs of sets of two leaves at a time.
5. Every link is found. A unit returns how many documents each set is linked with and, instead
   of all pairs, the links that connect what the links connect; these make components.

Nothing is capped, and no step needs all sets, links or components in one place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleskeep.llm.common import SLICE_BYTES, columns, joined, map_texts, raw_texts, record_batch, small_batches
from saleskeep.llm.graph import components
from saleskeep.llm.shingles import digest, shingle_sets
from saleskeep.workspace import Workspace

#: A pair is linked when PERCENT of its union, at least, is common.
PERCENT = 80
#: Shingles of a bucket, and of a unit of work, on average.
BUCKET_TOKENS, UNIT_TOKENS = 4_000_000, 500_000
#: Small blocks share a unit; a block above this part of a unit has one to itself.
OWN_UNIT = 8
LEAF, FAN = 32, 8
#: Bytes of text whose sets a task holds at a time, and of a batch that Spark sends to Python. The
#: latter is one slice of postings.
PART_BYTES, BATCH_BYTES = SLICE_BYTES // 4, SLICE_BYTES // 16 * 15
#: Tokens that two leaves are compared on at a time.
STRIP = 65_536
BITS_PER_TOKEN, FEWEST_BITS, MOST_BITS = 4, 256, 8_192


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def _signatures(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest (NULL for an empty set)."""
    rows = _rows(documents)

    def make():
        def run(batch: pa.RecordBatch) -> list:
            sets = shingle_sets(raw_texts(batch.column("text")))
            digests = [digest(s) if len(s) else None for s in sets]
            return [batch.column("doc_id"), batch.column("text_hash"), [len(s) for s in sets], digests]

        return run

    return map_texts(rows, make, "doc_id long, text_hash long, n_shingles long, digest binary", limit=PART_BYTES)


POSTINGS = columns("bucket int, owners binary, counts binary, tokens binary, settled binary")


def pack(bucket: np.ndarray, owner: np.ndarray, token: np.ndarray, ids: np.ndarray, buckets: int, settled=None) -> list:
    """Postings as one row per bucket: owners' ids, how many tokens each has there, the tokens."""
    order = np.lexsort((owner, bucket))
    bucket, owner, token = bucket[order], owner[order], token[order]
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = [[], [], [], [], []]
    for b in range(buckets):
        part = slice(edges[b], edges[b + 1])
        own, count = np.unique(owner[part], return_counts=True)
        extra = settled[1][settled[0] == b] if settled is not None else token[:0]
        if len(own) or len(extra):
            for column, value in zip(rows, (b, ids[own].tobytes(), count.astype(np.uint32).tobytes(), token[part].tobytes(), extra.tobytes())):
                column.append(value)
    return rows


def _slice_postings(texts: list[bytes | None], buckets: int) -> list:
    """Each class of a slice once. A token is its high 32 bits in the bucket of its low ones: if
    two meet by chance, a shingle counts as shared that is not, and only costs time later."""
    classes = {digest(s): s for s in shingle_sets(texts) if len(s)}
    if not classes:
        return [[], [], [], [], []]
    ids = np.frombuffer(b"".join(classes), "V16")
    sets = list(classes.values())
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    first = np.concatenate([[True], every[1:] != every[:-1]])
    start = np.flatnonzero(first)
    size = np.diff(np.concatenate([start, [len(every)]]))
    bucket, high = (every % np.uint64(buckets)).astype(np.int32), (every >> np.uint64(32)).astype(np.uint32)
    alone, shared = start[size == 1], start[size > 1]
    return pack(bucket[alone], owner[alone], high[alone], ids, buckets, (bucket[shared], high[shared]))


def _unique_counts(table: pa.Table) -> pa.Table:
    """(digest, n): of each class in a bucket the tokens that no other class holds."""
    ids = joined(table.column("owners"), np.uint64).reshape(-1, 2)
    order = np.lexsort((ids[:, 1], ids[:, 0]))
    ids = ids[order]
    new = np.append(True, (ids[1:] != ids[:-1]).any(axis=1))[: len(ids)]
    who, names = np.empty(len(order), np.uint32), ids[new]
    who[order] = np.cumsum(new) - 1
    del ids, order, new
    # Only one array of all tokens, sorted in place: a bucket holds millions. Settled tokens have
    # an owner of their own.
    token, settled = joined(table.column("tokens"), np.uint32), joined(table.column("settled"), np.uint32)
    pair = np.concatenate([token, settled], dtype=np.uint64)
    pair <<= np.uint64(32)
    pair[: len(token)] |= np.repeat(who, joined(table.column("counts"), np.uint32))
    pair[len(token) :] |= np.uint64(len(names))
    del token, settled, who
    pair.sort()
    pair = pair[np.append(True, pair[1:] != pair[:-1])[: len(pair)]]
    token = (pair >> np.uint64(32)).astype(np.uint32)
    first = np.append(True, token[1:] != token[:-1])[: len(token)]
    del token
    pair = pair[first & np.append(first[1:], True)[: len(first)]]
    pair &= np.uint64(0xFFFFFFFF)
    found = np.bincount(pair.astype(np.int64), minlength=len(names))[: len(names)]
    some = found > 0
    digests = pa.Array.from_buffers(pa.binary(16), int(some.sum()), [None, pa.py_buffer(names[some].tobytes())])
    return pa.table({"digest": digests.cast(pa.binary()), "n": pa.array(found[some].astype(np.int64))})


def _candidates(documents: DataFrame, classes: DataFrame, workspace: Workspace) -> DataFrame:
    """The classes with enough shingles in other classes."""
    spark = documents.sparkSession
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(2 * spark.sparkContext.defaultParallelism, -(-total // BUCKET_TOKENS))

    def make():
        return lambda batch: _slice_postings(raw_texts(batch.column("text")), buckets)

    postings = map_texts(documents.filter("doc_id IS NOT NULL").select("text"), make, POSTINGS)
    own = postings.groupBy("bucket").applyInArrow(_unique_counts, "digest binary, n long")
    own = own.groupBy("digest").agg(F.sum("n").alias("own"))
    kept = classes.join(own, "digest", "left").filter(
        (F.col("n_shingles") - F.coalesce("own", F.lit(0))) * 100 >= F.col("n_shingles") * PERCENT
    )
    return workspace.keep(kept.drop("own"), "candidates")


def _sets(documents: DataFrame, candidates: DataFrame, workspace: Workspace) -> DataFrame:
    """key, weight (rows of the class), n, tokens (packed, sorted) of the candidates, each once."""
    wanted = candidates.select(
        F.col("first.*"), "key", F.col("class_size").alias("weight"), F.col("digest").alias("wanted")
    )
    rows = _rows(documents).join(wanted.hint("shuffle_hash"), ["doc_id", "text_hash"])

    def make():
        def run(batch: pa.RecordBatch) -> list:
            sets = shingle_sets(raw_texts(batch.column("text")))
            same = [digest(s) == w for s, w in zip(sets, batch.column("wanted").to_pylist())]
            return [
                batch.column("key").filter(pa.array(same)), batch.column("weight").filter(pa.array(same)),
                [len(s) for s, k in zip(sets, same) if k],
                [s.tobytes() for s, k in zip(sets, same) if k],
            ]

        return run

    found = map_texts(rows, make, "key long, weight long, n long, tokens binary", limit=PART_BYTES)
    # The same id and text may stand on several rows.
    return workspace.keep(found.dropDuplicates(["key"]), "sets")


def _frequencies(table: pa.Table) -> pa.Table:
    """(key, tokens, df): the tokens of each set in a bucket with the number of sets that hold
    them, without those that one set holds alone."""
    ids, number = joined(table.column("owners"), np.int64), joined(table.column("counts"), np.uint32)
    token = joined(table.column("tokens"), np.uint64)
    order = np.argsort(token)
    ordered = token[order]
    start = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    sizes = np.diff(np.append(start, len(ordered))).astype(np.uint32)
    df = np.empty(len(order), np.uint32)
    df[order] = np.repeat(sizes, sizes)
    del order, ordered, start, sizes
    shared = df > 1
    owner = np.repeat(np.arange(len(ids), dtype=np.uint32), number)[shared]
    token, df = token[shared], df[shared]
    some, start = np.unique(owner, return_index=True)
    ends = np.concatenate([start[1:], [len(owner)]])
    return pa.table({
        "key": pa.array(ids[some]),
        "shared": pa.array([token[a:b].tobytes() for a, b in zip(start, ends)], pa.binary()),
        "df": pa.array([df[a:b].tobytes() for a, b in zip(start, ends)], pa.binary()),
    })


def _prefixes(sets: DataFrame) -> DataFrame:
    """(key, token): the rarest shingles of each set that other sets share, as many as a linked
    set may lack and one more, counting first those it has alone."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    buckets = max(2 * sets.sparkSession.sparkContext.defaultParallelism, -(-total // BUCKET_TOKENS))
    response = columns("key long, shared binary, df binary")
    keys = columns("key long, token long")

    def spread(batches):
        for batch in batches:
            tokens = [np.frombuffer(t, np.uint64) for t in batch.column("tokens").to_pylist()]
            if tokens:
                every = np.concatenate(tokens)
                owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
                bucket = (every % np.uint64(buckets)).astype(np.int32)
                ids = batch.column("key").to_numpy()
                yield record_batch(POSTINGS, pack(bucket, owner, every, ids, buckets))

    def choose(batches):
        for batch in batches:
            owners, found = [], []
            for key, n, parts in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "parts"))):
                token = np.frombuffer(b"".join(p["shared"] for p in parts), np.uint64)
                df = np.frombuffer(b"".join(p["df"] for p in parts), np.uint32)
                need = -(-n * PERCENT // 100)
                size = (n - need + 1) - (n - len(token))
                if size > 0:
                    rarest = token[np.lexsort((token, df))[:size]]
                    owners.append(np.full(len(rarest), key))
                    found.append(rarest.view(np.int64))
            if owners:
                yield record_batch(keys, [np.concatenate(owners), np.concatenate(found)])

    answered = sets.select("key", "tokens").mapInArrow(spread, POSTINGS).groupBy("bucket").applyInArrow(_frequencies, response)
    whole = answered.groupBy("key").agg(F.collect_list(F.struct("shared", "df")).alias("parts"))
    return whole.join(sets.select("key", "n"), "key").select("key", "n", "parts").mapInArrow(choose, keys)


def _blocks(sets: DataFrame, workspace: Workspace) -> DataFrame:
    """(id, component): sets that share a prefix shingle, directly or through others."""
    keys = workspace.keep(_prefixes(sets), "prefixes")
    hubs = keys.groupBy("token").agg(F.min("key").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    edges = keys.join(hubs.select("token", "hub"), "token").select(F.col("key").alias("a"), F.col("hub").alias("b"))
    return components(edges, workspace)


class Tree:
    """A signature tree over sets in a given order: levels of nodes, leaves of sets first."""

    def __init__(self, sets: list[np.ndarray], bits: int) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.words = np.zeros((len(sets), bits // 64), np.uint64)
        for row, tokens in zip(self.words, sets):
            marks = np.zeros(bits, np.uint8)
            marks[(tokens >> np.uint64(20)).astype(np.int64) & (bits - 1)] = 1
            row[:] = np.packbits(marks, bitorder="little").view(np.uint64)
        self.excess = self.sizes - np.bitwise_count(self.words).sum(axis=1, dtype=np.int64)
        self.levels = [(self.words, self.sizes, self.sizes, self.excess)]
        self.spans = [np.arange(len(sets) + 1)]
        step = LEAF
        while len(self.levels[-1][0]) > 1:
            words, low, high, excess = self.levels[-1]
            at = np.arange(0, len(words), step)
            self.levels.append((
                np.bitwise_or.reduceat(words, at), np.minimum.reduceat(low, at),
                np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at),
            ))
            self.spans.append(np.concatenate([self.spans[-1][at], self.spans[-1][-1:]]))
            step = FAN

    def children(self, level: int, node: int) -> range:
        step = LEAF if level == 1 else FAN
        return range(node * step, min((node + 1) * step, len(self.levels[level - 1][0])))


def reachable(one: tuple, other: tuple, rows, cols) -> np.ndarray:
    """For each pair of nodes, whether its largest possible overlap reaches the threshold."""
    words, low, high, excess = (x[rows] for x in one)
    words_2, low_2, high_2, excess_2 = (x[cols] for x in other)
    common = np.bitwise_count(words[:, None, :] & words_2[None, :, :]).sum(axis=2, dtype=np.int64)
    overlap = np.minimum(common + np.minimum(excess[:, None], excess_2[None, :]), np.minimum(high[:, None], high_2[None, :]))
    return overlap * (100 + PERCENT) >= PERCENT * (low[:, None] + low_2[None, :])


class Sets:
    """Which sets are known to be connected."""

    def __init__(self, count: int) -> None:
        self.parent = list(range(count))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x


def overlaps(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of `one` has in common with each of `other`."""
    tokens, place = np.unique(np.concatenate(one), return_inverse=True)
    theirs = np.concatenate(other)
    place_2 = np.minimum(np.searchsorted(tokens, theirs), len(tokens) - 1)
    held = tokens[place_2] == theirs
    owner = np.repeat(np.arange(len(one)), [len(s) for s in one])
    owner_2, place_2 = np.repeat(np.arange(len(other)), [len(s) for s in other])[held], place_2[held]
    common = np.zeros((len(one), len(other)), np.int64)
    for start in range(0, len(tokens), STRIP):
        width = min(STRIP, len(tokens) - start)
        marks = []
        for count, rows, columns_ in ((len(one), owner, place), (len(other), owner_2, place_2)):
            inside = (columns_ >= start) & (columns_ < start + width)
            mark = np.zeros((count, width), np.float32)
            mark[rows[inside], columns_[inside] - start] = 1
            marks.append(mark)
        common += (marks[0] @ marks[1].T).astype(np.int64)
    return common


def linked_pairs(one: list[np.ndarray], other: list[np.ndarray], near: np.ndarray) -> np.ndarray:
    """Of the near pairs, those that are linked."""
    found = np.zeros(near.shape, bool)
    rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    if len(rows):
        sizes, sizes_2 = (np.array([len(s) for s in sets]) for sets in (one, other))
        common = overlaps([one[i] for i in rows], [other[j] for j in cols])
        union = sizes[rows][:, None] + sizes_2[cols][None, :] - common
        found[np.ix_(rows, cols)] = 100 * common >= PERCENT * union
    return found & near


def join_block(sets: list[np.ndarray], side: np.ndarray, weights: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that connect whatever the links between the sets connect, and for each set the
    weights of all sets that it is linked with. Sides 1 and 2: only pairs across them are looked
    at; all sides 0: all pairs."""
    own = not side.any()
    if not own and len(np.unique(side)) < 2:
        return [], np.zeros(len(sets), np.int64)
    largest = max(map(len, sets))
    bits = FEWEST_BITS
    while bits < min(MOST_BITS, BITS_PER_TOKEN * largest):
        bits *= 2
    order = sorted(range(len(sets)), key=lambda n: (side[n], int(sets[n][0]), len(sets[n])))
    halves = [np.array([n for n in order if side[n] == s]) for s in np.unique(side)]
    trees = [Tree([sets[n] for n in half], bits) for half in halves]
    left, right = trees[0], trees[-1]
    names, others = halves[0], halves[-1]
    known, links, weight = Sets(len(sets)), [], np.zeros(len(sets), np.int64)
    pending = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
    while pending:
        level, node, level_2, node_2 = pending.pop()
        if own and level == level_2 and node > node_2:
            continue
        if max(level, level_2) > 1:
            down = level >= level_2, level_2 >= level
            first = list(left.children(level, node)) if down[0] else [node]
            second = list(right.children(level_2, node_2)) if down[1] else [node_2]
            level, level_2 = level - down[0], level_2 - down[1]
            near = reachable(left.levels[level], right.levels[level_2], first, second)
            pending += [(level, first[i], level_2, second[j]) for i, j in zip(*np.nonzero(near))]
            continue
        rows, cols = left.spans[level][[node, node + 1]], right.spans[level_2][[node_2, node_2 + 1]]
        near = reachable(left.levels[0], right.levels[0], slice(*rows), slice(*cols))
        alike = own and node == node_2
        if alike:
            near &= ~np.eye(len(near), dtype=bool)
        one, other = names[slice(*rows)], others[slice(*cols)]
        found = linked_pairs([sets[n] for n in one], [sets[n] for n in other], near)
        weight[one] += found @ weights[other]
        if not alike:
            weight[other] += weights[one] @ found
        tops, tops_2 = (np.array([known.find(int(n)) for n in part]) for part in (one, other))
        for i, j in zip(*np.nonzero(found & (tops[:, None] != tops_2[None, :]))):
            a, b = int(one[i]), int(other[j])
            if known.find(a) != known.find(b):
                known.parent[known.find(a)] = known.find(b)
                links.append((a, b))
    return links, weight


LINKS = columns("a long, b long, weight long")


def _join_unit(table: pa.Table) -> pa.Table:
    """The links of a unit: of many small blocks, or of one pair of parts of a large block. A row
    with a = b holds the weight of all links of a."""
    found = []
    rows = zip(*(table.column(c).to_pylist() for c in ("block", "side", "key", "tokens", "weight")))
    rows = sorted(rows, key=lambda r: r[:3])
    start = 0
    for end in range(1, len(rows) + 1):
        if end == len(rows) or rows[end][0] != rows[start][0]:
            group = rows[start:end]
            if len(group) > 1:
                keys = [r[2] for r in group]
                links, weight = join_block(
                    [np.frombuffer(r[3], np.uint64) for r in group], np.array([r[1] for r in group]), np.array([r[4] for r in group])
                )
                found += [(keys[i], keys[j], 0) for i, j in links]
                found += [(key, key, w) for key, w in zip(keys, weight.tolist()) if w]
            start = end
    return pa.table({c: pa.array([r[n] for r in found], pa.int64()) for n, c in enumerate(("a", "b", "weight"))})


def _links(sets: DataFrame, blocks: DataFrame, workspace: Workspace) -> DataFrame:
    """(a, b, weight): links between classes that connect what all links connect and, where
    a = b, the documents that class a is linked with in one unit."""
    members = sets.join(blocks.select(F.col("id").alias("key"), F.col("component").alias("block")), "key")
    sizes = members.groupBy("block").agg(F.sum("n").alias("volume"))
    sizes = sizes.withColumn("parts", F.ceil(F.col("volume") / UNIT_TOKENS))
    whole = sizes.agg(F.sum("volume")).first()[0] or 0
    bins = max(2 * sets.sparkSession.sparkContext.defaultParallelism, -(-whole // UNIT_TOKENS))
    members = members.join(sizes, "block")
    part = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    split = members.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    unit = F.when(F.col("volume") * OWN_UNIT < UNIT_TOKENS, F.pmod(F.xxhash64("block"), F.lit(bins))).otherwise(
        F.xxhash64("block", low, high)
    )
    side = F.when(low == high, 0).when(F.col("part") == low, 1).otherwise(2)
    units = split.select(unit.alias("unit"), "block", side.alias("side"), "key", "tokens", "weight")
    return workspace.keep(units.groupBy("unit").applyInArrow(_join_unit, LINKS), "links")


def near_copies(documents: DataFrame, workspace: Workspace) -> DataFrame:
    """doc_id, n_shingles, component_id, class_size, n_links: one row per row of `documents`.

    Two texts are linked when the share of common distinct 5-word shingles is 80 of 100 or more;
    component_id is the smallest id that links reach; class_size counts the rows with an equal
    set, n_links all other rows that the row is linked with, those of its class included. A text
    without words, and a NULL one, has an empty set, class size 1, no link and is its own
    component. A row without an id takes no part and has no component, size or number of links.
    An id on several rows is judged by each row's text."""
    with small_batches(documents.sparkSession, BATCH_BYTES):
        signed = workspace.keep(_signatures(documents), "signatures")
        classes = signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("n_shingles").alias("n_shingles"),
            F.count("*").alias("class_size"),
        )
        # The numbers hold because the table is written.
        classes = workspace.keep(classes.withColumn("key", F.monotonically_increasing_id()), "classes")
        sets = _sets(documents, _candidates(documents, classes, workspace), workspace)
        links = _links(sets, _blocks(sets, workspace), workspace)
    found = components(links.select("a", "b"), workspace).select(F.col("id").alias("key"), "component")
    counted = links.filter("a = b").groupBy(F.col("a").alias("key")).agg(F.sum("weight").alias("linked"))
    placed = classes.join(found, "key", "left").join(counted, "key", "left").select(
        "digest", "class_size", F.col("first.doc_id").alias("rep"), F.coalesce("component", "key").alias("component"),
        (F.coalesce("linked", F.lit(0)) + F.col("class_size") - 1).alias("n_links"),
    )
    least = placed.groupBy("component").agg(F.min("rep").alias("least"))
    named = workspace.keep(placed.join(least, "component").select("digest", "class_size", "least", "n_links"), "named")
    own = F.col("doc_id").isNotNull()
    return signed.join(named, "digest", "left").select(
        "doc_id", "n_shingles",
        F.when(own, F.coalesce("least", "doc_id")).alias("component_id"),
        F.when(own, F.coalesce("class_size", F.lit(1))).alias("class_size"),
        F.when(own, F.coalesce("n_links", F.lit(0))).alias("n_links"),
    )


def keep_first(documents: DataFrame, workspace: Workspace) -> DataFrame:
    """One document of each component, that with the smallest id, and every row without an id.
    Of several rows with that id the one with the smallest text stays."""
    found = near_copies(documents, workspace)
    stays = found.filter("doc_id = component_id").select("doc_id").distinct()
    kept = documents.join(stays, "doc_id", "left_semi")
    several = documents.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    several = workspace.keep(several, "several")
    names = [F.col(f"`{c}`") for c in documents.columns]
    if not several.isEmpty():
        first = F.min_by(F.struct(*names), F.struct("text")).alias("row")
        chosen = kept.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(first)
        chosen = chosen.select(*(F.col(f"row.`{c}`").alias(c) for c in documents.columns))
        kept = kept.join(several, "doc_id", "left_anti").select(*names).union(chosen)
    return kept.select(*names).union(documents.filter("doc_id IS NULL"))
