"""Best-fit packing of token sequences, improved by swap-based local search.

1. Every text becomes ids, and ids of more than one sequence are cut into full pieces and a rest.
2. Full pieces are sequences of their own. All others are dealt, by a hash of their row number,
   into groups of about GROUP pieces, whatever documents, sources or copies they come from.
3. A group is packed by best fit, longest first. Then the search takes underfull bins, emptiest
   first, and gives their pieces to other underfull bins: a piece moves, one piece is exchanged for
   one, or two for one or one for two. Each step raises the sum of squared fills, so fuller bins
   grow fuller and the search ends. It stops early where a lower bound of the number of bins is
   reached.
4. The emptiest bins of each group are dealt anew into larger mixtures and packed once more, until
   one group is left, so the groups cost no more than one would.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from saleskeep.llm.common import columns, raw_texts, record_batch, text_slices
from saleskeep.workspace import Workspace

CAPACITY = 2048
#: Pieces of a group, on average, and bins of it that are dealt anew.
GROUP, DEALT_ANEW = 4096, 4
#: The id after the last one of a document.
END = 0
#: Entries that a worker remembers before it begins anew, and the bytes up to which one is kept.
MEMO, MEMO_BYTES = 1_000_000, 64
#: Characters whose words are known without the tokenizer's own splitting: printable ASCII and the
#: letters of Latin-1, which are composed and have one lower-case form.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: A text with this may hold a special token, which only the tokenizer reads.
SPECIAL = b"<|"


def _byte_characters() -> dict[int, str]:
    """How byte-level pieces write each byte: printable ones as they are, others from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + n) for n, b in enumerate(hidden)}


class Tokenizer(dict):
    """Texts to little-endian unsigned 32-bit ids, as the tokenizer's file has them. White space
    separates what is tokenised, so each word and each stretch between white space, A-Z in lower
    case, is tokenised once and remembered."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Read

        self.whole = Read.from_file(path)
        self.tokenize = self.whole.model.tokenize
        self.characters = _byte_characters()

    def encode(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.characters)
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def __missing__(self, raw: bytes) -> bytes:
        if raw.isalpha():
            found = self._word(raw.decode())
        elif PLAIN.fullmatch(text := raw.decode()):
            words = WORD.findall(text.lower())
            found = self._word(words[0]) if len(words) == 1 else b"".join([self[w.encode()] for w in words])
        else:
            found = self.encode(text)
        if len(raw) <= MEMO_BYTES:
            self[raw] = found
        return found

    def ids(self, text: bytes | None) -> bytes:
        """NULL is an empty text."""
        if not text:
            return b""
        if SPECIAL in text:
            return self.encode(text.decode())
        if len(self) >= MEMO:
            self.clear()
        return b"".join(map(self.__getitem__, text.lower().split()))


_worker: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a Python worker, which keeps what it knows from task to task."""
    if path not in _worker:
        _worker[path] = Tokenizer(path)
    return _worker[path]


def pieces(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids (unsigned 32-bit, little-endian): the ids of each text
    and END after them, cut every `capacity` ids.

    One row at least per row of `documents`; NULL and empty texts are END alone. A NULL id and
    repeated rows stay as they are; other columns of `documents` take no part."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    schema = columns("doc_id long, piece int, start long, length long, ids binary")
    size, end = 4 * capacity, END.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            for part in text_slices(batch, "text"):
                made = ([], [], [], [], [])
                for doc, text in zip(part.column("doc_id").to_pylist(), raw_texts(part.column("text"))):
                    ids = own.ids(text) + end
                    for number, at in enumerate(range(0, len(ids), size)):
                        cut = ids[at : at + size]
                        for to, value in zip(made, (doc, number, at // 4, len(cut) // 4, cut)):
                            to.append(value)
                yield record_batch(schema, list(made))

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def fewest(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """A lower bound of the bins. For each t: pieces above capacity - t stand alone, other large
    ones never share, and the pieces from t to half the capacity fill what these leave."""
    count = np.bincount(lengths, minlength=capacity + 1)
    many = np.concatenate([[0], np.cumsum(count)])
    total = np.concatenate([[0], np.cumsum(count * np.arange(capacity + 1))])
    t, half = np.arange(capacity // 2 + 1), capacity // 2 + 1
    alone = many[-1] - many[capacity - t + 1]
    large = many[capacity - t + 1] - many[half]
    room = large * capacity - (total[capacity - t + 1] - total[half])
    rest = np.maximum(0, total[half] - total[t] - room)
    return int((alone + large + -(-rest // capacity)).max())


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of places: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: a bin has room r
    for place in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[place])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[bin_].append(place)
        else:
            room, bin_ = capacity, len(bins)
            bins.append([place])
        if room > length:
            by_room[room - length].append(bin_)
            rooms |= 1 << (room - length)
    return bins


class Search:
    """Underfull bins and what each of them can give in return: nothing, a piece, two pieces."""

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], capacity: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.bins = {n: b for n, b in enumerate(bins) if int(lengths[b].sum()) < capacity}
        self.full = [b for n, b in enumerate(bins) if n not in self.bins]
        self.fills: dict[int, int] = {}
        self.returns: dict[int, tuple[np.ndarray, list[tuple[int, ...]]]] = {}
        for n in self.bins:
            self._note(n)

    def _offers(self, n: int) -> list[tuple[int, ...]]:
        """One piece of each length, and two of each two lengths."""
        one: dict[int, int] = {}
        again: dict[int, int] = {}
        for place in self.bins[n]:
            length = int(self.lengths[place])
            if length in one:
                again.setdefault(length, place)
            else:
                one[length] = place
        pairs = [*combinations(one.values(), 2), *((one[x], p) for x, p in again.items())]
        return [(p,) for p in one.values()] + pairs

    def _note(self, n: int) -> None:
        self.fills[n] = int(self.lengths[self.bins[n]].sum())
        offers = [(), *self._offers(n)]
        self.returns[n] = np.array([int(self.lengths[list(o)].sum()) for o in offers]), offers

    def step(self, source: int) -> bool:
        """The exchange out of `source` that raises the squared fills most; False without one."""
        others = [n for n in self.bins if n != source]
        if not others:
            return False
        sizes = [len(self.returns[n][0]) for n in others]
        back = np.concatenate([self.returns[n][0] for n in others])
        pair = np.concatenate([np.array([len(o) == 2 for o in self.returns[n][1]]) for n in others])
        fill = np.repeat([self.fills[n] for n in others], sizes)
        own, best, found = self.fills[source], 0, None
        for amount, offer in zip(*self.returns[source]):
            if not offer:
                continue
            moved = amount - back
            usable = (moved > 0) & (moved <= self.capacity - fill)
            if len(offer) == 2:
                usable &= ~pair & (back > 0)
            gain = np.where(usable, moved * (fill - own + moved), 0)
            at = int(gain.argmax())
            if gain[at] > best:
                best, found = int(gain[at]), (offer, at)
        if found is None:
            return False
        offer, at = found
        which = int(np.searchsorted(np.cumsum(sizes), at, side="right"))
        target = others[which]
        taken = self.returns[target][1][at - sum(sizes[:which])]
        self.bins[source] = [p for p in self.bins[source] if p not in offer] + list(taken)
        self.bins[target] = [p for p in self.bins[target] if p not in taken] + list(offer)
        for n in (source, target):
            self._note(n)
        if self.fills[target] == self.capacity:
            self._drop(target, self.full)
        return True

    def _drop(self, n: int, to: list[list[int]] | None = None) -> None:
        if to is not None:
            to.append(self.bins[n])
        for of in (self.bins, self.fills, self.returns):
            of.pop(n, None)

    def run(self, least: int) -> list[list[int]]:
        """Empties bins until `least` are left or no exchange helps."""
        going = True
        while going and len(self.full) + len(self.bins) > least:
            going = False
            for source in sorted(self.bins, key=lambda n: self.fills[n]):
                while source in self.bins and self.bins[source] and self.step(source):
                    going = True
                if source in self.bins and not self.bins[source]:
                    self._drop(source)
                if len(self.full) + len(self.bins) <= least:
                    break
        return self.full + list(self.bins.values())


def pack_group(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of places, each of `capacity` at most."""
    bins = best_fit(lengths, capacity)
    least = fewest(lengths, capacity)
    return bins if len(bins) <= least else Search(lengths, bins, capacity).run(least)


def _pack_groups(rows: DataFrame, groups: int, capacity: int) -> DataFrame:
    """`rows` with sequence_id (the smallest row number of the bin), offset and `anew`: whether the
    row's bin is one of its group's emptiest."""
    added = [StructField("sequence_id", LongType()), StructField("offset", LongType()), StructField("anew", LongType())]
    schema = StructType([*rows.schema.fields, *added])
    names, arrow = rows.columns, to_arrow_schema(schema)

    def pack(group: pa.Table) -> pa.Table:
        lengths, keys = group.column("length").to_numpy(), group.column("key").to_numpy()
        bins = pack_group(lengths, capacity)
        fills = np.array([lengths[b].sum() for b in bins])
        emptiest = [n for n in np.argsort(fills, kind="stable")[:DEALT_ANEW].tolist() if fills[n] < capacity]
        made = np.zeros((3, len(lengths)), np.int64)
        for n, places in enumerate(bins):
            sizes = lengths[places]
            made[:, places] = np.stack([np.full(len(places), keys[places].min()), np.cumsum(sizes) - sizes, np.zeros(len(places), np.int64)])
            made[2, places] = n in emptiest
        parts = [group.column(c).cast(arrow.field(c).type) for c in names] + [pa.array(x) for x in made]
        return pa.Table.from_arrays(parts, schema=arrow)

    dealt = rows.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(lambda group: pack(group.select(names)), schema)


def pack(pieces: DataFrame, workspace: Workspace, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """`pieces` with sequence_id and offset: where each piece lies. No sequence is longer than
    `capacity`, and its pieces follow each other from 0 without gaps.

    Reads the column `length` (1 to `capacity`); all others travel along, whatever their names. Rows
    without a length, or with one of another size, are an error. Repeated rows are pieces each. An
    empty table gives an empty one."""
    spark, names = pieces.sparkSession, pieces.columns
    length = F.col("length").cast("long")
    checked = F.when(length.between(1, capacity), length).otherwise(
        F.raise_error(F.lit(f"a piece's length has to be from 1 to {capacity}")).cast("long")
    )
    numbered = pieces.select(
        F.monotonically_increasing_id().alias("key"), checked.alias("length"), F.struct(*(F.col(f"`{c}`") for c in names)).alias("rest")
    )
    rows = workspace.keep(numbered, "pieces")
    done = [rows.filter(F.col("length") == capacity).select("rest", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    waiting = rows.filter(F.col("length") < capacity)
    while count := waiting.count():
        groups = -(-count // group)
        packed = workspace.keep(_pack_groups(waiting, groups, capacity), "packed")
        settled = packed if groups == 1 else packed.filter("anew = 0")
        done.append(settled.select("rest", "sequence_id", "offset"))
        if groups == 1:
            break
        waiting = packed.filter("anew = 1").select("key", "length", "rest")
    placed = done[0]
    for part in done[1:]:
        placed = placed.union(part)
    return placed.select(*(F.col(f"rest.`{c}`").alias(c) for c in names), "sequence_id", "offset")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids and spans (doc_id, piece, offset, length): the packed sequences, from placed
    pieces that carry their ids. A sequence is a group of `capacity` ids at most."""
    part = F.struct("offset", "doc_id", "piece", "length", "ids")
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    spans = F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["offset"].alias("offset"), p["length"].alias("length")))
    joined = F.aggregate("parts", F.lit(b""), lambda seen, p: F.concat(seen, p["ids"]))
    return parts.select("sequence_id", joined.alias("ids"), spans.alias("spans"))
