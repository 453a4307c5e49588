"""A unigram model over the pieces of a SentencePiece file, with whole-number weights.

A piece of rank r has the probability 1 / ((r + 1) * H), Zipf's law over the order of the file
with H the harmonic sum; its weight is the rounded logarithm in millionths, times 65,536, less
one. Sums of weights are exact whole numbers, so equal scores compare equal however a text is
cut, and of equally likely segmentations the one with fewer pieces wins. Characters outside the
vocabulary become one token per UTF-8 byte.

Pieces hold a word boundary only at their start and none holds a line break beside other
characters, so every segmentation has a boundary before each pre-token: spaces with the word
after them, spaces before a line break, or a line break.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import sentencepiece

#: Where the installed public vocabulary lies.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Millionths of a natural logarithm, and room below them for the number of pieces.
UNIT, ROOM = 1_000_000, 65_536
#: Tokens of a document begin with a space, which decoding takes off again.
PREFIX = " "
PRE_TOKEN = re.compile(r" *[^ \n]+| +|\n")


@dataclass(frozen=True)
class Vocabulary:
    """`nodes` is the pieces' trie: a character leads to the next node, None to the weight and
    the little-endian id of the piece that ends there."""

    weights: dict[str, int]
    reach: dict[str, int]
    nodes: dict
    byte_ids: tuple[int, ...]
    byte_weight: int
    longest: int
    texts: dict[int, bytes]

    def of_character(self, character: str) -> int:
        """The weight of a character that is no piece: that of its bytes."""
        return self.byte_weight * len(character.encode())

    def bytes_of_character(self, character: str) -> tuple[int, bytes]:
        ids = (self.byte_ids[b].to_bytes(4, "little") for b in character.encode())
        return self.of_character(character), b"".join(ids)


def load(path: str = PIECES) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal, byte_ids = [], {}
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            normal.append((i, model.id_to_piece(i).replace("▁", " ")))
    return vocabulary(normal, [byte_ids[b] for b in range(256)])


def vocabulary(pieces: list[tuple[int, str]], byte_ids: list[int]) -> Vocabulary:
    """From (id, text) in the order of their ranks, and the ids of the 256 bytes."""
    for _, text in pieces:
        if " " in text.lstrip(" ") or ("\n" in text and len(text) > 1):
            raise ValueError(f"piece {text!r} crosses pre-tokens")
    total = sum(1 / (r + 1) for r in range(len(pieces)))
    weight = lambda rank: -(round(UNIT * math.log((rank + 1) * total)) * ROOM + 1)
    reach: dict[str, int] = {}
    nodes: dict = {}
    for rank, (i, text) in enumerate(pieces):
        reach[text[0]] = max(reach.get(text[0], 1), len(text))
        node = nodes
        for character in text:
            node = node.setdefault(character, {})
        node[None] = (weight(rank), i.to_bytes(4, "little"))
    texts = {i: text.encode() for i, text in pieces}
    texts |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
    return Vocabulary(
        weights={text: weight(rank) for rank, (_, text) in enumerate(pieces)},
        reach=reach,
        nodes=nodes,
        byte_ids=tuple(byte_ids),
        byte_weight=weight(len(pieces)),
        longest=max((len(text) for _, text in pieces), default=1),
        texts=texts,
    )


def pre_tokens(text: str | None) -> list[str]:
    """NULL and empty texts have none."""
    return PRE_TOKEN.findall(PREFIX + text) if text else []


def segment(words: Iterable[str], vocabulary: Vocabulary) -> Iterator[tuple[int, bytes]]:
    """Score and ids (four bytes each) of the best segmentation of each word; words come sorted.

    Sorted words visit their trie depth first. What a prefix yields, its best scores and the
    pieces begun in it, stays on the path for all words that share it."""
    root = vocabulary.nodes
    best, back, begun, previous = [0], [(0, b"")], [[]], ""
    for word in words:
        shared = 0
        for one, other in zip(previous, word):
            if one != other:
                break
            shared += 1
        del best[shared + 1 :], back[shared + 1 :], begun[shared + 1 :]
        score, open_pieces = best[-1], begun[-1]
        for end in range(shared, len(word)):
            character, found = word[end], []
            node = root.get(character)
            if node is None:
                weight, ids = vocabulary.bytes_of_character(character)
            else:
                weight, ids = node.get(None) or vocabulary.bytes_of_character(character)
            score, step = score + weight, (end, ids)
            for start, node in open_pieces:
                node = node.get(character)
                if node is not None:
                    found.append((start, node))
                    piece = node.get(None)
                    if piece is not None and best[start] + piece[0] > score:
                        score, step = best[start] + piece[0], (start, piece[1])
            node = root.get(character)
            if node is not None:
                found.append((end, node))
            best.append(score)
            back.append(step)
            begun.append(found)
            open_pieces = found
        previous = word
        end, path = len(word), []
        while end:
            end, ids = back[end]
            path.append(ids)
        yield best[-1], b"".join(reversed(path))
