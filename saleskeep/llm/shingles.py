"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def coded_words(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of the texts, A-Z in lower case, of all words in a row their places among
    these, and the number of words of each text."""
    if not any(texts):
        return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.string())))
    lengths = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().view(pa.binary()).dictionary_encode()
    ends = np.cumsum(pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False), dtype=np.int64).tolist()
    data = coded.dictionary.buffers()[2].to_pybytes()
    words = [data[a:b] for a, b in zip([0, *ends], ends)]
    places = coded.indices.to_numpy().astype(np.int64)
    if b"" in words:  # what stands before the first white space or after the last
        empty = words.index(b"")
        full = places != empty
        lengths -= np.bincount(np.repeat(np.arange(len(lengths)), lengths)[~full], minlength=len(lengths))
        places = places[full]
        places -= places > empty
        del words[empty]
    return words, places, lengths


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, A-Z in lower case, and the number of words of each."""
    words, places, lengths = coded_words(texts)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[places], lengths


def shingle_sets(texts: list[bytes | None], size: int = WORDS) -> list[np.ndarray]:
    """For each text its distinct shingles, sorted; a text of fewer words is one shingle."""
    words, lengths = word_hashes(texts)
    rolled = np.full(len(words), np.uint64(size))
    for n in range(size):
        part = words[n : len(words) - size + 1 + n] if len(words) >= size else words[:0]
        rolled[: len(part)] = _mixed(rolled[: len(part)] + part)
    sets, start = [], 0
    for length in lengths:
        if length >= size:
            sets.append(np.unique(rolled[start : start + length - size + 1]))
        elif length:
            code = np.full(1, np.uint64(length))
            for word in words[start : start + length]:
                code = _mixed(code + word)
            sets.append(code)
        else:
            sets.append(words[:0])
        start += length
    return sets


def digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())
