"""Sets of word n-grams of whole texts, as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

#: Bytes of a text whose words are hashed together; a longer text is taken in parts that end at white space.
PART_BYTES = 1 << 20

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_BLANKS = b" \t\n\v\f\r"


def _spread(values: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit numbers in which every bit depends on every other."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _numbers(count: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _spread((np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


_BYTE_VALUES = _numbers(256, 1 << 40)


def _part_hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACES[raw], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    letters = np.flatnonzero(~_SPACES[raw])
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        weighed = _BYTE_VALUES[raw[letters]] * (_numbers(int(lengths.max()), 0) | np.uint64(1))[place]
        return _spread(np.add.reduceat(weighed, first) + lengths.astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word of ``text`` in order; only A-Z are lower-cased, only ASCII white space parts words."""
    data = text.encode("utf-8", "surrogatepass").lower()  # of bytes, only A-Z change
    if len(data) <= PART_BYTES:
        return _part_hashes(data)
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + PART_BYTES)
        while end < len(data) and data[end] not in _BLANKS:
            end += 1
        parts.append(_part_hashes(data[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word n-grams of a whole text; of fewer words, that of all."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    grams = max(1, len(hashes) - width + 1)
    span = min(width, len(hashes))
    mixed = np.full(grams, span, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(span):
            mixed = (mixed ^ hashes[i:i + grams]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    mixed = _spread(mixed)
    mixed.sort()
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]
