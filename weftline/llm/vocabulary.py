"""A byte-level BPE vocabulary file and the split of texts that precedes its merges.

Everything here is small per-process state of a task: the vocabulary (bounded by its
file) and bounded memo tables. The file's path is a parameter; every executor reads it
from its own installation.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex

# The split pattern of this vocabulary family, and its one added token.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# End of fixed values.

_pattern = regex.compile(SPLIT_PATTERN)

NO_RANK = np.int32(1 << 30)

#: Slots of the table of pairs, as a power of two; at most a quarter of them are used.
SLOT_BITS = 18

#: Entries a memo table may hold before it starts anew; frequent words refill it at once.
MEMO_ENTRIES = 150_000


def _byte_characters() -> dict[str, int]:
    """Character of each byte: printable bytes stand for themselves, the rest are numbered from 256."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Vocabulary:
    """Tokens by bytes, bytes by id, and the rank and result of every merge."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = _byte_characters()
        as_bytes = {name: bytes(byte_of[c] for c in name) for name in spec["model"]["vocab"]}
        self.id_of = {as_bytes[name]: i for name, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.added.items():
            self.bytes_of[i] = content.encode()
            self.id_of.pop(content.encode(), None)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (as_bytes[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.merges[self.id_of[left], self.id_of[right]] = (rank, self.id_of[left + right])
        self.made_by = {made: (rank, *pair) for pair, (rank, made) in self.merges.items()}
        self.byte_ids = [self.id_of[bytes([b])] for b in range(256)]
        self.byte_table = np.array(self.byte_ids, np.int32)
        self.merge_results = np.array([made for _, made in self.merges.values()], np.int32)
        # Pairs by one number: ids of these vocabularies are below 2^16, which packing relies on too.
        if max(self.bytes_of) >= 1 << 16:
            raise ValueError("vocabularies of 65,536 or more tokens are not supported")
        keys = np.array([(left << 16) | right for left, right in self.merges], np.uint32)
        order = np.argsort(keys)
        self.pair_ranks = order.astype(np.int32)
        self.pair_keys = keys[order]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def split_words(text: str) -> list[str]:
    """The pieces of ``text`` within which merges may happen."""
    if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
        return [text]  # letters only, after a space or not
    return _pattern.findall(text)


def _byte_characters() -> dict[str, int]:
    """Character of each byte: printable bytes stand for themselves, the rest are numbered from 256."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(hidden)}


class PairTable:
    """Ranks of pairs of ids by a perfect hash: any pair is looked for in one slot only.

    The upper bits of a pair's hash name its group, the lower ones a slot, which the group's
    shift (found by trial, until no two pairs share a slot) moves. The hash is one to one,
    so pairs of one group never meet.
    """

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        self._shifts = np.zeros(1 << (32 - SLOT_BITS), np.uint32)
        self._keys = np.zeros(1 << SLOT_BITS, np.uint32)
        self._ranks = np.full(1 << SLOT_BITS, NO_RANK)
        group, low = self._hashed(keys)
        random = np.random.default_rng(0)
        taken, claim = np.zeros(1 << SLOT_BITS, bool), np.empty(1 << SLOT_BITS, group.dtype)
        left = np.arange(len(keys))
        while len(left):
            tried = np.unique(group[left])
            self._shifts[tried] = random.integers(1 << SLOT_BITS, size=len(tried))
            slot = low[left] ^ self._shifts[group[left]]
            claim[slot] = group[left]
            met = np.zeros(len(self._shifts), bool)
            met[group[left][taken[slot] | (claim[slot] != group[left])]] = True
            fits = ~met[group[left]]
            taken[slot[fits]] = True
            self._keys[slot[fits]], self._ranks[slot[fits]] = keys[left[fits]], ranks[left[fits]]
            left = left[~fits]

    @staticmethod
    def _hashed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashed = keys * np.uint32(2654435769)
        return hashed >> np.uint32(SLOT_BITS), hashed & np.uint32((1 << SLOT_BITS) - 1)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NO_RANK`` where it cannot merge; symbols below 0 never merge."""
        keys = (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)
        group, low = self._hashed(keys)
        slot = low ^ self._shifts[group]
        return np.where((self._keys[slot] == keys) & ((left | right) >= 0), self._ranks[slot], NO_RANK)


class Vocabulary:
    """Tokens by bytes, bytes by id, and the rank and result of every merge."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = _byte_characters()
        as_bytes = {name: bytes(byte_of[c] for c in name) for name in spec["model"]["vocab"]}
        self.id_of = {as_bytes[name]: i for name, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.added.items():
            self.bytes_of[i] = content.encode()
            self.id_of.pop(content.encode(), None)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (as_bytes[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.merges[self.id_of[left], self.id_of[right]] = (rank, self.id_of[left + right])
        self.made_by = {made: (rank, *pair) for pair, (rank, made) in self.merges.items()}
        self.byte_ids = [self.id_of[bytes([b])] for b in range(256)]
        self.byte_table = np.array(self.byte_ids, np.int32)
        self.merge_results = np.array([made for _, made in self.merges.values()], np.int32)
        # Pairs by one number: ids of these vocabularies are below 2^16, which packing relies on too.
        if max(self.bytes_of) >= 1 << 16:
            raise ValueError("vocabularies of 65,536 or more tokens are not supported")
        keys = np.array([(left << 16) | right for left, right in self.merges], np.uint32)
        self.pairs = PairTable(keys, np.arange(len(keys), dtype=np.int32))
        # Of two bytes, by the first one times 256 plus the second.
        left, right = np.divmod(np.arange(1 << 16), 256)
        self.byte_pair_ranks = self.pairs.ranks_of(self.byte_table[left], self.byte_table[right])


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def split_words(text: str) -> list[str]:
    """The pieces of ``text`` within which merges may happen."""
    if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
        return [text]  # letters only, after a space or not
    return _pattern.findall(text)


def iterate_words(text: str) -> Iterator[str]:
    """The same pieces one by one, for readers that may stop early."""
    return (match[0] for match in _pattern.finditer(text))


class Memo(dict):
    """Values by key, made when first asked for, in a table of bounded size."""

    def __init__(self, make: Callable):
        super().__init__()
        self._make = make

    def __missing__(self, key):
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        value = self[key] = self._make(key)
        return value


def between_added(text: str, vocab: Vocabulary) -> list[tuple[str, int | None]]:
    """``text`` cut at the added tokens' strings: (text before, id of the token or None at the end)."""
    if not any(content in text for content in vocab.added):
        return [(text, None)]
    parts, at = [], 0
    for match in regex.finditer("|".join(map(regex.escape, sorted(vocab.added, key=len, reverse=True))), text):
        parts.append((text[at:match.start()], vocab.added[match[0]]))
        at = match.end()
    return [*parts, (text[at:], None)]
