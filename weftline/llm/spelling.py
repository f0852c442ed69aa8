"""Spelling variants: words that differ by one letter, each with its most frequent near word.

A word's letters fall into groups; its counts per group are a vector. One replaced letter
adds at most one to a group and takes one from another, one inserted letter only adds. So
the words stand in a trie by successive group counts, and the near words of a word are
found by a depth-first search that may spend one surplus and one deficit on its way; the
words of the leaves reached are verified letter by letter.

The trie is cut below its first levels into branches, one shuffle key each: a word is
stored in its own branch and searched for in every branch that its budget can reach. A
branch that holds too many words is cut again a few levels further down, and what is
still too large there is cut into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import column, hint_small
from weftline.workspace import materialize, scratch

LEAST_LETTERS = 5
LEAST_COUNT = 3
#: A word follows a near word that is at least so many times as frequent.
FACTOR = 2
#: One of so many occurrences loses a letter, by a hash of document and word.
DAMAGED = 97

#: Letter groups, each a level of the trie: letters by their code modulo this, in an order that puts frequent ones first.
LEVELS = 16
#: Levels of a branch, and of a branch that is cut again.
BRANCH_LEVELS, DEEP_LEVELS = 2, 5
#: Words of a branch, and of a block of one.
BRANCH_WORDS = 16_384
#: Words searched for at a time.
PROBES_AT_ONCE = 4_096
PAIRS_AT_ONCE = 100_000
#: Letters up to which words are verified side by side; longer ones are one by one.
LONG_LETTERS = 64

# The letters of a word.
LETTERS = "[A-Za-zÀ-ÿ]"
# End of fixed values.

_FIRST_LETTERS = [ord(c) % LEVELS for c in "eainrsto"]
_LEVEL_ORDER = [*dict.fromkeys(_FIRST_LETTERS), *sorted(set(range(LEVELS)) - set(_FIRST_LETTERS))]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged(word: Column, doc_id: Column) -> Column:
    """``word`` without the letter that its hash with the document's id names, where the hash says so."""
    hashed = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word))
    at = F.pmod(hashed, F.length(word)).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(hashed % DAMAGED == 0, shorter).otherwise(word)


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): distinct words of at least five letters that occur at least three times in all."""
    runs = F.regexp_extract_all(F.translate(column(text), _UPPER, _LOWER), F.lit(f"{LETTERS}{{{LEAST_LETTERS},}}"), F.lit(0))
    words = docs.select(column(doc_id).alias("doc_id"), F.explode(runs).alias("run"))
    words = words.select(damaged(F.col("run"), F.col("doc_id")).alias("word"))
    # The length is an aggregate, as a filter on the word would be pushed down and hash every occurrence again.
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.min(F.length("word")).alias("letters"))
    return counted.where((F.col("n") >= LEAST_COUNT) & (F.col("letters") >= LEAST_LETTERS)).select("word", "n")


def vectors(words: list[str]) -> np.ndarray:
    """Letters per group of each word, and their number in front: the levels of the trie."""
    lengths = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(owner * LEVELS + letters % LEVELS, minlength=len(words) * LEVELS).reshape(-1, LEVELS)
    return np.column_stack([lengths, counts[:, _LEVEL_ORDER]])


def _moves(levels: int) -> np.ndarray:
    """What one edit can add to the length and the first counts: longer by one, or as long with one surplus and deficit."""
    moves = set()
    for plus, minus in product(range(-1, levels), repeat=2):  # -1: in a later level
        step = [0] * levels
        if plus >= 0:
            step[plus] += 1
        grown = (1, *step)
        if minus >= 0:
            step[minus] -= 1
        moves |= {grown, (0, *step)}
    return np.array(sorted(moves), np.int64)


def _branch_keys(rows: np.ndarray) -> np.ndarray:
    """A number for the length and first counts of each row; rows with a negative count have none (-1)."""
    key = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for level in rows.T:
            key = (key ^ level.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    key = (key >> np.uint64(1)).astype(np.int64)
    return np.where((rows < 0).any(1), -1, key)


def _own_branches(levels: int):
    def own(words: pd.Series) -> pd.Series:
        return pd.Series(_branch_keys(vectors(list(words))[:, : levels + 1]))

    return F.pandas_udf(own, "bigint")


def _reached(levels: int):
    moves = _moves(levels)

    def reached(words: pd.Series) -> pd.Series:
        start = vectors(list(words))[:, : levels + 1]
        keys = np.column_stack([_branch_keys(start + move) for move in moves])
        return pd.Series([np.unique(row[row >= 0]) for row in keys], dtype=object)

    return F.pandas_udf(reached, "array<bigint>")


def one_edit(short: str, long: str) -> bool:
    """Whether exactly one replaced, inserted or deleted letter tells the words apart."""
    if len(short) > len(long):
        short, long = long, short
    if len(long) - len(short) > 1 or short == long:
        return False
    at = next((i for i, (a, b) in enumerate(zip(short, long)) if a != b), len(short))
    return short[at + (len(short) == len(long)):] == long[at + 1:]


class CountTrie:
    """Words by length and letter-group counts.

    Nodes of a level are numbers in the order of their path; a level is the sorted array
    of (node above, count), so one search finds the child of many nodes at once.
    """

    def __init__(self, words: list[str]):
        rows = vectors(words)
        order = np.lexsort(rows.T[::-1])
        self.words, rows = [words[i] for i in order], rows[order]
        self.base = int(rows.max(initial=0)) + 3
        above = np.zeros(len(rows), np.int64)
        new = np.zeros(len(rows), bool)
        new[:1] = True
        self.levels = []
        for column_of in rows.T:
            new[1:] |= column_of[1:] != column_of[:-1]
            self.levels.append((above * self.base + column_of)[new])
            above = np.cumsum(new) - 1
        self.leaves = np.concatenate([np.flatnonzero(new), [len(rows)]])
        self.lengths = rows[:, 0]
        self.in_order = np.array(sorted(self.words), dtype=object)
        self.ranks = np.searchsorted(self.in_order, np.array(self.words, dtype=object), "right")

    def reached(self, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probe, word) numbers for all leaves that a surplus and a deficit of one reach, words as long or longer by one."""
        at = np.arange(len(probes))
        state = [(at, np.zeros(len(probes), np.int64), np.ones(len(probes), bool), np.ones(len(probes), bool))]
        for level, keys in enumerate(self.levels):
            probe, node, surplus, deficit = (np.concatenate(x) for x in zip(*state))
            state = []
            for change in (0, 1, -1) if level else (0, 1):
                fits = slice(None) if change == 0 or not level else surplus if change == 1 else deficit
                own, below = probe[fits], node[fits]
                key = below * self.base + probes[own, level] + change
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                found = (keys[place] == key) & (probes[own, level] + change >= 0)
                plus, minus = surplus[fits][found], deficit[fits][found]
                if level and change:
                    plus, minus = (np.zeros_like(plus), minus) if change == 1 else (plus, np.zeros_like(minus))
                elif change:
                    minus = np.zeros_like(minus)  # a longer word only adds
                state.append((own[found], place[found], plus, minus))
        probe, leaf = (np.concatenate(x) for x in list(zip(*state))[:2])
        sizes = self.leaves[leaf + 1] - self.leaves[leaf]
        first = np.repeat(self.leaves[leaf] - (np.cumsum(sizes) - sizes), sizes)
        return np.repeat(probe, sizes), first + np.arange(len(first))

    def near(self, probes: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(probe, word) numbers of all words one edit away that are longer by one, or as long and later in order."""
        out: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for low in range(0, len(probes), PROBES_AT_ONCE):
            part = probes[low:low + PROBES_AT_ONCE]
            asked, reached = self.reached(vectors(part))
            ranks = np.searchsorted(self.in_order, np.array(part, dtype=object))
            later = (np.array([len(w) for w in part], np.int64)[asked] < self.lengths[reached]) | (ranks[asked] < self.ranks[reached])
            asked, reached = asked[later], reached[later]
            for at in range(0, len(asked), PAIRS_AT_ONCE):
                i, j = asked[at:at + PAIRS_AT_ONCE], reached[at:at + PAIRS_AT_ONCE]
                near = one_edit_apart(part, self.words, i, j)
                out.append((low + i[near], j[near]))
        return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])


def _letters(words: list[str], rows: np.ndarray, width: int) -> np.ndarray:
    return np.array([words[i] for i in rows], dtype=f"U{width}").view(np.uint32).reshape(len(rows), width)


def one_edit_apart(short: list[str], long: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of a word and one as long or longer by one are one edit apart: a mask over the pairs (i, j)."""
    own, i = np.unique(i, return_inverse=True)
    other, j = np.unique(j, return_inverse=True)
    lengths = np.array([len(short[n]) for n in own], np.int64)[i]
    longer = np.array([len(long[n]) for n in other], np.int64)[j] > lengths
    out = np.zeros(len(i), bool)
    if lengths.max(initial=0) > LONG_LETTERS:
        for n in np.flatnonzero(lengths > LONG_LETTERS):
            out[n] = one_edit(short[own[i[n]]], long[other[j[n]]])
    fits = np.flatnonzero(lengths <= LONG_LETTERS)
    if not len(fits):
        return out
    width = int(lengths[fits].max()) + 1
    a = _letters([w[:width] for w in short], own, width)[i[fits]]
    b = _letters([w[:width] for w in long], other, width)[j[fits]]
    differ = a != b
    replaced = ~longer[fits] & (differ.sum(1) == 1)
    # One letter more: what the words share at the start and, moved by one, at the end covers the shorter word.
    place = np.arange(width)
    inside = place[None, :] < lengths[fits][:, None]
    start = np.logical_and.accumulate(~differ & inside, axis=1).sum(1)
    moved = np.zeros_like(differ)
    moved[:, :-1] = a[:, :-1] == b[:, 1:]
    end = np.logical_and.accumulate((moved | ~inside)[:, ::-1], axis=1).sum(1) - (width - lengths[fits])
    out[fits] = replaced | (longer[fits] & (start + end >= lengths[fits]))
    return out


def _search(stored: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
    i = j = np.empty(0, np.int64)
    words: list[str] = []
    probes = list(asking["probe"])
    if len(stored) and len(asking):
        trie = CountTrie(list(stored["word"]))
        i, j = trie.near(probes)
        words = trie.words
    count_of = dict(zip(stored["word"], stored["n"], strict=True))
    found = [words[n] for n in j]
    return pd.DataFrame({
        "a": pd.Series([probes[n] for n in i], dtype=object), "a_n": asking["probe_n"].to_numpy()[i],
        "b": pd.Series(found, dtype=object), "b_n": np.array([count_of[w] for w in found], np.int64),
    })


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every two words (word, n) that are one edit apart, once."""
    words = words.select("word", "n").withColumns({
        "branch": _own_branches(BRANCH_LEVELS)("word"), "deep": _own_branches(DEEP_LEVELS)("word"),
    })
    words = materialize(words, "words")
    sizes = words.groupBy("branch").agg(F.count(F.lit(1)).alias("words"))
    large = hint_small(materialize(sizes.where(F.col("words") > BRANCH_WORDS).select("branch"), "large"), 32)

    def parted(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        return rows.join(large, key, "left_anti"), rows.join(large, key, "left_semi")

    stored, deep_stored = parted(words, "branch")
    asking = words.select(F.col("word").alias("probe"), F.col("n").alias("probe_n"))
    probes = asking.select("*", F.explode(_reached(BRANCH_LEVELS)("probe")).alias("branch"))
    here = hint_small(materialize(stored.select("branch").distinct(), "branches"), 32)
    probes = probes.join(here, "branch", "left_semi")
    small = stored.select("branch", "word", "n").groupBy("branch").cogroup(probes.groupBy("branch")).applyInPandas(
        _search, "a string, a_n bigint, b string, b_n bigint"
    )
    loads = deep_stored.groupBy("deep").agg(F.ceil(F.count(F.lit(1)) / BRANCH_WORDS).cast("int").alias("blocks"))
    loads = hint_small(materialize(loads, "loads"), 32)
    if loads.isEmpty():
        return small
    deep_stored = deep_stored.join(loads, "deep").select("deep", F.pmod(F.xxhash64("word"), "blocks").alias("block"), "word", "n")
    deep_probes = asking.select("*", F.explode(_reached(DEEP_LEVELS)("probe")).alias("deep")).join(loads, "deep")
    every_block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks").cast("bigint") - 1))
    deep_probes = deep_probes.select(F.col("deep").alias("deep"), every_block.alias("block"), "probe", "probe_n")
    keys = ["deep", "block"]
    return small.union(
        deep_stored.groupBy(*keys).cogroup(deep_probes.groupBy(*keys)).applyInPandas(_search, "a string, a_n bigint, b string, b_n bigint")
    )


def group_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words (word, n).

    Two words are near if exactly one inserted, deleted or replaced letter tells them
    apart. A word's form is its near word of largest n, of equal ones the smallest, if
    that n is at least twice its own, else null; root is where following forms ends.
    """
    words = materialize(words.select("word", "n"), "counted")
    pairs = materialize(near_pairs(words), "pairs")
    either = pairs.select("a", "b", "b_n").union(pairs.select("b", "a", "a_n")).toDF("word", "other", "other_n")
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form")))
    around = either.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    follows = -F.col("best.rank") >= FACTOR * F.col("n")
    rows = materialize(words.join(around, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(follows, F.col("best.form")).alias("form"), F.when(follows, -F.col("best.rank")).alias("form_n"),
    ), "forms")
    # Each round doubles the forms followed; a form is twice as frequent, so there are few rounds.
    steps = materialize(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "steps")
    while True:
        onward = hint_small(steps.select(F.col("word").alias("root"), F.col("root").alias("next")), 256)
        moved = steps.join(onward, "root", "left")
        if moved.where("next IS NOT NULL").isEmpty():
            break
        steps = materialize(moved.select("word", F.coalesce("next", "root").alias("root")), "steps")
    return rows.join(hint_small(steps, 256), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of all texts of ``docs``.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, of which only A-Z are
    lower-cased; where 97 divides the CRC-32 of ``<doc_id>:<word>``, the word loses the
    letter at that hash modulo its length. Words of five letters or more that occur three
    times or more are returned, each once. Null and empty texts have no words; a null id is
    written as nothing before the colon; a repeated row counts again; an empty table gives
    no rows. Other columns are not read.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(group_variants(count_words(docs, doc_id, text)), "variants")
