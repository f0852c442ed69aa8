"""Groups of documents whose sets of word n-grams are similar, by exact Jaccard similarity.

Tokens (n-gram hashes) are hashed into groups; a document's counts per group are a point.
Two sets cannot overlap by more than the sum of the smaller counts of each group, and
count-vector R-trees use that bound, on boxes first and then on points, to leave only
pairs that may reach the threshold. Those are verified on their whole sets.

The points are dealt to the trees by shared tokens. Of a set of a tokens any
a - ceil(t*a) + 1 must meet those of every partner, if all sets are ordered alike; here
by hash, with tokens that are frequent in a sample at the end, so few documents meet in
one bucket. How buckets are cut and their links gathered is that of ``linking``. Larger
sets have more groups, halved where they meet smaller ones, so the bound stays sharp.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.linking import BLOCK_ROWS, Screen, linked_groups
from weftline.llm.shingles import shingle_hashes

GROUPS = 128
#: Groups are doubled until a group holds no more tokens than this on average.
GROUP_TOKENS = 6
SAMPLE_DOCUMENTS = 20_000
FREQUENT_IN_SAMPLE = 4
FREQUENT_TOKENS = 200_000
LEAF_POINTS = 32

_LOW_HASHES = np.uint64(1 << 62)


def least_overlap(a: int | np.ndarray, b: int | np.ndarray, percent: int):
    """Shared tokens that two sets of a and b tokens need to be ``percent`` similar."""
    return -(-percent * (a + b) // (100 + percent))


def _prefix(tokens: np.ndarray, percent: int, frequent: np.ndarray) -> np.ndarray:
    size = len(tokens) - -(-percent * len(tokens) // 100) + 1
    if not len(frequent):
        return tokens[:size]
    for reach in (2 * size + 8, len(tokens)):
        own = tokens[:reach]
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        rare = frequent[at] != own
        if rare.sum() >= size:
            return own[rare][:size]
    return np.concatenate([tokens[rare], tokens[~rare]])[:size]


def _counts(tokens: np.ndarray) -> np.ndarray:
    """Tokens per group, of 8 bits; a set with more in one group gets full counts everywhere."""
    groups = GROUPS
    while len(tokens) > groups * GROUP_TOKENS:
        groups *= 2
    counts = np.bincount(((tokens >> np.uint64(7)) % np.uint64(groups)).astype(np.int64), minlength=groups)
    return np.full(groups, 255, np.uint8) if counts.max(initial=0) > 255 else counts.astype(np.uint8)


class _Points:
    """Counts of a batch, which can be folded to fewer groups."""

    def __init__(self, sketches: pd.Series):
        self.counts = [np.frombuffer(sketch, np.uint8) for sketch in sketches]
        self.groups = np.array([len(c) for c in self.counts], np.int64)

    def folded(self, rows: np.ndarray, groups: int) -> np.ndarray:
        """Counts of ``rows`` as a matrix of that many groups; a fold adds the two halves."""
        out = np.empty((len(rows), groups), np.int32)
        for size in np.unique(self.groups[rows]):
            at = np.flatnonzero(self.groups[rows] == size)
            stacked = np.stack([self.counts[i] for i in rows[at]])
            out[at] = stacked.reshape(len(at), size // groups, groups).sum(1, dtype=np.int32)
        return out


def _near(percent: int):
    def near(points: _Points, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        groups = np.minimum(points.groups[a], points.groups[b])
        out = np.zeros(len(a), bool)
        for size in np.unique(groups):
            at = np.flatnonzero(groups == size)
            own, place = np.unique(np.concatenate([a[at], b[at]]), return_inverse=True)
            folded = points.folded(own, int(size))
            step = max(1, (1 << 21) // int(size))
            for low in range(0, len(at), step):
                part = at[low:low + step]
                left, right = folded[place[low:low + len(part)]], folded[place[len(at) + low:len(at) + low + len(part)]]
                out[part] = np.minimum(left, right).sum(1) >= least_overlap(sizes[a[part]], sizes[b[part]], percent)
        return out

    return near


class CountTree:
    """An R-tree over count vectors, packed from the top along the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, rows: np.ndarray | None = None):
        rows = np.arange(len(points)) if rows is None else rows
        self.high, self.least = points[rows].max(0), sizes[rows].min()
        self.rows, self.below = rows, []
        if len(rows) > LEAF_POINTS:
            own = points[rows]
            widest = int(np.argmax(own.max(0) - own.min(0)))
            order = rows[np.argsort(own[:, widest], kind="stable")]
            self.below = [CountTree(points, sizes, half) for half in np.array_split(order, 2)]

    def search(self, points: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of the tree's own rows whose summed coordinate minima reach the overlap they need, each once."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        self._search(points, sizes, np.arange(len(points)), percent, out)
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([p for p, _ in out]), np.concatenate([r for _, r in out])

    def _search(self, points, sizes, asking, percent, out) -> None:
        bound = np.minimum(points[asking], self.high).sum(1, dtype=np.int64)
        asking = asking[bound >= least_overlap(sizes[asking], self.least, percent)]
        if not len(asking):
            return
        for child in self.below:
            child._search(points, sizes, asking, percent, out)
        if self.below:
            return
        for row in self.rows:
            others = asking[asking < row]
            shared = np.minimum(points[others], points[row]).sum(1, dtype=np.int64)
            hits = others[shared >= least_overlap(sizes[others], sizes[row], percent)]
            if len(hits):
                out.append((hits, np.full(len(hits), row)))


def _search(percent: int):
    def search(points: _Points, sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts, own = points.folded(rows, int(points.groups[rows].min())), sizes[rows]
        a, b = CountTree(counts, own).search(counts, own, percent)
        return rows[a], rows[b]

    return search


def count_screen(percent: int, frequent: np.ndarray) -> Screen:
    """Sketches are group counts; what their summed minima rule out is no candidate. Buckets are prefix tokens."""

    def sketch(tokens: np.ndarray) -> tuple[bytes, np.ndarray]:
        return _counts(tokens).tobytes(), _prefix(tokens, percent, frequent).view(np.int64)

    return Screen(sketch, _Points, _near(percent), _search(percent))


def frequent_tokens(docs: DataFrame, width: int) -> np.ndarray:
    """The most frequent low tokens of a bounded sample of documents.

    They only decide the order of tokens, so any list gives the same result. Only low
    hashes can come into a prefix; the list is bounded.
    """
    share = min(1.0, SAMPLE_DOCUMENTS / max(docs.count(), 1))
    sample = docs.where(F.pmod(F.xxhash64("h1"), F.lit(1 << 20)) <= int(share * (1 << 20))).select("text")

    def low(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingle_hashes(text, width) for text in batch["text"]]
            found = [tokens[tokens < _LOW_HASHES] for tokens in found]
            values, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
            yield pd.DataFrame({"token": values.view(np.int64), "docs": counts})

    counted = sample.mapInPandas(low, "token bigint, docs bigint").groupBy("token").agg(F.sum("docs").alias("docs"))
    top = counted.where(F.col("docs") >= FREQUENT_IN_SAMPLE).orderBy(F.desc("docs"), "token").limit(FREQUENT_TOKENS)
    return np.sort(top.toPandas()["token"].to_numpy(np.int64).view(np.uint64))


def jaccard_groups(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90,
    block_rows: int = BLOCK_ROWS, first_round: bool = True,
) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``.

    Words are lower-cased in A-Z and parted by ASCII white space. Two rows are linked when
    their sets of ``width``-word shingles are at least ``percent`` similar; component_id
    is the smallest id reachable by links. Ids may repeat: rows with one id and different
    sets are still separate rows, though of one component only if links say so. A null id
    counts as larger than any other. Null, empty and blank texts have no shingles and are
    linked with nothing, not even with each other: their component is their own id. An
    empty table gives no rows; other columns are not read. Shingles are told apart by
    64-bit hashes.
    """

    def screen(read: DataFrame) -> Screen:
        return count_screen(percent, frequent_tokens(read, width))

    return linked_groups(docs, doc_id, text, width, percent, screen, block_rows, first_round)
