"""Near-duplicate groups by MinHash, with sequential Bayesian verification.

A document's signature holds the smallest value of its shingle set under each of many
hash functions; two signatures agree at a place with a probability that is the Jaccard
similarity of the sets. Bands of a few places each make the buckets. Candidates of a
bucket are compared batch by batch of places: after n places with m agreements, and a
uniform prior, the similarity has the posterior Beta(m + 1, n - m + 1), and a pair is
dropped as soon as the posterior probability of reaching the threshold is below the
chosen miss probability. Survivors are verified exactly, on their whole sets. How buckets
are cut and their links gathered is that of ``linking``.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from weftline.llm.linking import BLOCK_ROWS, Screen, linked_groups

BANDS = 32
BAND_PLACES = 5
#: Places compared between two looks at the posterior.
BATCH_PLACES = 32
#: Posterior probability of similarity below which a pair is dropped.
MISS_PROBABILITY = 1e-6

_PLACES = BANDS * BAND_PLACES
#: Tokens hashed by all functions at a time.
_TOKENS_AT_ONCE = 512


def _mixed(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


_TURNS = _mixed(np.arange(1, _PLACES + 1, dtype=np.uint64))[:, None]
_FACTORS = _mixed(np.arange(1001, _PLACES + 1001, dtype=np.uint64))[:, None] | np.uint64(1)


def signature(tokens: np.ndarray) -> np.ndarray:
    """16 bits of the smallest hash of the set under each function."""
    least = np.full(_PLACES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(tokens), _TOKENS_AT_ONCE):
            part = (tokens[None, at:at + _TOKENS_AT_ONCE] ^ _TURNS) * _FACTORS
            least = np.minimum(least, part.min(1))
    return (_mixed(least) & np.uint64(0xFFFF)).astype(np.uint16)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A bucket key for each band of each signature."""
    bands = signatures.reshape(len(signatures), BANDS, BAND_PLACES).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2])
    for place in range(BAND_PLACES):
        keys = _mixed(keys ^ (bands[:, :, place] + np.uint64(1)) << np.uint64(20))
    return (keys >> np.uint64(1)).astype(np.int64)


def least_agreements(places: int, percent: int, miss: float) -> int:
    """Fewest agreements in ``places`` at which the posterior still gives the threshold more than ``miss``.

    For Beta(m + 1, n - m + 1), P(similarity >= t) is the probability that n + 1 trials of
    chance t have at most m successes.
    """
    t, below = percent / 100, 0.0
    for m in range(places + 1):
        below += comb(places + 1, m) * t**m * (1 - t) ** (places + 1 - m)
        if below >= miss:
            return m
    return places


def _signatures(sketches: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint16).reshape(-1, _PLACES)


def bayes_screen(percent: int, miss: float) -> Screen:
    """Sketches are signatures; a pair is dropped when its posterior says so after some batch of places."""
    looks = [
        (at, min(at + BATCH_PLACES, _PLACES), least_agreements(min(at + BATCH_PLACES, _PLACES), percent, miss))
        for at in range(0, _PLACES, BATCH_PLACES)
    ]

    def sketch(tokens: np.ndarray) -> tuple[bytes, np.ndarray]:
        own = signature(tokens)
        return own.tobytes(), np.unique(band_keys(own[None, :])[0])

    def near(rows: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        left = np.arange(len(a))
        agreed = np.zeros(len(a), np.int64)
        for first, last, least in looks:
            agreed += (rows[a[left], first:last] == rows[b[left], first:last]).sum(1)
            likely = agreed >= least
            left, agreed = left[likely], agreed[likely]
        out = np.zeros(len(a), bool)
        out[left] = True
        return out

    return Screen(sketch, _signatures, near)


def near_duplicate_groups(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
    miss: float = MISS_PROBABILITY, block_rows: int = BLOCK_ROWS, first_round: bool = True,
) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``.

    Words are lower-cased in A-Z and parted by ASCII white space. Two rows are linked when
    their sets of ``width``-word shingles are at least ``percent`` similar; component_id is
    the smallest id reachable by links. Every link is confirmed on whole sets. A pair at
    the threshold of 0.8 shares no band with a probability of 3e-6, and passes each look
    at its posterior but for ``miss``. Ids may repeat: rows with one id and different sets
    are separate rows. A null id counts as larger than any other. Null, empty and blank
    texts have no shingles and are linked with nothing: their component is their own id.
    An empty table gives no rows; other columns are not read.
    """
    return linked_groups(docs, doc_id, text, width, percent, lambda read: bayes_screen(percent, miss), block_rows, first_round)
