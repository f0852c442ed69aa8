"""BPE encoding of many words at once by an array of pair ranks by position.

The symbols of all words of a batch lie in one array. In place of a map from pairs to
positions there are the rank of the pair at each position and a sorted list of the
positions that can merge, scanned and sorted anew in every sweep. Every word's lowest
active rank is applied at all its positions there, for all words at once, and only the
entries next to a merge change. A merge's result can only merge at a higher rank, so each word sees its
ranks in ascending order, and sweeps go on until no rank is active.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.vocabulary import NO_RANK, Vocabulary, between_added, split_words, vocabulary

#: Bytes of text whose words are merged together.
CHUNK_BYTES = 2 << 20


def pair_ranks(left: np.ndarray, right: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Rank of each pair, ``NO_RANK`` where it cannot merge; symbols below 0 never merge."""
    return vocab.pairs.ranks_of(left, right)


def merge_words(raw: np.ndarray, lengths: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of words that lie in a row in ``raw``, and the number of ids of each word."""
    if not len(lengths):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    ends = np.cumsum(lengths + 1)
    symbols = np.full(int(ends[-1]), -1, np.int32)
    inside = np.ones(len(symbols), bool)
    inside[ends - 1] = False
    symbols[inside] = vocab.byte_table[raw]

    following = np.arange(1, len(symbols) + 1, dtype=np.int32)
    preceding = np.arange(-1, len(symbols) - 1, dtype=np.int32)
    rank = np.full(len(symbols) + 1, NO_RANK)  # the last entry stands for "outside"
    pairs = raw.astype(np.uint16) << np.uint16(8)
    pairs[:-1] |= raw[1:]
    rank[:-1][inside] = vocab.byte_pair_ranks[pairs]
    rank[ends[lengths > 0] - 2] = NO_RANK  # a word's last byte has none to merge with
    word_of = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)
    active = np.flatnonzero(rank < NO_RANK)
    while len(active):
        own, word = rank[active], word_of[active]
        first = np.flatnonzero(np.diff(word, prepend=-1))
        lowest = np.repeat(np.minimum.reduceat(own, first), np.diff(first, append=len(active)))
        at = active[own == lowest]
        # In a run of equal overlapping pairs (as in "aaaa") the first, third, ... merge.
        tied = np.zeros(len(at), bool)
        tied[1:] = (preceding[at[1:]] == at[:-1]) & (rank[at[1:]] == rank[at[:-1]])
        if tied.any():
            place = np.arange(len(at))
            run = place - np.maximum.accumulate(np.where(tied, -1, place))
            at = at[run % 2 == 0]
        gone = following[at]
        symbols[at] = vocab.merge_results[rank[at]]
        symbols[gone] = -2
        rank[gone] = NO_RANK
        beyond = following[gone]
        following[at] = beyond
        preceding[beyond] = at
        before = preceding[at]
        changed = np.concatenate([at, before[before >= 0]])
        rank[changed] = pair_ranks(symbols[changed], symbols[following[changed]], vocab)
        # A pair that could not merge may be able to now: its left symbol's entry joins the index.
        if len(active) > len(rank) // 8:
            active = np.flatnonzero(rank < NO_RANK)  # for a long index one look at all positions is less work
            continue
        joined = np.concatenate([active, changed])
        joined = np.sort(joined[rank[joined] < NO_RANK], kind="stable")
        active = joined[np.diff(joined, prepend=-1) != 0]

    alive = symbols >= 0
    return symbols[alive].astype(np.uint32), np.diff(np.cumsum(alive)[ends - 1], prepend=0)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the stretches, one stretch after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _after_space(pieces: pa.Array) -> pa.Array:
    empty, space = (pa.scalar(value, pa.large_string()) for value in ("", " "))
    return pc.binary_join_element_wise(empty, pieces, space)


def piece_words(pieces: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of pieces: (words, number of each piece's words in a row, how many each piece has)."""
    # Letters are one word and letters before punctuation two; only other pieces need the split pattern.
    letters = pc.match_substring_regex(pieces, r"^ ?\p{L}+$")
    before = pc.extract_regex(pc.filter(pieces, pc.invert(letters)), r"^(?P<head> ?\p{L}+)(?P<tail>[!-/:-@\[-`{-~]+)$")
    single = letters.to_numpy(zero_copy_only=False)
    paired = np.zeros(len(pieces), bool)
    paired[~single] = pc.is_valid(before).to_numpy(zero_copy_only=False)
    heads, tails = (pc.struct_field(before.drop_null(), part) for part in ("head", "tail"))
    other = np.flatnonzero(~single & ~paired)
    split = [split_words(piece) for piece in pieces.take(pa.array(other)).to_pylist()]
    rest = pa.concat_arrays([
        tails.cast(pa.large_string()), pa.array([word for own in split for word in own], pa.large_string())
    ]).dictionary_encode()
    simple = pc.filter(pieces, letters)
    words = pa.concat_arrays([array.cast(pa.large_string()) for array in (simple, heads, rest.dictionary)])
    words = words.dictionary_encode()  # letters may also stand before punctuation
    coded = len(simple) + len(heads) + rest.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    per_piece = np.ones(len(pieces), np.int64)
    per_piece[paired] = 2
    per_piece[other] = np.fromiter(map(len, split), np.int64, len(split))
    starts = np.cumsum(per_piece) - per_piece
    number = np.empty(int(per_piece.sum()), np.int64)
    number[starts[single]] = np.arange(len(simple))
    number[starts[paired]] = len(simple) + np.arange(len(heads))
    number[starts[paired] + 1] = coded[: len(heads)]
    number[_ranges(starts[other], per_piece[other])] = coded[len(heads):]
    return words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64)[number], per_piece


def raw_words(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words in a row, and the length of each."""
    if not len(words):
        return np.empty(0, np.uint8), np.empty(0, np.int64)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset: words.offset + len(words) + 1]
    return np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]], np.diff(offsets)


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches; of an empty stretch 0."""
    summed, ends = np.concatenate([[0], np.cumsum(values)]), np.cumsum(lengths)
    return summed[ends] - summed[ends - lengths]


class Pieces:
    """A batch of texts cut at single spaces: distinct pieces, and which of them each text has.

    ``distinct`` are the pieces with the space before them, then those at the start of a
    text. Valuing them one by one is exact as long as no white space touches a cut;
    ``apart`` marks the texts where it does, and those with an added token's string.
    """

    def __init__(self, texts: pa.Array, vocab: Vocabulary):
        cut = pc.split_pattern(texts, " ")
        offsets = cut.offsets.to_numpy().astype(np.int64)
        pieces = cut.flatten().dictionary_encode()
        self.codes = pieces.indices.to_numpy().astype(np.int64)
        self.per_text = np.diff(offsets)
        plain = pieces.dictionary.cast(pa.large_string())
        space = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"
        edge = pc.match_substring_regex(plain, f"^$|^{space}|{space}$").to_numpy(zero_copy_only=False)
        self.apart = np.logical_or.reduceat(edge[self.codes], offsets[:-1])
        for content in vocab.added:
            self.apart |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        firsts = plain.take(pa.array(self.codes[offsets[:-1]])).dictionary_encode()
        self.codes[offsets[:-1]] = len(plain) + firsts.indices.to_numpy().astype(np.int64)
        self.distinct = pa.concat_arrays([_after_space(plain), firsts.dictionary.cast(pa.large_string())])


class PairIndexCoder:
    """Encodes batches of texts: distinct pieces first, whole texts by looking these up."""

    def __init__(self, vocab: Vocabulary):
        self._vocab = vocab

    def _encode_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row and the number of ids of each; pieces are encoded apart from each other."""
        words, number, per_piece = piece_words(pieces)
        ids, counts = merge_words(*raw_words(words), self._vocab)
        starts = np.cumsum(counts) - counts
        return ids[_ranges(starts[number], counts[number])], segment_sums(counts[number], per_piece)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        batch = Pieces(texts, self._vocab)
        ids, lengths = self._encode_pieces(batch.distinct)
        starts = np.cumsum(lengths) - lengths
        counts = segment_sums(lengths[batch.codes], batch.per_text)
        ids = ids[_ranges(starts[batch.codes], lengths[batch.codes])]
        if not batch.apart.any():
            return ids, counts
        numbers = np.flatnonzero(batch.apart)
        own_ids, own_counts = self._split_whole([texts[int(n)].as_py() for n in numbers])
        starts = np.cumsum(counts) - counts
        counts[numbers] = own_counts
        starts[numbers] = len(ids) + np.cumsum(own_counts) - own_counts
        return np.concatenate([ids, own_ids])[_ranges(starts, counts)], counts

    def _split_whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [between_added(text, self._vocab) for text in texts]
        words = [word for own in parts for text, _ in own for word in split_words(text)]
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        ids, counts = self._encode_pieces(coded.dictionary)
        starts, codes = np.cumsum(counts) - counts, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        out, lengths, at = [], [], 0
        for own in parts:
            found = []
            for text, added in own:
                n = len(split_words(text))
                here = codes[at:at + n]
                at += n
                found.append(ids[_ranges(starts[here], counts[here])])
                if added is not None:
                    found.append(np.array([added], np.uint32))
            out.extend(found)
            lengths.append(sum(map(len, found)))
        return np.concatenate([np.empty(0, np.uint32), *out]), np.array(lengths, np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self._vocab.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


_coders: dict[str, PairIndexCoder] = {}


def pair_index_coder(path: str) -> PairIndexCoder:
    """This process's coder for a vocabulary file."""
    if path not in _coders:
        _coders[path] = PairIndexCoder(vocabulary(path))
    return _coders[path]


def row_chunks(batches: Iterable[pa.RecordBatch], text: str, size_of_chunk: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in chunks of bounded text size."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False)
        filled, start = 0, 0
        for row, size in enumerate(sizes.tolist()):
            filled += size
            if filled >= size_of_chunk or row == len(sizes) - 1:
                yield batch.slice(start, row + 1 - start)
                filled, start = 0, row + 1


def encoded_chunks(batches: Iterable[pa.RecordBatch], text: str, path: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row chunks, with all their ids in a row and the number of ids of each row."""
    coder = pair_index_coder(path)
    for part in row_chunks(batches, text):
        yield part, *coder.encode_all(part[text])
    pa.default_memory_pool().release_unused()  # the process waits for other tasks, which may need none of it


def encode_texts(docs: DataFrame, path: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` plus the token ids of ``text`` as packed little-endian unsigned 32-bit integers.

    A null or empty text has no ids. Every row stays as it is, also repeated ones and ones
    with null ids; an equally named column is replaced. No shuffle; a task holds one chunk
    of rows and the ids of its distinct words.
    """
    kept = docs.select(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c.lower() != ids.lower()])
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values, counts in encoded_chunks(batches, text, path):
            packed = np.split(values, np.cumsum(counts)[:-1])
            column = pa.array([own.tobytes() for own in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, ids])

    return kept.mapInArrow(encode, schema)


def decode_ids(encoded: DataFrame, path: str, *, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` plus the text that packed ids stand for; null or no ids give an empty text."""

    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = pair_index_coder(path)
        for batch in batches:
            yield pd.Series([coder.decode(np.frombuffer(value or b"", "<u4")) for value in batch], dtype=object)

    return encoded.withColumn(text, F.pandas_udf(decode, "string")(F.col(f"`{ids}`")))


def round_trip_digests(docs: DataFrame, path: str, *, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, plus token count and digests of ids and of the text decoded from them.

    Ids and decoded texts exist for one row at a time; only digests leave the task.
    """

    kept = [c for c in docs.columns if c not in (text, "n_tokens", "ids_sha256", "decoded_sha256")]
    rows = docs.select(*[F.col("`" + c.replace("`", "``") + "`") for c in [*kept, text]])
    schema = T.StructType([
        *rows.schema.fields[:-1], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pair_index_coder(path)
        for part, values, counts in encoded_chunks(batches, text, path):
            id_digests, text_digests = [], []
            for own in np.split(values, np.cumsum(counts)[:-1]):
                id_digests.append(hashlib.sha256(own.astype("<u4")).hexdigest())
                text_digests.append(hashlib.sha256(coder.decode(own).encode()).hexdigest())
            columns = [*part.columns[:-1], pa.array(counts), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(digest, schema)
