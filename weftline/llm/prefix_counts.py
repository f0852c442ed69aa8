"""Exact token counts of every prefix of a text, without encoding any prefix.

For each byte position of a word the table keeps the last token of that prefix's
encoding and the number of its tokens. The last token is the one vocabulary entry that
ends there and stands unchanged next to the last token before it, so

    count[i] = count[i - length of last token] + 1

fills the table from left to right, for all distinct words of a batch at once. Words
follow one another independently, so a prefix of a text costs the sum of the words
before the cut plus one table entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weftline.llm.common import columns
from weftline.llm.pair_index import NO_RANK, Pieces, pair_ranks, piece_words, raw_words, row_chunks, segment_sums
from weftline.llm.vocabulary import Vocabulary, between_added, split_words, vocabulary

TOKEN_LIMIT = 512

#: Bytes of text whose words are tabled together.
CHUNK_BYTES = 8 << 20

#: Pairs of tokens whose verdict is remembered.
PAIR_ENTRIES = 2_000_000

_NEVER = np.int64(1 << 40)
_CONTRACTIONS = ("'re", "'ve", "'ll")


class _Edges:
    """For each token the symbols at its left or right edge, from last to first merge.

    ``until`` is the rank that merges a symbol away, ``begun`` the one that made it (-1: a byte).
    """

    def __init__(self, vocab: Vocabulary, side: int):
        symbols, until, first = [], [], []
        for token in range(max(vocab.bytes_of) + 1):
            first.append(len(symbols))
            symbol, ends = token, _NEVER
            while symbol in vocab.bytes_of:
                symbols.append(symbol)
                until.append(ends)
                made = vocab.made_by.get(symbol)
                if made is None:
                    break
                ends, symbol = made[0], made[1 + side]
        self.first = np.array([*first, len(symbols)], np.int64)
        self.symbols, self.until = np.array(symbols, np.int32), np.array(until, np.int64)
        self.begun = np.append(self.until[1:], _NEVER)
        self.begun[self.first[1:] - 1] = -1


class PrefixTable:
    """Prefix counts of words, and of texts made of them."""

    def __init__(self, vocab: Vocabulary):
        self._vocab = vocab
        self._left_of, self._right_of = _Edges(vocab, 0), _Edges(vocab, 1)
        made = [(token, *vocab.made_by[token]) for token in vocab.made_by]
        tokens, ranks, lefts, rights = (np.array(part, np.int64) for part in zip(*made, strict=True))
        alone = dict(zip(tokens.tolist(), self._stand_together(lefts, rights, ranks).tolist(), strict=True))
        self._whole = np.ones(max(vocab.bytes_of) + 1, bool)
        for token, _, left, right in sorted(made, key=lambda m: m[1]):
            self._whole[token] = alone[token] and self._whole[left] and self._whole[right]
        self._steps, self._next, self._token_at = self._trie()
        self._pairs, self._verdicts = np.empty(0, np.uint32), np.empty(0, bool)

    def _trie(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vocabulary as a trie: sorted (node, byte) steps, where each leads, and the token of each node."""
        nodes: dict[tuple[int, int], int] = {}
        token_at = [-1]
        for raw, token in self._vocab.id_of.items():
            if not self._whole[token]:
                continue
            node = 0
            for byte in raw:
                if (node, byte) not in nodes:
                    nodes[node, byte] = len(token_at)
                    token_at.append(-1)
                node = nodes[node, byte]
            token_at[node] = token
        steps = np.array([node << 8 | byte for node, byte in nodes], np.int32)
        order = np.argsort(steps)
        return steps[order], np.array(list(nodes.values()), np.int32)[order], np.array(token_at, np.int32)

    def _stand_together(self, left: np.ndarray, right: np.ndarray, below: np.ndarray | np.int64 = _NEVER) -> np.ndarray:
        """For pairs of tokens: whether no merge of a rank under ``below`` joins their inner edges.

        Two edge symbols are there together until the first of them is merged into its own
        token. Of equal ranks the left place merges first.
        """
        good = np.ones(len(left), bool)
        open_pairs = np.arange(len(left))
        i, j = self._right_of.first[left].copy(), self._left_of.first[right].copy()
        below = np.broadcast_to(below, len(left))
        while len(open_pairs):
            x, y = i[open_pairs], j[open_pairs]
            rank = pair_ranks(self._right_of.symbols[x], self._left_of.symbols[y], self._vocab).astype(np.int64)
            joins = (rank < NO_RANK) & (rank < below[open_pairs]) & (rank < self._right_of.until[x]) & (rank <= self._left_of.until[y])
            good[open_pairs[joins]] = False
            # Step back to what was there before the later of the two symbols was made.
            x_begun, y_begun = self._right_of.begun[x], self._left_of.begun[y]
            on = ~joins & ((x_begun >= 0) | (y_begun >= 0))
            i[open_pairs] += on & (x_begun >= y_begun)
            j[open_pairs] += on & (y_begun >= x_begun)
            open_pairs = open_pairs[on]
        return good

    def _verdict(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_stand_together`` with memory."""
        keys = (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)
        at = np.searchsorted(self._pairs, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self._pairs)
        known[inside] = self._pairs[at[inside]] == keys[inside]
        out = np.zeros(len(keys), bool)
        out[known] = self._verdicts[at[known]]
        if not known.all():
            new, where = np.unique(keys[~known], return_inverse=True)
            found = self._stand_together((new >> np.uint32(16)).astype(np.int64), (new & np.uint32(0xFFFF)).astype(np.int64))
            out[~known] = found[where]
            if len(self._pairs) + len(new) > PAIR_ENTRIES:
                self._pairs, self._verdicts = np.empty(0, np.uint32), np.empty(0, bool)
            place = np.searchsorted(self._pairs, new)
            self._pairs, self._verdicts = np.insert(self._pairs, place, new), np.insert(self._verdicts, place, found)
        return out

    def words(self, raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Token counts of all prefixes of words that lie in a row: entry i is that of its word up to byte i."""
        size = len(raw)
        ends = np.repeat(np.cumsum(lengths), lengths).astype(np.int32)
        begins = ends - np.repeat(lengths, lengths).astype(np.int32)
        raw = raw.astype(np.int32)
        # All tokens in the words: from every byte as far as the trie leads.
        starts, reaches, tokens = [], [], []
        at, node = np.arange(size, dtype=np.int32), np.zeros(size, np.int32)
        step = 0
        while len(at):
            keys = node << 8 | raw[at + step]
            found = np.minimum(np.searchsorted(self._steps, keys), len(self._steps) - 1)
            on = self._steps[found] == keys
            at, node = at[on], self._next[found[on]]
            token = self._token_at[node]
            hit = token >= 0
            starts.append(at[hit])
            reaches.append(np.full(int(hit.sum()), step, np.int32))
            tokens.append(token[hit])
            step += 1
            inside = at + step < ends[at]
            at, node = at[inside], node[inside]
        start, token = np.concatenate(starts), np.concatenate(tokens)
        last_byte = start + np.concatenate(reaches)
        # By distance of the end from its word's begin, then by end; the longest token first.
        depth = last_byte - begins[last_byte]
        order = np.lexsort((start, last_byte, depth))
        start, token, last_byte, depth = start[order], token[order], last_byte[order], depth[order]
        counts, last = np.zeros(size, np.int64), np.full(size, -1, np.int32)
        bounds = np.flatnonzero(np.diff(depth, prepend=-1, append=-1))
        for low, high in zip(bounds, bounds[1:], strict=False):
            todo = np.arange(low, high)
            while len(todo):
                # The longest candidate left of every end.
                own = last_byte[todo]
                head = np.flatnonzero(np.diff(own, prepend=-1))
                pick = todo[head]
                from_begin = start[pick] == begins[start[pick]]
                before = np.where(from_begin, -1, start[pick] - 1)
                fits = from_begin.copy()
                inner = np.flatnonzero(~from_begin)
                if len(inner):
                    fits[inner] = self._verdict(last[before[inner]], token[pick[inner]])
                chosen = pick[fits]
                last[last_byte[chosen]] = token[chosen]
                counts[last_byte[chosen]] = np.where(from_begin[fits], 1, counts[before[fits]] + 1)
                left = np.ones(len(todo), bool)
                left[head] = False
                todo = todo[left & (last[own] < 0)]
        return counts

    def _word_counts(self, words: list[str]) -> list[list[int]]:
        """Counts of all prefixes of each word, a contraction's by the words that its prefixes have."""
        raw = [word.encode() for word in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        flat = self.words(np.frombuffer(b"".join(raw), np.uint8), lengths).tolist() if raw else []
        out, at = [], 0
        for word, size in zip(words, lengths.tolist(), strict=True):
            own = flat[at:at + size]
            at += size
            if word in _CONTRACTIONS:
                own[1] = own[0] + 1  # "'" and a letter
            out.append(own)
        return out

    def of_prefixes(self, text: str) -> list[int]:
        """Token counts of all prefixes of ``text`` by UTF-8 bytes, its own count last.

        At a cut that splits a run of white space, a contraction or an added token's
        string, the words of the prefix differ from those of the text; such entries are
        counted with the words that the prefix itself has.
        """
        counts, before = [0], 0
        for part, added in between_added(text, self._vocab):
            words = split_words(part)
            inside_of = self._word_counts(words)
            for i, (word, inside) in enumerate(zip(words, inside_of, strict=True)):
                inside = list(inside)
                if i and words[i - 1].isspace() and word[0].isspace():
                    # Cut here, the white space is one run; the word before it is its beginning.
                    own = len(word[0].encode())
                    run = self._word_counts([words[i - 1] + word[0]])[0]
                    inside[:own] = [c - inside_of[i - 1][-1] for c in run[-own:]]
                counts.extend(before + c for c in inside)
                before += inside_of[i][-1]
            if added is not None:
                string = self._vocab.bytes_of[added].decode()
                tail = "".join(words[-2:])
                fixed = before - sum(own[-1] for own in inside_of[-2:])
                counts.extend(fixed + self.total(tail + string[:n]) for n in range(1, len(string)))
                before += 1
                counts.append(before)
        return counts

    def total(self, text: str) -> int:
        """Number of tokens of one text."""
        parts = between_added(text, self._vocab)
        return sum(sum(own[-1] for own in self._word_counts(split_words(part))) + (added is not None) for part, added in parts)

    def fitting_bytes(self, text: str, limit: int) -> int:
        """UTF-8 length of the longest prefix, cut between characters, of at most ``limit`` tokens."""
        raw = text.encode()
        return max(i for i, c in enumerate(self.of_prefixes(text)) if c <= limit and (i == len(raw) or raw[i] & 0xC0 != 0x80))

    def measure(self, texts: pa.Array, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each text: the number of tokens, and the bytes of a longest prefix of at most ``limit`` tokens.

        The prefix ends between characters, inside the first piece of the text that does
        not fit as a whole.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        batch = Pieces(texts, self._vocab)
        words, number, per_piece = piece_words(batch.distinct)
        raw, lengths = raw_words(words)
        counts = self.words(raw, lengths)
        of_word = counts[np.cumsum(lengths) - 1] if len(lengths) else counts
        of_piece = segment_sums(of_word[number], per_piece)
        tokens = of_piece[batch.codes]
        totals = segment_sums(tokens, batch.per_text)
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        fitting = sizes.copy()
        over = np.flatnonzero((totals > limit) & ~batch.apart)
        if len(over):
            first = np.cumsum(batch.per_text) - batch.per_text
            summed = np.concatenate([[0], np.cumsum(tokens)])
            # The piece of each text in which the limit is passed.
            crossing = np.searchsorted(summed, summed[first[over]] + limit, side="right") - 1
            room = limit - (summed[crossing] - summed[first[over]])
            piece_bytes = pc.binary_length(batch.distinct).to_numpy(zero_copy_only=False).astype(np.int64)
            laid = np.concatenate([[0], np.cumsum(piece_bytes[batch.codes])])
            fitting[over] = laid[crossing] - laid[first[over]] + self._fits(batch.distinct.take(pa.array(batch.codes[crossing])), room)
        for n in np.flatnonzero(batch.apart):
            text = texts[int(n)].as_py()
            totals[n] = self.total(text)
            if totals[n] > limit:
                fitting[n] = self.fitting_bytes(text, limit)
        return totals, fitting

    def _fits(self, pieces: pa.Array, room: np.ndarray) -> np.ndarray:
        """Bytes of each piece that make at most ``room`` tokens."""
        split = [split_words(piece) for piece in pieces.to_pylist()]
        tables = iter(self._word_counts([word for own in split for word in own]))
        out = []
        for own, left in zip(split, room.tolist(), strict=True):
            size, used, best = 0, 0, 0
            for word in own:
                raw, table = word.encode(), next(tables)
                for i, count in enumerate(table, start=1):
                    if used + count <= left and (i == len(raw) or raw[i] & 0xC0 != 0x80):
                        best = max(best, size + i)
                size, used = size + len(raw), used + table[-1]
            out.append(best)
        return np.array(out, np.int64)


_tables: dict[str, PrefixTable] = {}


def prefix_table(path: str) -> PrefixTable:
    """This process's table for a vocabulary file; its memory of pairs lasts as long as the process."""
    if path not in _tables:
        _tables[path] = PrefixTable(vocabulary(path))
    return _tables[path]


def count_tokens(
    docs: DataFrame, path: str, *, text: str = "text", limit: int = TOKEN_LIMIT,
    n_bytes: str = "n_bytes", n_tokens: str = "n_tokens", over_limit: str = "over_limit", fitting: str = "fitting_bytes",
) -> DataFrame:
    """``docs`` plus byte count, exact token count, whether it is over ``limit``, and the bytes that fit into it.

    A null or empty text has 0 bytes and 0 tokens. Rows are neither merged nor dropped, so
    repeated rows and ids, null ids and an empty table come out as they are; a column of
    ``docs`` with the name of a new one is replaced. Texts are read whole, whatever their
    length. No shuffle.
    """
    kept = docs.select(*columns([c for c in docs.columns if c not in (n_bytes, n_tokens, over_limit, fitting)]))
    kinds = {n_bytes: T.LongType(), n_tokens: T.LongType(), over_limit: T.BooleanType(), fitting: T.LongType()}
    schema = T.StructType([*kept.schema.fields, *[T.StructField(name, kind) for name, kind in kinds.items()]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(path)
        for part in row_chunks(batches, text, CHUNK_BYTES):
            totals, fits = table.measure(part[text], limit)
            sizes = pc.cast(pc.fill_null(pc.binary_length(part[text]), 0), pa.int64())
            new = [sizes, pa.array(totals), pa.array(totals > limit), pa.array(fits)]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)

    return kept.mapInArrow(count, schema)
