"""Token counts, BPE round trips and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from docs_fixture import make_docs  # noqa: F401
from tokenizers import Tokenizer

from weftline.llm.packing import pack, tail_lengths
from weftline.llm.pair_index import decode_ids, encode_texts, pair_index_coder, pair_ranks, piece_words, round_trip_digests
from weftline.llm.prefix_counts import count_tokens, prefix_table
from weftline.llm.queries import BYTE_BPE
from weftline.llm.vocabulary import NO_RANK, vocabulary

ODD = [
    "", "a", "  a  b ", "\n\n x", "x \n y\t\tz", "don't we'll I'VE they're 'r're", "<|endoftext|>hi <|endoftext|>", "a<|endoftext|> b",
    "\x1c a\x1d\x1f b \x85 c", "x" * 3000, "aaaaaaaaab" * 50, "日本語 一二三 ②½ ٣", "🙂🙂 👩‍👩‍👧", "\r\n\r\n a", "a \x0b b", "   ", "it's  's 'S",
    "end.\nStart, (again)...", "ünïcödé naïve", " ", "word " * 4000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    alphabet = "ab '’\n\t   \x1c\x851²éß日_-.<|>"
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(400)]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_and_totals_equal_the_library(library, texts):
    coder, table = pair_index_coder(BYTE_BPE), prefix_table(BYTE_BPE)
    ids, counts = coder.encode_all(pa.array(texts))
    totals, _ = table.measure(pa.array(texts), 10)
    at = 0
    for text, count, total in zip(texts, counts, totals, strict=True):
        want = ids_of(library, text)
        assert ids[at:at + count].tolist() == want
        assert total == len(want)
        assert coder.decode(ids[at:at + count]) == library.decode(want, skip_special_tokens=False)
        at += count


def test_each_word_is_merged_once():
    pieces = [" word", " word,", " word.", " word!?", "word", "word,", " 1-word", " 2-word", " (word)", " ", "", " ü,"]
    words, number, per_piece = piece_words(pa.array(pieces, pa.large_string()))
    listed = words.to_pylist()
    assert len(listed) == len(set(listed))  # " word" stands in several pieces
    ends = np.cumsum(per_piece)
    assert ["".join(listed[n] for n in number[end - size:end]) for end, size in zip(ends, per_piece, strict=True)] == pieces


def test_pair_ranks_equal_the_merges():
    vocab, random_ = vocabulary(BYTE_BPE), np.random.default_rng(5)
    made = np.array(list(vocab.merges), np.int32)
    some = random_.integers(-2, 1 << 16, (20_000, 2)).astype(np.int32)
    left, right = np.concatenate([made, some, [[-1, -1], [0, 0], [65535, 65535]]]).astype(np.int32).T
    want = [vocab.merges.get(pair, (NO_RANK, None))[0] for pair in zip(left.tolist(), right.tolist(), strict=True)]
    assert pair_ranks(left, right, vocab).tolist() == want
    of_bytes = vocab.byte_pair_ranks.reshape(256, 256)
    for a, b in random_.integers(0, 256, (2000, 2)).tolist():
        assert of_bytes[a, b] == vocab.merges.get((vocab.byte_ids[a], vocab.byte_ids[b]), (NO_RANK, None))[0]


def test_every_prefix_has_its_count(library, texts):
    table = prefix_table(BYTE_BPE)
    for text in [t for t in texts if len(t) < 40][:250]:
        counts = table.of_prefixes(text)
        for end in range(len(text) + 1):
            assert counts[len(text[:end].encode())] == len(ids_of(library, text[:end])), (text, end)


def test_counts_for_tables(spark, make_docs, library):
    rows = [(1, None), (2, ""), (2, ""), (None, "one two three"), (5, "word " * 4000), (6, "<|endoftext|>" * 3)]
    docs = make_docs(rows, n_tokens="clash", fitting_bytes="clash")
    got = count_tokens(docs, BYTE_BPE, limit=10).collect()
    assert len(got) == len(rows)
    for row in got:
        raw = (row.text or "").encode()
        assert (row.n_bytes, row.n_tokens) == (len(raw), len(ids_of(library, row.text)))
        assert row.over_limit == (row.n_tokens > 10)
        assert len(ids_of(library, raw[: row.fitting_bytes].decode())) <= 10
    assert count_tokens(docs.limit(0), BYTE_BPE).count() == 0


def test_encode_decode_and_digests(spark, make_docs, library):
    docs = make_docs([(1, "a  b"), (1, "a  b"), (2, None), (None, "x\ny <|endoftext|>")], ids="clash", ids_sha256="clash")
    back = decode_ids(encode_texts(docs, BYTE_BPE), BYTE_BPE).collect()
    assert all(r.decoded == (r.text or "") for r in back) and len(back) == 4
    for row in round_trip_digests(docs, BYTE_BPE).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        ids = np.array(ids_of(library, row.text), "<u4").tobytes()
        assert (row.n_tokens, row.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
    assert round_trip_digests(docs.limit(0), BYTE_BPE).count() == 0


def check_packing(rows, pieces, library, window=2048):
    by_length = sorted(((r.doc_id is not None, r.doc_id or 0), r.start) for r in pieces)
    assert len(by_length) == len(pieces)
    tokens = sum(len(ids_of(library, r[1])) + 1 for r in rows)
    assert sum(p.length for p in pieces) == tokens
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    lengths = []
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        lengths.append(at)
    assert all(n == window or n & (n - 1) == 0 for n in lengths) and max(lengths, default=0) <= window
    assert sum(lengths) == tokens
    return sequences


def test_packing_holds_each_token_once(spark, make_docs, library):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "γ", "x"]) for _ in range(rng.randint(0, 900))), f"s{i % 3 if i % 3 else 0}") for i in range(60)]
    rows += [(100, None, None), (101, "", "s1"), (102, "long " * 9000, "s2")]
    pieces = pack(make_docs(rows, sequence_id="clash"), BYTE_BPE).collect()
    check_packing(rows, pieces, library)
    ids = {i: np.array(ids_of(library, text) + [1], "<u4") for i, text, _ in rows}
    for i, own in ids.items():
        at = 0
        for p in sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(own)
            assert p.ids_crc32 == zlib.crc32(own[p.start: p.start + p.length].tobytes())
            at += p.length
        assert at == len(own)


def test_windows_hold_the_target_shares(spark, make_docs, library):
    rows = [(i, "one two three four five six seven " * 60, "big" if i % 4 else "small") for i in range(80)]
    pieces = pack(make_docs(rows), BYTE_BPE, window=512, quantum=32).collect()
    sequences = check_packing(rows, pieces, library, window=512)
    total = sum(p.length for p in pieces)
    share = sum(p.length for p in pieces if p.source == "small") / total
    for own in sequences.values():
        if sum(p.length for p in own) == 512:
            assert abs(sum(p.length for p in own if p.source == "small") - 512 * share) <= 3 * 32
    fixed = pack(make_docs(rows), BYTE_BPE, window=512, quantum=32, shares={"small": 0.5, "big": 0.5}).collect()
    early = [p for p in fixed if p.sequence_id < 20]
    assert abs(sum(p.length for p in early if p.source == "small") / sum(p.length for p in early) - 0.5) < 0.03
    check_packing(rows, fixed, library, window=512)


def test_packing_of_nothing_and_of_equal_rows(spark, make_docs, library):
    docs = make_docs([(1, "same text"), (1, "same text"), (None, "same text"), (None, None)])
    pieces = pack(docs, BYTE_BPE).collect()
    assert sum(p.length for p in pieces) == 3 * (len(ids_of(library, "same text")) + 1) + 1
    assert pack(docs.limit(0), BYTE_BPE).count() == 0
    assert tail_lengths(0) == [] and tail_lengths(1_037) == [1024, 8, 4, 1]
