"""Spelling variants and hard negatives against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from docs_fixture import make_docs  # noqa: F401
from pyspark.sql import functions as F

from weftline.llm import shared_lists, spelling
from weftline.llm.shared_lists import centres_of, hard_negatives, inner_products
from weftline.llm.spelling import CountTrie, group_variants, one_edit, one_edit_apart, spelling_variants

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, before = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(before[j] + (x != y), before[j + 1] + 1, row[j] + 1))
    return row[-1]


def counted(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 97 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def variants(counts):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and edits(v, w) == 1] for w in counts}
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[word] = best if best and counts[best] >= 2 * counts[word] else None
    out = []
    for word, form in forms.items():
        root = word
        while forms[root]:
            root = forms[root]
        out.append((word, form, root, counts[word], len(near[word]), counts[form] if form else None))
    return sorted(out, key=str)


def wordy(seed, documents=60):
    rng = random.Random(seed)
    letters = "abcdefgéßÿÀ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 8))) for _ in range(25)]
    words = list(base)
    for word in base * 6:
        at = rng.randrange(len(word))
        words.append(rng.choice([word[:at] + word[at + 1:], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1:]]))
    rows = []
    for doc in range(documents):
        own = [rng.choice(words[: 1 + rng.randrange(len(words))]) for _ in range(120)]
        rows.append((doc, " 7,".join(w.upper() if rng.random() < 0.1 else w for w in own)))
    return [*rows, (None, "nulled nulled"), (900, None), (901, ""), (902, " -- "), (903, "long" * 50_000), (904, "nulled xnulled"), rows[0], rows[0]]


def test_variants_equal_brute_force(spark, make_docs):
    rows = wordy(1)
    got = spelling_variants(make_docs(rows, word="clash", n="clash", form="clash"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == variants(counted(rows))


def test_branches_may_be_cut_again(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BRANCH_WORDS", 3)
    counts = {w: n for w, n in counted(wordy(2)).items()}
    got = group_variants(spark.createDataFrame(list(counts.items()), "word string, n bigint"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == variants(counts)


def test_forms_are_followed_to_the_end(spark):
    chain = [("aaaa" + "b" * i + "ccc", 3 * 2**i) for i in range(12)]
    got = {r.word: r for r in group_variants(spark.createDataFrame(chain, "word string, n bigint")).collect()}
    assert {r.root for r in got.values()} == {chain[-1][0]} and got[chain[-1][0]].form is None
    assert got[chain[3][0]].form == chain[4][0] and got[chain[3][0]].n_near == 2


def test_no_documents_no_words(spark, make_docs):
    assert spelling_variants(make_docs([])).count() == 0
    assert spelling_variants(make_docs([(1, None), (2, "abcd")])).count() == 0


def test_trie_finds_exactly_the_words_one_edit_away():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcqé") for _ in range(rng.randint(5, 7))) for _ in range(700)})
    trie, probes = CountTrie(words), words[::7]
    got = {(probes[i], trie.words[j]) for i, j in zip(*trie.near(probes))}
    assert got == {(p, w) for p in probes for w in words if (len(p) < len(w) or (len(p) == len(w) and p < w)) and edits(p, w) == 1}
    for a, b in [("abc", "abc"), ("abc", "abcd"), ("abc", "xabc"), ("abc", "axc"), ("abc", "axcd"), ("ab", "abcd"), ("aab", "ab")]:
        assert one_edit(a, b) == (edits(a, b) == 1)
    long = "x" * 80
    pairs = [("abc", "abc"), ("abc", "abcd"), ("abc", "xabc"), ("abc", "axc"), ("abc", "adcb"), ("aab", "aaab"), (long, long + "y"), (long, "y" + long[1:]), (long, "yy" + long[1:])]
    mask = one_edit_apart([a for a, _ in pairs], [b for _, b in pairs], np.arange(len(pairs)), np.arange(len(pairs)))
    assert mask.tolist() == [edits(a, b) == 1 for a, b in pairs]


SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string, row string"


def mined(rows):
    def fine(r):
        return r[0] is not None and r[1] is not None and r[2] is not None and all(x is not None and np.isfinite(np.float32(x)) for x in r[1])

    rows = {(r[0], tuple(int(np.floor(float(np.float32(x)) * 256)) for x in r[1]), (r[2] + 1) % 10 if r[0] % 7 == 0 else r[2]) for r in rows if fine(r)}
    out = []
    for vec, own, label in rows:
        if vec % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i, k) for i, v, k in rows if i != vec and len(v) == len(own))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            fits = [(i, -t) for t, i, k in scored if k != label and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(vec, p, rank, i, -s, t) for rank, (i, t) in enumerate(fits, 1)]
    return sorted(out)


def asked(vectors, **more):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives(vectors, F.col("vec_id") % 100 == 0, label, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def test_negatives_equal_brute_force(spark):
    random_ = np.random.default_rng(3)
    centres = random_.normal(size=(6, 8))
    rows = []
    for i in range(1500):
        at = random_.integers(6)
        rows.append((i, [float(x) for x in centres[at] + 0.4 * random_.normal(size=8)], int(at if random_.random() < 0.7 else random_.integers(10))))
    rows += [(2000 + i, rows[100][1], i % 4) for i in range(40)]  # ties
    rows += [(2100, [0.0] * 8, 1), (2200, None, 1), (2300, rows[0][1], None), (2301, [None, *rows[0][1][1:]], 2), (2302, [float("nan")] * 8, 2)]
    rows += [(None, rows[0][1], 0), (2400, [1.0, 2.0], 3), (2401, [1.5, 2.0], 3), (2402, [1.4, 1.9], 4), (2500, [], 3), rows[5], rows[5], (100, rows[7][1], 1)]
    rows += [(3000 + i, [float(10**6 * x) for x in rows[i][1]], i % 3) for i in range(30)]
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    assert asked(frame, anchors_per_cluster=4, first_share=1 / 64, block_rows=200) == mined(rows)


def test_an_anchor_walks_once_for_all_its_positives(spark, monkeypatch):
    random_, walks, walk = np.random.default_rng(9), [], shared_lists.Lists.walk

    def counted(self, asking, same_label, k):
        walks.append(asking.count())
        return walk(self, asking, same_label, k)

    monkeypatch.setattr(shared_lists.Lists, "walk", counted)
    monkeypatch.setattr(shared_lists, "ANCHOR_BLOCK", 2)  # several parts of anchors meet each block of rows
    rows = [(i, [float(x) for x in 1 + random_.normal(size=6)], int(random_.integers(4)), "", "") for i in range(0, 1500, 4)]
    want = mined(rows)
    assert asked(spark.createDataFrame(rows, SCHEMA), anchors_per_cluster=5, first_share=1 / 16, block_rows=100) == want
    assert len(want) > 100
    assert walks == [15, 15]  # five positives each, but not a walk for each


def test_a_block_keeps_each_range_apart():
    random_ = np.random.default_rng(2)
    vectors, anchors = random_.integers(-9, 9, (700, 4)), random_.integers(-9, 9, (600, 4))
    rows = pd.DataFrame({"vec_id": np.arange(700) // 2, "label": random_.integers(3, size=700), "embedding": list(vectors)})
    ranges = [(np.array([1, 4]), np.array([0, -50]), np.array([20, 60]))] * len(anchors)
    asking = pd.DataFrame({"row": np.arange(600) + 7, "cluster": -5, "vec_id": np.arange(600), "label": 1, "embedding": list(anchors)})
    asking["want"], asking["least"], asking["most"] = zip(*ranges, strict=True)
    found = shared_lists._compared(lambda cluster, norms, units: np.arange(len(norms)), False, 3)(asking, rows)
    want = set()
    for n, anchor in enumerate(anchors):
        scored = [(-int(s), int(i)) for s, i, k in zip(vectors @ anchor, rows["vec_id"], rows["label"], strict=True) if k != 1 and i != n]
        for number, low, high in ((1, 0, 20), (4, -50, 60)):
            want |= {(n + 7, number, i, -s, place) for place, (s, i) in enumerate(sorted(x for x in scored if low <= -x[0] <= high)[:3])}
    found["place"] = found.groupby(["row", "want"]).cumcount()
    assert {tuple(map(int, r)) for r in found[["row", "want", "vec_id", "score", "place"]].to_numpy()} == want


def test_no_vectors_no_negatives(spark):
    assert asked(spark.createDataFrame([], SCHEMA)) == []
    assert asked(spark.createDataFrame([(0, [1.0], 1, "", ""), (3, [1.0], 1, "", "")], SCHEMA)) == []


def test_products_are_exact_beyond_doubles():
    a, b = np.array([[2**40, 3]]), np.array([[2**20, 1], [2**40, 1]])
    assert inner_products(a, b).tolist() == [[2**60 + 3, 2**63 - 1]]
    assert len(centres_of(np.ones((5, 2)), 4)) == 1


@pytest.mark.parametrize("seed", range(3))
def test_bounds_hold_for_every_anchor(seed):
    from weftline.llm.shared_lists import Clusters

    random_ = np.random.default_rng(seed)
    anchors, rows = random_.normal(size=(50, 5)) * 300, random_.normal(size=(300, 5)) * 300
    unit = anchors / np.sqrt((anchors**2).sum(1, keepdims=True))
    clusters = Clusters(5, centres_of(unit, 4))
    cluster, angle = clusters.of(anchors)
    for c in np.unique(cluster):
        mine = cluster == c
        bound = clusters.bounds(int(c), float(angle[mine].max()), rows)
        assert (unit[mine] @ rows.T <= bound[None, :]).all()
