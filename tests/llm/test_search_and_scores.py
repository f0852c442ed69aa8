"""Nearest neighbours, licenses and toxicity against brute force and held-out rows."""

import gc
import random
import re
import weakref

import numpy as np
import pytest
from docs_fixture import make_docs  # noqa: F401
from pyspark.sql import functions as F

from weftline.llm.kmeans_tree import Tree, nearest
from weftline.llm.licenses import TEMPLATES, scan_licenses, template_bigrams
from weftline.llm.toxicity import Lexicon, allowed_edits, classify, held_out, quotations


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, query_id string, leaf string")


def brute(rows, k):
    usable = [(i, np.array(v, np.float64)) for i, v, *_ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in usable:
        if i % 50:
            continue
        scored = sorted((-(float((q * v).sum()) / (np.sqrt((q * q).sum()) * np.sqrt((v * v).sum()))), j) for j, v in usable if j != i)
        out[i] = [(j, -s) for s, j in scored[:k]]
    return out


@pytest.mark.parametrize("block_rows", [8_192, 60])
def test_neighbours_reach_the_recall(spark, block_rows):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 12] + 0.6 * rng.normal(size=16)], "c", "c") for i in range(1500)]
    rows += [(1500 + i, rows[7][1], "c", "c") for i in range(500)]  # one common vector
    rows += [(5000, None, "c", "c"), (5050, [0.0] * 16, "c", "c"), (5100, [float("nan")] * 16, "c", "c"), (5150, [1.0, None] * 8, "c", "c"), (None, rows[0][1], "c", "c")]
    got = {}
    result = nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0, leaf_rows=100, block_rows=block_rows)
    for r in result.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(rows, 5)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
    same = [q for q in want if 1500 <= q < 2000]
    assert all([j for j, _ in got[q]] == [j for j, _ in want[q]] for q in same)


def test_few_and_no_candidates(spark):
    rows = [(0, [1.0, 0.0], "c", "c"), (1, [1.0, 1.0], "c", "c"), (50, [0.0, 2.0], "c", "c"), (3, [1.0], "c", "c")]
    got = [tuple(r) for r in nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert [(q, n, v) for q, n, v, _ in got] == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert nearest(vectors(spark, rows[:1]), F.col("vec_id") % 50 == 0).count() == 0
    assert nearest(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_best_bins_come_in_order_and_are_complete():
    rows = np.random.default_rng(1).normal(size=(500, 8))
    tree = Tree(rows, 20)
    order = tree.best_bins(rows[0], 10_000)
    assert sorted(order) == list(range(len(tree.leaf_of))) and len(order) > 10
    assert set(tree.leaves(rows)) <= set(order)


def test_licenses_equal_a_full_comparison(spark, make_docs):
    rng = random.Random(2)
    notices = [w for ws in TEMPLATES.values() for w in ws]
    filler = "the quick brown fox jumps over a lazy dog and runs under the license of nature".split()
    rows = []
    for i in range(120):
        lines = [" ".join(rng.choice(filler) for _ in range(rng.randint(1, 30))) for _ in range(4)]
        if i % 2:
            words = rng.choice(notices).split()
            for _ in range(rng.choice([0, 0, 1, 3])):
                words[rng.randrange(len(words))] = "changed"
            lines.insert(rng.randrange(4), " ".join(words))
        rows.append((i, rng.choice(["\n", "\n\n"]).join(lines)))
    rows += [(500, None), (501, ""), (502, "All rights reserved."), (502, "All rights reserved."), (None, "released under the MIT license"), (503, "x " * 50_000)]
    got = {(r.doc_id, r.license): (r.dice, r.n_units) for r in scan_licenses(make_docs(rows, dice="clash", license="clash")).collect()}
    want, units = {}, {}
    for doc, text in rows:
        own = set((text or "").split("\n")) | set(re.split(r"\n\s*\n", text or "")) | {text or ""}
        units.setdefault(doc, set()).update(frozenset(template_bigrams(unit)) for unit in own)
    for doc, seen in units.items():
        for bigrams in seen - {frozenset()}:
            best = min((-2 * len(bigrams & set(b)) / (len(bigrams) + len(b)), name) for name, ws in TEMPLATES.items() for b in map(template_bigrams, ws))
            if -best[0] >= 0.8:
                dice, n = want.get((doc, best[1]), (0, 0))
                want[doc, best[1]] = (max(dice, -best[0]), n + 1)
    assert got == want and len(got) > 40
    assert scan_licenses(make_docs([])).count() == 0


def test_automata_equal_edit_distance():
    def prefix_distance(term, word):
        row = list(range(len(term) + 1))
        best = row[-1]
        for letter in word:
            row = _next(row, term, letter)
            best = min(best, row[-1])
        return best

    def _next(row, term, letter):
        out = [row[0] + 1]
        for i, own in enumerate(term):
            out.append(min(out[i] + 1, row[i + 1] + 1, row[i] + (own != letter)))
        return out

    rng = random.Random(6)
    terms = {"idiot": (3.0, 1.0), "moron": (2.0, 1.5), "worthless": (4.0, 2.0), "bad": (1.0, 0.5)}
    lexicon = Lexicon(terms)
    for _ in range(4000):
        word = list(rng.choice([*terms, "idol", "morning", "worth"]))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "o"])
        word = "".join(word) + rng.choice(["", "s", "ness"])
        found, exact = lexicon.match(word)
        exact_terms = [t for t in terms if word.startswith(t)]
        if exact_terms:
            assert exact and found == max(exact_terms, key=len)
        elif found:
            assert not exact and prefix_distance(found, word) <= allowed_edits(found)
        else:
            # The first letter has to be the term's own, so only such words must be found.
            assert not any(word[:1] == t[0] and prefix_distance(t[1:], word[1:]) <= allowed_edits(t) for t in terms)


def test_first_letters_can_be_misspelled():
    lexicon = Lexicon({"idiot": (3.0, 1.0), "pathetic": (3.0, 1.5), "worthless": (4.0, 2.0), "bad": (1.0, 0.5)})
    found = {"1diot": "idiot", "diot": "idiot", "xidiots": "idiot", "xathetic": "pathetic", "xpathetic": "pathetic",
             "orthless": "worthless", "vvorthless": "worthless", "rthless": "worthless", "xxworthless": "worthless"}
    assert {word: lexicon.match(word) for word in found} == {word: (term, False) for word, term in found.items()}
    for word in ("xad", "ad", "iot", "xxdiot", "xxpathetic", "thless", "xxxworthless"):
        assert lexicon.match(word) == (None, False)


def labelled(make_docs, spark, count=900):
    rng = random.Random(8)
    clean = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrt"]
    rows, labels = [], []
    for i in range(count):
        words = [rng.choice(clean) for _ in range(rng.randint(20, 80))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                term = list(rng.choice(["schmorgel", "plinkert", "vrazzo"]))
                if rng.random() < 0.2:
                    term[rng.randrange(2, len(term))] = "z"
                words[rng.randrange(len(words))] = "".join(term)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxic_rows_are_found_and_clean_ones_left(spark, make_docs):
    rows, labels = labelled(make_docs, spark)
    rows += [(5000, None), (5001, ""), (5002, "schmorgel " * 20_000), (None, "plinkert vrazzo schmorgel bad"), (5002, "bal bam")]
    docs = make_docs(rows, score="clash", hits="clash", toxic="clash")
    got = classify(docs, labels).collect()
    assert len(got) == len(rows)
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in got if r.held_out and r.doc_id in toxic]
    right = sum(r.predicted == toxic[r.doc_id] for r in held)
    assert len(held) > 200 and right >= 0.97 * len(held)
    by_id = {(r.doc_id, r.hits > 0): r for r in got}
    assert by_id[5000, False].predicted == by_id[5001, False].predicted == 0
    assert by_id[5002, True].predicted == 1 and by_id[None, True].predicted == 1
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_rows_do_not_matter(spark, make_docs):
    rows, labels = labelled(make_docs, spark, 300)
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = sorted(map(tuple, classify(make_docs(rows), labels).collect()))
    two = sorted(map(tuple, classify(make_docs(rows), turned).collect()))
    assert one == two


def test_a_lexicon_goes_with_its_last_user():
    gc.disable()  # each task has a lexicon of its own, and a process runs many tasks between two collections
    try:
        lexicon = Lexicon({"idiot": (3.0, 1.0)})
        before = lexicon.features("you idiot and idiots")
        lexicon.forget()
        assert lexicon.features("you idiot and idiots") == before and before[3] == 2
        left = weakref.ref(lexicon)
        del lexicon
        assert left() is None
    finally:
        gc.enable()


def test_quoted_terms_weigh_less():
    lexicon = Lexicon({"idiot": (3.0, 1.0)})
    used, quoted = lexicon.features("you idiot go away now"), lexicon.features('you "idiot" go away now')
    assert used[0] > quoted[0] > 0 and used[3] == quoted[3] == 1


def test_long_quotations_are_paired_over_the_whole_text():
    lexicon, calm = Lexicon({"idiot": (3.0, 1.0)}), "calm words\n" * 80
    weighed = {name: lexicon.features(text)[0] for name, text in {
        "used": "idiot", "quoted": 'say "idiot" now', "long": f'say "{calm}idiot" now', "paragraphs": f'say "{calm}\n\n"idiot" now',
        "typographic": f"say “{calm}idiot” now", "german": f"sag „{calm}idiot“ nun", "french": f"dit «{calm}idiot» ici",
        "between": f'"{calm}" idiot "{calm}"', "lone": f'a 5" pipe, idiot, "{calm}"', "open": f'"{calm} idiot', "stray": f'"{calm} "a" idiot "b"',
    }.items()}
    full, less = weighed["used"], weighed["quoted"]
    assert full > less > 0
    assert {name for name, value in weighed.items() if value == less} == {"quoted", "long", "paragraphs", "typographic", "german", "french"}
    assert {name for name, value in weighed.items() if value == full} == {"used", "between", "lone", "open", "stray"}


def test_quotations_in_four_languages_and_stray_marks():
    """Each text names by [ ] what its marks quote; the brackets are not part of it."""
    for marked in (
        "Er sagte [»du Idiot«] … du Idiot … [»Halt«]", "Il dit [«mon idiot»] … idiot … [« non »], puis", "Han sa [”din idiot”] och idiot och [”nej”].",
        "She said [‘you idiot’], it's the dogs’ idiot [‘no’].", "[‹oui›] idiot [›nein‹]", "Sie rief [„du Idiot“], Idiot, [‚nein‘].",
        "l’idiot n’est pas l’ami", "[“one ‘two’ three”] four", 'a 5" pipe, idiot, ["b"]', "no “end idiot\n\nidiot ”here", 'say ["a\n\n"b\n\n"c"] d',
        'say "a\n\nb" c\n\nd ["e"]', "“open idiot", "idiot”", "", "»", '["a"]["b"]',
    ):
        text, spans, start = "", [], None
        for letter in marked:
            if letter == "[":
                start = len(text)
            elif letter == "]":
                spans.append((start, len(text)))
            else:
                text += letter
        assert quotations(text) == spans, marked


def test_without_labels_of_both_kinds(spark, make_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r.predicted for r in classify(make_docs([(1, "a"), (2, None)]), none).collect()] == [0, 0]
    assert classify(make_docs([]), none).count() == 0
