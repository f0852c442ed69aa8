"""Exact, line and near-duplicate operators and sharding against brute force."""

import hashlib
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from docs_fixture import make_docs  # noqa: F401
from pyspark.sql import functions as F

from weftline.llm import exact_dedup
from weftline.llm.common import smallest_labels
from weftline.llm.exact_dedup import deduplicate, first_seen
from weftline.llm.jaccard import jaccard_groups
from weftline.llm.line_dedup import drop_boilerplate_lines, host_of
from weftline.llm.minhash import least_agreements, near_duplicate_groups
from weftline.llm.sharding import assign_shards, longest_walk, permuted, shard_digest, sides
from weftline.workspace import ROWS_A_TASK, materialize, new_folder


def similar_groups(rows, width, percent):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        grams = {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
        sets.append(grams)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            lowest[root(i)] = min(doc, lowest.get(root(i), doc))
    return sorted(((doc, len(s), lowest.get(root(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, groups=12, copies=8):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = [rng.choice(words) for _ in range(60)]
    rows, doc = [], 0
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([2, 3, 12, 40, 120, 300]))]
        for c in range(copies):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                own = own + shared  # a passage that unlike documents share
            rows.append((doc * 7 % 1000, " ".join(own).upper() if c == 1 else "\t ".join(own)))
            doc += 1
    return rows + [(5001, None), (5002, ""), (5003, " \n "), (None, rows[0][1]), (5004, "one"), (5005, "One"), (5004, "one")]


@pytest.mark.parametrize("groups,width,percent", [(jaccard_groups, 3, 90), (jaccard_groups, 5, 80), (near_duplicate_groups, 4, 80)])
def test_groups_equal_a_full_comparison(spark, make_docs, groups, width, percent):
    rows = corpus(width)
    docs = make_docs(rows, component_id="clash", n_shingles="clash")
    got = groups(docs.repartition(5), width=width, percent=percent, block_rows=7).collect()
    assert sorted((tuple(r) for r in got), key=str) == similar_groups(rows, width, percent)


@pytest.mark.parametrize("groups", [jaccard_groups, near_duplicate_groups])
def test_full_round_finds_all_links_alone(spark, make_docs, groups):
    rows = corpus(99, groups=5)
    got = groups(make_docs(rows), width=2, percent=80, first_round=False, block_rows=9).collect()
    assert sorted((tuple(r) for r in got), key=str) == similar_groups(rows, 2, 80)


@pytest.mark.parametrize("groups", [jaccard_groups, near_duplicate_groups])
def test_large_groups_that_are_not_linked(spark, make_docs, groups):
    """Copies of one text, each far enough from the others: all stand in common buckets, few are linked."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(150):
        own = list(base)
        for at in rng.sample(range(300), rng.choice([2, 9, 14])):
            own[at] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(own)))
    got = groups(make_docs(rows), width=3, percent=90, block_rows=64).collect()
    assert sorted((tuple(r) for r in got), key=str) == similar_groups(rows, 3, 90)


@pytest.mark.parametrize("groups", [jaccard_groups, near_duplicate_groups])
def test_no_documents_no_groups(spark, make_docs, groups):
    assert groups(make_docs([]), width=3).count() == 0
    assert [tuple(r) for r in groups(make_docs([(1, "a b c d")]), width=3).collect()] == [(1, 2, 1)]


def test_very_long_texts_are_read_whole(spark, make_docs):
    rng = random.Random(8)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(260_000))
    rows = [(1, text), (2, text + " and more"), (3, text[:len(text) // 2]), (4, "y" * 3_000_000), (5, "y" * 3_000_000 + "z")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicate_groups(make_docs(rows), width=4).collect()}
    words = text.split()
    whole = len(set(zip(words, words[1:], words[2:], words[3:])))
    assert got[1] == (whole, 1) and got[2][1] == 1 and got[3][1] == 3 and got[4] == (1, 4) and got[5] == (1, 5)


@pytest.mark.parametrize("places", [1, 32, 64, 160])
def test_posterior_bound_is_that_of_the_beta_law(places):
    """P(similarity >= t) by numeric integration of the posterior, just above and below the bound."""
    def posterior(m):
        grid = [i / 20_000 for i in range(20_001)]
        weight = [s**m * (1 - s) ** (places - m) for s in grid]
        return sum(w for s, w in zip(grid, weight) if s >= 0.8) / sum(weight)

    least = least_agreements(places, 80, 1e-4)
    assert posterior(least) >= 0.9e-4 and (least == 0 or posterior(least - 1) < 1.1e-4)


def test_labels_follow_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (300, 300)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    labels = {r.node: r.component for r in smallest_labels(frame, spark).collect()}
    assert all(labels[i] == 0 for i in range(61)) and labels[200] == labels[150] == 100


def stored(spark, rows, files=3):
    folder = new_folder(spark, "docs").removeprefix("file:") + "/documents.parquet"
    import os

    os.makedirs(folder)
    for n in range(files):
        own = rows[n::files]
        columns = {"doc_id": pa.array([r[0] for r in own], pa.int64()), "text": pa.array([r[1] for r in own], pa.string())}
        pq.write_table(pa.table(columns | {"digest": ["clash"] * len(own), "batch": [7] * len(own)}), f"{folder}/{n}.parquet")
    return folder


def same_texts(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc)
    out = []
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        out += [(doc, ids[0], len(ids), n == 0, digest) for n, doc in enumerate(ids)]
    return sorted(out, key=str)


COPIES = [
    (9, "a b"), (3, "a\n\tb"), (4, "a  b"), (4, "a b"), (1, None), (2, ""), (5, " "), (None, "x"), (None, "x"), (7, "x"), (8, "long " * 50_000), (6, "long  " * 50_000),
    (10, "ab"),
]


def test_exact_copies_over_several_batches(spark):
    path = stored(spark, COPIES)
    got = deduplicate(spark, path, files_per_batch=1)
    assert sorted((tuple(r) for r in got.collect()), key=str) == same_texts(COPIES)


def test_state_knows_what_earlier_runs_saw(spark):
    path, state = stored(spark, COPIES[:6], 2), new_folder(spark, "state")
    first_seen(spark, path, state=state).count()
    more = pa.table({"doc_id": pa.array([2, 0], pa.int64()), "text": ["a b", "new"], "digest": ["c", "c"], "batch": [1, 1]})
    pq.write_table(more, f"{path}/more.parquet")
    seen = {r.keep.doc_id: r.group_size for r in first_seen(spark, path, state=state).collect()}
    assert seen == {2: 5, 1: 2, 0: 1}


@pytest.mark.parametrize("files", [1, 3])
def test_neighbouring_tables_are_not_read(spark, files):
    import shutil

    path = stored(spark, COPIES, files)
    shutil.copytree(path, f"{path}_old")
    if files == 1:
        path = f"{path}/0.parquet"
        shutil.copy(path, f"{path}.bak.parquet")
    assert sorted((tuple(r) for r in deduplicate(spark, path).collect()), key=str) == same_texts(COPIES)


def test_equal_digests_of_unequal_texts_are_parted(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "digest_of", lambda text: F.lit("same").substr(1, 4))
    got = deduplicate(spark, stored(spark, COPIES)).drop("text_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((r[:4] for r in same_texts(COPIES)), key=str)


def test_an_empty_table_has_no_copies(spark):
    path = new_folder(spark, "none") + "/documents.parquet"
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(path)
    assert deduplicate(spark, path).count() == 0


def kept_lines(rows, ratio, least):
    pages, holding = {}, {}
    for _, text, host in rows:
        if text is not None:
            pages[host or ""] = pages.get(host or "", 0) + 1
            for line in {x.strip(" ") for x in text.split("\n")}:
                holding[host or "", line] = holding.get((host or "", line), 0) + 1
    out = []
    for doc, text, host in rows:
        if text is None:
            out.append((doc, None, 0))
            continue
        lines = text.split("\n")
        left = [
            x for x in lines
            if not x.strip(" ") or not (holding[host or "", x.strip(" ")] >= least and holding[host or "", x.strip(" ")] > ratio * pages[host or ""])
        ]
        out.append((doc, "\n".join(left), len(lines) - len(left)))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_lines_are_dropped_by_host(spark, make_docs, monkeypatch, broadcast_bytes):
    monkeypatch.setattr("weftline.llm.line_dedup.BROADCAST_BYTES", broadcast_bytes)
    rng = random.Random(1)
    rows = []
    for i in range(300):
        host = ["a", "a", "b", None][i % 4]
        lines = [f"own {i}", *[f"common {rng.randrange(12)}" for _ in range(3)], "", f"  menu {host} ", "twice", "twice"]
        rng.shuffle(lines)
        rows.append((i % 250, "\n".join(lines), host))
    rows += [(900, None, "a"), (901, "", "b"), (902, "menu a", "a"), (903, "line\n" * 3000, "c"), (903, "line\n" * 3000, "c")]
    docs = make_docs(rows, dropped_lines="clash", drop="clash", lines="clash")
    got = drop_boilerplate_lines(docs, host=F.col("source"), ratio=0.3, min_pages=3)
    assert got.columns == [*[c for c in docs.columns if c != "dropped_lines"], "dropped_lines"]
    assert sorted(((r.doc_id, r.text, r.dropped_lines) for r in got.collect()), key=str) == kept_lines(rows, 0.3, 3)
    assert drop_boilerplate_lines(docs.limit(0), host=F.col("source")).count() == 0


def test_hosts_of_urls(spark):
    urls = ["https://A.example.org:8080/x", "http://b.org", "no url", None, "ftp://c.net?q"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in frame.select(host_of(F.col("url"))).collect()] == ["a.example.org", "b.org", "", "", "c.net"]


@pytest.mark.parametrize("rows", [1, 2, 3, 10, 97, 1000])
def test_places_are_a_permutation(spark, rows):
    a, b = sides(rows)
    assert a * b >= rows and a * b - rows < a
    passes = longest_walk(spark, rows)
    places = sorted(r[0] for r in spark.range(rows).select(permuted(F.col("id"), rows, passes)).collect())
    assert places == list(range(rows))


def test_shards_are_even_and_reproducible(spark, make_docs):
    rows = [(i % 90, f"text {i % 95}") for i in range(200)] + [(None, None), (None, None), (3, "")]
    docs = make_docs(rows, shard="clash", slot="clash", number="clash")
    got = shard_digest(docs, 8).collect()
    assert len(got) == len(rows)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    sizes = [len(v) for v in by_shard.values()]
    assert len(by_shard) == 8 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    again = shard_digest(docs.repartition(7), 8).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    assert shard_digest(docs.limit(0), 8).count() == 0
    wide = assign_shards(docs.select("doc_id", "n_chars", "shard"), ["doc_id", "n_chars"], 3)
    assert wide.columns == ["doc_id", "n_chars", "shard", "slot"] and wide.count() == len(rows)


def test_tables_of_known_size_are_written_by_few_tasks(spark):
    rows = spark.range(3_000).repartition(8, "id")
    for given, tasks in ((None, 8), (0, 1), (3_000, 1), (ROWS_A_TASK + 1, 2), (100 * ROWS_A_TASK, 8)):
        written = materialize(rows, "sized", rows=given)
        assert len(written.inputFiles()) == tasks
        assert sorted(r.id for r in written.collect()) == list(range(3_000))
