"""Neighbour search against a full comparison in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.operators import knn
from weftline.operators.knn import hvdm_features, impute

SCHEMA = "id bigint, a double, b double, kind string, place string, target double"


def fixture_rows(count=150, seed=1, gaps=False):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(count):
        hot = i % 3 == 0  # a third of all rows share one feature vector
        a = 0.5 if hot else float(np.round(rng.normal(), 3))
        b = 0.25 if hot else float(np.round(rng.exponential(), 3))
        if gaps and rng.random() < 0.2:
            a = None
        if gaps and rng.random() < 0.2:
            b = None
        target = None if rng.random() < 0.25 else float(rng.integers(0, 1000))
        rows.append((i, a, b, "xyz"[rng.integers(3)], "pq"[rng.integers(2)], target))
    return rows


def whole(value):
    return np.floor(value * (1 << 20) + 0.5)


def brute_force(rows, k, metric, same_place=False, nominal=False):
    known = {j: [r[j] for r in rows if r[j] is not None] for j in (1, 2)}
    low = {j: min(v) for j, v in known.items()}
    span = {j: max(v) - min(v) for j, v in known.items()}

    def unit(row, j):
        return None if row[j] is None else (row[j] - low[j]) / span[j]

    def distance(p, q):
        parts = []
        for j in (1, 2):
            x, y = unit(p, j), unit(q, j)
            if x is not None and y is not None:
                parts.append((x - y) * (x - y) if metric == "euclidean" else abs(x - y))
        return sum(parts) * (2 / len(parts)) if parts else None

    answer = {}
    column = 3 if nominal else 5
    for p in rows:
        if p[5] is not None:
            continue
        found = []
        for q in rows:
            if q[5] is None or (same_place and p[4] != q[4]):
                continue
            d = distance(p, q)
            if d is not None:
                found.append((d, q[0], q[column]))
        best = [value for _, _, value in sorted(found)[:k]]
        if nominal:
            answer[p[0]] = min(set(best), key=lambda v: (-best.count(v), v)) if best else None
        else:
            answer[p[0]] = sum(best) / len(best) if best else None
    return answer


@pytest.mark.parametrize("metric,gaps,local,leaf", [
    ("euclidean", False, False, 4), ("manhattan", True, True, 4), ("euclidean", True, False, 1),
])
def test_equals_full_comparison(spark, metric, gaps, local, leaf):
    rows = fixture_rows(gaps=gaps)
    df = spark.createDataFrame(rows, SCHEMA)
    block = F.col("place") if local else None
    out = impute(df, "id", "target", ["a", "b"], 3, metric, block, leaf_vectors=leaf).collect()
    assert len(out) == len(rows)
    expected = brute_force(rows, 3, metric, local)
    got = {r["id"]: r["target"] for r in out}
    for row in rows:
        if row[5] is not None:
            assert got[row[0]] == row[5]
        elif expected[row[0]] is None:
            assert got[row[0]] is None
        else:
            assert got[row[0]] == pytest.approx(expected[row[0]], abs=1e-9)


def test_nominal_target_takes_most_frequent_value(spark):
    rows = fixture_rows(seed=3)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("kind", F.when(F.col("target").isNotNull(), F.col("kind")))
    out = {r["id"]: r["kind"] for r in impute(df, "id", "kind", ["a", "b"], 3, leaf_vectors=4).collect()}
    for key, value in brute_force(rows, 3, "euclidean", nominal=True).items():
        assert out[key] == value


def test_too_few_donors_and_constant_feature(spark):
    rows = [(1, 1.0, 2.0, "x", "p", 10.0), (2, 1.0, 3.0, "x", "p", None), (3, 1.0, 9.0, "x", "q", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r["id"]: r["target"] for r in impute(df, "id", "target", ["a", "b"], 3).collect()}
    assert out == {1: 10.0, 2: 10.0, 3: 10.0}
    local = impute(df, "id", "target", ["a", "b"], 3, block=F.col("place"))
    assert {r["id"]: r["target"] for r in local.collect()} == {1: 10.0, 2: 10.0, 3: None}


def test_value_difference_metric(spark):
    rows = fixture_rows(count=90, seed=5)
    df = spark.createDataFrame(rows, SCHEMA)
    ready, names = hvdm_features(df, ["a", "b"], ["kind"], "place")
    out = {r["id"]: r["target"] for r in impute(ready, "id", "target", names, 3, scale=False, leaf_vectors=4).collect()}
    spread = {j: np.round(np.std([r[j] for r in rows]), 6) for j in (1, 2)}
    share = {
        v: [np.mean([r[4] == c for r in rows if r[3] == v]) for c in "pq"] for v in "xyz"
    }
    for p in rows:
        if p[5] is not None:
            continue
        ranked = sorted(
            (
                sum((whole(p[j] / (4 * spread[j])) - whole(q[j] / (4 * spread[j]))) ** 2 for j in (1, 2))
                + sum((whole(np.round(x, 6)) - whole(np.round(y, 6))) ** 2 for x, y in zip(share[p[3]], share[q[3]])),
                q[0], q[5],
            )
            for q in rows if q[5] is not None
        )
        assert out[p[0]] == pytest.approx(sum(r[2] for r in ranked[:3]) / 3)


def test_written_tables_do_not_grow_with_depth(spark, monkeypatch):
    """rows are written and shuffled a fixed number of times, however deep the space is cut."""
    labels = []

    def recorded(df, label, write=knn.materialize):
        labels.append(label)
        return write(df, label)

    monkeypatch.setattr(knn, "materialize", recorded)
    df = spark.createDataFrame(fixture_rows(count=200, seed=7), SCHEMA)
    counts = []
    for leaf in (200, 1):
        labels.clear()
        impute(df, "id", "target", ["a", "b"], 3, leaf_vectors=leaf).collect()
        counts.append(len(labels))
    # Only the pairs with other tiles and their slices come on top of what a single tile needs.
    assert counts[1] <= counts[0] + 2


@pytest.mark.parametrize("gaps,local", [(False, False), (True, True)])
def test_crowded_tiles_are_met_in_slices(spark, monkeypatch, gaps, local):
    monkeypatch.setattr(knn, "SLICE_PROBES", 2)
    monkeypatch.setattr(knn, "_HELD", 16)
    rows = fixture_rows(count=120, seed=11, gaps=gaps)
    df = spark.createDataFrame(rows, SCHEMA)
    block = F.col("place") if local else None
    got = {r["id"]: r["target"] for r in impute(df, "id", "target", ["a", "b"], 3, block=block, leaf_vectors=16).collect()}
    for key, value in brute_force(rows, 3, "euclidean", local).items():
        assert got[key] == (value if value is None else pytest.approx(value, abs=1e-9))
