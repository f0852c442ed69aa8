"""Approximate nearest neighbours by cosine, with a hierarchical k-means tree.

The tree is fitted on a bounded sample and has a bounded number of leaves, so it can be
handed to every task; all rows are put into its leaves. A query visits leaves best bin
first: a priority queue of tree nodes, nearest centre first. How many leaves to visit is
widened until a sample of queries, compared with all rows, reaches the wanted recall.
Leaves are cut into blocks of bounded size, so a leaf that holds a third of all rows is
many tasks; vectors that are repeated count only with their smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import column, hint_small
from weftline.workspace import materialize

SAMPLE_ROWS = 20_000
CALIBRATION_QUERIES = 200
TARGET_RECALL = 0.97
BRANCHES = 8
LEAF_ROWS = 1_000
MAX_LEAVES = 4_096
BLOCK_ROWS = 8_192
SEED = 7


def _centres(rows: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    centres = rows[random.choice(len(rows), k, replace=False)]
    for _ in range(12):
        nearest = np.argmin(((centres**2).sum(1))[None, :] - 2 * rows @ centres.T, axis=1)
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


class Tree:
    """Nodes with a centre each; ``children`` is None at leaves, which are numbered."""

    def __init__(self, rows: np.ndarray, leaf_rows: float, branches: int = BRANCHES, max_leaves: int = MAX_LEAVES):
        self.centres: list[np.ndarray] = [rows.mean(0)]
        self.children: list[list[int] | None] = [None]
        self.leaf_of: dict[int, int] = {}
        random = np.random.default_rng(SEED)
        open_nodes, leaves = [(0, rows)], 1
        while open_nodes:
            node, own = open_nodes.pop(0)
            distinct = len(np.unique(own, axis=0)) if len(own) <= 2 * branches else branches
            k = min(branches, distinct)
            if len(own) <= leaf_rows or k < 2 or leaves + k - 1 > max_leaves:
                continue
            centres = _centres(own, k, random)
            nearest = np.argmin((centres**2).sum(1)[None, :] - 2 * own @ centres.T, axis=1)
            filled = [i for i in range(k) if (nearest == i).any()]
            if len(filled) < 2:
                continue
            self.children[node] = []
            leaves += len(filled) - 1
            for i in filled:
                self.children[node].append(len(self.centres))
                open_nodes.append((len(self.centres), own[nearest == i]))
                self.centres.append(centres[i])
                self.children.append(None)
        self.leaf_of = {n: i for i, n in enumerate(n for n, below in enumerate(self.children) if below is None)}

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf each row falls into, going to the nearest centre at every node."""
        out = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            below = self.children[node]
            if below is None:
                out[at] = self.leaf_of[node]
                continue
            centres = np.stack([self.centres[n] for n in below])
            nearest = np.argmin((centres**2).sum(1)[None, :] - 2 * rows[at] @ centres.T, axis=1)
            todo.extend((n, at[nearest == i]) for i, n in enumerate(below) if (nearest == i).any())
        return out

    def best_bins(self, query: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves, best bin first."""
        centres = self._matrix()
        distance = (centres**2).sum(1) - 2 * centres @ query
        queue, found = [(0.0, 0)], []
        while queue and len(found) < visits:
            _, node = heappop(queue)
            if self.children[node] is None:
                found.append(self.leaf_of[node])
            else:
                for n in self.children[node]:
                    heappush(queue, (float(distance[n]), n))
        return found

    def _matrix(self) -> np.ndarray:
        if not hasattr(self, "_stacked"):
            self._stacked = np.stack(self.centres)
        return self._stacked


def _usable(vector: Column) -> Column:
    """Not null, no null or non-finite part, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(1, keepdims=True))


def _scored(queries: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
    """(query number, row number, cosine) of each query's k nearest rows, ties to smaller ids."""
    norms, query_norms = np.sqrt((rows * rows).sum(1)), np.sqrt((queries * queries).sum(1))
    for at in range(0, len(queries), 512):
        part = queries[at:at + 512]
        rough = (part @ rows.T) / norms[None, :]
        wanted = min(k + 16, len(rows))
        near = np.argpartition(-rough, wanted - 1, axis=1)[:, :wanted]
        for i, own in enumerate(near):
            # One formula for all final scores: equal vectors get equal scores wherever they lie.
            exact = (rows[own] * part[i]).sum(1) / (norms[own] * query_norms[at + i])
            for j in np.lexsort((row_ids[own], -exact))[:k]:
                yield at + i, own[j], float(exact[j])


def nearest(
    vectors: DataFrame, queries: Column, *, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5,
    sample_rows: int = SAMPLE_ROWS, target_recall: float = TARGET_RECALL, leaf_rows: int = LEAF_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row that ``queries`` selects.

    Score is the cosine of the original vectors in double precision; of equal scores the
    smaller id is nearer. A query is no candidate for itself; with fewer candidates than k
    all are returned, with none there is no row. Vectors that are null, zero, hold null or
    non-finite parts, or have another length than most, and rows with a null id, take no
    part. Of rows with one id and several vectors each is a row; a row repeated with its id
    counts once. An empty table gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    own = vectors.select(
        column(vec_id).cast("bigint").alias("vec_id"), column(embedding).alias("embedding"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    ).where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    lengths = own.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    own = own.where(F.size("embedding") == lengths["n"])
    # Of equal vectors the k + 1 smallest ids can be among the nearest; the limit works before the shuffle.
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    rows = own.select("vec_id", "embedding").withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")
    rows = materialize(rows.distinct(), "vectors")
    asked = own.where("asks").select("vec_id", "embedding").distinct()
    groups = asked.groupBy("embedding").agg(F.min("vec_id").alias("query"))
    asked = materialize(asked.join(groups, "embedding").select(F.col("vec_id").alias("query_id"), "query"), "asked")
    groups = materialize(groups, "queries")

    count = rows.count()
    share = min(1.0, sample_rows / max(count, 1))
    picked = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) <= int(share * (1 << 20)))
    sample = _unit(_matrix(picked.select("embedding").toPandas()["embedding"])) if count else np.zeros((1, lengths["n"]))
    tree = Tree(sample, max(1.0, leaf_rows * len(sample) / max(count, 1)))

    def fall(batch: pd.Series) -> pd.Series:
        return pd.Series(tree.leaves(_unit(_matrix(batch))))

    leaf = F.pandas_udf(fall, "bigint")
    placed = materialize(rows.withColumn("leaf", leaf("embedding")), "placed")
    visits = _calibrated(tree, placed, groups, k, target_recall)

    sizes = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))  # a row per leaf, so bounded

    def visit(batch: pd.Series) -> pd.Series:
        return pd.Series([tree.best_bins(query, visits) for query in _unit(_matrix(batch))], dtype=object)

    bins = F.pandas_udf(visit, "array<bigint>")
    probes = materialize(groups.withColumn("leaf", F.explode(bins("embedding"))), "probes")
    loads = probes.groupBy("leaf").agg(F.count(F.lit(1)).alias("load"))
    blocks = sizes.join(loads, "leaf").select(
        "leaf", F.ceil(F.col("size") / block_rows).alias("row_blocks"), F.ceil(F.col("load") / block_rows).alias("query_blocks")
    )
    blocks = hint_small(materialize(blocks, "blocks"), 64)

    def dealt(side: DataFrame, key: str, own_blocks: str, other_blocks: str) -> DataFrame:
        """Each row in its own block, once for every block of the other side."""
        own_block = F.pmod(F.xxhash64(key), F.col(own_blocks)).alias(own_blocks[:-1])
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other_blocks) - 1)).alias(other_blocks[:-1])
        return side.join(blocks, "leaf").select("leaf", own_block, every, key, "embedding")

    left = dealt(probes, "query", "query_blocks", "row_blocks")
    right = dealt(placed, "vec_id", "row_blocks", "query_blocks")
    key = ["leaf", "query_block", "row_block"]

    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            ids, asking = rows["vec_id"].to_numpy(), queries["query"].to_numpy()
            hits = _scored(_matrix(queries["embedding"]), _matrix(rows["embedding"]), ids, k + 1)
            found = [(asking[q], ids[r], score) for q, r, score in hits]
        return pd.DataFrame(found, columns=["query", "vec_id", "score"])

    hits = left.groupBy(key).cogroup(right.groupBy(key)).applyInPandas(search, "query bigint, vec_id bigint, score double")
    # A vector's own id may be among the k + 1; what is left per query is cut to k.
    order = [F.desc("score"), "vec_id"]
    best = hits.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("place") <= k + 1)
    answers = asked.join(best, "query").where("vec_id != query_id")
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _calibrated(tree: Tree, placed: DataFrame, groups: DataFrame, k: int, target: float) -> int:
    """Leaves to visit so that a bounded sample of queries finds ``target`` of its true neighbours.

    The sample is compared with all rows where they lie; each task returns k rows a query.
    """
    total = groups.count()
    share = min(1.0, CALIBRATION_QUERIES / max(total, 1))
    sample = groups.where(F.pmod(F.xxhash64("query"), F.lit(1 << 20)) <= int(share * (1 << 20))).toPandas()
    if sample.empty:
        return 1
    asking, ids = _matrix(sample["embedding"]), sample["query"].to_numpy()

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch["vec_id"].to_numpy()
            hits = _scored(asking, _matrix(batch["embedding"]), rows, k + 1)
            found = [(int(ids[q]), int(rows[r]), int(batch["leaf"].iloc[r]), score) for q, r, score in hits if rows[r] != ids[q]]
            yield pd.DataFrame(found, columns=["query", "vec_id", "leaf", "score"])

    true = placed.mapInPandas(compare, "query bigint, vec_id bigint, leaf bigint, score double")
    true = true.withColumn(
        "place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    ).where(F.col("place") <= k).toPandas()
    order = {int(q): {leaf: n for n, leaf in enumerate(tree.best_bins(v, len(tree.leaf_of)))} for q, v in zip(ids, _unit(asking), strict=True)}
    depth = sorted(order[q][leaf] for q, leaf in zip(true["query"], true["leaf"], strict=True))
    return 1 + depth[min(len(depth) - 1, int(np.ceil(target * len(depth))) - 1)] if depth else 1
