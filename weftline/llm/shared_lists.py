"""Hard negatives by exact inner products: clustered anchors share one candidate list each.

Anchors are clustered by direction. For a candidate at angle t from a cluster's centre,
no anchor at most r from that centre can have a larger inner product than
|candidate| |anchor| cos(max(0, t - r)). So each cluster has one list of all candidates,
sorted once by that bound, and every anchor of the cluster walks it from the top until
what it has found is better than anything the rest of the list can give.

Lists are walked in stretches, all clusters at once. Rows are dealt to blocks, which hold
their part of every list: the anchors that are still walking go to the blocks, each cluster
is compared there with the block's rows of its stretch, and the best of each block go on.
So no row is copied for each cluster. An anchor walks once for all that it looks for (it
has one range of scores for each positive); ranges that are certified finished take no part
in the next stretch, and nothing below the best found so far is looked at again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import column
from weftline.workspace import materialize, scratch

#: Anchors that the centres are fitted on at most, chosen by a hash of their row, and per cluster.
SAMPLE_ANCHORS = 20_000
ANCHORS_PER_CLUSTER = 64
MOST_CLUSTERS = 256
#: The first stretch of a list, as a share of it; up to the end of each next one it is four times as much.
FIRST_SHARE = 1 / 32
BLOCK_ROWS = 4_096
SEED = 11

#: Rows that the ends of stretches are taken from at most; they decide the speed only.
SAMPLE_ROWS = 20_000
#: Anchors that go to a block of rows together, about, and of these at most so many are compared at once.
ANCHOR_BLOCK = 8_192
ANCHOR_CHUNK = 512

#: Added to bounds so that rounding never makes one too small.
_SLACK = 1e-9

#: The range of all scores.
_LOWEST, _HIGHEST = -(2**63), 2**63 - 1
_WANTS = "array<struct<want int, least bigint, most bigint>>"


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def quantised(vector: Column) -> Column:
    """Each part as floor(256 x); parts beyond what a long holds become its nearest value."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256))


def centres_of(rows: np.ndarray, k: int) -> np.ndarray:
    """Unit centres of ``k`` clusters by direction; fewer if there are fewer directions."""
    rows = np.unique(rows, axis=0)
    random = np.random.default_rng(SEED)
    centres = rows[random.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(10):
        nearest = np.argmax(rows @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        norms = np.sqrt((sums**2).sum(1, keepdims=True))
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centres)
    return centres


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()) if len(vectors) else np.empty((0, 0), np.int64)


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(np.float64) ** 2).sum(1))


def _units(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(_norms(rows), 1e-300)[:, None]


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows; beyond the range of a long, the nearest long."""
    top = float(max(np.abs(a.astype(np.float64)).max(initial=0), 1) * max(np.abs(b.astype(np.float64)).max(initial=0), 1)) * max(1, a.shape[1])
    if top < 2.0**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)


class Clusters:
    """Centres for vectors of one length; vectors of other lengths are one cluster a length, without a direction."""

    def __init__(self, length: int, centres: np.ndarray):
        self.length, self.centres = length, centres

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and angle to its centre of each row; cluster -1 - length where there is no centre."""
        if rows.shape[1] != self.length or not len(self.centres):
            return np.full(len(rows), -1 - rows.shape[1]), np.zeros(len(rows))
        units = _units(rows)
        cosines = units @ self.centres.T
        nearest = np.argmax(cosines, axis=1)
        return nearest, np.arccos(np.clip(cosines[np.arange(len(rows)), nearest], -1, 1))


    def has(self, cluster: int, length: int) -> bool:
        return length == (-1 - cluster if cluster < 0 else self.length)

    def bounds(self, cluster: int, radius: float, rows: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products of rows with any anchor of the cluster, per unit of the anchor's norm."""
        return self.bounds_of(cluster, radius, _norms(rows), _units(rows))

    def bounds_of(self, cluster: int, radius: float, norms: np.ndarray, units: np.ndarray) -> np.ndarray:
        """``bounds`` of rows with these norms and directions."""
        if cluster < 0:
            return norms * (1 + _SLACK)
        cosines = np.clip(units @ self.centres[cluster], -1, 1)
        apart = np.maximum(0, np.arccos(cosines) - radius - 1e-7)
        return norms * (np.cos(np.minimum(apart, np.pi)) + _SLACK)


def _by_length(batch: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lengths = batch.map(len).to_numpy()
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, np.stack(batch.iloc[at].to_numpy())


def hard_negatives(
    vectors: DataFrame, anchors: Column, label: Column, *, vec_id: str = "vec_id", embedding: str = "embedding",
    positives: int = 5, negatives: int = 5, least_percent: int = 80, most_percent: int = 100,
    anchors_per_cluster: int = ANCHORS_PER_CLUSTER, first_share: float = FIRST_SHARE, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows that ``anchors`` selects; ``label`` is a row's label. Parts of
    vectors become floor(256 x); a score is the exact integer inner product with the
    anchor, higher ones first, ties by smaller id. An anchor's positives are its first
    rows of equal label; for each, its negatives are the first rows of another label whose
    score is ``least_percent`` to ``most_percent`` of the positive's. With fewer rows all
    are returned; an anchor without positives, and a positive without negatives, gives no
    row. Rows with a null id, label or vector, or a null or non-finite part, take no part.
    A row repeated as a whole counts once; of rows with one id and different contents each
    is a row, but none is a partner of its own id. Vectors are compared with those of
    their own length only. An empty table gives no rows. Other columns are not read.
    """
    with scratch(vectors.sparkSession) as keep:
        return keep(_mined(
            vectors, anchors, label, vec_id, embedding, positives, negatives, least_percent, most_percent,
            anchors_per_cluster, first_share, block_rows,
        ), "negatives")


def _mined(
    vectors, anchors, label, vec_id, embedding, positives, negatives, least_percent, most_percent, per_cluster, first_share, block_rows,
) -> DataFrame:
    own = vectors.select(
        column(vec_id).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
        column(embedding).alias("embedding"), F.coalesce(anchors, F.lit(False)).alias("asks"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    own = own.withColumn("embedding", quantised(F.col("embedding"))).distinct()
    # Of equal vectors of one label only the smallest ids can come in, one more than are wanted as one may be the anchor.
    copies = Window.partitionBy("embedding", "label").orderBy("vec_id")
    most = max(positives, negatives) + 1
    rows = own.select("vec_id", "label", "embedding").withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= most)
    rows = materialize(rows.drop("copy"), "rows")
    asking = own.where("asks").select("vec_id", "label", "embedding").withColumn("row", F.monotonically_increasing_id())
    lists = Lists(materialize(asking, "asking"), rows, per_cluster, first_share, block_rows)

    whole_range = F.array(F.struct(F.lit(0).alias("want"), F.lit(_LOWEST).alias("least"), F.lit(_HIGHEST).alias("most")))
    best = lists.walk(lists.asking.withColumn("wants", whole_range.cast(_WANTS)), True, positives)
    partners = best.select("row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # The limits in whole numbers: least_percent * positive <= 100 * negative <= most_percent * positive.
    whole = F.col("positive_score").cast("decimal(25,0)")
    low, high = (F.ceil(whole * least_percent / 100).cast("bigint"), F.floor(whole * most_percent / 100).cast("bigint"))
    partners = partners.withColumns({"least": low, "most": high}).where("least <= most")
    wanted = partners.withColumn("want", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")))
    wanted = materialize(wanted, "wanted")
    wants = wanted.groupBy("row").agg(F.collect_list(F.struct("want", "least", "most")).cast(_WANTS).alias("wants"))
    mined = lists.walk(materialize(lists.asking.join(wants, "row"), "wanting"), False, negatives)
    ranks = Window.partitionBy("row", "want").orderBy(F.desc("score"), "vec_id")
    named = wanted.join(lists.asking.select("row", F.col("vec_id").alias("anchor_id")), "row")
    named = named.select("row", "want", "anchor_id", "positive_id", "positive_score")
    return mined.withColumn("rank", F.row_number().over(ranks)).join(named, ["row", "want"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def _fitted(asking: DataFrame, per_cluster: int) -> Clusters:
    """Centres from a bounded sample of the anchors of the most frequent length."""
    lengths = asking.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None or lengths["n"] < 1:
        return Clusters(0, np.empty((0, 0)))
    sample = _sampled(asking.where(F.size("embedding") == lengths["n"]), lengths["count"], SAMPLE_ANCHORS, "row")
    k = int(np.clip(round(lengths["count"] / per_cluster), 1, MOST_CLUSTERS))
    return Clusters(lengths["n"], centres_of(_units(np.stack(sample.to_numpy()).astype(np.float64)), k))


def _sampled(rows: DataFrame, count: int, most: int, key: str) -> pd.Series:
    """Vectors of about ``most`` rows at most, by a hash of ``key``; all if there are fewer."""
    share = min(1.0, most / max(count, 1))
    picked = rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 20)) <= int(share * (1 << 20)))
    return picked.select("embedding").toPandas()["embedding"]


class Lists:
    """Clustered anchors, and the shared candidate list of each cluster."""

    def __init__(self, asking: DataFrame, rows: DataFrame, per_cluster: int, first_share: float, block_rows: int):
        self.rows, self.block_rows = rows, block_rows
        self.clusters = clusters = _fitted(asking, per_cluster)

        def place(batch: pd.Series) -> pd.DataFrame:
            cluster, angle, norm = (np.zeros(len(batch)) for _ in range(3))
            for at, own in _by_length(batch):
                cluster[at], angle[at] = clusters.of(own)
                norm[at] = _norms(own)
            return pd.DataFrame({"cluster": cluster.astype(np.int64), "angle": angle, "norm": norm})

        placed = asking.withColumn("p", F.pandas_udf(place, "cluster bigint, angle double, norm double")("embedding"))
        self.asking = materialize(placed.select("*", "p.cluster", "p.angle", "p.norm").drop("p"), "placed")
        # A row per cluster: bounded by MOST_CLUSTERS and the number of vector lengths.
        radii = self.asking.groupBy("cluster").agg(F.max("angle").alias("radius")).collect()
        self.radius = {r["cluster"]: r["radius"] for r in radii}
        self.count = rows.count()
        self.cuts = self._cut(first_share)

    def _cut(self, first_share: float) -> dict[int, list[float]]:
        """Bounds at which stretches of each list end, from a bounded sample of rows; they decide the speed only."""
        sample = _sampled(self.rows, self.count, SAMPLE_ROWS, "vec_id")
        shares = []
        while first_share < 1:
            shares.append(first_share)
            first_share = 4 * first_share
        by_length = {own.shape[1]: own for _, own in _by_length(sample)}
        cuts = {}
        for cluster in self.radius:
            own = next((rows for length, rows in by_length.items() if self.clusters.has(cluster, length)), None)
            inner = [] if own is None else [float(x) for x in np.quantile(self.clusters.bounds(cluster, self.radius[cluster], own), [1 - s for s in shares])]
            cuts[cluster] = [*inner, *[-np.inf] * (len(shares) - len(inner)), -np.inf]
        return cuts

    def walk(self, asking: DataFrame, same_label: bool, k: int) -> DataFrame:
        """(row, want, vec_id, score): for each of the ``wants`` of a row of ``asking`` the k best rows with scores in its range."""
        schema = "row bigint, want int, vec_id bigint, score bigint"
        order = Window.partitionBy("row", "want").orderBy(F.desc("score"), "vec_id")
        blocks = max(1, -(-self.count // self.block_rows))
        dealt = self.rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(blocks)))
        best = None
        stretches = max((len(c) for c in self.cuts.values()), default=0)
        for number in range(stretches):
            count = asking.count()
            if not count:
                break
            parts = -(-count // ANCHOR_BLOCK)
            wants = [F.col(f"wants.{part}").alias(part) for part in ("want", "least", "most")]
            left = asking.select("row", "cluster", "vec_id", "label", "embedding", *wants).withColumns({
                "part": F.pmod(F.xxhash64("row"), F.lit(parts)), "block": _each(blocks),
            })
            right = dealt.withColumn("part", _each(parts))
            search = _compared(self._stretch(number), same_label, k)
            found = left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInPandas(search, schema)
            ranked = (found if best is None else best.union(found)).withColumn("place", F.row_number().over(order))
            best = materialize(ranked.where(F.col("place") <= k).drop("place"), "best")
            if number + 1 < stretches:
                asking = materialize(self._open(asking, best, number, k), "open")
        return best if best is not None else asking.sparkSession.createDataFrame([], schema)

    def _stretch(self, number: int) -> Callable[[int, np.ndarray, np.ndarray], np.ndarray]:
        """A function of a cluster and rows' norms and directions: places of the rows in this stretch of the cluster's list."""
        ends = {c: (cuts[number], np.inf if number == 0 else cuts[number - 1]) for c, cuts in self.cuts.items()}
        shape, radius = self.clusters, self.radius

        def inside(cluster: int, norms: np.ndarray, units: np.ndarray) -> np.ndarray:
            if not shape.has(cluster, units.shape[1]):
                return np.empty(0, np.int64)
            bound = shape.bounds_of(cluster, radius[cluster], norms, units)
            return np.flatnonzero((bound > ends[cluster][0]) & (bound <= ends[cluster][1]))

        return inside

    def _open(self, asking: DataFrame, best: DataFrame, number: int, k: int) -> DataFrame:
        """``asking`` with those wants for which the rest of the list may still hold something better, or equal with a smaller id."""
        ends = F.create_map(*[F.lit(x) for c, cuts in self.cuts.items() for x in (c, float(cuts[number]))])
        worst = best.groupBy("row", "want").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("worst")).where(F.col("found") >= k)
        worst = worst.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("want", "worst"))).alias("worst"))
        rest = F.col("norm") * ends[F.col("cluster")]
        # With k found, only what is no worse than these can still come in.
        raised = F.transform("wants", lambda w: w.withField("least", F.greatest(w["least"], F.col("worst")[w["want"]])))
        left = F.filter("wants", lambda w: ~(w["least"] > F.col("rest")) & (w["least"] <= w["most"]))
        ended = ends[F.col("cluster")] == float("-inf")
        going = asking.join(worst, "row", "left").where(~ended).withColumn("wants", raised).withColumn("rest", rest)
        return going.withColumn("wants", left).where(F.size("wants") > 0).select(*asking.columns)


def _each(count: int) -> Column:
    """Every number below ``count``, a row each."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))


def _compared(inside: Callable[[int, np.ndarray, np.ndarray], np.ndarray], same_label: bool, k: int):
    def search(asking: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, ...]] = []
        if len(asking) and len(rows):
            for at, vectors in _by_length(rows["embedding"]):
                ids, labels = rows["vec_id"].to_numpy()[at], rows["label"].to_numpy()[at]
                norms, units = _norms(vectors), _units(vectors)
                for cluster, own in asking.groupby("cluster"):
                    here = inside(cluster, norms, units)
                    for start in range(0, len(own) if len(here) else 0, ANCHOR_CHUNK):
                        some = own.iloc[start: start + ANCHOR_CHUNK]
                        found.extend(_best(some, ids[here], labels[here], vectors[here], same_label, k))
        parts = [np.concatenate(part) for part in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 4
        return pd.DataFrame(dict(zip(("row", "want", "vec_id", "score"), parts, strict=True)))

    return search


def _best(
    asking: pd.DataFrame, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, same_label: bool, k: int,
) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, want, vec_id, score) as arrays, for each want of each row of ``asking`` that finds something."""
    scores = inner_products(_matrix(asking["embedding"]), vectors)
    row, vec_id, label = (asking[name].to_numpy() for name in ("row", "vec_id", "label"))
    wants, least, most = (asking[name].to_list() for name in ("want", "least", "most"))
    fits = scores >= np.array([low.min() for low in least])[:, None]
    fits &= scores <= np.array([high.max() for high in most])[:, None]
    fits &= (labels == label[:, None]) == same_label
    fits &= ids != vec_id[:, None]
    for n in np.flatnonzero(fits.any(axis=1)):
        near = np.flatnonzero(fits[n])
        # Upwards, and of equal scores the larger ids first; a range's best are the last ones below its end.
        near = near[np.lexsort((~ids[near], scores[n, near]))]
        own = scores[n, near]
        end = np.searchsorted(own, most[n], "right")
        size = np.clip(end - np.searchsorted(own, least[n], "left"), 0, k)
        at = near[np.repeat(end - 1 + np.cumsum(size) - size, size) - np.arange(size.sum())]
        if len(at):
            yield np.full(len(at), row[n]), np.repeat(wants[n], size), ids[at], scores[n, at]
