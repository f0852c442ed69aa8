"""Exact k-nearest-neighbour imputation in tiles.

Comparing every incomplete row with every complete one grows with the product of both. Here
the complete rows' distinct feature vectors are dealt to tiles of about equal size, along the
medians of a bounded sample; boxes and counts of the tiles are taken from all rows. Each
incomplete vector is compared with its own tile first. Its k-th neighbour there bounds how
far a nearer one can be, so it is compared only with those other tiles whose boxes reach into
that distance, usually none. No pair is skipped unless it is proven not to matter, so the
result equals the full comparison, and a row is shuffled a fixed number of times, not once a level.

Rows that share all features are one vector with its k smallest ids, so a value shared by a
third of the table costs as much as a single row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.workspace import materialize

#: Vectors of a tile; more only where there would be over MOST_TILES tiles.
TILE_VECTORS = 4_096
#: Bounds the list of tiles, which the driver holds and every task reads.
MOST_TILES = 16_384
#: Sampled vectors per tile, from which the medians are taken; they decide speed only.
SAMPLE_PER_TILE = 16
#: Incomplete vectors of a tile that are compared in one go; a tile with more is met in several slices.
SLICE_PROBES = 16_384
#: Distances that are held at a time.
_HELD = 1 << 20

METRICS = {"euclidean": lambda x: x * x, "manhattan": np.abs}


class _Space:
    """Feature columns ``u0, u1, ...`` and the distance on them; a missing feature is NaN in arrays."""

    def __init__(self, size: int, gaps: set[int], metric: str):
        self.size = size
        self.gaps = gaps
        self.metric = metric
        self.names = [f"u{i}" for i in range(size)]

    def pattern(self) -> Column:
        """A digit per feature that some row lacks: 1 where this one does."""
        bits = [F.when(F.col(n).isNull(), "1").otherwise("0") for i, n in enumerate(self.names) if i in self.gaps]
        return F.concat(*bits) if bits else F.lit("")

    def matrix(self, rows, prefix: str = "u") -> np.ndarray:
        """The features of an Arrow table or batch, one row per vector."""
        columns = [rows.column(f"{prefix}{i}").to_pandas().to_numpy(dtype=float) for i in range(self.size)]
        return np.column_stack(columns)

    def measured(self, offsets: Iterator[np.ndarray]) -> np.ndarray:
        """The distance made of per-feature ``offsets``.

        Only features both sides know count, scaled up to all features; without any, the
        distance is NaN. Terms are added in fixed order, so equal distances are equal anywhere.
        """
        term = METRICS[self.metric]
        total = known = None
        for offset in offsets:
            part = term(offset)
            if self.gaps:
                there = ~np.isnan(part)
                part = np.where(there, part, 0.0)
                known = there.astype(float) if known is None else known + there
            total = part if total is None else total + part
        if not self.gaps:
            return total
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(known > 0, total * (float(self.size) / known), np.nan)

    def distances(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self.measured(x[:, None, i] - y[None, :, i] for i in range(self.size))

    def bounds(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """No vector in the box is nearer than the first, and none is farther than the second.

        Subtraction, the metric's terms and their sum in fixed order are monotonic in floating
        point too, so the bounds hold for the computed distances exactly.
        """
        below, above = low - x, x - high
        near = self.measured(np.maximum(np.maximum(below[:, i], above[:, i]), 0.0) for i in range(self.size))
        return near, self.measured(np.maximum(-below[:, i], -above[:, i]) for i in range(self.size))


class _Cuts:
    """A binary tree of ``depth`` levels over the space: a node sends on to the right what exceeds its cut."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros((1 << depth) - 1, dtype=int)
        self.cut = np.full((1 << depth) - 1, np.inf)
        # A missing feature stands before all others.
        held = [np.where(np.isnan(sample), -np.inf, sample)]
        for level in range(depth):
            below = []
            for at, rows in enumerate(held, start=(1 << level) - 1):
                self.axis[at], self.cut[at] = self._halves(rows)
                right = rows[:, self.axis[at]] > self.cut[at]
                below += [rows[~right], rows[right]]
            held = below

    @staticmethod
    def _halves(rows: np.ndarray) -> tuple[int, float]:
        if len(rows) < 2:
            return 0, np.inf
        finite = np.isfinite(rows)
        spread = np.where(finite, rows, -np.inf).max(axis=0) - np.where(finite, rows, np.inf).min(axis=0)
        axis = int(np.argmax(spread))
        values = np.sort(rows[:, axis])
        cut = values[(len(values) - 1) // 2]
        if cut == values[-1]:
            lower = values[values < cut]
            cut = lower[-1] if len(lower) else np.inf
        return axis, cut

    def leaves(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=int)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.axis[node]] > self.cut[node])
        return node - ((1 << self.depth) - 1)

    def leaf(self, names: list[str]) -> Column:
        if not self.depth:
            return F.lit(0)
        cuts = self

        def leaf(*features: pd.Series) -> pd.Series:
            return pd.Series(cuts.leaves(np.column_stack([f.to_numpy(dtype=float) for f in features])), dtype="int32")

        return F.pandas_udf(leaf, "int")(*names)


class _Forest:
    """The tiles' boxes, and those of ever larger groups of them, one tree per block and set of known features."""

    def __init__(self, tiles: pd.DataFrame, space: _Space):
        self.tiles = tiles["tile"].to_numpy(dtype=object)
        self.number = {tile: i for i, tile in enumerate(self.tiles)}
        low = tiles[[f"lo_{n}" for n in space.names]].to_numpy(dtype=float)
        high = tiles[[f"hi_{n}" for n in space.names]].to_numpy(dtype=float)
        lows, highs, counts = [low], [high], [tiles["vector_count"].to_numpy(dtype=float)]
        children = [np.full((len(tiles), 2), -1)]
        group = tiles.groupby(["block", "pattern"], sort=False).ngroup().to_numpy() if len(tiles) else np.zeros(0, int)
        depth, leaf = tiles["depth"].to_numpy(dtype=int), tiles["leaf"].to_numpy(dtype=int)
        total, roots = len(tiles), {}
        owner = tiles["block"].to_numpy(dtype=object)
        first_of = {int(g): owner[i] for i, g in reversed(list(enumerate(group)))}
        ids = groups = places = np.zeros(0, dtype=int)
        for level in range(int(depth.max(initial=0)), -1, -1):
            here = np.nonzero(depth == level)[0]
            ids, groups, places = np.concatenate([ids, here]), np.concatenate([groups, group[here]]), np.concatenate([places, leaf[here]])
            if not level:
                break
            keys, parent = np.unique((groups << level) + (places >> 1), return_inverse=True)
            up_low, up_high = np.full((len(keys), space.size), np.nan), np.full((len(keys), space.size), np.nan)
            below_low, below_high, below_count = np.concatenate(lows), np.concatenate(highs), np.concatenate(counts)
            np.fmin.at(up_low, parent, below_low[ids])
            np.fmax.at(up_high, parent, below_high[ids])
            up_count = np.bincount(parent, weights=below_count[ids], minlength=len(keys))
            up_children = np.full((len(keys), 2), -1)
            up_children[parent, places & 1] = ids
            for held, more in ((lows, up_low), (highs, up_high), (counts, up_count), (children, up_children)):
                held.append(more)
            groups, places = keys >> level, keys & ((1 << level) - 1)
            ids = total + np.arange(len(keys))
            total += len(keys)
        for node, g in zip(ids, groups):
            roots.setdefault(first_of[int(g)], []).append(int(node))
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)
        self.count, self.children = np.concatenate(counts), np.concatenate(children)
        self.roots = {block: np.array(nodes) for block, nodes in roots.items()}

    def reached(
        self, space: _Space, k: int, x: np.ndarray, blocks: list, reach: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probe, tile) pairs that can hold one of the ``k`` nearest, and the distance beyond which none lies."""
        starts = [self.roots.get(b, np.zeros(0, dtype=int)) for b in blocks]
        probe = np.repeat(np.arange(len(x)), [len(s) for s in starts])
        node = np.concatenate([np.zeros(0, dtype=int), *starts])
        reach, found = reach.copy(), []
        while len(node):
            near, far = space.bounds(x[probe], self.low[node], self.high[node])
            keep = near <= reach[probe]
            probe, node, near, far = probe[keep], node[keep], near[keep], far[keep]
            # The nearest boxes that together hold k vectors bound the distance of the k-th.
            order = np.lexsort((far, probe))
            held = np.cumsum(self.count[node[order]])
            first = np.searchsorted(probe[order], probe[order])
            before = np.concatenate([[0.0], held])[first]
            enough = held - before >= k
            np.minimum.at(reach, probe[order][enough], far[order][enough])
            keep = near <= reach[probe]
            probe, node, near = probe[keep], node[keep], near[keep]
            tile = node < len(self.tiles)
            found.append((probe[tile], node[tile], near[tile]))
            below = self.children[node[~tile]]
            probe, node = np.repeat(probe[~tile], 2), below.ravel()
            probe, node = probe[node >= 0], node[node >= 0]
        probe, node, near = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, dtype=int) for i in range(3))
        keep = near <= reach[probe]
        return probe[keep], node[keep], reach


def _donor_vectors(rows: DataFrame, space: _Space, k: int) -> DataFrame:
    """Distinct vectors with a target, each with its ``k`` smallest ids and their targets."""
    key = ["block", *space.names]
    known = rows.where(F.col("target").isNotNull())
    first = Window.partitionBy(*key).orderBy("id")
    few = known.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= k)
    vectors = few.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("id", "target"))).alias("donors"))
    return materialize(vectors, "knn-vectors")


def _cuts(vectors: DataFrame, space: _Space, tile_vectors: int) -> _Cuts:
    """Cuts at which every tile gets about ``tile_vectors``, by a sample of bounded size."""
    count = vectors.count()
    wanted = max(tile_vectors, math.ceil(count / MOST_TILES))
    depth = math.ceil(math.log2(max(1.0, count / wanted)))
    share = min(1.0, SAMPLE_PER_TILE * (1 << depth) / max(1, count))
    sample = vectors.where(F.pmod(F.xxhash64(*space.names), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    held = sample.select(*space.names).toPandas() if depth else pd.DataFrame(columns=space.names)
    return _Cuts(held.to_numpy(dtype=float), depth)


def _tiled(vectors: DataFrame, space: _Space, cuts: _Cuts, tile_vectors: int) -> tuple[DataFrame, DataFrame]:
    """The vectors with their tile, and per block the depth down to which it is cut.

    A block is cut as deep as its number of vectors asks for; if it lies so densely that
    this leaves a tile crowded, it is cut down to the last level.
    """
    placed = vectors.withColumns({"leaf": cuts.leaf(space.names), "pattern": space.pattern()})
    placed = materialize(placed, "knn-placed")
    sizes = placed.groupBy("block").agg(F.count(F.lit(1)).alias("size"))
    wanted = F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("size") / F.lit(float(tile_vectors))))).cast("int")
    depths = materialize(sizes.select("block", F.least(wanted, F.lit(cuts.depth)).alias("depth")), "knn-depths")
    fullest = placed.join(depths, "block").where("depth > 0").groupBy("block", "depth", _place(cuts).alias("place")).agg(
        F.count(F.lit(1)).alias("size")
    ).groupBy("block").agg((F.max("size") > 4 * tile_vectors).alias("crowded"))
    deep = F.when(F.col("crowded"), F.lit(cuts.depth)).otherwise(F.col("depth"))
    depths = materialize(depths.join(fullest, "block", "left").select("block", deep.alias("depth")), "knn-depths")
    return _with_tile(placed, depths, cuts), depths


def _place(cuts: _Cuts) -> Column:
    """The leaf's ancestor at the block's depth."""
    return F.call_function("shiftright", F.col("leaf"), F.lit(cuts.depth) - F.col("depth"))


def _with_tile(placed: DataFrame, depths: DataFrame, cuts: _Cuts) -> DataFrame:
    # The block comes last, because it may hold any text. A block that is not cut is one tile.
    known = F.when(F.col("depth") > 0, F.col("pattern")).otherwise(F.lit(""))
    found = placed.join(depths, "block").withColumns({"leaf": _place(cuts), "pattern": known})
    return found.withColumn("tile", F.concat_ws("|", F.col("leaf").cast("string"), "pattern", "block"))


def _meet(probes: DataFrame, donors: DataFrame, space: _Space, k: int) -> DataFrame:
    """``(vector, block, u..., tile, reach, near)``: each probe of a tile with its ``k`` nearest donors there.

    ``near`` has more than ``k`` entries where several are equally far, and none beyond ``reach``.
    """
    crowded = materialize(
        probes.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / F.lit(SLICE_PROBES)).alias("slices")).where("slices > 1"), "knn-slices"
    )
    slices = F.coalesce(F.col("slices"), F.lit(1))
    probes = probes.join(crowded, "tile", "left").withColumn("slice", F.pmod(F.xxhash64("vector"), slices)).drop("slices")
    donors = donors.select("tile", "donors", *[F.col(n).alias(f"v{n[1:]}") for n in space.names]).join(crowded, "tile", "left")
    donors = donors.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1))).drop("slices")

    def work(left, right):
        import pyarrow as pa

        left, right = left.combine_chunks(), right.combine_chunks()
        x, y = space.matrix(left), space.matrix(right, "v")
        reach = left.column("reach").to_numpy().copy()
        found = [(np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0))]
        step = max(1, _HELD // max(1, len(y)))
        for at in range(0, len(x) if len(y) else 0, step):
            far = space.distances(x[at:at + step], y)
            here = reach[at:at + step]
            if len(y) >= k:
                kth = np.partition(far, k - 1, axis=1)[:, k - 1]
                here[:] = np.fmin(here, kth)
            probe, donor = np.nonzero(far <= here[:, None])
            found.append((probe + at, donor, far[probe, donor]))
        probe, donor, far = (np.concatenate([f[i] for f in found]) for i in range(3))
        ends = np.concatenate([[0], np.cumsum(np.bincount(probe, minlength=len(x)))]).astype("int32")
        taken = right.column("donors").take(pa.array(donor))
        taken = pa.concat_arrays(taken.chunks) if taken.num_chunks else pa.array([], type=taken.type)
        pairs = pa.StructArray.from_arrays([pa.array(far, type=pa.float64()), taken], ["distance", "donors"])
        out = left.drop_columns(["slice", "reach"])
        return out.append_column("reach", pa.array(reach)).append_column("near", pa.ListArray.from_arrays(pa.array(ends), pairs))

    kept = [c for c in probes.columns if c not in ("slice", "reach")]
    pair = T.StructType([T.StructField("distance", T.DoubleType()), T.StructField("donors", donors.schema["donors"].dataType)])
    schema = T.StructType([*[probes.schema[c] for c in kept], T.StructField("reach", T.DoubleType()), T.StructField("near", T.ArrayType(pair))])
    order = [*kept, "slice", "reach"]
    met = probes.select(*order).groupBy("tile", "slice").cogroup(donors.groupBy("tile", "slice"))
    return met.applyInArrow(work, schema)


def _elsewhere(home: DataFrame, donors: DataFrame, space: _Space, k: int) -> DataFrame:
    """``(vector, u..., tile, reach)``: the other tiles that each probe has to be compared with."""
    sizes = donors.groupBy("block", "pattern", "leaf", "depth", "tile").agg(
        F.count(F.lit(1)).alias("vector_count"),
        *[F.min(n).alias(f"lo_{n}") for n in space.names], *[F.max(n).alias(f"hi_{n}") for n in space.names],
    ).where("depth > 0")
    shared = home.sparkSession.sparkContext.broadcast(_Forest(sizes.toPandas(), space))

    def reached(batches):
        import pyarrow as pa

        forest = shared.value
        names = pa.array(forest.tiles, type=pa.string())
        for batch in batches:
            blocks = batch.column("block").to_pylist()
            own = np.array([forest.number.get(t, -1) for t in batch.column("tile").to_pylist()], dtype=int)
            probe, tile, reach = forest.reached(space, k, space.matrix(batch), blocks, batch.column("reach").to_numpy())
            other = tile != own[probe]
            probe, tile = probe[other], tile[other]
            taken = pa.Table.from_batches([batch.select(["vector", *space.names])]).take(pa.array(probe))
            taken = taken.append_column("tile", names.take(pa.array(tile))).append_column("reach", pa.array(reach[probe]))
            yield from taken.combine_chunks().to_batches()

    columns = [F.col("vector"), F.col("block"), *[F.col(n) for n in space.names], F.col("tile"), F.col("reach")]
    schema = T.StructType([home.schema[c] for c in ["vector", *space.names, "tile", "reach"]])
    return home.select(*columns).mapInArrow(reached, schema)


def _nearest_donors(rows: DataFrame, space: _Space, k: int, tile_vectors: int) -> DataFrame:
    """``(vector, id, target, distance, rank)``: the ``k`` nearest donors of each incomplete vector.

    ``rows`` has ``id``, ``target``, ``block``, ``vector`` (the text of block and features) and
    the features ``u0, u1, ...``. Equal distances are ordered by id.
    """
    vectors = _donor_vectors(rows, space, k)
    cuts = _cuts(vectors, space, tile_vectors)
    donors, depths = _tiled(vectors, space, cuts, tile_vectors)
    probes = rows.where(F.col("target").isNull()).select("vector", "block", *space.names).dropDuplicates(["vector"])
    probes = probes.withColumns({"leaf": cuts.leaf(space.names), "pattern": space.pattern()})
    probes = _with_tile(probes, depths, cuts).select("vector", "block", *space.names, "tile", F.lit(math.inf).alias("reach"))
    home = materialize(_meet(materialize(probes, "knn-probes"), donors, space, k), "knn-home")
    near = home.select("vector", "near")
    if cuts.depth:
        pairs = materialize(_elsewhere(home, donors, space, k), "knn-pairs")
        near = near.unionByName(_meet(pairs, donors, space, k).select("vector", "near"))
    # A donor among the k nearest belongs to one of the k vectors whose first donor is nearest.
    order = Window.partitionBy("vector").orderBy("distance", F.col("donors")[0]["id"])
    each = near.select("vector", F.inline("near"))
    closest = each.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    final = Window.partitionBy("vector").orderBy("distance", "id")
    each = closest.select("vector", "distance", F.inline("donors"))
    return each.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)


def _extremes(df: DataFrame, columns: list[Column]) -> tuple[list[tuple[float, float]], set[int]]:
    """Smallest and largest value per column, and the positions of columns with missing values."""
    parts = []
    for i, c in enumerate(columns):
        parts += [
            F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"), F.count_if(c.isNull()).alias(f"missing{i}")
        ]
    row = df.agg(*parts).first()
    count = range(len(columns))
    return [(row[f"lo{i}"] or 0.0, row[f"hi{i}"] or 0.0) for i in count], {i for i in count if row[f"missing{i}"]}


def impute(
    df: DataFrame,
    id_column: str,
    target: str,
    features: list[str],
    k: int = 3,
    metric: str = "euclidean",
    block: Column | None = None,
    scale: bool = True,
    leaf_vectors: int = TILE_VECTORS,
) -> DataFrame:
    """``df`` with missing ``target`` values taken from the ``k`` nearest complete rows.

    Numeric targets get the mean of their neighbours, others the most frequent value (the
    smallest of equally frequent ones). Features are divided by their range unless ``scale``
    is off. A missing feature is left out of the distance, which is scaled up accordingly.
    With ``block``, neighbours come from the same block only; without, from everywhere.
    Values without any donor stay NULL. ``leaf_vectors`` is the number of complete vectors that
    are compared at a time.
    """
    numbers = [F.col(f"`{c}`").cast("double") for c in features]
    numbers = [F.when(~F.isnan(n), n) for n in numbers]
    ends, gaps = _extremes(df, numbers)
    if scale:
        numbers = [
            (n - F.lit(lo)) / F.lit(hi - lo) if hi > lo else n * F.lit(0.0)
            for n, (lo, hi) in zip(numbers, ends)
        ]
    place = F.coalesce(block.cast("string"), F.lit("")) if block is not None else F.lit("")
    vector = F.concat_ws("|", *[F.coalesce(n.cast("string"), F.lit("?")) for n in numbers], place)
    rows = df.select(
        F.col(id_column).alias("id"), F.col(target).alias("target"), place.alias("block"),
        vector.alias("vector"), *[n.alias(f"u{i}") for i, n in enumerate(numbers)],
    )
    neighbours = _nearest_donors(rows, _Space(len(numbers), gaps, metric), k, leaf_vectors)
    is_number = isinstance(df.schema[target].dataType, T.NumericType)
    value = F.avg("target") if is_number else F.mode("target", True)
    found = neighbours.groupBy("vector").agg(value.cast(df.schema[target].dataType).alias("_imputed"))
    # Complete rows, usually the bulk, pass through without a shuffle.
    complete = df.where(F.col(target).isNotNull())
    filled = df.where(F.col(target).isNull()).withColumn("_vector", vector)
    filled = filled.join(found.withColumnRenamed("vector", "_vector"), "_vector", "left")
    columns = [F.col("_imputed").alias(c) if c == target else F.col(f"`{c}`") for c in df.columns]
    return complete.unionByName(filled.select(*columns))


_HVDM_SCALE = float(1 << 20)


def hvdm_features(
    df: DataFrame, numeric: list[str], nominal: list[str], label: str
) -> tuple[DataFrame, list[str]]:
    """Feature columns on which the plain Euclidean distance is the heterogeneous value difference.

    A number is divided by four standard deviations. A nominal value becomes its vector of class
    shares P(label | value), one column per label: the value difference is the Euclidean distance
    of those vectors. Use the result with ``impute(..., scale=False)``.

    Deviations and shares are rounded to six digits, and features to whole multiples of 2^-20,
    given as whole numbers. Squares and their sums are then exact, so equal distances are equal
    on any engine. The labels become columns, so they are few by nature.
    """
    labels = [row[0] for row in df.select(label).where(F.col(label).isNotNull()).distinct().orderBy(label).collect()]
    spreads = df.agg(*[F.round(F.stddev_pop(c), 6).alias(c) for c in numeric]).first() if numeric else {}

    def whole(value: Column) -> Column:
        return F.floor(value * F.lit(_HVDM_SCALE) + F.lit(0.5)).cast("double")

    out, names = df, []
    for c in numeric:
        spread = spreads[c]
        value = whole(F.col(c) / F.lit(4 * spread)) if spread else F.col(c) * F.lit(0.0)
        out = out.withColumn(f"hvdm_{c}", value.cast("double"))
        names.append(f"hvdm_{c}")
    for c in nominal:
        columns = [f"hvdm_{c}_{i}" for i in range(len(labels))]
        shares = df.where(F.col(label).isNotNull() & F.col(c).isNotNull()).groupBy(c).agg(
            *[
                whole(F.round(F.count_if(F.col(label) == F.lit(v)) / F.count(F.lit(1)), 6)).alias(name)
                for v, name in zip(labels, columns)
            ]
        )
        out = out.join(materialize(shares, "label-shares"), c, "left")
        names += columns
    return out.select(*df.columns, *names), names
