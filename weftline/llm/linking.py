"""Exact links between documents that meet in buckets, without writing out the pairs of a bucket.

A ``Screen`` says what is kept of a document's set (a sketch), in which buckets it stands,
and which pairs of a bucket may be linked. Links are then looked for in two passes:

1. Buckets, cut into blocks of bounded size, are screened where their sketches lie. What
   leaves a task is not pairs but the rows that have some partner left in that bucket. A
   pair belongs to the first bucket that both rows stand in; each row brings along the
   first of its buckets, so that nearly no other bucket looks at the pair again.
2. Whole sets are sent to those rows only. The task screens them again, compares what is
   left on whole sets, and gives out a spanning set of links: fewer than it has rows.

Only connections matter. So each document is first sent to its smallest bucket alone;
that links nearly all near copies at the price of one row a document. Then all buckets
that still hold several components are searched in full; of those with the same rows one
is enough. In a bucket that is too large
for one block, rows of its largest component need not meet each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import column, empty_as_text, hint_small, smallest_labels
from weftline.llm.shingles import shingle_hashes
from weftline.workspace import materialize, scratch

#: Rows and tokens a block of a bucket has at most, but for single larger documents.
BLOCK_ROWS = 1_024
BLOCK_TOKENS = 2 << 20

#: Arrow batches of texts and sets are held below this size, whatever the length of a text.
BATCH_ROWS = 500
BATCH_BYTES = 8 << 20

#: Buckets a row brings along to tell whether it has met a partner before.
FIRST_BUCKETS = 16

#: Pairs of one comparison of sketches.
_PAIRS_AT_ONCE = 20_000
#: Groups up to this size are compared side by side.
SMALL_GROUP = 32


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows reach Python in batches of bounded bytes for the block."""
    wanted = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@dataclass(frozen=True)
class Screen:
    """What a method knows of a set, and which pairs it cannot rule out.

    ``sketch(tokens)`` gives (bytes, bucket keys as int64); ``load(sketches)`` makes of a
    column of such bytes what ``near(loaded, sizes, a, b)`` (a mask over row pairs) and,
    for groups above ``SMALL_GROUP`` rows, ``search(loaded, sizes, rows)`` (pairs of rows)
    take.
    """

    sketch: Callable
    load: Callable
    near: Callable
    search: Callable | None = None


def linked(left: int, right: int, shared: int, percent: int) -> bool:
    return 100 * shared >= percent * (left + right - shared)


def linked_groups(
    docs: DataFrame, doc_id: str, text: str, width: int, percent: int, make_screen: Callable[[DataFrame], Screen],
    block_rows: int = BLOCK_ROWS, first_round: bool = True,
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``."""
    with scratch(docs.sparkSession) as keep, small_batches(docs.sparkSession):
        return keep(_grouped(docs, doc_id, text, width, percent, make_screen, block_rows, first_round), "groups")


def _sketches(read: DataFrame, width: int, screen: Screen) -> DataFrame:
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                tokens = shingle_hashes(text, width)
                digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
                packed, keys = screen.sketch(tokens) if len(tokens) else (b"", np.empty(0, np.int64))
                rows.append((len(tokens), digest, packed, keys))
            yield pd.DataFrame(rows, columns=["n", "digest", "sketch", "keys"])

    made = F.pandas_udf(sketch, "n bigint, digest binary, sketch binary, keys array<bigint>")
    return read.select("doc_id", "h1", "h2", made("text").alias("s")).select("doc_id", "h1", "h2", "s.*")


def _grouped(docs, doc_id, text, width, percent, make_screen, block_rows, first_round) -> DataFrame:
    value = empty_as_text(text)
    read = docs.select(
        column(doc_id).cast("bigint").alias("doc_id"), value.alias("text"),
        F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(1), value).alias("h2"),
    )
    screen = make_screen(read)
    sketches = materialize(_sketches(read, width, screen).withColumn("key", F.monotonically_increasing_id()), "sketches")
    # Equal sets are one node from the start.
    nodes = materialize(
        sketches.where("n > 0").groupBy("digest").agg(F.min("key").alias("node"), F.min("doc_id").alias("low_id")), "nodes",
        rows=sketches.count(),
    )
    heads = hint_small(nodes.select(F.col("node").alias("key")), 48)
    points = sketches.join(heads, "key").withColumnRenamed("key", "node")
    points = materialize(points.select("node", "n", "h1", "h2", "sketch", "keys"), "points")
    places = points.select("node", "n", F.explode("keys").alias("bucket"))
    shared = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("bucket")
    places = materialize(places.join(shared, "bucket").select("node", "n", "bucket"), "places")

    def labelled(edges: DataFrame) -> DataFrame:
        return materialize(smallest_labels(edges, docs.sparkSession), "labels", rows=2 * edges.count())

    def found(dealt: DataFrame) -> DataFrame:
        return materialize(_links(dealt, points, read, width, percent, screen), "links")

    edges = labels = None
    if first_round and not places.isEmpty():
        edges = found(_dealt_once(places, block_rows).withColumn("before", F.array().cast("array<bigint>")))
        labels = labelled(edges)
    dealt = _dealt_in_full(places, labels, percent, block_rows)
    if not dealt.isEmpty():
        more = found(dealt)
        labels = labelled(more if edges is None else edges.union(more))

    placed = nodes.select("digest", F.col("low_id").alias("component_id"))
    if labels is not None:
        joined = nodes.join(hint_small(labels, 48), "node", "left").withColumn("component", F.coalesce("component", "node"))
        lowest = joined.groupBy("component").agg(F.min("low_id").alias("component_id"))
        placed = joined.join(lowest, "component").select("digest", "component_id")
    # One row per distinct set, so copies meet it on one key: the small side is spread by hint or by skew handling.
    placed = hint_small(materialize(placed, "placed", rows=nodes.count()), 96)
    return sketches.select("doc_id", "n", "digest").join(placed, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _blocks(rows: str, tokens: str, block_rows: int):
    return F.ceil(F.greatest(F.col(rows) / block_rows, F.col(tokens) / BLOCK_TOKENS)).cast("int")


def _dealt_once(places: DataFrame, block_rows: int) -> DataFrame:
    """Each node in one block of its smallest shared bucket, and the bucket's first node in all of them."""
    first = materialize(places.groupBy("node").agg(F.min("bucket").alias("bucket"), F.first("n").alias("n")), "first", rows=places.count())
    loads = first.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens"), F.min("node").alias("lead")
    ).where("rows > 1").select("bucket", "lead", _blocks("rows", "tokens", block_rows).alias("blocks"))
    joined = first.join(loads, "bucket")
    block = F.when(F.col("node") == F.col("lead"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    return joined.select("bucket", F.explode(block).alias("block"), "node", F.col("node").alias("component"))


def _dealt_in_full(places: DataFrame, labels: DataFrame | None, percent: int, block_rows: int) -> DataFrame:
    """All buckets that hold several components, so that any two rows of different ones meet in some block.

    A bucket that fits is one block. Else the rows of its largest component and the others
    are cut into parts by themselves, and every part of the others meets every part of
    either kind; parts of the largest component do not meet each other.
    """
    if labels is None:
        placed = places.withColumn("component", F.col("node"))
    else:
        placed = places.join(hint_small(labels, 48), "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Partners stand in the same or the next band of sizes; a row without any in its bucket need not be sent.
    width = 1.0001 * float(np.log(100 / percent))
    placed = placed.withColumn("band", F.floor(F.log("n") / width).cast("int"))
    bands = placed.groupBy("bucket", "band").agg(F.count(F.lit(1)).alias("rows")).groupBy("bucket").agg(
        F.map_from_entries(F.collect_list(F.struct("band", "rows"))).alias("bands")
    )
    own_bits, other_bits = F.xxhash64("node"), F.xxhash64(F.lit(1), "node")
    per_component = placed.groupBy("bucket", "component").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens"), F.bit_xor(own_bits).alias("bits"), F.bit_xor(other_bits).alias("more_bits")
    )
    loads = per_component.groupBy("bucket").agg(
        F.sum("rows").alias("rows"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("components"),
        F.max(F.struct("rows", "tokens", "component")).alias("most"), F.bit_xor("bits").alias("bits"), F.bit_xor("more_bits").alias("more_bits"),
    ).where("components > 1")
    # Buckets of the same rows: the first stands for all.
    loads = loads.groupBy("rows", "bits", "more_bits").agg(F.min(F.struct("bucket", "tokens", "most")).alias("first")).select("rows", "first.*").withColumns({
        "most_rows": F.col("most.rows"), "most_tokens": F.col("most.tokens"),
        "rest_rows": F.col("rows") - F.col("most.rows"), "rest_tokens": F.col("tokens") - F.col("most.tokens"),
    }).select(
        "bucket", F.col("most.component").alias("largest"), (_blocks("rows", "tokens", block_rows) == 1).alias("fits"),
        _blocks("most_rows", "most_tokens", block_rows).alias("parts"), _blocks("rest_rows", "rest_tokens", block_rows).alias("rests"),
    )
    loads = materialize(loads.join(bands, "bucket"), "loads", rows=places.count() // 2)
    partners = sum((F.coalesce(F.try_element_at("bands", F.col("band") + step), F.lit(0)) for step in (-1, 0, 1)), F.lit(0))
    joined = placed.join(loads, "bucket").where(partners > 1)
    firsts = joined.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("bucket")), 1, FIRST_BUCKETS).alias("firsts"))
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("component") == F.col("largest"), F.col("parts")).otherwise(F.col("rests"))).cast("int")
    block = F.expr("""
        CASE WHEN fits THEN array(0)
             WHEN component = largest THEN sequence(mine * rests, mine * rests + rests - 1)
             ELSE concat(transform(sequence(0, parts - 1), i -> i * rests + mine),
                         transform(sequence(0, rests - 1), j -> parts * rests + least(j, mine) * rests + greatest(j, mine)))
        END""")
    dealt = joined.withColumn("mine", mine).select("bucket", F.explode(block).alias("block"), "node", "component")
    return dealt.join(firsts, "node").select("bucket", "block", "node", "component", F.filter("firsts", lambda b: b < F.col("bucket")).alias("before"))


def _links(dealt: DataFrame, points: DataFrame, read: DataFrame, width: int, percent: int, screen: Screen) -> DataFrame:
    """Links (a, b) that span what is similar enough in each block of ``dealt``."""
    group = ["bucket", "block"]
    sketched = dealt.join(points.select("node", "n", "sketch"), "node")
    # Many blocks are tiny: they are taken from sorted partitions instead of one call each.
    screened = sketched.repartition(*group).sortWithinPartitions(*group).select(*group, "node", "component", "before", "n", "sketch")
    kept = materialize(screened.mapInPandas(
        _screening(screen, percent), "bucket bigint, block int, node bigint, component bigint, before array<bigint>"
    ), "kept")

    wanted = kept.select("node").distinct().join(points.select("node", "h1", "h2"), "node")
    wanted = hint_small(materialize(wanted, "wanted", rows=kept.count()), 72)
    texts = read.join(wanted, ["h1", "h2"]).select("node", "text").dropDuplicates(["node"])

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "tokens": [shingle_hashes(t, width).tobytes() for t in batch["text"]]})

    whole = materialize(texts.mapInPandas(sets, "node bigint, tokens binary"), "sets")
    rows = kept.join(whole, "node").join(points.select("node", "n", "sketch"), "node")
    ordered = rows.repartition(*group).sortWithinPartitions(*group).select(*group, "node", "component", "before", "n", "sketch", "tokens")
    return ordered.mapInPandas(_verifying(screen, percent), "a bigint, b bigint")


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows of sorted partitions with the starts of their groups and the end; a group is never cut by a batch."""
    rest: list[pd.DataFrame] = []  # of the last group so far, which the next batch may go on with
    for batch in batches:
        if not len(batch):
            continue
        if rest and (batch["bucket"].iloc[-1], batch["block"].iloc[-1]) == (rest[0]["bucket"].iloc[0], rest[0]["block"].iloc[0]):
            rest.append(batch)
            continue
        rows = pd.concat([*rest, batch], ignore_index=True) if rest else batch
        keys = rows[["bucket", "block"]].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1])
        rest = [rows.iloc[starts[-1]:].reset_index(drop=True)]
        if len(starts) > 1:
            yield rows.iloc[: starts[-1]], starts
    if rest:
        rows = pd.concat(rest, ignore_index=True)
        yield rows, np.array([0, len(rows)])


def _met(before: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows have an earlier bucket in common."""
    own, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    bucket, number = np.unique(np.concatenate([np.empty(0, np.int64), *[before[i] for i in own]]), return_inverse=True)
    out = np.zeros(len(a), bool)
    if not len(bucket):
        return out
    lengths = np.array([len(before[i]) for i in own])
    ranks = np.full((len(own), int(lengths.max())), -1, np.int64)
    ranks[np.arange(ranks.shape[1]) < lengths[:, None]] = number
    left, right = ranks[place[: len(a)]], ranks[place[len(a):]]
    for column_of in right.T:
        out |= ((left == column_of[:, None]) & (left >= 0)).any(1)
    return out


def _candidates(rows: pd.DataFrame, starts: np.ndarray, screen: Screen, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group that have different components, may be linked, and have not met in an earlier bucket."""
    sizes, components, before = rows["n"].to_numpy(), rows["component"].to_numpy(), rows["before"].tolist()
    loaded = screen.load(rows["sketch"])
    lengths = np.diff(starts)
    number = np.repeat(np.arange(len(lengths)), lengths)
    large = np.flatnonzero(lengths > SMALL_GROUP)
    out: list[tuple[np.ndarray, np.ndarray]] = []

    def keep(a: np.ndarray, b: np.ndarray) -> None:
        for at in range(0, len(a), _PAIRS_AT_ONCE):
            x, y = a[at:at + _PAIRS_AT_ONCE], b[at:at + _PAIRS_AT_ONCE]
            fits = (components[x] != components[y]) & (100 * np.minimum(sizes[x], sizes[y]) >= percent * np.maximum(sizes[x], sizes[y]))
            x, y = x[fits], y[fits]
            if len(x):
                near = screen.near(loaded, sizes, x, y)
                x, y = x[near], y[near]
            if len(x):
                new = ~_met(before, x, y)
                out.append((x[new], y[new]))

    searched = large if screen.search else large[:0]
    by_tree = np.isin(number, searched)
    for step in range(1, int(lengths.max(initial=1))):
        at = np.flatnonzero((number[step:] == number[:-step]) & ~by_tree[step:])
        if not len(at):
            break
        keep(at, at + step)
    for i in searched:
        keep(*screen.search(loaded, sizes, np.arange(starts[i], starts[i + 1])))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _screening(screen: Screen, percent: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, starts in _whole_groups(batches):
            a, b = _candidates(rows, starts, screen, percent)
            at = np.unique(np.concatenate([a, b]))
            yield rows.iloc[at][["bucket", "block", "node", "component", "before"]]

    return run


class _Forest:
    """Which rows are connected so far; rows of one component are from the start."""

    def __init__(self, components: np.ndarray):
        _, first, of = np.unique(components, return_index=True, return_inverse=True)
        self._above = first[of].tolist()

    def root(self, row: int) -> int:
        above = self._above
        while above[row] != row:
            above[row] = above[above[row]]
            row = above[row]
        return row

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self._above[max(a, b)] = min(a, b)
        return a != b


def _shared_by_block(sets: list[np.ndarray]) -> np.ndarray:
    """Shared tokens of all pairs of sets, as sums of products over the tokens that several of them hold."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = held[token] > 1
    rows, token = rows[often], token[often]
    order = np.argsort(token, kind="stable")
    rows, token = rows[order], token[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    width = max(64, (4 << 20) // max(1, len(sets)))
    column_of = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]])) if len(token) else token
    for low in range(0, int(column_of[-1]) + 1 if len(token) else 0, width):
        first, last = np.searchsorted(column_of, [low, low + width])
        part = np.zeros((len(sets), min(width, int(column_of[-1]) + 1 - low)), np.float32)
        part[rows[first:last], column_of[first:last] - low] = 1
        shared += part @ part.T
    return shared


def _verifying(screen: Screen, percent: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, starts in _whole_groups(batches):
            a, b = _candidates(rows, starts, screen, percent)
            nodes, group = rows["node"].to_numpy(), np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            found: list[tuple[int, int]] = []
            for i in np.unique(group[a]):
                mine = group[a] == i
                found += _spanning(rows, a[mine], b[mine], percent)
            ends = np.array(found, np.int64).reshape(-1, 2)
            yield pd.DataFrame({"a": nodes[ends[:, 0]], "b": nodes[ends[:, 1]]})

    return run


def _spanning(rows: pd.DataFrame, a: np.ndarray, b: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links among the candidate pairs of one group that connect all that the links connect."""
    own, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a):]
    sets = [np.frombuffer(t, np.uint64) for t in rows["tokens"].iloc[own]]
    forest = _Forest(rows["component"].to_numpy()[own])
    out = []
    if len(a) > 8 * len(own) and len(own) > 16 and max(map(len, sets)) < 1 << 24:  # float32 counts exactly
        counts = _shared_by_block(sets)
        sizes = np.array([len(s) for s in sets], np.int64)
        shared = counts[a, b].astype(np.int64)
        near = 100 * shared >= percent * (sizes[a] + sizes[b] - shared)
        for x, y in zip(a[near].tolist(), b[near].tolist(), strict=True):
            if forest.join(x, y):
                out.append((own[x], own[y]))
        return out
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        if forest.root(x) == forest.root(y):
            continue
        shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        if linked(len(sets[x]), len(sets[y]), shared, percent) and forest.join(x, y):
            out.append((own[x], own[y]))
    return out
