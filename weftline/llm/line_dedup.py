"""Removal of lines that too many pages of one host share.

For every host: the share of its pages that contain a line. Lines above a ratio are
boilerplate there and are dropped, wherever they stand on a page; the same line stays on
hosts where it is rare.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import BROADCAST_BYTES, column, free_name
from weftline.workspace import materialize

RATIO = 0.05
MIN_PAGES = 5

#: Tasks that share the pages of one host when the boilerplate table is too large to broadcast.
SALTS = 64


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; the empty string where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))


def _line_key(line: Column) -> Column:
    """Two independent 64-bit hashes of a line without white space at its ends."""
    plain = F.trim(line)
    return F.struct(F.xxhash64(plain).alias("h1"), F.xxhash64(F.lit(1), plain).alias("h2"))


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float, min_pages: int) -> DataFrame:
    """(host, drop): the keys of each host's boilerplate lines.

    At most (mean lines per page) / ratio lines of a host can be above the ratio, whatever
    its size, so each list is small. Counts are combined before they are shuffled.
    """
    lines = pages.select(host.alias("host"), F.split(text, "\n").alias("lines"))
    totals = lines.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    keys = F.array_distinct(F.transform("lines", _line_key))
    counted = (
        lines.select("host", F.explode(keys).alias("key"))
        .groupBy("host", "key.h1", "key.h2").agg(F.count(F.lit(1)).alias("line_pages"))
        .where(F.col("line_pages") >= min_pages)
    )
    empty = _line_key(F.lit(""))
    common = counted.join(totals, "host").where(
        (F.col("line_pages") > F.col("host_pages") * F.lit(ratio))
        & ~((F.col("h1") == empty["h1"]) & (F.col("h2") == empty["h2"]))
    )
    return common.groupBy("host").agg(F.collect_list(F.struct("h1", "h2")).alias("drop"))


def drop_boilerplate_lines(
    pages: DataFrame, *, host: Column, text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES,
    dropped: str | None = "dropped_lines",
) -> DataFrame:
    """``pages`` with boilerplate lines taken out of ``text``, plus the number of lines dropped.

    A line is boilerplate on a host if at least ``min_pages`` of the host's pages and more
    than ``ratio`` of them contain it. Lines are compared without blanks at their ends;
    blank lines are never dropped. A page counts once for a line that it repeats.

    Every page stays, also when all its lines go (its text is then empty). A null text
    stays null; a null host is the host "". Repeated rows are separate pages. An empty
    table stays empty. A column named like ``dropped`` is replaced; with ``dropped=None``
    the columns are those of ``pages``. Texts are not shuffled unless the boilerplate of
    all hosts is over the broadcast bound; then pages of one host are spread over tasks.
    """
    key, lines = free_name(pages.columns, "host_key"), free_name(pages.columns, "lines")
    drop, host_column = free_name(pages.columns, "drop"), F.coalesce(host, F.lit(""))
    common = materialize(
        boilerplate(pages.where(column(text).isNotNull()), host_column, column(text), ratio, min_pages), "boilerplate"
    ).withColumnsRenamed({"host": key, "drop": drop})
    size = common.agg(F.sum(F.size(drop) * 24 + F.length(key) + 64)).first()[0] or 0
    marked = pages.withColumn(key, host_column)
    if size <= BROADCAST_BYTES:
        marked = marked.join(F.broadcast(common), key, "left")
    else:
        salt = free_name(pages.columns, "salt")
        spread = common.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        marked = marked.withColumn(salt, F.pmod(F.xxhash64(column(text)), F.lit(SALTS)).cast("int"))
        marked = marked.join(spread, [key, salt], "left").drop(salt)
    split = F.split(column(text), "\n")
    kept = F.filter(split, lambda line: ~F.array_contains(column(drop), _line_key(line)))
    marked = marked.withColumn(lines, F.when(column(drop).isNotNull(), kept))
    gone = F.coalesce(F.size(split) - F.size(column(lines)), F.lit(0)).cast("int")
    out = [
        F.coalesce(F.array_join(column(lines), "\n"), column(text)).alias(c) if c == text else column(c)
        for c in pages.columns if c != dropped
    ]
    if dropped:
        out.append(F.when(column(lines).isNull(), F.lit(0)).otherwise(gone).alias(dropped))
    return marked.select(*out)
