"""Typed, partitioned tables: creation, loading, compaction."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.conform import INVALID, LEFT_OUT, Contract, complete, loadable, set_aside
from weftline.workspace import Storage, materialize, open_partitions

#: Partitions that a task writes to side by side; with more, the rest of its rows is sorted.
OPEN_PARTITIONS = 32


def create_table(spark: SparkSession, name: str, contract: Contract, location: str) -> None:
    """Drop and create ``name`` as an external Parquet table with the contract's columns."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in contract.schema.fields
    )
    parts = ", ".join(f"`{c}`" for c in contract.partition_by)
    layout = f" PARTITIONED BY ({parts})" if parts else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{layout} LOCATION '{location}'")


def load_table(conformed: DataFrame, name: str, contract: Contract, aside: str) -> dict[str, int]:
    """Append the loadable rows by position and return counts.

    What does not go into the table is written to ``aside`` (see ``set_aside``): no row and
    no value is lost. The conformed rows are written once, and both outputs read from
    there. ``source = loaded + rejected`` is checked. The append order is that of the
    created table, which moves partition columns to the end.
    """
    seen = Observation()
    lost = [
        F.count_if(F.find_in_set(F.lit(f.name), F.col(INVALID)) > 0).alias(f"invalid_{f.name}")
        for f in contract.schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    watched = conformed.observe(
        seen,
        F.count(F.lit(1)).alias("source"),
        F.count_if(complete(contract)).alias("loaded"),
        F.count_if(~complete(contract)).alias("rejected"),
        F.count_if(F.size(LEFT_OUT) > 0).alias("with_values_left_out"),
        *lost,
    )
    staged = materialize(watched, "conformed")
    order = conformed.sparkSession.table(name).columns
    with open_partitions(conformed.sparkSession, OPEN_PARTITIONS):
        loadable(staged, contract).select(*order).write.insertInto(name, overwrite=False)
    set_aside(staged, contract).write.parquet(aside)
    counts = seen.get
    if counts["source"] != counts["loaded"] + counts["rejected"]:
        raise AssertionError(f"rows lost while loading {name}: {counts}")
    return counts


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: list[str],
    cluster_by: str,
    file_bytes: int = 256 << 20,
) -> DataFrame:
    """Rewrite the Parquet dataset ``source`` to ``target`` in few, time-clustered files.

    Ranges run over partition columns, clustering column and a per-row salt, so neither a hot
    partition nor one repeated timestamp ends up in a single task. ``source`` is left alone;
    switch the table's location once the new copy is complete.
    """
    ranges = max(1, math.ceil(Storage(spark).bytes_under(source) / file_bytes))
    rows = spark.read.parquet(source)
    salt = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    (
        rows.select("*", salt.alias("_salt"))
        .repartitionByRange(ranges, *partition_by, cluster_by, "_salt")
        .sortWithinPartitions(*partition_by, cluster_by)
        .drop("_salt")
        .write.partitionBy(*partition_by).parquet(target)
    )
    return spark.read.schema(rows.schema).parquet(target)


def switch_location(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")

