"""Joins and numbering that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# A side is broadcast only if a bounded count proves it has at most this many rows.
BROADCAST_ROWS = 500_000
# A key is "hot" when it holds more than 1/HOT_SHARE of the rows; hence there are
# fewer than HOT_SHARE hot keys, which bounds what the hot branch broadcasts.
HOT_SHARE = 4096


def at_most(df: DataFrame, rows: int) -> bool:
    """True if ``df`` has at most ``rows`` rows; reads no more than ``rows + 1`` of them."""
    return df.limit(rows + 1).count() <= rows


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    weight: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """Join ``fact`` to ``dim`` (one row per key) without a straggler on hot keys.

    A small ``dim`` is broadcast after its size has been checked. Otherwise the
    fact rows of hot keys meet a broadcast of just those keys, and all other rows
    take a shuffle join. ``weight`` names a column of ``dim`` that already holds
    the number of fact rows per key, which saves counting them.
    """
    if at_most(dim, broadcast_rows):
        return fact.join(F.broadcast(dim), key, how)
    if weight:
        counts = dim.select(key, F.col(weight).alias("_n"))
    else:
        counts = materialize(fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = materialize(
        counts.where(F.col(key).isNotNull() & (F.col("_n") * hot_share > F.lit(total))).select(key)
    )
    if hot.isEmpty():
        return fact.join(dim, key, how)
    hot_dim = dim.join(F.broadcast(hot), key, "left_semi")
    return (
        fact.join(F.broadcast(hot), key, "left_semi")
        .join(F.broadcast(hot_dim), key, how)
        .unionByName(fact.join(F.broadcast(hot), key, "left_anti").join(dim, key, how))
    )


def with_index(df: DataFrame, order: list[str], name: str = "index", start: int = 0) -> DataFrame:
    """Number the rows 0,1,2,... in ``order`` without a one-partition sort.

    Rows are range-partitioned, numbered inside each partition, and shifted by the
    sizes of the partitions before it; only those sizes meet in one place.
    """
    ranged = materialize(
        df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id())
    )
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        ranged.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + F.col("_row") - 1 + F.lit(start)).cast("bigint"))
        .drop("_part", "_row", "_offset")
    )
