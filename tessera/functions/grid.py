"""Chunk grids: tiling an N-d extent, batch ranges and the chunk-done probe."""

from __future__ import annotations

from math import prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROBE = 10  # cells per axis the chunk-done probe looks at


def _ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def chunk_grid(spark: SparkSession, shape: list[int], chunk: list[int]) -> DataFrame:
    """One row per chunk in C order, the last chunk of an axis clipped to the extent."""
    if len(shape) != len(chunk) or min(chunk) < 1:
        raise ValueError("shape and chunk need the same rank and positive chunk sizes")
    counts = [_ceil_div(s, c) for s, c in zip(shape, chunk)]
    index, stride = [], prod(counts)
    for n in counts:
        stride //= max(n, 1)
        index.append((F.expr(f"id div {max(stride, 1)}") % F.lit(max(n, 1))).cast("bigint"))
    starts = [i * F.lit(c) for i, c in zip(index, chunk)]
    stops = [F.least((i + 1) * F.lit(c), F.lit(s)) for i, c, s in zip(index, chunk, shape)]
    as_bigint = lambda cols: F.array(*[c.cast("bigint") for c in cols])
    return spark.range(prod(counts)).select(
        F.col("id").alias("chunk_id"),
        as_bigint(index).alias("idx"),
        as_bigint(starts).alias("starts"),
        as_bigint(stops).alias("stops"),
    )


def chunk_id_of(axes: list[Column], shape: list[int], chunk: list[int]) -> Column:
    """The C-order chunk number a cell belongs to."""
    number: Column = F.lit(0).cast("bigint")
    for axis, s, c in zip(axes, shape, chunk):
        number = number * F.lit(_ceil_div(s, c)) + F.floor(axis / F.lit(c)).cast("bigint")
    return number


def batch_ranges(spark: SparkSession, total: int, batch: int) -> DataFrame:
    """Half-open ``[start, stop)`` ranges covering ``0..total``."""
    first = F.col("id") * F.lit(batch)
    return spark.range(_ceil_div(total, batch)).select(
        F.col("id").alias("batch"),
        first.alias("start"),
        F.least(first + F.lit(batch), F.lit(total)).cast("bigint").alias("stop"),
    )


def chunk_done_probe(
    voxels: DataFrame, shape: list[int], chunk: list[int], value: str = "seg_id", whole: bool = False
) -> DataFrame:
    """Chunks with any non-zero cell in their first 10 cells per axis (or anywhere, if ``whole``)."""
    axes = [F.col(a) for a in "zyx"]
    hit = F.col(value) != 0
    if not whole:
        for axis, c in zip(axes, chunk):
            hit = hit & (axis % F.lit(c) < PROBE)
    done = (
        voxels.where(hit)
        .select(chunk_id_of(axes, shape, chunk).alias("chunk_id"))
        .distinct()
        .withColumn("done", F.lit(True))
    )
    grid = chunk_grid(voxels.sparkSession, shape, chunk)
    return grid.join(done, "chunk_id", "left").select("chunk_id", F.coalesce("done", F.lit(False)).alias("done"))
