"""Relabelling and filtering voxels through lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grid import chunk_id_of
from .keyed import lookup_join

MAX_UINT32 = (1 << 32) - 1


def _uint32(label: Column) -> Column:
    """The label, or an error if an unsigned 32-bit volume could not hold it."""
    message = F.concat(F.lit("label outside uint32: "), label.cast("string"))
    return F.when(label.between(0, MAX_UINT32), label).otherwise(F.raise_error(message))


def relabel(voxels: DataFrame, lookup: DataFrame, value: str = "seg_id", out: str = "label") -> DataFrame:
    """Add ``out``: the label of each voxel's id, 0 where the id is unknown.

    ``lookup`` has the columns ``seg_id`` (unique) and ``label``.
    """
    table = lookup.select(F.col("seg_id").alias(value), _uint32(F.col("label").cast("bigint")).alias("_label"))
    return lookup_join(voxels, table, value).withColumn(out, F.coalesce("_label", F.lit(0))).drop("_label")


def _flagged(values: DataFrame, valid: DataFrame, value: str) -> DataFrame:
    members = valid.select(F.col(valid.columns[0]).alias(value)).distinct().withColumn("_member", F.lit(True))
    return lookup_join(values, members, value)


def keep_labels(voxels: DataFrame, valid: DataFrame, value: str = "label", out: str = "filtered") -> DataFrame:
    """Add ``out``: the value itself if it is in ``valid`` (one column), else 0; NULL counts as 0."""
    kept = F.when(F.col("_member"), F.col(value)).otherwise(F.lit(0)).cast("bigint")
    return _flagged(voxels, valid, value).withColumn(out, kept).drop("_member")


def relabel_and_filter(voxels: DataFrame, lookup: DataFrame, valid: DataFrame) -> DataFrame:
    """Both outputs in one pass: ``label`` and ``filtered`` (the label if it is valid).

    Validity is resolved on the lookup, not on the voxels, so the volume is joined
    once and, for a lookup of proven size, never shuffled.
    """
    flagged = keep_labels(lookup.withColumn("_label", _uint32(F.col("label").cast("bigint"))), valid)
    table = flagged.select("seg_id", "_label", "filtered")
    return lookup_join(voxels, table, "seg_id").select(
        *voxels.columns,
        F.coalesce("_label", F.lit(0)).alias("label"),
        F.coalesce("filtered", F.lit(0)).alias("filtered"),
    )


def mask_from_ids(voxels: DataFrame, ids: DataFrame, value: str = "seg_id", out: str = "mask") -> DataFrame:
    """1 where the id is in the list and not 0, else 0."""
    hit = F.col("_member") & (F.col(value) != 0)
    return _flagged(voxels, ids, value).withColumn(out, F.when(hit, 1).otherwise(0)).drop("_member")


def relabel_progress(voxels: DataFrame, shape: list[int], chunk: list[int]) -> DataFrame:
    """How many chunks of the grid hold data, out of how many: ``(done, total)``."""
    total = 1
    for s, c in zip(shape, chunk):
        total *= -(-s // c)
    axes = [F.col(a) for a in "zyx"]
    return voxels.select(chunk_id_of(axes, shape, chunk).alias("chunk_id")).agg(
        F.countDistinct("chunk_id").alias("done"), F.lit(total).cast("bigint").alias("total")
    )
