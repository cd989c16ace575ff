"""Shape statistics of labelled objects, all from partial aggregates."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keyed import lookup_join
from .stencil import AXES, EDGE, Cells, offsets, per_block

# An eigenvalue below this share of the largest is rounding noise of a flat object.
FLAT = 1e-9


def bounding_boxes(voxels: DataFrame, label: str = "seg_id", only: DataFrame | None = None) -> DataFrame:
    """Half-open box and voxel count per label, optionally only for the labels in ``only``."""
    boxes = voxels.where(F.col(label) != 0).groupBy(label).agg(
        *[F.min(a).alias(f"{a}0") for a in AXES],
        *[(F.max(a) + 1).alias(f"{a}1") for a in AXES],
        F.count(F.lit(1)).alias("voxels"),
    )
    if only is None:
        return boxes
    return boxes.join(only.select(F.col(only.columns[0]).alias(label)).distinct(), label, "left_semi")


def subvolume(voxels: DataFrame, value: int, box: dict[str, int], label: str = "seg_id") -> DataFrame:
    """Voxels of one label in a half-open box, re-based to the box's origin."""
    inside = F.col(label) == value
    for a in AXES:
        inside = inside & (F.col(a) >= box[f"{a}0"]) & (F.col(a) < box[f"{a}1"])
    return voxels.where(inside).select(*[(F.col(a) - box[f"{a}0"]).alias(a) for a in AXES], label)


def _moments() -> list[Column]:
    pairs = [("z", "y"), ("z", "x"), ("y", "x")]
    return [
        *[F.var_pop(a).alias(f"_{a}{a}") for a in AXES],
        *[F.covar_pop(a, b).alias(f"_{a}{b}") for a, b in pairs],
    ]


def _elongation() -> Column:
    """Largest over smallest eigenvalue of the inertia tensor of the ``_moments``.

    Closed form for symmetric 3x3 matrices (Smith, CACM 1961).
    """
    vz, vy, vx = (F.col(f"_{a}{a}") for a in AXES)
    zy, zx, yx = -F.col("_zy"), -F.col("_zx"), -F.col("_yx")
    q = (vz + vy + vx) * 2 / 3
    dz, dy, dx = vy + vx - q, vz + vx - q, vz + vy - q
    off = zy * zy + zx * zx + yx * yx
    p = F.sqrt((dz * dz + dy * dy + dx * dx + 2 * off) / 6)
    det = dz * (dy * dx - yx * yx) - zy * (zy * dx - yx * zx) + zx * (zy * yx - dy * zx)
    r = F.when(p > 0, F.least(F.greatest(det / F.nullif(2 * p * p * p, F.lit(0.0)), F.lit(-1.0)), F.lit(1.0))).otherwise(0.0)
    angle = F.acos(r) / 3
    largest = q + 2 * p * F.cos(angle)
    smallest = q + 2 * p * F.cos(angle + 2 * math.pi / 3)
    return F.when(smallest > FLAT * largest, largest / smallest).otherwise(F.lit(float("inf")))


def elongation(voxels: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Voxel count and elongation per key; infinite for flat or single-voxel objects."""
    keys = keys or ["seg_id"]
    grouped = voxels.groupBy(*keys).agg(F.count(F.lit(1)).alias("volume"), *_moments())
    return grouped.select(*keys, "volume", _elongation().alias("elongation"))


def surface_area(voxels: DataFrame, label: str = "seg_id", edge: int = EDGE) -> DataFrame:
    """Voxel faces per label that do not border a voxel of the same label."""
    steps = offsets(6)

    def kernel(cells: Cells) -> dict:
        faces = np.zeros(len(cells), dtype=np.int64)
        for step in steps:
            faces += cells.same(step, label) < 0
        labels, row = np.unique(cells.columns[label][cells.core], return_inverse=True)
        return {label: labels, "faces": np.bincount(row, faces[cells.core], len(labels)).astype(np.int64)}

    partial = per_block(voxels, kernel, f"{label} bigint, faces bigint", [label], halo=1, edge=edge)
    return partial.groupBy(label).agg(F.sum("faces").alias("surface"))


def morphology(voxels: DataFrame, components: DataFrame, label: str = "seg_id", edge: int = EDGE) -> DataFrame:
    """Volume, box size, centroid, surface, elongation and component count per label."""
    base = voxels.groupBy(label).agg(
        F.count(F.lit(1)).alias("volume"),
        *[(F.max(a) - F.min(a) + 1).alias(f"{a}_size") for a in AXES],
        *[F.avg(a).alias(f"{a}_mean") for a in AXES],
        *_moments(),
    )
    base = base.withColumn("elongation", _elongation()).drop("_zz", "_yy", "_xx", "_zy", "_zx", "_yx")
    return base.join(surface_area(voxels, label, edge), label).join(components, label)


def assign_by_overlap(organelles: DataFrame, cells: DataFrame) -> DataFrame:
    """Each organelle's cell: the one with most shared voxels, the lowest label among equals."""
    shared = organelles.select(*AXES, F.col("seg_id").alias("organelle")).join(
        cells.select(*AXES, F.col("seg_id").alias("cell")), list(AXES)
    )
    overlap = shared.groupBy("organelle", "cell").agg(F.count(F.lit(1)).alias("overlap"))
    best = overlap.groupBy("organelle").agg(F.max(F.struct("overlap", -F.col("cell"))).alias("_best"))
    return best.select("organelle", (-F.col("_best")["col2"]).alias("cell"), F.col("_best")["overlap"].alias("overlap"))


def elongation_gate(regions: DataFrame, objects: DataFrame, min_size: int, label: str = "seg_id", gain: float = 0.8) -> DataFrame:
    """Labels whose split makes them rounder.

    ``regions(label, region, volume, elongation)``, ``objects(label, elongation)``. Valid
    if two regions reach ``min_size`` and their volume-weighted mean elongation is
    below ``gain`` times the object's.
    """
    mean = regions.where(F.col("volume") >= min_size).groupBy(label).agg(
        F.count(F.lit(1)).alias("_regions"), (F.sum(F.col("elongation") * F.col("volume")) / F.sum("volume")).alias("_mean")
    )
    whole = objects.select(label, F.col("elongation").alias("_whole"))
    return mean.join(whole, label).where((F.col("_regions") >= 2) & (F.col("_mean") < F.col("_whole") * gain)).select(label)
