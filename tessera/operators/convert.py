"""Whole-array jobs: from a stored array to stored arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..functions.scalars import INTENSITY_MAX, INTENSITY_MIN
from ..session import materialize
from ..sources import arrays, zarr2
from ..sources.blocks import auto_chunk, rechunk, to_blocks, to_voxels
from ..sources.precomputed import write_precomputed
from . import fuse
from .dictionary import mask_blocks, one_output, relabel_blocks
from .tasks import map_blocks

ZLIB = {"id": "zlib", "level": 1}


def _store(blocks: DataFrame, path: str, shape, chunks, dtype: str, aligned: bool = True) -> dict:
    zarr2.create(path, shape, chunks, dtype, ZLIB)
    if not aligned:
        blocks = rechunk(blocks, list(shape), list(chunks))
    written = zarr2.write_blocks(blocks, path).count()
    return {"output_path": path, "chunks_written": written, "chunks_total": zarr2.number_of_chunks(shape, chunks)}


def normalize_block(cells: np.ndarray, low: int = INTENSITY_MIN, high: int = INTENSITY_MAX) -> np.ndarray:
    return ((np.clip(cells.astype(np.float64), low, high) - low) / (high - low) * 255).astype(np.uint8)


def normalize_array(
    spark: SparkSession, source: str, target: str, low: int = INTENSITY_MIN, high: int = INTENSITY_MAX, chunks=None
) -> dict:
    """16-bit to 8-bit array; no shuffle unless the chunks change."""
    meta = zarr2.read_meta(source)
    blocks = map_blocks(zarr2.read_blocks(spark, source), normalize_block, low=low, high=high)
    chunks = list(chunks or meta["chunks"])
    return _store(blocks, target, meta["shape"], chunks, "uint8", chunks == meta["chunks"])


def resample_array(spark: SparkSession, source: str, target: str, factors, method: str = "nearest", chunks=None) -> dict:
    meta = zarr2.read_meta(source)
    shape = [max(1, int(n / f)) for n, f in zip(meta["shape"], factors)]
    chunks = list(chunks or [max(1, min(int(c / f), 256)) for c, f in zip(meta["chunks"], factors)])
    dtype = np.dtype(meta["dtype"]).name
    cells = fuse.resample(to_voxels(zarr2.read_blocks(spark, source), "val"), meta["shape"], tuple(factors), method)
    if np.dtype(dtype).kind in "iu":
        # interpolated values are rounded to the nearest value the type can hold
        limits = np.iinfo(dtype)
        cells = cells.selectExpr(
            "z", "y", "x", f"least(greatest(round(val), {float(limits.min)}D), {float(limits.max)}D) as val"
        )
    return _store(to_blocks(cells, shape, chunks, dtype, "val"), target, shape, chunks, dtype)


def relabel_array(spark: SparkSession, source: str, labels: str, filtered: str, lookup: DataFrame, valid: DataFrame) -> list[dict]:
    """Relabelled and filtered copies of an array, both from one scan of it."""
    meta = zarr2.read_meta(source)
    both = materialize(relabel_blocks(zarr2.read_blocks(spark, source), lookup, valid))
    return [
        _store(one_output(both, column), path, meta["shape"], meta["chunks"], "uint32")
        for column, path in (("label", labels), ("filtered", filtered))
    ]


def mask_array(spark: SparkSession, source: str, target: str, ids: DataFrame) -> dict:
    """An array that is 1 where the id is in the list, else 0; chunks without such an id are not stored."""
    meta = zarr2.read_meta(source)
    masked = mask_blocks(zarr2.read_blocks(spark, source), ids)
    return _store(one_output(masked, "mask"), target, meta["shape"], meta["chunks"], "uint8")


def merge_nuclei_arrays(spark: SparkSession, cells: str, nuclei: str, target: str, factor: int = 2) -> dict:
    cell_meta, meta = zarr2.read_meta(cells), zarr2.read_meta(nuclei)
    merged = fuse.merge_nuclei(
        to_voxels(zarr2.read_blocks(spark, cells)), to_voxels(zarr2.read_blocks(spark, nuclei)), factor,
        cell_meta["shape"], meta["shape"],
    )
    return _store(to_blocks(merged, meta["shape"], meta["chunks"], "uint32"), target, meta["shape"], meta["chunks"], "uint32")


def voxels_to_array(voxels: DataFrame, target: str, shape, chunks, dtype: str, value: str = "seg_id") -> dict:
    return _store(to_blocks(voxels, list(shape), list(chunks), dtype, value), target, shape, chunks, dtype)


def npy_to_array(spark: SparkSession, source: str, target: str, chunk=None) -> dict:
    array = np.load(source, mmap_mode="r")
    chunk = list(chunk or auto_chunk(list(array.shape), array.dtype.itemsize))
    arrays.register(spark)
    blocks = spark.read.format("npy").option("chunk", ",".join(map(str, chunk))).load(source)
    return _store(blocks, target, array.shape, chunk, array.dtype.name)


def tiff_to_array(spark: SparkSession, source: str, target: str, chunk=None) -> dict:
    reader = arrays.TiffReader(source, arrays.tiff_pages(source), list(chunk) if chunk else None)
    arrays.register(spark)
    blocks = spark.read.format("tiffstack").option("chunk", ",".join(map(str, reader.chunk))).load(source)
    return _store(blocks, target, reader.shape, reader.chunk, reader.dtype.name)


def array_to_precomputed(spark: SparkSession, source: str, target: str, resolution=(8, 8, 8), voxel_offset=(0, 0, 0), encoding: str = "raw") -> dict:
    meta = zarr2.read_meta(source)
    return write_precomputed(
        zarr2.read_blocks(spark, source), target, meta["shape"], meta["chunks"], np.dtype(meta["dtype"]).name,
        tuple(resolution), tuple(voxel_offset), source, encoding=encoding,
    )
