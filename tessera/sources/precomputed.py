"""Sink and source for the public "precomputed" multi-resolution layout (raw or palette encoding, one scale)."""

from __future__ import annotations

import gzip
import json
import math
import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunkfiles, palette
from .blocks import BLOCK_SCHEMA, as_array, chunks_together

RAW, PALETTE = "raw", "compressed_segmentation"
RESULT = "idx array<bigint>, ok boolean, error string"


def layer(dtype: str) -> str:
    return "segmentation" if np.dtype(dtype).kind in "iu" and np.dtype(dtype) != np.uint8 else "image"


def write_precomputed(
    blocks: DataFrame, path: str, shape: list[int], chunk: list[int], dtype: str,
    resolution: tuple[int, ...] = (8, 8, 8), voxel_offset: tuple[int, ...] = (0, 0, 0), source: str = "", tolerant: bool = False,
    encoding: str = RAW,
) -> dict:
    """Write z,y,x blocks as x,y,z chunk files plus ``info``; returns the folder and how many chunks were written or failed.

    Shape and chunk are given as z,y,x; resolution and offset as x,y,z. A chunk that
    cannot be written fails the job; with ``tolerant`` it is counted and does not stop the others.
    ``encoding`` is ``raw`` or, for unsigned 32- and 64-bit cells, ``compressed_segmentation``. The folder may be on any
    file system that Arrow can open.
    """
    if encoding not in (RAW, PALETTE) or encoding == PALETTE and np.dtype(dtype) not in (np.uint32, np.uint64):
        raise ValueError(f"no encoding {encoding!r} for {dtype}")
    key = "_".join(str(r) for r in resolution)
    scale = {
        "key": key, "size": shape[::-1], "resolution": list(resolution), "voxel_offset": list(voxel_offset),
        "chunk_sizes": [chunk[::-1]], "encoding": encoding,
    }
    if encoding == PALETTE:
        scale["compressed_segmentation_block_size"] = list(palette.BLOCK)
    info = {
        "@type": "neuroglancer_multiscale_volume", "type": layer(dtype), "data_type": np.dtype(dtype).name,
        "num_channels": 1, "scales": [scale],
    }
    system, root = chunkfiles.open_folder(path)
    chunkfiles.write_file(system, f"{root}/info", json.dumps(info).encode())
    step = {"method": "write_precomputed", "source": source, "date": time.strftime("%Y-%m-%d %H:%M %Z")}
    provenance = {"description": "", "owners": [], "processing": [step], "sources": []}
    chunkfiles.write_file(system, f"{root}/provenance", json.dumps(provenance).encode())
    system.create_dir(f"{root}/{key}", recursive=True)

    def store(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, folder = chunkfiles.open_folder(path)
        for frame in frames:
            rows = []
            for row in frame.itertuples(index=False):
                error = None
                try:
                    cells = as_array(row).astype(np.dtype(dtype).newbyteorder("<"), copy=False)
                    first = [int(s) + o for s, o in zip(row.starts[::-1], voxel_offset)]
                    name = "_".join(f"{a}-{a + n}" for a, n in zip(first, cells.shape[::-1]))
                    # x runs fastest in the file, which is the C order of a z,y,x block
                    content = palette.encode(cells) if encoding == PALETTE else cells.tobytes()
                    chunkfiles.write_file(target, f"{folder}/{key}/{name}.gz", gzip.compress(content, mtime=0))
                except Exception as exc:
                    if not tolerant:
                        raise
                    error = f"{type(exc).__name__}: {exc}"
                rows.append(([int(i) for i in row.idx], error is None, error))
            yield pd.DataFrame(rows, columns=["idx", "ok", "error"])

    counts = blocks.mapInPandas(store, RESULT).agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("ok")).first()
    return {"folder": f"{str(path).rstrip('/')}/{key}", "written": counts["ok"], "failed": counts["n"] - counts["ok"]}


def read_precomputed(spark: SparkSession, path: str) -> DataFrame:
    """The stored chunks of the first scale as z,y,x blocks; ``starts`` leave out the voxel offset.

    The chunk grid is dealt out, so no folder is listed; chunks without a file give no row.
    """
    content = chunkfiles.read_file(path, "info")
    if content is None:
        raise FileNotFoundError(f"{path} has no info")
    info = json.loads(content)
    scale, dtype = info["scales"][0], np.dtype(info["data_type"])
    packed, sides = scale["encoding"] == PALETTE, tuple(scale.get("compressed_segmentation_block_size", palette.BLOCK))
    if scale["encoding"] not in (RAW, PALETTE):
        raise ValueError(f"unsupported encoding {scale['encoding']!r}")
    shape, chunk, offset, key = scale["size"][::-1], scale["chunk_sizes"][0][::-1], scale["voxel_offset"][::-1], scale["key"]
    grid = [-(-n // c) for n, c in zip(shape, chunk)]
    total, whole = math.prod(grid), pa.list_(pa.int64())
    kinds = [whole, whole, whole, pa.string(), pa.binary()]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = chunkfiles.open_folder(path)
        for k in (k for batch in batches for k in batch.column(0).to_pylist()):
            idx = [int(i) for i in np.unravel_index(k, grid)]
            low = [i * c for i, c in zip(idx, chunk)]
            size = [min(c, n - s) for c, n, s in zip(chunk, shape, low)]
            name = "_".join(f"{s + o}-{s + o + n}" for s, o, n in zip(low[::-1], offset[::-1], size[::-1]))
            try:
                with system.open_input_file(f"{folder}/{key}/{name}.gz") as f:
                    content = gzip.decompress(f.read())
            except FileNotFoundError:
                continue
            cells = palette.decode(content, size, dtype, sides) if packed else np.frombuffer(content, dtype.newbyteorder("<")).astype(dtype)
            row = (idx, low, size, dtype.name, cells.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=[f.split()[0] for f in BLOCK_SCHEMA.split(", ")])

    parts = -(-total // chunks_together(total, math.prod(chunk) * dtype.itemsize))
    return spark.range(0, total, 1, max(1, parts)).mapInArrow(load, BLOCK_SCHEMA)
