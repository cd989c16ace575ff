"""Reading boxes of a volume, from stored voxels or from a service, chunk by chunk."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import chunk_grid
from ..sources.blocks import BLOCK_SCHEMA
from .stencil import AXES

log = logging.getLogger(__name__)

# (offset_xyz, size_xyz, mag) -> array in z, y, x order
Fetch = Callable[[tuple, tuple, int], np.ndarray]


def read_box(voxels: DataFrame, offset_xyz: tuple[int, int, int], size_xyz: tuple[int, int, int], mag: int = 1) -> DataFrame:
    """Voxels of a box, re-based to its corner; offset and size in full-resolution x,y,z.

    The range predicates reach the Parquet scan. At ``mag`` > 1 the stored voxels are
    taken to be of that magnification.
    """
    low = [o // mag for o in offset_xyz[::-1]]
    size = [s // mag for s in size_xyz[::-1]]
    box = voxels
    for a, o, s in zip(AXES, low, size):
        box = box.where((F.col(a) >= o) & (F.col(a) < o + s))
    return box.withColumns({a: F.col(a) - o for a, o in zip(AXES, low)})


def fetch_volume(
    spark: SparkSession, shape: tuple[int, int, int], chunk: tuple[int, int, int], fetch: Fetch, mag: int = 1,
    dtype: str = "int32", todo: DataFrame | None = None, tries: int = 3, tolerant: bool = False,
) -> DataFrame:
    """Fetch a z,y,x volume chunk by chunk as blocks at magnification ``mag``.

    Shape and chunk are full-resolution and must be multiples of ``mag``. A chunk that
    fails ``tries`` times fails the job. With ``tolerant`` it gives a row without data
    instead, and all rows have an ``error`` column, null where the chunk was fetched.
    ``todo`` restricts the work to the chunk ids it lists.
    """
    if any(n % mag for n in (*shape, *chunk)):
        raise ValueError(f"shape {shape} and chunk {chunk} must be multiples of mag {mag}")
    tasks = chunk_grid(spark, list(shape), list(chunk))
    if todo is not None:
        tasks = tasks.join(todo.select("chunk_id"), "chunk_id", "left_semi")

    def load(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for task in frame.itertuples(index=False):
                starts, stops = [int(s) for s in task.starts], [int(s) for s in task.stops]
                size = [b - a for a, b in zip(starts, stops)]
                cells = error = None
                for attempt in range(tries):
                    try:
                        cells = np.ascontiguousarray(fetch(tuple(starts[::-1]), tuple(size[::-1]), mag).astype(dtype))
                        break
                    except Exception as exc:
                        log.error("chunk %s attempt %d: %s", starts, attempt + 1, exc)
                        error = exc
                if cells is None and not tolerant:
                    raise RuntimeError(f"chunk at {starts} could not be fetched in {tries} tries") from error
                where = [int(i) for i in task.idx], [s // mag for s in starts]
                if cells is None:
                    row = *where, [n // mag for n in size], dtype, None, f"{type(error).__name__}: {error}"
                else:
                    row = *where, list(cells.shape), dtype, cells.tobytes(), None
                names = ["idx", "starts", "shape", "dtype", "data", "error"]
                yield pd.DataFrame([row], columns=names) if tolerant else pd.DataFrame([row[:-1]], columns=names[:-1])

    schema = f"{BLOCK_SCHEMA}, error string" if tolerant else BLOCK_SCHEMA
    return tasks.repartition("chunk_id").mapInPandas(load, schema)
