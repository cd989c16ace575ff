"""Dense blocks: one row per chunk of an N-d array, and the way to sparse voxels and back.

Columns: ``idx`` (chunk position), ``starts`` (first cell), ``shape``, ``dtype``, ``data``
(C-order bytes). A block is bounded by the chunk size, whatever the array's extent.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stencil import AXES

BLOCK_SCHEMA = "idx array<bigint>, starts array<bigint>, shape array<bigint>, dtype string, data binary"
_LONGS = pa.list_(pa.int64())
BLOCK_ARROW = pa.schema([("idx", _LONGS), ("starts", _LONGS), ("shape", _LONGS), ("dtype", pa.string()), ("data", pa.binary())])
TARGET_BYTES = 64 * 1024 * 1024  # size of an automatic chunk
# A partition of a scan reads this many bytes of decoded chunks, and at most this many chunks; grids of few chunks are
# dealt one by one, and no scan has more than this many partitions.
PARTITION_BYTES, PARTITION_CHUNKS = 128 << 20, 1024
LEAST_PARTITIONS, MOST_PARTITIONS = 64, 100_000
VOXEL_ROWS = 1 << 16  # cells that leave a block together
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1024  # blocks that leave a task together


def auto_chunk(shape: list[int], itemsize: int, cubic: bool = False) -> list[int]:
    """Chunk of about 64 MB; axes shorter than their share pass the rest on unless ``cubic``."""
    left, rank, chunk = max(1, TARGET_BYTES // itemsize), len(shape), []
    for n in shape:
        side = min(n, max(1, int(left ** (1.0 / rank))))
        chunk.append(side)
        if not cubic:
            left = max(1, left // side)
    return chunk


def chunks_together(total: int, chunk_bytes: int) -> int:
    """How many chunks of a grid of ``total`` one partition of a scan reads."""
    most = min(PARTITION_BYTES // max(1, chunk_bytes), PARTITION_CHUNKS)
    return max(1, min(most, total // LEAST_PARTITIONS), -(-total // MOST_PARTITIONS))


def fixed_chunk(shape: list[int]) -> list[int]:
    """64 per axis for volumes, else up to 512."""
    return [64] * 3 if len(shape) == 3 else [min(512, n) for n in shape]


def as_array(row) -> np.ndarray:
    return np.frombuffer(row.data, dtype=row.dtype).reshape([int(n) for n in row.shape])


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch, one at a time, since blocks may be large."""
    for row in zip(*batch.columns):
        yield tuple(v.as_py() for v in row)


def in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of blocks in batches of bounded size; small blocks share one, whose making costs more than they do."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def to_voxels(blocks: DataFrame, value: str = "seg_id") -> DataFrame:
    """Non-zero cells of 3-D blocks; integers as BIGINT, other types as DOUBLE.

    The column type follows ``value``: ``seg_id`` and ``label`` are integers.
    """
    kind, cast = ("bigint", np.int64) if value in ("seg_id", "label") else ("double", np.float64)

    names = [*AXES, value]

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*batch.columns):
                starts, shape, dtype, data = (v.as_py() for v in row)
                cells = np.frombuffer(data, dtype=dtype).reshape(shape)
                where = np.nonzero(cells)
                held.append([*[w + s for w, s in zip(where, starts)], cells[where].astype(cast)])
                size += len(where[0])
                if size >= VOXEL_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)
                    held, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)

    return blocks.select("starts", "shape", "dtype", "data").mapInArrow(explode, f"z bigint, y bigint, x bigint, {value} {kind}")


def to_blocks(voxels: DataFrame, shape: list[int], chunk: list[int], dtype: str, value: str = "seg_id") -> DataFrame:
    """Blocks that hold at least one voxel; a value the type cannot hold is an error."""
    limits = np.iinfo(dtype) if np.dtype(dtype).kind in "iu" else None
    keyed = voxels.select(
        *AXES, F.col(value).alias("val"), *[F.floor(F.col(a) / F.lit(c)).alias(f"_b{a}") for a, c in zip(AXES, chunk)]
    )

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        idx, cells = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            found = np.stack([batch.column(f"_b{a}").to_numpy(zero_copy_only=False) for a in AXES])
            places = np.stack([batch.column(a).to_numpy(zero_copy_only=False) for a in AXES])
            values = batch.column("val").to_numpy(zero_copy_only=False)
            if limits:
                outside = np.flatnonzero((values < limits.min) | (values > limits.max))
                if len(outside):
                    raise OverflowError(f"value outside {dtype} in block {found[:, outside[0]].tolist()}")
            cuts = np.flatnonzero((found[:, 1:] != found[:, :-1]).any(axis=0)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(values)]):
                # a block may go on from the batch before
                if idx != (at := found[:, low].tolist()):
                    if idx is not None:
                        yield idx, starts, size, dtype, cells.tobytes()
                    idx, starts = at, [i * c for i, c in zip(at, chunk)]
                    size = [min(c, n - s) for c, n, s in zip(chunk, shape, starts)]
                    cells = np.zeros(size, dtype=dtype)
                cells[tuple(p[low:high] - s for p, s in zip(places, starts))] = values[low:high]
        if idx is not None:
            yield idx, starts, size, dtype, cells.tobytes()

    keys = [f"_b{a}" for a in AXES]
    return keyed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda batches: in_batches(cells_of(batches), BLOCK_ARROW), BLOCK_SCHEMA)


def rechunk(blocks: DataFrame, shape: list[int], chunk: list[int]) -> DataFrame:
    """Cut blocks along another grid; absent parts are 0.

    Every block is sliced where it stands and only the pieces move, each to the one
    new block it belongs to.
    """
    rank = len(shape)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                cells, starts = as_array(row), [int(s) for s in row.starts]
                first = [s // c for s, c in zip(starts, chunk)]
                last = [(s + n - 1) // c for s, n, c in zip(starts, cells.shape, chunk)]
                pieces = []
                for offset in np.ndindex(*[b - a + 1 for a, b in zip(first, last)]):
                    idx = [a + o for a, o in zip(first, offset)]
                    low = [max(i * c, s) for i, c, s in zip(idx, chunk, starts)]
                    high = [min((i + 1) * c, s + n) for i, c, s, n in zip(idx, chunk, starts, cells.shape)]
                    piece = np.ascontiguousarray(cells[tuple(slice(a - s, b - s) for a, b, s in zip(low, high, starts))])
                    pieces.append((idx, low, list(piece.shape), row.dtype, piece.tobytes()))
                yield pd.DataFrame(pieces, columns=["idx", "starts", "shape", "dtype", "data"])

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        idx = [int(i) for i in frame["idx"].iloc[0]]
        starts = [i * c for i, c in zip(idx, chunk)]
        cells = np.zeros([min(c, n - s) for c, n, s in zip(chunk, shape, starts)], dtype=frame["dtype"].iloc[0])
        for row in frame.itertuples(index=False):
            piece = as_array(row)
            cells[tuple(slice(int(a) - s, int(a) - s + n) for a, s, n in zip(row.starts, starts, piece.shape))] = piece
        return pd.DataFrame([(idx, starts, list(cells.shape), cells.dtype.name, cells.tobytes())], columns=frame.columns[:5])

    pieces = blocks.select(*[f.split()[0] for f in BLOCK_SCHEMA.split(", ")]).mapInPandas(cut, BLOCK_SCHEMA)
    keys = [F.col("idx")[i].alias(f"_i{i}") for i in range(rank)]
    keyed = pieces.select("*", *keys)
    return keyed.groupBy(*[f"_i{i}" for i in range(rank)]).applyInPandas(
        lambda frame: join(frame[["idx", "starts", "shape", "dtype", "data"]]), BLOCK_SCHEMA
    )
