"""Chunked arrays in the public zarr version 2 layout: discovery, data source, sink.

Metadata is a small JSON file per array, read on the driver. The ``zarr2`` data source lists the chunk grid, not the folder:
filters on the bounds of blocks reach it, so chunks outside a wanted box are never opened. Codecs are those of ``codecs``.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from ..functions.scalars import layer_type
from . import chunkfiles
from .blocks import BLOCK_ARROW, BLOCK_SCHEMA, chunks_together, in_batches, rows_of
from .codecs import codec

CATALOG_SCHEMA = "path string, shape array<bigint>, dtype string, chunks array<bigint>"


def read_meta(path: str) -> dict:
    text = chunkfiles.read_file(path, ".zarray")
    if text is None:
        raise FileNotFoundError(f"no array at {path}")
    meta = json.loads(text)
    if meta.get("filters"):
        raise ValueError(f"unsupported filters in {path}")
    return meta


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """All arrays below ``path`` with their layer type; the root array has the empty path."""
    rows = []
    for folder, names, files in sorted(os.walk(path)):
        if ".zarray" in files:
            names.clear()  # nothing below an array but its chunks
            meta = read_meta(folder)
            name = os.path.relpath(folder, path)
            rows.append(("" if name == "." else name, meta["shape"], np.dtype(meta["dtype"]).name, meta["chunks"]))
        names.sort()
    return spark.createDataFrame(rows, CATALOG_SCHEMA).withColumn("layer", layer_type(F.col("dtype")))


def resolve(path: str, array: str = "") -> str:
    """Folder of one array; ValueError for a group without a name, KeyError for a missing part."""
    if not array and not (Path(path) / ".zarray").exists():
        raise ValueError(f"{path} is a group: name one of its arrays")
    folder = Path(path)
    for part in [p for p in array.split("/") if p]:
        folder = folder / part
        if not folder.is_dir():
            raise KeyError(f"{part!r} not found in {folder.parent}")
    if not (folder / ".zarray").exists():
        raise KeyError(f"{array!r} is not an array")
    return str(folder)


@dataclass
class Chunks(InputPartition):
    """A run of chunks in C order of the grid that starts at ``first`` and has ``counts`` chunks per axis."""

    first: list[int]
    counts: list[int]
    start: int
    stop: int


class ZarrReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.names = path, schema.names
        meta = self.meta = read_meta(path)
        if meta.get("fill_value"):
            raise ValueError("arrays with a fill value other than 0 are not sparse")
        self.box = [[0, n] for n in meta["shape"]]
        codec(meta.get("compressor"))  # an unknown codec fails here, not in a task

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of blocks cut the chunk grid; all filters are applied again by Spark, as a block is kept or left whole."""
        chunks, shape = self.meta["chunks"], self.meta["shape"]
        for f in filters:
            yield f
            end, _, axis = str(f.attribute[0]).rpartition("_") if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) else ("", "", "")
            if end not in ("low", "high") or f.value is None:
                continue
            i, least, most = int(axis), -math.inf, math.inf
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                least = f.value + isinstance(f, GreaterThan)
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                most = f.value - isinstance(f, LessThan)
            # chunks k with least <= bound <= most, where the bound is k * c, or the smaller of (k + 1) * c and the extent
            c, n = chunks[i], -(-shape[i] // chunks[i])
            bound = (lambda k: k * c) if end == "low" else (lambda k: min((k + 1) * c, shape[i]))  # noqa: B023
            low, high = self.box[i][0] // c, -(-self.box[i][1] // c)
            guess = 0 if least == -math.inf else max(0, min(n, math.floor(least / c) - 1))
            while guess < n and bound(guess) < least:
                guess += 1
            last = n if most == math.inf else max(0, min(n, math.floor(most / c) + 1))
            while last > 0 and bound(last - 1) > most:
                last -= 1
            low, high = max(low, guess), min(high, last)
            self.box[i] = [low * c, max(low, high) * c]

    def partitions(self) -> Sequence[Chunks]:
        chunks = self.meta["chunks"]
        first = [low // c for (low, _), c in zip(self.box, chunks)]
        counts = [max(0, -(-high // c) - f) for (_, high), c, f in zip(self.box, chunks, first)]
        total = math.prod(counts)
        run = chunks_together(total, math.prod(chunks) * np.dtype(self.meta["dtype"]).itemsize)
        return [Chunks(first, counts, k, min(total, k + run)) for k in range(0, total, run)] or [Chunks(first, counts, 0, 0)]

    def read(self, partition: Chunks) -> Iterator[pa.RecordBatch]:
        bounds = [(f"{end}_{i}", pa.int64()) for i in range(len(self.meta["shape"])) for end in ("low", "high")]
        types = {f.name: f.type for f in BLOCK_ARROW} | dict(bounds)
        rows = (tuple(row[c] for c in self.names) for row in self.chunks_of(partition))
        yield from in_batches(rows, pa.schema([(c, types[c]) for c in self.names]))

    def chunks_of(self, partition: Chunks) -> Iterator[dict]:
        meta, dtype = self.meta, np.dtype(self.meta["dtype"])
        decode, _ = codec(meta.get("compressor"), dtype.itemsize)
        shape, chunks, order = meta["shape"], meta["chunks"], meta.get("order", "C")
        system, folder = chunkfiles.open_folder(self.path)
        separator = meta.get("dimension_separator", ".")
        for k in range(partition.start, partition.stop):
            idx = [int(f + i) for f, i in zip(partition.first, np.unravel_index(k, partition.counts))]
            try:
                with system.open_input_file(f"{folder}/{separator.join(map(str, idx))}") as f:
                    content = f.read()
            except FileNotFoundError:
                continue
            cells = np.frombuffer(decode(content), dtype=dtype).reshape(chunks, order=order)
            starts = [i * c for i, c in zip(idx, chunks)]
            size = [min(c, n - s) for c, n, s in zip(chunks, shape, starts)]
            native = np.ascontiguousarray(cells[tuple(slice(0, n) for n in size)], dtype=dtype.newbyteorder("="))
            row = {"idx": idx, "starts": starts, "shape": size, "dtype": native.dtype.name, "data": native.tobytes()}
            for i, (s, n) in enumerate(zip(starts, size)):
                row |= {f"low_{i}": s, f"high_{i}": s + n}
            yield row


class Zarr(DataSource):
    """``spark.read.format("zarr2").load(path)``: blocks, with their bounds ``low_i``, ``high_i`` on each axis."""

    @classmethod
    def name(cls) -> str:
        return "zarr2"

    def schema(self) -> str:
        rank = len(read_meta(self.options["path"])["shape"])
        return BLOCK_SCHEMA + "".join(f", low_{i} bigint, high_{i} bigint" for i in range(rank))

    def reader(self, schema: StructType) -> ZarrReader:
        return ZarrReader(self.options["path"], schema)


def read_blocks(spark: SparkSession, path: str, box: list[tuple[int, int]] | None = None) -> DataFrame:
    """Stored chunks as blocks, clipped to the extent; optionally only those that meet ``box``.

    Chunks that are not stored hold the fill value and give no row. Chunks outside the box are not opened.
    """
    spark.dataSource.register(Zarr)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    found = spark.read.format("zarr2").load(path)
    for i, (low, high) in enumerate(box or []):
        found = found.where((F.col(f"low_{i}") < high) & (F.col(f"high_{i}") > low))
    return found.select(*[f.split()[0] for f in BLOCK_SCHEMA.split(", ")])


def create(path: str, shape: list[int], chunks: list[int], dtype: str, compressor: dict | None = None) -> None:
    meta = {
        "zarr_format": 2, "shape": list(shape), "chunks": list(chunks), "dtype": np.dtype(dtype).str,
        "compressor": compressor, "fill_value": 0, "order": "C", "filters": None,
    }
    system, folder = chunkfiles.open_folder(path)
    chunkfiles.write_file(system, f"{folder}/.zarray", json.dumps(meta, indent=1).encode())


def encode_blocks(blocks: DataFrame, meta: dict) -> DataFrame:
    """``(name, data)`` of the chunk files of chunk-aligned blocks."""
    chunks, dtype = meta["chunks"], np.dtype(meta["dtype"])
    separator = meta.get("dimension_separator", ".")
    _, encode = codec(meta.get("compressor"), dtype.itemsize)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for idx, starts, size, kind, data in rows_of(batch):
                if any(s % c for s, c in zip(starts, chunks)):
                    raise ValueError(f"block at {starts} is not aligned to chunks {chunks}")
                whole = np.zeros(chunks, dtype=dtype)
                whole[tuple(slice(0, n) for n in size)] = np.frombuffer(data, kind).reshape(size)
                yield separator.join(map(str, idx)), encode(whole.tobytes())

    files = pa.schema([("name", pa.string()), ("data", pa.binary())])
    return blocks.select(*BLOCK_ARROW.names).mapInArrow(lambda batches: in_batches(store(batches), files), chunkfiles.SCHEMA)


def write_blocks(blocks: DataFrame, path: str, resume: bool = False) -> DataFrame:
    """Write chunk-aligned blocks into an existing array; returns ``(idx, bytes)`` per finished chunk.

    The sink commits by task. With ``resume``, blocks whose chunks an earlier run has finished are neither computed into
    chunks nor written again.
    """
    meta, spark = read_meta(path), blocks.sparkSession
    separator = meta.get("dimension_separator", ".")
    if resume:
        done = chunkfiles.finished(spark, path).select(F.split("name", "[./]").cast("array<bigint>").alias("idx"))
        blocks = blocks.join(done, "idx", "left_anti")
    written = chunkfiles.save(encode_blocks(blocks, meta), path, resume)
    return written.select(F.split("name", f"[{separator}]").cast("array<bigint>").alias("idx"), "bytes")


def number_of_chunks(shape: list[int], chunks: list[int]) -> int:
    return math.prod(-(-n // c) for n, c in zip(shape, chunks))
