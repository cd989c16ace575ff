"""Single-file arrays: ``.npy`` and TIFF stacks (classic and big; plain, deflate or LZW strips).

Both are read by byte range: the driver reads the header only and each task reads
the cells of its own blocks, or the strips that hold them. Sinks lay the file out first and let every task write
its cells in place. The file must be on storage all executors share.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .blocks import BLOCK_SCHEMA, as_array, auto_chunk, chunks_together

# TIFF tag numbers and field sizes.
TAG = {"width": 256, "height": 257, "bits": 258, "compression": 259, "photometric": 262, "offsets": 273,
       "samples": 277, "rows_per_strip": 278, "counts": 279, "predictor": 317, "tile": 322, "sample_format": 339}
FIELD = {1: "B", 2: "c", 3: "H", 4: "I", 5: "II", 16: "Q"}
PLAIN, LZW, DEFLATE = (1,), (5,), (8, 32946)
LZW_CLEAR, LZW_END, LZW_BITS = 256, 257, (9, 12)
TIFF_LIMIT = 1 << 32
BATCH_BYTES = 1 << 20  # chunks that leave a scan together
PAGES_TOGETHER = 1 << 16  # page headers that a task writes
_BLOCK_COLUMNS = [f.split()[0] for f in BLOCK_SCHEMA.split(", ")]


class Slab(InputPartition):
    """The chunks ``start`` to ``stop`` of a grid in C order, and the places of the pages that hold them."""

    def __init__(self, start, stop, pages=None):
        self.start, self.stop, self.pages = start, stop, pages


class _ArrayReader(DataSourceReader):
    """One partition per run of chunks of the grid; ``cells`` reads one chunk."""

    def __init__(self, path: str, shape: list[int], chunk: list[int], itemsize: int):
        self.path, self.shape, self.chunk, self.itemsize = path, shape, chunk, itemsize
        self.grid = [-(-n // c) for n, c in zip(shape, chunk)]

    def partitions(self):
        total = math.prod(self.grid)
        run = chunks_together(total, math.prod(self.chunk) * self.itemsize)
        return [Slab(k, min(total, k + run)) for k in range(0, total, run)]

    def open(self, slab: Slab):
        """What ``cells`` reads from."""
        raise NotImplementedError

    def cells(self, opened, slices):
        raise NotImplementedError

    def read(self, slab: Slab) -> Iterator[pa.RecordBatch]:
        whole, opened, held, size = pa.list_(pa.int64()), self.open(slab), [], 0
        kinds = [whole, whole, whole, pa.string(), pa.binary()]

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=_BLOCK_COLUMNS)

        for k in range(slab.start, slab.stop):
            idx = [int(i) for i in np.unravel_index(k, self.grid)]
            starts = [i * c for i, c in zip(idx, self.chunk)]
            slices = tuple(slice(s, min(s + c, n)) for s, c, n in zip(starts, self.chunk, self.shape))
            part = np.ascontiguousarray(self.cells(opened, slices))
            part = part.astype(part.dtype.newbyteorder("="), copy=False)
            held.append((idx, starts, list(part.shape), part.dtype.name, part.tobytes()))
            size += part.nbytes
            if size >= BATCH_BYTES:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()


class NpyReader(_ArrayReader):
    def open(self, slab):
        return np.load(self.path, mmap_mode="r")

    def cells(self, opened, slices):
        return opened[slices]


class NpySource(DataSource):
    """``spark.read.format("npy").option("chunk", "64,64,64").load(path)``"""

    @classmethod
    def name(cls):
        return "npy"

    def schema(self):
        return BLOCK_SCHEMA

    def reader(self, schema):
        array = np.load(self.options["path"], mmap_mode="r")
        chunk = self.options.get("chunk")
        chunk = [int(c) for c in chunk.split(",")] if chunk else auto_chunk(list(array.shape), array.dtype.itemsize)
        return NpyReader(self.options["path"], list(array.shape), chunk, array.dtype.itemsize)


class _Pages:
    """Walks through an open TIFF file: where its pages lie, and the tags of one page."""

    def __init__(self, file):
        self.file, mark = file, file.read(2)
        if mark not in (b"II", b"MM"):
            raise ValueError(f"{file.name} is not a TIFF file")
        self.end = end = "<" if mark == b"II" else ">"
        (version,) = struct.unpack(f"{end}H", file.read(2))
        # the kinds of: number of entries, number of values, offset
        if version == 42:
            many, size, place = "H", "I", "I"
        elif version == 43 and struct.unpack(f"{end}HH", file.read(4)) == (8, 0):
            many, size, place = "Q", "Q", "Q"
        else:
            raise ValueError(f"{file.name} is not a TIFF file")
        self.many, self.head, self.place = struct.Struct(f"{end}{many}"), struct.Struct(f"{end}HH{size}"), struct.Struct(f"{end}{place}")
        (self.first,) = self.place.unpack(file.read(self.place.size))

    def places(self) -> Iterator[int]:
        """Offsets of all pages; only the links between them are read."""
        at, file = self.first, self.file
        while at:
            yield at
            file.seek(at)
            (entries,) = self.many.unpack(file.read(self.many.size))
            file.seek(at + self.many.size + entries * (self.head.size + self.place.size))
            (at,) = self.place.unpack(file.read(self.place.size))

    def tags(self, at: int) -> dict:
        """Tags of the page at ``at``; each value is a tuple of numbers."""
        file, end, head, room = self.file, self.end, self.head, self.place.size
        file.seek(at)
        (entries,) = self.many.unpack(file.read(self.many.size))
        tags = {"byteorder": end}
        for entry in [file.read(head.size + room) for _ in range(entries)]:
            tag, kind, n = head.unpack_from(entry)
            layout = f"{end}{n}{FIELD[kind]}" if kind in FIELD and kind not in (2, 5) else None
            if layout is None:
                continue
            raw = entry[head.size :]
            if struct.calcsize(layout) > room:
                file.seek(self.place.unpack(raw)[0])
                raw = file.read(struct.calcsize(layout))
            tags[tag] = struct.unpack(layout, raw[: struct.calcsize(layout)])
        return tags


def tiff_pages(path: str) -> list[dict]:
    """Tags of every page."""
    with open(path, "rb") as file:
        pages = _Pages(file)
        return [pages.tags(at) for at in list(pages.places())]


def tiff_places(path: str) -> list[int]:
    """Offset of every page."""
    with open(path, "rb") as file:
        return list(_Pages(file).places())


def _first_page(path: str) -> dict:
    with open(path, "rb") as file:
        pages = _Pages(file)
        return pages.tags(pages.first)


def unpack_lzw(data: bytes) -> bytes:
    """Codes lie from the high bit down and widen one code before the table of their width is full."""
    narrow, wide = LZW_BITS
    single = [bytes([i]) for i in range(256)] + [b"", b""]
    table, width, previous, out = list(single), narrow, b"", []
    held = bits = 0
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & (1 << width) - 1
        if code == LZW_END:
            break
        if code == LZW_CLEAR:
            table, width, previous = list(single), narrow, b""
            continue
        if code > len(table) or code == len(table) and not previous:
            raise ValueError("damaged LZW strip")
        entry = table[code] if code < len(table) else previous + previous[:1]
        if previous:
            table.append(previous + entry[:1])
        out.append(entry)
        previous = entry
        while width < wide and len(table) + 1 >= 1 << width:
            width += 1
    return b"".join(out)


def _strip(content: bytes, page: dict, dtype: np.dtype, rows: int, nx: int) -> np.ndarray:
    """The first ``rows`` rows of a strip."""
    (packing,) = page.get(TAG["compression"], PLAIN)
    content = zlib.decompress(content) if packing in DEFLATE else unpack_lzw(content) if packing in LZW else content
    cells = np.frombuffer(content, dtype, rows * nx).reshape(rows, nx)
    if page.get(TAG["predictor"], (1,))[0] == 2 and packing not in PLAIN:
        native = dtype.newbyteorder("=")
        cells = np.cumsum(cells.astype(native), axis=1, dtype=native)  # differences wrap around
    return cells


def _tiff_dtype(page: dict) -> np.dtype:
    packing, predictor = page.get(TAG["compression"], PLAIN)[0], page.get(TAG["predictor"], (1,))[0]
    kind = {1: "u", 2: "i", 3: "f"}.get(page.get(TAG["sample_format"], (1,))[0])
    if page.get(TAG["samples"], (1,))[0] != 1 or TAG["tile"] in page or kind is None or page[TAG["bits"]][0] % 8:
        raise ValueError("only single-channel TIFF in strips of whole bytes is supported")
    if packing not in PLAIN + LZW + DEFLATE or predictor > 2 or predictor == 2 and kind == "f":
        raise ValueError(f"unsupported TIFF compression {packing} with predictor {predictor}")
    return np.dtype(f"{page['byteorder']}{kind}{page[TAG['bits']][0] // 8}")


class TiffReader(_ArrayReader):
    """The driver knows where the pages lie; a task gets the places of its own pages, and reads their tags.

    ``pages`` are the places, or the tags, of all pages.
    """

    def __init__(self, path, pages, chunk):
        first = pages[0] if isinstance(pages[0], dict) else _first_page(path)
        self.pages, self.dtype = pages, _tiff_dtype(first)
        shape = [len(pages), first[TAG["height"]][0], first[TAG["width"]][0]]
        super().__init__(path, shape, chunk or auto_chunk(shape, self.dtype.itemsize, cubic=True), self.dtype.itemsize)

    def __getstate__(self):
        return {**self.__dict__, "pages": None}

    def partitions(self):
        pages = self.pages or tiff_places(self.path)
        slabs = super().partitions()
        layer = math.prod(self.grid[1:])
        for slab in slabs:
            slab.pages = pages[slab.start // layer * self.chunk[0] : ((slab.stop - 1) // layer + 1) * self.chunk[0]]
        return slabs

    def open(self, slab):
        """The file, its first page that is wanted, and the tags from there on."""
        first = slab.start // math.prod(self.grid[1:]) * self.chunk[0]
        with open(self.path, "rb") as file:
            walk = _Pages(file)
            pages = [p if isinstance(p, dict) else walk.tags(p) for p in slab.pages]
        for page in pages:
            if _tiff_dtype(page) != self.dtype or [page[TAG["height"]][0], page[TAG["width"]][0]] != self.shape[1:]:
                raise ValueError("pages differ in size or type")
        return open(self.path, "rb"), first, pages

    def cells(self, opened, slices):
        file, first, pages = opened
        ny, nx = self.shape[1:]
        zs, ys, xs = slices
        out = np.empty([s.stop - s.start for s in slices], self.dtype)
        for page, plane in zip(pages[zs.start - first : zs.stop - first], out, strict=True):
            rows = min(ny, page.get(TAG["rows_per_strip"], (ny,))[0])
            plain = page.get(TAG["compression"], PLAIN) == PLAIN
            for k in range(ys.start // rows, -(-ys.stop // rows)):
                low, high = max(ys.start, k * rows), min(ys.stop, (k + 1) * rows)
                strip, part = page[TAG["offsets"]][k], plane[low - ys.start : high - ys.start]
                if plain and part.shape[1] == nx:
                    file.seek(strip + (low - k * rows) * nx * self.dtype.itemsize)
                    part[:] = np.frombuffer(file.read(part.nbytes), self.dtype).reshape(part.shape)
                elif plain:
                    for y in range(low, high):
                        file.seek(strip + ((y - k * rows) * nx + xs.start) * self.dtype.itemsize)
                        part[y - low] = np.frombuffer(file.read(part[y - low].nbytes), self.dtype)
                else:
                    file.seek(strip)
                    content = _strip(file.read(page[TAG["counts"]][k]), page, self.dtype, min(rows, ny - k * rows), nx)
                    part[:] = content[low - k * rows : high - k * rows, xs]
        return out


class TiffSource(DataSource):
    """``spark.read.format("tiffstack").load(path)``: one z plane per page."""

    @classmethod
    def name(cls):
        return "tiffstack"

    def schema(self):
        return BLOCK_SCHEMA

    def reader(self, schema):
        chunk = self.options.get("chunk")
        return TiffReader(self.options["path"], tiff_places(self.options["path"]), [int(c) for c in chunk.split(",")] if chunk else None)


def register(spark: SparkSession) -> SparkSession:
    for source in (NpySource, TiffSource):
        spark.dataSource.register(source)
    return spark


def _write_in_place(blocks: DataFrame, path: str, offset: int, shape: list[int], dtype: str) -> None:
    def store(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            target = np.memmap(path, dtype=dtype, mode="r+", offset=offset, shape=tuple(shape))
            for row in frame.itertuples(index=False):
                cells = as_array(row)
                target[tuple(slice(int(s), int(s) + n) for s, n in zip(row.starts, cells.shape))] = cells
            target.flush()
            yield pd.DataFrame({"blocks": [len(frame)]})

    blocks.mapInPandas(store, "blocks bigint").agg({"blocks": "sum"}).collect()


def write_npy(blocks: DataFrame, path: str, shape: list[int], dtype: str) -> str:
    target = np.lib.format.open_memmap(path, mode="w+", dtype=dtype, shape=tuple(shape))
    offset = target.offset
    del target
    _write_in_place(blocks, path, offset, shape, dtype)
    return path


def write_mask_tiff(blocks: DataFrame, path: str, shape: list[int], big: bool | None = None) -> str:
    """8-bit TIFF stack of ``value * 255`` (modulo 256), one page per z plane.

    A file beyond the reach of 32-bit offsets is a BigTIFF; ``big`` asks for one at any size.
    """
    from ..operators.tasks import map_blocks

    nz, ny, nx = shape
    fields = 10
    classic = 8 + nz * (2 + 12 * fields + 4)
    big = classic + nz * ny * nx >= TIFF_LIMIT if big is None else big
    head, page_bytes = (16, 8 + 20 * fields + 8) if big else (8, 2 + 12 * fields + 4)
    base = head + nz * page_bytes
    if not big and base + nz * ny * nx >= TIFF_LIMIT:
        raise ValueError("too large for a classic TIFF file")
    with open(path, "wb") as file:
        file.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, head) if big else struct.pack("<2sHI", b"II", 42, head))
        file.truncate(base + nz * ny * nx)
    values = {"width": nx, "height": ny, "bits": 8, "compression": 1, "photometric": 1,
              "offsets": base, "samples": 1, "rows_per_strip": ny, "counts": ny * nx, "sample_format": 1}
    small = ("bits", "compression", "photometric", "samples", "sample_format")
    place = "<u8" if big else "<u4"
    entry = [("tag", "<u2"), ("kind", "<u2"), ("n", place), ("value", place)]
    page = np.dtype([("fields", "<u8" if big else "<u2"), ("entries", entry, (fields,)), ("next", place)])

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in batch.column(0).to_pylist():
                z = np.arange(first, min(first + PAGES_TOGETHER, nz))
                pages = np.zeros(len(z), page)
                pages["fields"] = fields
                for i, (name, value) in enumerate(values.items()):
                    own = pages["entries"][:, i]
                    own["tag"], own["n"] = TAG[name], 1
                    own["kind"] = 3 if name in small else 16 if big else 4
                    own["value"] = value + z * (ny * nx) if name == "offsets" else value
                pages["next"] = np.where(z + 1 < nz, head + (z + 1) * page_bytes, 0)
                with open(path, "r+b") as file:
                    file.seek(head + first * page_bytes)
                    file.write(pages.tobytes())
            yield batch

    blocks.sparkSession.range(0, nz, PAGES_TOGETHER).mapInArrow(headers, "id bigint").count()
    scaled = map_blocks(blocks, lambda cells: (cells.astype(np.int64) * 255).astype(np.uint8))
    _write_in_place(scaled, path, base, shape, "uint8")
    return path
