"""Codecs of chunk files: zlib, gzip, zstd, and the public Blosc 1 container.

A Blosc buffer is a 16-byte header, the offsets of its blocks, and for each block one stream or one per byte of an element;
a stream is its length and its data, stored as they are if that is no longer. Bytes (or bits) of the elements of a block
may have been shuffled before.
"""

from __future__ import annotations

import gzip
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa

# fixed values of the container format
_SHUFFLE, _STORED, _BIT_SHUFFLE, _ONE_STREAM = 0x01, 0x02, 0x04, 0x10
_FORMATS = {1: "lz4_raw", 2: "snappy", 3: "zlib", 4: "zstd"}
_MOST_STREAMS, _LEAST_ELEMENTS = 16, 128
_HEADER = "<BBBBIII"

_NAMES = {"lz4": 1, "lz4hc": 1, "zlib": 3, "zstd": 4}
_BLOCK_BYTES = 1 << 18


def _inflate(name: str, data: bytes, size: int) -> bytes:
    return zlib.decompress(data) if name == "zlib" else pa.decompress(data, decompressed_size=size, codec=name, asbytes=True)


def _deflate(name: str, data: bytes, level: int) -> bytes:
    if name == "zlib":
        return zlib.compress(data, level)
    return (pa.Codec(name, compression_level=level) if name == "zstd" else pa.Codec(name)).compress(data, asbytes=True)


def _unshuffle(data: bytes, size: int, bits: bool) -> bytes:
    n = len(data) // size
    if bits:
        n -= n % 8
        planes = np.frombuffer(data, np.uint8, n * size).reshape(size * 8, n // 8)
        cells = np.unpackbits(planes, axis=1, bitorder="little").reshape(size, 8, n).transpose(2, 0, 1)
        head = np.packbits(cells, axis=2, bitorder="little").tobytes()
    else:
        head = np.frombuffer(data, np.uint8, n * size).reshape(size, n).T.tobytes()
    return head + data[n * size :]


def unpack_blosc(data: bytes) -> bytes:
    """The bytes in a Blosc 1 buffer; ValueError for inner formats that are not supported (BloscLZ)."""
    _, _, flags, size, total, block, _ = struct.unpack_from(_HEADER, data)
    start = struct.calcsize(_HEADER)
    if flags & _STORED:
        return data[start : start + total]
    if not total:
        return b""
    name = _FORMATS.get(flags >> 5)
    if name is None:
        raise ValueError(f"unsupported format {flags >> 5} in a Blosc buffer")
    out = []
    for i, at in enumerate(struct.unpack_from(f"<{-(-total // block)}i", data, start)):
        length = min(block, total - i * block)
        split = not flags & _ONE_STREAM and size <= _MOST_STREAMS and block // size >= _LEAST_ELEMENTS and length == block
        streams, part = (size, length // size) if split else (1, length)
        pieces = []
        for _ in range(streams):
            (stored,) = struct.unpack_from("<i", data, at)
            piece = data[at + 4 : at + 4 + stored]
            pieces.append(piece if stored == part else _inflate(name, piece, part))
            at += 4 + stored
        whole = b"".join(pieces)
        if flags & (_SHUFFLE | _BIT_SHUFFLE) and size > 1 or flags & _BIT_SHUFFLE:
            whole = _unshuffle(whole, size, bool(flags & _BIT_SHUFFLE))
        out.append(whole)
    return b"".join(out)


def pack_blosc(data: bytes, size: int, name: str = "lz4", level: int = 5, shuffle: bool = True) -> bytes:
    """A Blosc 1 buffer of elements of ``size`` bytes, one stream a block."""
    if name not in _NAMES:
        raise ValueError(f"unsupported format {name!r} in a Blosc buffer")
    code, block = _NAMES[name], max(size, _BLOCK_BYTES - _BLOCK_BYTES % size)
    shuffle = shuffle and size > 1
    streams = []
    for i in range(0, len(data), block):
        part = data[i : i + block]
        n = len(part) // size
        plain = np.frombuffer(part, np.uint8, n * size).reshape(n, size).T.tobytes() + part[n * size :] if shuffle else part
        packed = _deflate(_FORMATS[code], plain, level)
        packed = plain if len(packed) >= len(plain) else packed
        streams.append(struct.pack("<i", len(packed)) + packed)
    head = struct.calcsize(_HEADER) + 4 * len(streams)
    starts = head + np.cumsum([0, *map(len, streams)])[:-1]
    total = head + sum(map(len, streams))
    flags = code << 5 | _ONE_STREAM | (_SHUFFLE if shuffle else 0)
    return struct.pack(_HEADER, 2, 1, flags, size, len(data), min(block, max(1, len(data))), total) + struct.pack(f"<{len(streams)}i", *map(int, starts)) + b"".join(streams)


def codec(compressor: dict | None, itemsize: int = 1) -> tuple[Callable[[bytes], bytes], Callable[[bytes], bytes]]:
    """(decode, encode) of a compressor as array metadata names it."""
    settings = compressor or {}
    name, level = settings.get("id"), settings.get("level", 1)
    if name is None:
        return bytes, bytes
    if name == "zlib":
        return zlib.decompress, lambda raw: zlib.compress(raw, level)
    if name == "gzip":
        return gzip.decompress, lambda raw: gzip.compress(raw, level, mtime=0)
    if name == "zstd":

        def read(data: bytes) -> bytes:
            with pa.input_stream(pa.py_buffer(data), compression="zstd") as stream:
                return stream.read()

        return read, lambda raw: _deflate("zstd", raw, level)
    if name == "blosc":
        shuffle = settings.get("shuffle", 1)
        return unpack_blosc, lambda raw: pack_blosc(raw, itemsize, settings.get("cname", "lz4"), settings.get("clevel", 5), shuffle in (1, -1))
    raise ValueError(f"unsupported codec {name!r}")
