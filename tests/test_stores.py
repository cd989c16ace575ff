"""Codecs, the committing sink and the pruning scan of chunked arrays."""

import json
import struct
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.sources import blocks, chunkfiles, zarr2
from tessera.sources.codecs import codec, pack_blosc, unpack_blosc


def container(data, size, block, code, deflate, shuffle=0, one_stream=False):
    """A Blosc buffer written stream by stream, as the format is described: a stream for each byte of an element."""
    out, streams = b"", []
    for i in range(0, len(data), block):
        part = data[i : i + block]
        n = len(part) // size
        if shuffle == 1:
            part = b"".join(part[k : n * size : size] for k in range(size)) + part[n * size :]
        if shuffle == 2:
            n -= n % 8
            cells = np.frombuffer(part, np.uint8, n * size).reshape(n, size)
            rows = [np.packbits((cells[:, k] >> b) & 1, bitorder="little").tobytes() for k in range(size) for b in range(8)]
            part = b"".join(rows) + part[n * size :]
        split = not one_stream and len(part) == block and block // size >= 128 and size <= 16
        pieces = [part[k * len(part) // size : (k + 1) * len(part) // size] for k in range(size)] if split else [part]
        body = b""
        for piece in pieces:
            packed = deflate(piece)
            packed = piece if len(packed) >= len(piece) else packed
            body += struct.pack("<i", len(packed)) + packed
        streams.append(body)
    at = 16 + 4 * len(streams)
    for body in streams:
        out += struct.pack("<i", at)
        at += len(body)
    flags = code << 5 | {0: 0, 1: 1, 2: 4}[shuffle] | (0x10 if one_stream else 0)
    return struct.pack("<BBBBIII", 2, 1, flags, size, len(data), block, at) + out + b"".join(streams)


SAMPLES = [
    np.arange(5000, dtype="<u4").tobytes(), np.random.default_rng(0).integers(0, 3, 4097).astype("<u2").tobytes() + b"x", b"ab", b"", bytes(100_000),
    np.random.default_rng(1).bytes(9000), np.random.default_rng(2).normal(size=1500).tobytes(),
]


@pytest.mark.parametrize("code,deflate", [(1, lambda x: pa.Codec("lz4_raw").compress(x, asbytes=True)), (3, zlib.compress), (4, lambda x: pa.Codec("zstd").compress(x, asbytes=True)), (2, lambda x: pa.Codec("snappy").compress(x, asbytes=True))])
@pytest.mark.parametrize("shuffle", [0, 1, 2])
@pytest.mark.parametrize("one_stream", [False, True])
def test_blosc_containers_are_read(code, deflate, shuffle, one_stream):
    for data in SAMPLES:
        for size in (1, 2, 4, 8):
            assert unpack_blosc(container(data, size, 2048, code, deflate, shuffle, one_stream)) == data
    stored = struct.pack("<BBBBIII", 2, 1, 0x02, 4, 12, 12, 28) + b"abcdefghijkl"
    assert unpack_blosc(stored) == b"abcdefghijkl"
    with pytest.raises(ValueError):
        unpack_blosc(container(b"x" * 64, 1, 64, 0, bytes))


@pytest.mark.parametrize("settings", [None, {"id": "zlib", "level": 2}, {"id": "gzip"}, {"id": "zstd", "level": 3}, *[{"id": "blosc", "cname": c, "clevel": 5, "shuffle": s} for c in ("lz4", "zstd", "zlib") for s in (0, 1)]])
def test_codecs_round_trip(settings):
    for data in SAMPLES:
        decode, encode = codec(settings, 4)
        assert bytes(decode(encode(data))) == data
    big = np.arange(200_000, dtype="<u4").tobytes()
    assert unpack_blosc(pack_blosc(big, 4)) == big and len(pack_blosc(big, 4)) < len(big) / 4
    with pytest.raises(ValueError):
        codec({"id": "rle"})


def stored(spark, path, volume, chunk, compressor=None, separator="."):
    zarr2.create(path, volume.shape, chunk, volume.dtype.name, compressor)
    if separator != ".":
        meta = json.loads((Path(path) / ".zarray").read_text())
        (Path(path) / ".zarray").write_text(json.dumps(meta | {"dimension_separator": separator}))
    rows = [(*map(int, c), int(volume[tuple(c)])) for c in np.argwhere(volume)]
    voxels = spark.createDataFrame(rows, "z bigint, y bigint, x bigint, seg_id bigint").repartition(3)
    return blocks.to_blocks(voxels, list(volume.shape), list(chunk), volume.dtype.name)


def dense(df, shape):
    out = np.zeros(shape, "int64")
    for r in df.collect():
        part = blocks.as_array(r)
        out[tuple(slice(int(s), int(s) + n) for s, n in zip(r.starts, part.shape))] = part
    return out


@pytest.fixture(scope="module")
def volume():
    out = np.random.default_rng(4).integers(0, 5, size=(5, 7, 9)).astype("uint16")
    out[:2, 3:6, 4:8] = 0  # a chunk that is not stored
    out[4, 6, 8] = 1
    return out


@pytest.mark.parametrize("separator", [".", "/"])
def test_blosc_arrays_and_absent_chunks(spark, volume, tmp_path, separator):
    path = str(tmp_path / "v")
    written = zarr2.write_blocks(stored(spark, path, volume, (2, 3, 4), {"id": "blosc", "cname": "zstd", "clevel": 3, "shuffle": 1}, separator), path)
    assert written.count() == 26 and sorted(map(tuple, (r.idx for r in written.collect())))[0] == (0, 0, 0)
    assert np.array_equal(dense(zarr2.read_blocks(spark, path), volume.shape), volume)


def test_chunks_outside_the_box_are_never_opened(spark, volume, tmp_path):
    path = str(tmp_path / "v")
    zarr2.write_blocks(stored(spark, path, volume, (2, 3, 4), {"id": "zlib"}), path).count()
    want = dense(zarr2.read_blocks(spark, path), volume.shape)
    for name in ("0.0.0", "2.2.2", "1.0.0"):
        (tmp_path / "v" / name).write_bytes(b"damaged")
    with pytest.raises(Exception, match="zlib|decompress|incorrect"):
        zarr2.read_blocks(spark, path).collect()
    got = zarr2.read_blocks(spark, path, box=[(0, 5), (3, 6), (0, 9)])
    assert got.count() == 8 and np.array_equal(dense(got, volume.shape)[:, 3:6], want[:, 3:6])
    spark.dataSource.register(zarr2.Zarr)
    frame = spark.read.format("zarr2").load(path)
    assert frame.where("low_1 = 3 and high_2 <= 4").count() == 3
    assert frame.where("low_0 >= 4 and low_2 < 8").count() == 6 and frame.where("high_0 > 4 and low_2 < 8 and high_1 < 7").count() == 4
    assert frame.where("low_0 > 100").count() == 0 and frame.where("low_0 = 1").count() == 0


def test_a_failed_run_resumes(spark, volume, tmp_path):
    path = str(tmp_path / "v")
    ready = stored(spark, path, volume, (2, 3, 4))
    encoded = zarr2.encode_blocks(ready, zarr2.read_meta(path)).where("name <> '1.1.1'").repartitionByRange(4, "name")
    broken = F.when(F.col("name") == "2.2.2", F.raise_error(F.lit("lost"))).otherwise(F.col("data"))
    with pytest.raises(Exception, match="lost"):
        chunkfiles.save(encoded.select("name", broken.cast("binary").alias("data")), path)
    before = {r.name for r in chunkfiles.finished(spark, path).collect()}
    assert 0 < len(before) < 25 and "2.2.2" not in before
    marks = {name: (tmp_path / "v" / name).stat().st_mtime_ns for name in before}
    assert zarr2.write_blocks(ready, path, resume=True).count() == 26
    assert all((tmp_path / "v" / name).stat().st_mtime_ns == t for name, t in marks.items())
    assert np.array_equal(dense(zarr2.read_blocks(spark, path), volume.shape), volume)
    assert zarr2.write_blocks(ready, path).count() == 26  # without resume all is written again
    assert any((tmp_path / "v" / name).stat().st_mtime_ns != t for name, t in marks.items())


def test_folders_named_by_uri(spark, volume, tmp_path):
    path = f"file://{tmp_path}/v"
    assert zarr2.write_blocks(stored(spark, path, volume, (4, 4, 4), {"id": "zstd"}), path).count() == 12
    assert np.array_equal(dense(zarr2.read_blocks(spark, path), volume.shape), volume)
    with pytest.raises(FileNotFoundError):
        zarr2.read_meta(f"{path}-none")
