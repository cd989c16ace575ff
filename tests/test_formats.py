"""TIFF variants and the palette encoding, on bytes laid out here as the formats describe them."""

import struct
import zlib

import numpy as np
import pytest

from tessera.sources import arrays, palette


def lzw(data):
    """Codes from the high bit down, one bit wider once the entry before the last of a width is in the table."""
    out, held, bits, width = bytearray(), 0, 0, 9

    def put(code):
        nonlocal held, bits
        held, bits = held << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)

    fresh = lambda: {bytes([i]): i for i in range(256)}
    table, following, word = fresh(), 258, b""
    put(256)
    for byte in data:
        longer = word + bytes([byte])
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer] = following
        following += 1
        word = bytes([byte])
        if following == 4095:
            put(table[word])
            put(256)
            table, following, word, width = fresh(), 258, b"", 9
        elif following in (512, 1024, 2048):
            width += 1
    if word:
        put(table[word])
        following += 1
        if following in (512, 1024, 2048):
            width += 1
    put(257)
    if bits:
        out.append(held << 8 - bits & 255)
    return bytes(out)


def tiff(volume, packing, predictor, rows, big, end):
    """A stack with one page a plane; strips first, then a table of tags after each page's strips."""
    n_z, ny, nx = volume.shape
    count, place = ("Q", "Q") if big else ("H", "I")
    size = "Q" if big else "I"
    head = struct.pack(f"{end}2sHHHQ", b"II" if end == "<" else b"MM", 43, 8, 0, 0) if big else struct.pack(f"{end}2sHI", b"II" if end == "<" else b"MM", 42, 0)
    out, link = bytearray(head), len(head) - (8 if big else 4)
    deflate = {1: bytes, 5: lzw, 8: zlib.compress, 32946: zlib.compress}[packing]
    for plane in volume:
        offsets, sizes = [], []
        for y in range(0, ny, rows):
            strip = plane[y : y + rows]
            if predictor == 2:
                strip = np.concatenate([strip[:, :1], strip[:, 1:] - strip[:, :-1]], axis=1)
            body = deflate(strip.astype(strip.dtype.newbyteorder(end)).tobytes())
            offsets.append(len(out))
            sizes.append(len(body))
            out += body
        tags = []
        kind = {"u": 1, "i": 2, "f": 3}[volume.dtype.kind]
        for tag, values in ((256, [nx]), (257, [ny]), (258, [8 * volume.dtype.itemsize]), (259, [packing]), (273, offsets), (277, [1]), (278, [rows]), (279, sizes), (317, [predictor]), (339, [kind])):
            raw = struct.pack(f"{end}{len(values)}{place}", *values)
            if len(raw) > struct.calcsize(place):
                raw, at = struct.pack(f"{end}{place}", len(out)), raw
                out += at
            tags.append(struct.pack(f"{end}HH{size}", tag, 16 if big else 4, len(values)) + raw)
        struct.pack_into(f"{end}{place}", out, link, len(out))
        out += struct.pack(f"{end}{count}", len(tags)) + b"".join(tags)
        link = len(out)
        out += struct.pack(f"{end}{place}", 0)
    return bytes(out)


@pytest.mark.parametrize("size", [0, 1, 5, 300, 5000, 60_000])
def test_lzw(size):
    rng = np.random.default_rng(size)
    for data in (bytes(size), rng.bytes(size), rng.integers(0, 3, size).astype(np.uint8).tobytes()):
        assert arrays.unpack_lzw(lzw(data)) == data


@pytest.mark.parametrize("dtype", ["uint8", "int16", "uint32", "float32"])
def test_tiff_variants(spark, tmp_path, dtype):
    arrays.register(spark)
    volume = np.random.default_rng(1).integers(0, 100, (3, 7, 11)).astype(dtype)
    volume[0, 0, :2] = [0, 90]
    for packing, predictor, rows, big, end in ((1, 1, 3, True, "<"), (5, 1, 3, False, ">"), (8, 2, 2, True, ">"), (5, 2, 7, False, "<"), (32946, 1, 20, False, "<")):
        if predictor == 2 and volume.dtype.kind == "f":
            continue
        path = tmp_path / f"{packing}-{predictor}.tif"
        path.write_bytes(tiff(volume, packing, predictor, rows, big, end))
        got = np.zeros_like(volume)
        for r in spark.read.format("tiffstack").option("chunk", "2,4,5").load(str(path)).collect():
            assert r.dtype == dtype
            got[tuple(slice(s, s + n) for s, n in zip(r.starts, r.shape))] = np.frombuffer(r.data, r.dtype).reshape([*r.shape])
        assert (got == volume).all()


def test_tasks_get_the_tags_of_their_own_pages(tmp_path):
    import pickle

    path = tmp_path / "a.tif"
    path.write_bytes(tiff(np.zeros((6, 4, 4), np.uint8), 8, 1, 2, True, "<"))
    reader = arrays.TiffReader(str(path), arrays.tiff_pages(str(path)), [2, 4, 4])
    assert [len(p.pages) for p in reader.partitions()] == [2, 2, 2]
    again = pickle.loads(pickle.dumps(reader))
    assert again.pages is None and len(again.partitions()) == 3


def test_unsupported_tiffs_are_errors(tmp_path):
    path = tmp_path / "a.tif"
    path.write_bytes(b"not a tiff file")
    with pytest.raises(ValueError, match="not a TIFF"):
        arrays.tiff_pages(str(path))
    with pytest.raises(ValueError, match="unsupported TIFF compression"):
        arrays._tiff_dtype({"byteorder": "<", 258: (8,), 259: (7,)})
    with pytest.raises(ValueError, match="damaged"):
        arrays.unpack_lzw(b"\xff\xff")


@pytest.mark.parametrize("dtype", ["uint32", "uint64"])
@pytest.mark.parametrize("values", [1, 2, 3, 5, 17, 300])
def test_palettes(dtype, values):
    rng = np.random.default_rng(values)
    ids = rng.integers(0, 2**32 if dtype == "uint32" else 2**63, values).astype(dtype)
    for shape in ((8, 8, 8), (1, 1, 1), (9, 17, 5), (16, 8, 24)):
        cells = rng.choice(ids, shape)
        packed = palette.encode(cells)
        assert (palette.decode(packed, shape, dtype) == cells).all()
        assert (palette.decode(palette.encode(cells, (4, 2, 8)), shape, dtype, (4, 2, 8)) == cells).all()


def test_palette_layout():
    cells = np.full((8, 8, 16), 7, np.uint32)
    cells[0, 0, 9] = 9
    words = np.frombuffer(palette.encode(cells), "<u4")
    # channel at word 1; block 0: no bits, palette after two headers; block 1: one bit a cell, cells first
    assert words[:6].tolist() == [1, 4, 4, 1 << 24 | 21, 5, 7]
    assert words[6] == 2 and not words[7:22].any() and words[22:].tolist() == [7, 9]
    same = palette.encode(np.random.default_rng(0).integers(0, 2, (8, 8, 64)).astype(np.uint64))
    assert len(same) == 4 * (1 + 16 + 8 * 16 + 4)  # one palette for all
    with pytest.raises(ValueError):
        palette.encode(cells.astype(np.int64))
