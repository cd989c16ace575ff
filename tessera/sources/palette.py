"""The public "compressed_segmentation" encoding of a chunk: palettes of 8 x 8 x 8 blocks and bit-packed places in them.

A chunk is words of 32 bits: where its channel begins, then two words for each block (x fastest: place of the palette in
the low 24 bits, bits a cell in the high 8; place of the cells), then cells and palettes. Places count words from the
channel's first. Equal palettes of a chunk are stored once. Cells are unsigned 32- or 64-bit; arrays here are z, y, x.
"""

from __future__ import annotations

import numpy as np

BLOCK = (8, 8, 8)  # as x, y, z
_WIDTHS = np.array([0, 1, 2, 4, 8, 16, 32])
_PLACES = 1 << 24


def _grid(shape, block) -> list[int]:
    return [-(-n // b) for n, b in zip(shape, block[::-1])]


def _packed(codes: np.ndarray, bits: int) -> np.ndarray:
    each = 32 // bits
    lanes = np.pad(codes, (0, -len(codes) % each)).astype(np.uint32).reshape(-1, each)
    return np.bitwise_or.reduce(lanes << (np.arange(each, dtype=np.uint32) * np.uint32(bits)), axis=1)


def _unpacked(words: np.ndarray, bits: int, n: int) -> np.ndarray:
    each = 32 // bits
    mask = np.uint32((1 << bits) - 1)
    return (words[:, None] >> (np.arange(each, dtype=np.uint32) * np.uint32(bits)) & mask).ravel()[:n]


def encode(cells: np.ndarray, block: tuple[int, int, int] = BLOCK) -> bytes:
    if cells.dtype not in (np.uint32, np.uint64):
        raise ValueError(f"{cells.dtype} has no palette encoding")
    grid, sides = _grid(cells.shape, block), block[::-1]
    # cells beyond the chunk repeat its last ones, so that they add nothing to a palette
    whole = np.pad(cells, [(0, g * b - n) for g, b, n in zip(grid, sides, cells.shape)], mode="edge")
    blocks = whole.reshape([k for g, b in zip(grid, sides) for k in (g, b)]).transpose(0, 2, 4, 1, 3, 5).reshape(-1, np.prod(sides))
    header, parts, seen = np.zeros((len(blocks), 2), np.uint32), [], {}
    at = header.size
    for k, one in enumerate(blocks):
        palette, codes = np.unique(one, return_inverse=True)
        bits = int(_WIDTHS[np.searchsorted(_WIDTHS, (len(palette) - 1).bit_length())])
        header[k, 1] = at
        if bits:
            parts.append(_packed(codes.ravel(), bits))
            at += len(parts[-1])
        stored = palette.astype(palette.dtype.newbyteorder("<")).tobytes()
        if stored not in seen:
            seen[stored] = at
            parts.append(np.frombuffer(stored, "<u4"))
            at += len(parts[-1])
        if seen[stored] >= _PLACES:
            raise ValueError("chunk too large for palettes at 24-bit places")
        header[k, 0] = bits << 24 | seen[stored]
    return np.concatenate([np.ones(1, np.uint32), header.ravel(), *parts]).astype("<u4").tobytes()


def decode(data: bytes, shape, dtype, block: tuple[int, int, int] = BLOCK) -> np.ndarray:
    words = np.frombuffer(data, "<u4")
    channel, dtype = words[words[0] :].astype(np.uint32), np.dtype(dtype)
    grid, sides = _grid(shape, block), block[::-1]
    n, wide = int(np.prod(sides)), dtype.itemsize // 4
    out = np.zeros((int(np.prod(grid)), n), dtype)
    for k, (head, begin) in enumerate(channel[: 2 * len(out)].reshape(-1, 2).tolist()):
        bits, place = head >> 24, head % _PLACES
        codes = _unpacked(channel[begin : begin + -(-n * bits // 32)], bits, n) if bits else np.zeros(1, np.uint32)
        size = int(codes.max()) + 1
        palette = channel[place : place + size * wide].astype("<u4").tobytes()
        out[k] = np.frombuffer(palette, dtype.newbyteorder("<"))[codes]
    whole = out.reshape(*grid, *sides).transpose(0, 3, 1, 4, 2, 5).reshape([g * b for g, b in zip(grid, sides)])
    return np.ascontiguousarray(whole[tuple(slice(0, s) for s in shape)])
