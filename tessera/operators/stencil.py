"""Neighbourhood work on sparse volumes, one bounded block of space per task call.

A block is a cube of ``EDGE`` cells per axis plus a halo, so a group never exceeds
(EDGE + 2 * halo)^3 rows however large an object is. Rows near a block face are
sent to each block whose halo they lie in; everything else is shuffled once.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDGE = 32
GROUP_CELLS = 1 << 17  # cells of the lines that one group of a pass holds, unless a single line is longer
PIECE = 256  # cells of a line in one piece, where long lines are cut
AXES = ("z", "y", "x")
CONNECTIVITY = {6: 1, 18: 2, 26: 3}


def offsets(connectivity: int, half: bool = False) -> list[tuple[int, int, int]]:
    """Neighbour steps; with ``half`` only one of each opposite pair."""
    if connectivity not in CONNECTIVITY:
        raise ValueError("connectivity must be 6, 18 or 26")
    reach = CONNECTIVITY[connectivity]
    steps = [s for s in product((-1, 0, 1), repeat=3) if 0 < sum(map(abs, s)) <= reach]
    return [s for s in steps if s > (0, 0, 0)] if half else steps


class Cells:
    """The rows of one block, in C order, with neighbour lookup by position.

    With ``layer``, rows are ordered by that column first and only rows with the same
    value are neighbours; a cell may then appear once per value.
    """

    def __init__(self, table: pa.Table, halo: int, edge: int, columns: list[str], layer: str | None = None):
        self.block = [table.column(f"_b{a}")[0].as_py() for a in AXES]
        self.pad, self.edge = halo + 1, edge
        self.width = edge + 2 * self.pad
        raw = [table.column(a).to_numpy() for a in AXES]
        local = [c - b * edge + self.pad for c, b in zip(raw, self.block)]
        key = self.pack(local)
        if layer:
            key += np.unique(table.column(layer).to_numpy(), return_inverse=True)[1] * self.width**3
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.coords = [c[order] for c in raw]
        self.local = [c[order] for c in local]
        self.columns = {c: table.column(c).to_numpy()[order] for c in columns}
        self.core = np.ones(len(key), bool)
        for c in self.local:
            self.core &= (c >= self.pad) & (c < self.pad + edge)

    def __len__(self) -> int:
        return len(self.key)

    def pack(self, local):
        return (local[0] * self.width + local[1]) * self.width + local[2]

    def step(self, offset) -> int:
        return int(self.pack(offset))

    def neighbour(self, offset) -> np.ndarray:
        """Row number of each cell's neighbour, -1 where that cell is not stored."""
        wanted = self.key + self.step(offset)
        at = np.searchsorted(self.key, wanted)
        at[at == len(self.key)] = 0
        return np.where(self.key[at] == wanted, at, -1)

    def same(self, offset, column: str) -> np.ndarray:
        """Like ``neighbour``, but -1 as well where ``column`` differs."""
        at, values = self.neighbour(offset), self.columns[column]
        return np.where((at >= 0) & (values[at] == values), at, -1)

    def take(self, rows, **extra) -> dict:
        """Coordinates of the selected rows plus the ``extra`` columns."""
        return {**{a: c[rows] for a, c in zip(AXES, self.coords)}, **extra}


def per_block(
    df: DataFrame, kernel: Callable[[Cells], dict], schema: str, columns: list[str], halo: int = 0, edge: int = EDGE,
    layer: str | None = None,
) -> DataFrame:
    """Run ``kernel`` on every block of ``df`` (``z, y, x`` and ``columns``)."""
    names = [part.split()[0] for part in schema.split(",")]
    spread = df.select(*AXES, *columns)
    for a in AXES:
        low, high = F.floor((F.col(a) - halo) / F.lit(edge)), F.floor((F.col(a) + halo) / F.lit(edge))
        block = F.explode(F.sequence(low, high)) if halo else low
        spread = spread.withColumn(f"_b{a}", block)

    def run(table: pa.Table) -> pa.Table:
        out = kernel(Cells(table, halo, edge, columns, layer))
        return pa.table({n: out[n] for n in names})

    return spread.groupBy(*[f"_b{a}" for a in AXES]).applyInArrow(run, schema)


def box_of(shape: tuple[int | None, int, int], edge: int = EDGE) -> tuple[int, int, int]:
    """Sides of a block of up to ``edge ** 3`` cells: short axes of the volume go whole, the others have the longer sides (None: no end)."""
    left, sides = edge**3, [0, 0, 0]
    order = sorted(range(3), key=lambda k: math.inf if shape[k] is None else shape[k])
    for k, axis in enumerate(order):
        side = next(n for n in range(edge, left + 2) if (n + 1) ** (3 - k) > left)
        sides[axis] = side if shape[axis] is None else max(1, min(side, shape[axis]))
        left //= sides[axis]
    return tuple(sides)


def per_box(
    df: DataFrame, kernel: Callable[..., dict], schema: str, columns: list[str], layer: str, box: tuple[int, int, int],
    shape: tuple[int | None, int, int], halo: int | tuple[int, int, int] = 0,
) -> DataFrame:
    """Run ``kernel(coords, columns, low, high)`` on every block of ``box`` cells, with rows in order of ``layer``.

    ``low`` and ``high`` bound the block's own cells, the rows reach ``halo`` cells (by axis) beyond. Blocks start at 0 and
    end with the volume; no block is made of rows beyond it. Only the first axis may have no end.
    """
    names = [part.split()[0] for part in schema.split(",")]
    halos = (halo,) * 3 if isinstance(halo, int) else halo
    spread, key, counts = df.select(*AXES, *columns), F.lit(0).cast("bigint"), [None if n is None else -(-n // side) for n, side in zip(shape, box)]
    for a, side, n, reach in zip(AXES, box, counts, halos):
        at = F.col(a)
        if n is not None and n <= 1:
            continue
        low, high = F.greatest(F.floor((at - reach) / F.lit(side)), F.lit(0)), F.floor((at + reach) / F.lit(side))
        high = high if n is None else F.least(high, F.lit(n - 1))
        spread = spread.withColumn(f"_b{a}", F.explode(F.when(low <= high, F.sequence(low, high))) if reach else low)
        key = key * F.lit(n or 0) + F.col(f"_b{a}")
    spread = spread.select(*AXES, *columns, key.alias("_b"))

    def run(table: pa.Table) -> pa.Table:
        left, block = table.column("_b")[0].as_py(), []
        for n in reversed(counts):
            left, k = (0, left) if n is None else divmod(left, max(1, n))
            block.append(k)
        order = np.argsort(table.column(layer).to_numpy(), kind="stable")
        coords = [table.column(a).to_numpy()[order] for a in AXES]
        low = [b * side for b, side in zip(reversed(block), box)]
        high = [b + side if n is None else min(b + side, n) for b, side, n in zip(low, box, shape)]
        out = kernel(coords, {c: table.column(c).to_numpy()[order] for c in columns}, low, high)
        return pa.table({n: out[n] for n in names})

    return spread.groupBy("_b").applyInArrow(run, schema)


def _tile(length: int) -> int:
    """Side of the square of lines of ``length`` cells that one group holds."""
    return max(1, min(EDGE, math.isqrt(GROUP_CELLS // max(1, length))))


def line_pass(
    df: DataFrame, axis: str, kernel: Callable[..., np.ndarray], length: int, fill: dict[str, float], carry: str | None = None, tile: int | None = None
) -> DataFrame:
    """Run ``kernel`` along whole lines of one axis.

    ``kernel`` gets the columns named in ``fill`` as dense arrays (lines, length) and
    returns lines in which NaN marks cells that are not stored. The length may change
    unless an integer column is carried along (``carry``).
    A group holds ``tile * tile`` lines, fewer where they are long, and at least a whole one.
    """
    return cut_pass(df, axis, lambda k, *dense: (0, kernel(*dense)), (F.lit(0), F.lit(0)), lambda k: (0, length), fill, carry, tile or _tile(length))


def cut_pass(
    df: DataFrame, axis: str, kernel: Callable[..., tuple[int, np.ndarray]], pieces: tuple[Column, Column],
    window: Callable[[int], tuple[int, int]], fill: dict[str, float], carry: str | None = None, tile: int | None = None,
) -> DataFrame:
    """Run ``kernel`` along pieces of the lines of one axis, so that a group is bounded however long a line is.

    ``pieces`` are the first and the last piece that a cell is sent to. Piece ``k`` sees the cells from ``window(k)[0]``
    up to ``window(k)[1]``, as in ``line_pass``. ``kernel`` gets ``k`` as well, and returns the position of its first
    cell with the lines from there on.
    """
    others = [a for a in AXES if a != axis]
    schema = "z bigint, y bigint, x bigint, " + (f"{carry} bigint, " if carry else "") + "val double"
    tile = tile or _tile(window(0)[1] - window(0)[0])
    tiled = df.select(
        *AXES, *fill, F.explode(F.sequence(*[p.cast("bigint") for p in pieces])).alias("_piece"),
        *[F.floor(F.col(a) / F.lit(tile)).alias(f"_b{a}") for a in others],
    )

    def run(table: pa.Table) -> pa.Table:
        piece = table.column("_piece")[0].as_py()
        low, high = window(piece)
        along = table.column(axis).to_numpy()
        base = [table.column(f"_b{a}")[0].as_py() * tile for a in others]
        if along.min() < low or along.max() >= high:
            table = table.filter(pa.array((along >= low) & (along < high)))
        first, second = (table.column(a).to_numpy() - b for a, b in zip(others, base))
        lines, row = np.unique(first * tile + second, return_inverse=True)
        along = table.column(axis).to_numpy() - low
        dense = []
        for name, empty in fill.items():
            array = np.full((len(lines), high - low), empty, dtype=table.column(name).to_numpy().dtype)
            array[row, along] = table.column(name).to_numpy()
            dense.append(array)
        begin, result = kernel(piece, *dense)
        line, position = np.nonzero(~np.isnan(result))
        columns = {
            axis: position + begin,
            others[0]: lines[line] // tile + base[0],
            others[1]: lines[line] % tile + base[1],
        }
        out = {a: columns[a].astype("int64") for a in AXES}
        if carry:
            out[carry] = dense[list(fill).index(carry)][line, position + (begin - low)]
        return pa.table({**out, "val": result[line, position]})

    return tiled.groupBy("_piece", *[f"_b{a}" for a in others]).applyInArrow(run, schema)
