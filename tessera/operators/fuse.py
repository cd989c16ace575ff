"""Downsampling, resampling and fusing volumes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stencil import AXES, EDGE, PIECE, cut_pass, line_pass

ORDERS = {"nearest": 0, "linear": 1, "cubic": 3}
# Inverse of the cubic B-spline sampling filter: sqrt(3) * POLE^|k|, below 1e-20 past TAPS.
POLE = 3**0.5 - 2
TAPS = 36


def stride(voxels: DataFrame, factor: int) -> DataFrame:
    """Every ``factor``-th cell per axis."""
    kept = voxels.where(" and ".join(f"{a} % {factor} = 0" for a in AXES))
    return kept.withColumns({a: F.expr(f"{a} div {factor}") for a in AXES})


def merge_nuclei(cells: DataFrame, nuclei: DataFrame, factor: int = 2, cell_shape=None, nuclei_shape=None) -> DataFrame:
    """Strided cell labels where a nucleus is present as well."""
    if cell_shape and nuclei_shape and any(-(-c // factor) != n for c, n in zip(cell_shape, nuclei_shape)):
        raise ValueError(f"cell shape {cell_shape} does not match nuclei shape {nuclei_shape} at factor {factor}")
    small = stride(cells.where("seg_id > 0"), factor)
    return small.join(nuclei.where("seg_id > 0").select(*AXES), list(AXES))


def _sizes(shape, factors):
    return [max(1, int(n / f)) for n, f in zip(shape, factors)]


def _scale(n: int, m: int) -> float:
    """Distance in input cells between two output cells (end points aligned)."""
    return (n - 1) / (m - 1) if m > 1 else 1.0


def resample(voxels: DataFrame, shape: tuple[int, int, int], factors: tuple[float, float, float], method: str = "nearest", value: str = "val", piece: int = PIECE) -> DataFrame:
    """Resample to ``floor(shape / factors)`` cells with aligned end points; absent cells are 0.

    A factor below 1 gives more cells than there were. Any method name other than linear or cubic means nearest.
    """
    if any(f <= 0 for f in factors):
        raise ValueError("factors must be positive")
    order = ORDERS.get(method, 0)
    sizes = _sizes(shape, factors)
    if order == 0:
        return _nearest(voxels, shape, sizes)
    if order == 1:
        return _linear(voxels, shape, sizes, value)
    out = voxels.select(*AXES, F.col(value).cast("double").alias("val"))
    for a, n, m in zip(AXES, shape, sizes):
        if max(n, m) > 4 * piece:
            out = _cut_cubic(out, a, n, m, piece)
        else:
            out = line_pass(out, a, lambda val, m=m: _nan_zero(cubic_lines(val, m), val), n, {"val": 0.0})
    return out.withColumnRenamed("val", value)


def _cut_cubic(cells: DataFrame, axis: str, n: int, m: int, piece: int) -> DataFrame:
    """``cubic_lines`` on pieces of the lines, each with the cells that its coefficients read."""
    s, halo = _scale(n, m), TAPS + 4
    outs = max(1, min(piece, int(piece / s))) if s else piece

    def window(k: int) -> tuple[int, int]:
        first, last = k * outs, min(m, (k + 1) * outs) - 1
        return max(0, math.floor(first * s) - halo), min(n, math.floor(last * s) + halo + 1)

    def kernel(k: int, val: np.ndarray) -> tuple[int, np.ndarray]:
        begin, end = k * outs, min(m, (k + 1) * outs)
        return begin, _nan_zero(cubic_lines(val, m, n, np.arange(begin, end), window(k)[0]), val)

    at, most = F.col(axis), -(-m // outs) - 1
    # a cell is sent a piece too far rather than not at all, and left out there
    low, high = (F.greatest(F.floor((at - halo - 1) / F.lit(s * outs)) - 1, F.lit(0)), F.least(F.floor((at + halo + 1) / F.lit(s * outs)), F.lit(most))) if s else (F.lit(0), F.lit(most))
    return cut_pass(cells.where(at.between(0, n - 1)).where(low <= high), axis, kernel, (low, high), window, {"val": 0.0})


def _nan_zero(lines: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Cells that are 0 but for rounding, by the largest value of their line, are not stored."""
    return np.where(np.abs(lines) > 1e-12 * np.abs(source).max(axis=1, keepdims=True), lines, np.nan)


def _nearest(voxels: DataFrame, shape, sizes) -> DataFrame:
    """Keep the cells some output cell rounds to; where cells get fewer, each serves at most one output cell per axis."""
    out, test, moved = voxels, F.lit(True), {}
    for a, n, m in zip(AXES, shape, sizes):
        if m > n:
            # the exact bounds are tested below
            low, high = (F.ceil((F.col(a) + h) / F.lit(_scale(n, m))) for h in (-0.5, 0.5)) if n > 1 else (F.lit(0), F.lit(m - 1))
            served = F.sequence(F.greatest(low - 1, F.lit(0)).cast("bigint"), F.least(high + 1, F.lit(m - 1)).cast("bigint"))
            out = out.withColumn(f"_{a}", F.explode(served))
            i = F.col(f"_{a}")
        else:
            i = F.ceil((F.col(a) - 0.5) / F.lit(_scale(n, m)))
        test = test & (i >= 0) & (i < m) & (F.floor(i * F.lit(_scale(n, m)) + 0.5) == F.col(a))
        moved[a] = i.cast("bigint")
    return out.where(test).withColumns(moved).select(*voxels.columns)


def _linear(voxels: DataFrame, shape, sizes, value: str) -> DataFrame:
    """Every output cell reads the (up to) eight stored cells around it, a cube of ``EDGE`` output cells at a time.

    A cell is sent to each cube that has an output cell less than one input cell away. No cube reads more than
    2 * EDGE planes of input per axis, whatever the factor.
    """
    scales = [_scale(n, m) for n, m in zip(shape, sizes)]
    spread = voxels.select(*AXES, F.col(value).cast("double").alias("_v"))
    for a, n, m, s in zip(AXES, shape, sizes, scales):
        # the margin is wider than the rounding; exact bounds are tested where cells are read
        low, high = (F.ceil((F.col(a) - 1) / F.lit(s) - 1e-6), F.floor((F.col(a) + 1) / F.lit(s) + 1e-6)) if n > 1 else (F.lit(0), F.lit(m - 1))
        low, high = F.greatest(low, F.lit(0)), F.least(high, F.lit(m - 1))
        blocks = F.sequence(F.floor(low / F.lit(EDGE)), F.floor(high / F.lit(EDGE)))
        spread = spread.where(low <= high).withColumn(f"_b{a}", F.explode(blocks))

    def run(table: pa.Table) -> pa.Table:
        outs, planes, at, weights, inside, code = [], [], [], [], np.ones(table.num_rows, bool), 0
        for a, m, s in zip(AXES, sizes, scales):
            first = table.column(f"_b{a}")[0].as_py() * EDGE
            out = np.arange(first, min(first + EDGE, m))
            base = np.floor(out * s).astype(np.int64)
            plane = np.unique(np.concatenate([base, base + 1]))
            own = table.column(a).to_numpy()
            place = np.minimum(np.searchsorted(plane, own), len(plane) - 1)
            inside &= plane[place] == own
            code = code * len(plane) + place
            outs.append(out)
            planes.append(len(plane))
            at.append([np.searchsorted(plane, base + k) for k in (0, 1)])
            weights.append([1 - np.abs(out * s - (base + k)) for k in (0, 1)])
        cells, code = int(np.prod(planes)), code[inside]
        values = np.bincount(code, table.column("_v").to_numpy()[inside], cells).reshape(planes)
        stored = (np.bincount(code, minlength=cells) > 0).reshape(planes)
        total, found = np.zeros([len(o) for o in outs]), np.zeros([len(o) for o in outs], bool)
        for corner in np.ndindex(2, 2, 2):
            weight = np.multiply.outer(np.multiply.outer(*[weights[i][corner[i]] for i in (0, 1)]), weights[2][corner[2]])
            read = np.ix_(*[at[i][corner[i]] for i in range(3)])
            use = stored[read] & (weight > 0)
            total += np.where(use, weight * values[read], 0.0)
            found |= use
        where = np.nonzero(found)
        return pa.table({**{a: o[w] for a, o, w in zip(AXES, outs, where)}, value: total[where]})

    return spread.groupBy(*[f"_b{a}" for a in AXES]).applyInArrow(run, f"z bigint, y bigint, x bigint, {value} double")


def _cubic(d: np.ndarray) -> np.ndarray:
    d = np.abs(d)
    return np.where(d < 1, (4 - 6 * d * d + 3 * d**3) / 6, np.where(d < 2, (2 - d) ** 3 / 6, 0.0))


def cubic_lines(lines: np.ndarray, m: int, n: int | None = None, outs: np.ndarray | None = None, first: int = 0) -> np.ndarray:
    """Resample each row to ``m`` cells by cubic B-spline interpolation with mirrored ends.

    Of a line of ``n`` cells, ``lines`` may be a part that begins at ``first`` and holds what the output cells ``outs`` read.
    """
    n = n or lines.shape[1]
    outs = np.arange(m) if outs is None else outs
    if n == 1:
        return np.repeat(lines, len(outs), axis=1)
    # mirrored at ends of the line; what lies beyond the part is not read
    padded = np.pad(lines, ((0, 0), (TAPS + 1, TAPS + 2)), mode="reflect")
    width = lines.shape[1] + 3  # coefficients for the positions -1 .. n + 1 of the part
    shares = ((k, 3**0.5 * POLE ** abs(k)) for k in range(-TAPS, TAPS + 1))
    coefficients = sum(w * padded[:, TAPS + k : TAPS + k + width] for k, w in shares)
    position = outs * _scale(n, m)
    base = np.floor(position).astype(int)
    return sum(_cubic(position - base - t) * coefficients[:, base - first + t + 1] for t in (-1, 0, 1, 2))
