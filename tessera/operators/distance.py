"""Distance to the background and Gaussian smoothing, per object."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .stencil import AXES, EDGE, PIECE, Cells, cut_pass, line_pass, per_block

TRUNCATE = 4.0  # kernel radius in standard deviations
DECIMALS = 9  # smoothed values are rounded, so that equal heights compare as equal


def _envelopes(squared: np.ndarray, change: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower envelopes of the parabolas ``squared[q] + (p - q) ** 2`` over each run of a line.

    ``change`` marks where a run begins, ``part`` the cells that add a parabola. The envelope of a run that begins at
    ``s`` fills the slots ``s, s + 1, ...`` of its line: returns which slots are filled, the parabola's position in each,
    and where it begins to be the lowest. Every cell is pushed and popped at most once.
    """
    lines, n = squared.shape
    filled, vertex, since = np.zeros((lines, n), bool), np.zeros((lines, n), np.int64), np.full((lines, n), -np.inf)
    base, top = np.zeros(lines, np.int64), np.full(lines, -1)  # of the run that each line is in
    for q in range(n):
        new = change[:, q]
        base[new], top[new] = q, q - 1
        todo = np.flatnonzero(part[:, q])
        while len(todo):
            rows = todo[top[todo] >= base[todo]]
            v = vertex[rows, top[rows]]
            meet = (squared[rows, q] + q * q - squared[rows, v] - v * v) / (2.0 * (q - v))
            hidden = meet <= since[rows, top[rows]]
            below = rows[~hidden]
            first = todo[top[todo] < base[todo]]
            for ready, begin in ((first, -np.inf), (below, meet[~hidden])):
                top[ready] += 1
                vertex[ready, top[ready]], since[ready, top[ready]], filled[ready, top[ready]] = q, begin, True
            todo = rows[hidden]
            filled[todo, top[todo]] = False
            top[todo] -= 1
    return filled, vertex, since


def nearest_along(labels: np.ndarray, squared: np.ndarray) -> np.ndarray:
    """One axis of a separable squared distance transform, per run of equal labels, in linear time.

    ``squared`` holds what the axes done so far gave (inf at first). A cell of another
    label is at distance 0 of itself, so nothing beyond the ends of the own run can
    be nearer than those ends; the ends of the line itself are no background.
    """
    n = labels.shape[1]
    at = np.arange(n)
    change = np.ones(labels.shape, bool)
    change[:, 1:] = labels[:, 1:] != labels[:, :-1]
    start = np.maximum.accumulate(np.where(change, at, 0), axis=1)
    last = np.ones(labels.shape, bool)
    last[:, :-1] = change[:, 1:]
    end = np.minimum.accumulate(np.where(last, at, n)[:, ::-1], axis=1)[:, ::-1]
    low = np.where(start > 0, at - start + 1.0, np.inf)
    high = np.where(end < n - 1, end - at + 1.0, np.inf)
    best = np.minimum(squared, np.minimum(low, high) ** 2)
    stored = labels != 0
    part = stored & np.isfinite(squared)
    if part.any():
        filled, vertex, since = _envelopes(squared, change, part)
        # slots in order of line, run and place; each cell takes the last one of its run that begins before it
        run = np.cumsum(change.ravel()).reshape(change.shape) * (n + 2.0)
        slot_line, slot = np.nonzero(filled)
        begin = run[slot_line, slot] + np.clip(since[slot_line, slot], -1, n)
        line, cell = np.nonzero(stored)
        found = np.searchsorted(begin, run[line, cell] + cell, side="right") - 1
        own = found >= 0
        own[own] = run[slot_line[found[own]], slot[found[own]]] == run[line[own], cell[own]]
        line, cell, source = line[own], cell[own], vertex[slot_line, slot][found[own]]
        best[line, cell] = np.minimum(best[line, cell], squared[line, source] + (cell - source) ** 2.0)
    return np.where(stored, best, np.nan)


def dense_squared(labels: np.ndarray) -> np.ndarray:
    """Squared distance of each cell with a label to the nearest cell with another one; inf where a cell has none."""
    squared = np.full(labels.shape, np.inf)
    for axis in (2, 1, 0):
        lines = np.ascontiguousarray(np.moveaxis(labels, axis, -1))
        found = nearest_along(lines.reshape(-1, lines.shape[-1]), np.moveaxis(squared, axis, -1).reshape(-1, lines.shape[-1]))
        squared = np.moveaxis(np.where(np.isnan(found), np.inf, found).reshape(lines.shape), -1, axis)
    return squared


def _cut_nearest(cells: DataFrame, axis: str, length: int, label: str, piece: int, halo: int) -> DataFrame:
    """``nearest_along`` on pieces of the lines that see ``halo`` cells more on either side.

    What lies beyond is more than ``halo`` cells away, so a distance up to ``halo + 1`` is right. Lines with a cell that
    found none so near are done again as a whole.
    """

    def window(k: int) -> tuple[int, int]:
        return max(0, k * piece - halo), min(length, (k + 1) * piece + halo)

    def kernel(k: int, labels: np.ndarray, squared: np.ndarray) -> tuple[int, np.ndarray]:
        begin, end = k * piece, min(length, (k + 1) * piece)
        low = window(k)[0]
        return begin, nearest_along(labels, squared)[:, begin - low : end - low]

    at, most = F.col(axis), -(-length // piece) - 1
    pieces = (F.greatest(F.floor((at - halo) / F.lit(piece)), F.lit(0)), F.least(F.floor((at + halo) / F.lit(piece)), F.lit(most)))
    fill = {label: 0, "val": np.inf}
    near = materialize(cut_pass(cells, axis, kernel, pieces, window, fill, carry=label))
    lines = [a for a in AXES if a != axis]
    far = materialize(near.where(F.col("val") > float((halo + 1) ** 2)).select(*lines).distinct())
    if far.isEmpty():
        return near
    again = line_pass(cells.join(far, lines, "left_semi").select(*cells.columns), axis, nearest_along, length, fill, carry=label)
    return near.join(far, lines, "left_anti").select(*near.columns).unionByName(again)


def squared_distance(voxels: DataFrame, shape: tuple[int, int, int], label: str = "seg_id", piece: int = PIECE, halo: int = EDGE) -> DataFrame:
    """``(z, y, x, label, val)``: squared distance to the nearest cell of the volume with another label."""
    out = voxels.select(*AXES, F.col(label).cast("bigint").alias(label), F.lit(float("inf")).alias("val"))
    # long axes last: what the others found shortens the reach along them
    for axis, n in sorted(reversed(list(zip(AXES, shape))), key=lambda part: part[1] > 4 * piece):
        if n > 4 * piece:
            out = _cut_nearest(out, axis, n, label, piece, halo)
        else:
            out = line_pass(out, axis, nearest_along, n, {label: 0, "val": np.inf}, carry=label)
    return out


def gaussian_weights(sigma: float) -> np.ndarray:
    reach = int(TRUNCATE * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return weights / weights.sum()


def smooth(distances: DataFrame, shape: tuple[int, int, int], sigma: float, label: str = "seg_id", edge: int = EDGE) -> DataFrame:
    """Gaussian smoothing of each object's distances, edge cells of the volume repeated outwards.

    Returns ``(z, y, x, label, val, inside)``; the result reaches beyond the object by the
    kernel radius, where ``inside`` is false.
    """
    if not sigma:
        return distances.select(*AXES, label, F.round("val", DECIMALS).alias("val"), F.lit(True).alias("inside"))
    weights = gaussian_weights(sigma)
    reach = len(weights) // 2

    def spread(at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(source row, target position, weight) along one axis of extent n."""
        rows = np.arange(len(at))
        parts = [(rows, at + t, np.full(len(at), weights[reach + t])) for t in range(-reach, reach + 1)]
        for side, border in ((0, rows[at == 0]), (n - 1, rows[at == n - 1])):
            for t in range(reach):
                # what a target t cells from the border would have read beyond it
                share = weights[reach + t + 1 :].sum()
                parts.append((border, np.full(len(border), abs(side - t)), np.full(len(border), share)))
        source, target, share = (np.concatenate(p) for p in zip(*parts))
        keep = (target >= 0) & (target < n)
        return source[keep], target[keep], share[keep]

    def kernel(cells: Cells) -> dict:
        labels, rank = np.unique(cells.columns[label], return_inverse=True)
        coords, value = list(cells.coords), cells.columns["val"]
        own = rank * cells.width**3 + cells.pack(cells.local)
        for axis in range(3):
            source, target, share = spread(coords[axis], shape[axis])
            first = cells.block[axis] * edge
            core = (target >= first) & (target < first + edge)
            source, target, share = source[core], target[core], share[core]
            moved = [c[source] for c in coords]
            moved[axis] = target
            local = [c - b * edge + cells.pad for c, b in zip(moved, cells.block)]
            code = rank[source] * cells.width**3 + cells.pack(local)
            code, first_row, row = np.unique(code, return_index=True, return_inverse=True)
            value = np.bincount(row, value[source] * share, len(code)).astype(float)
            coords, rank = [c[first_row] for c in moved], rank[source][first_row]
        out = {a: c for a, c in zip(AXES, coords)}
        return {**out, label: labels[rank], "val": np.round(value, DECIMALS), "inside": np.isin(code, own)}

    schema = f"z bigint, y bigint, x bigint, {label} bigint, val double, inside boolean"
    return per_block(distances, kernel, schema, [label, "val"], halo=reach, edge=edge)
