"""Height fields of single objects in one block, as dense arrays: climbs, saddles, h-maxima and floods.

Cells are ranked by height; of equal cells the lower C-order number is the higher one. What a block can tell for certain
is settled here. A basin is open if one of its cells touches a cell of the object beyond the block, or if its climb ends
there; only open basins, and those whose fate hangs on them, are left to the graph over all blocks.
"""

from __future__ import annotations

import numpy as np

from .distance import DECIMALS, dense_squared
from .stencil import CONNECTIVITY, offsets

FIELD, MAXIMUM, PEAK, NODE, LINK, LEVEL_CELL, FAR = range(7)


def smoothed(dense: np.ndarray, begin: list[int], low: list[int], high: list[int], shape: tuple[int, int, int], weights: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Separable smoothing of ``dense``, whose first cell is ``begin``, for the cells from ``low`` up to ``high``.

    Edge cells of the volume are repeated outwards. Returns the values that something reached, and their first cell.
    """
    reach, begin = len(weights) // 2, list(begin)
    for axis, n in enumerate(shape):
        dense = np.moveaxis(dense, axis, 0)
        first, last = begin[axis], begin[axis] + len(dense)
        start, stop = max(first - reach, low[axis]), min(last + reach, high[axis])
        out = np.zeros((max(0, stop - start), *dense.shape[1:]))
        for t in range(-reach, reach + 1):
            a, b = max(first + t, start), min(last + t, stop)
            if a < b:
                out[a - start : b - start] += dense[a - t - first : b - t - first] * weights[reach + t]
        for side, there in ((0, first == 0), (n - 1, last == n)):
            for t in range(reach if there else 0):
                # what a target t cells from the border would have read beyond it
                if start <= abs(side - t) < stop:
                    out[abs(side - t) - start] += dense[0 if side == 0 and first == 0 else n - 1 - first] * weights[reach + t + 1 :].sum()
        dense, begin[axis] = np.moveaxis(out, 0, axis), start
    return dense, begin


def _around(rank: np.ndarray, connectivity: int) -> np.ndarray:
    """The highest rank of each cell and its neighbours."""

    def along(a: np.ndarray, axis: int) -> np.ndarray:
        out, a = a.copy(), np.moveaxis(a, axis, 0)
        view = np.moveaxis(out, axis, 0)
        np.maximum(view[1:], a[:-1], out=view[1:])
        np.maximum(view[:-1], a[1:], out=view[:-1])
        return out

    reach = CONNECTIVITY[connectivity]
    if reach == 3:
        return along(along(along(rank, 0), 1), 2)
    once = [along(rank, axis) for axis in range(3)]
    if reach == 2:
        once = [along(once[0], 1), along(once[0], 2), along(once[1], 2)]
    return np.maximum(np.maximum(once[0], once[1]), once[2])


def find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _descending(value: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """``cells``, which are in order, from the highest to the lowest; of equal ones the lower number first."""
    found = -value[cells]
    order = np.argsort(found)
    found = found[order]
    same = found[1:] == found[:-1]
    if same.any():
        group = np.cumsum(np.concatenate([[False], ~same]))
        tied = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]]))
        order[tied] = order[tied][np.lexsort((order[tied], group[tied]))]
    return cells[order]


class Relief:
    """Basins of one object in a box: ``value`` has -inf where no cell is, ``core`` tells the block's own cells.

    up     end of each cell's climb; a cell beyond the block ends at itself
    rim    own cells that touch cells beyond the block
    ends, a, b, saddle   ends of the climbs, and from the highest saddle down the best one of each pair of them, by rank
    """

    def __init__(self, value: np.ndarray, core: np.ndarray, connectivity: int):
        flat = value.ravel()
        cells = np.flatnonzero(flat > -np.inf).astype(np.int32)
        order = _descending(flat, cells)
        self.rank = np.zeros(flat.size, np.int32)
        self.rank[order] = np.arange(len(order), 0, -1, dtype=np.int32)
        self.at = np.concatenate([np.zeros(1, np.int32), order[::-1]])  # cell of each rank
        rank = self.rank.reshape(value.shape)
        mine = core & (rank > 0)
        self.own = mine.ravel()
        own = np.flatnonzero(self.own)
        self.up = up = np.arange(flat.size, dtype=np.int32)
        up[own] = self.at[_around(rank, connectivity).ravel()[own]]
        end = up[own]
        while True:
            further = up[end]
            if np.array_equal(further, end):
                break
            up[own] = end = further
        beyond = (rank > 0) & ~core
        self.rim = np.flatnonzero(self.own & (_around(beyond.view(np.int8), connectivity) > 0).ravel()) if beyond.any() else np.zeros(0, np.int64)
        # pairs of neighbours with different ends; of two blocks that see a pair, the owner of the later cell reports it
        end = np.where(rank > 0, up.reshape(value.shape), -1)
        pairs = []
        for step in offsets(connectivity, half=True):
            here = tuple(slice(max(0, -d), n - max(0, d)) for d, n in zip(step, value.shape))
            there = tuple(slice(max(0, d), n - max(0, -d)) for d, n in zip(step, value.shape))
            a, b = end[here], end[there]
            found = np.flatnonzero((a != b) & (a >= 0) & mine[there])
            if len(found):
                pairs.append((a.ravel()[found], b.ravel()[found], np.minimum(rank[here], rank[there]).ravel()[found]))
        a, b, saddle = (np.concatenate(p) for p in zip(*pairs)) if pairs else [np.zeros(0, np.int32)] * 3
        # the highest saddle of each pair of ends
        a, b = np.minimum(a, b).astype(np.int64), np.maximum(a, b)
        pair, row = np.unique(a * flat.size + b, return_inverse=True)
        top = np.zeros(len(pair), np.int32)
        np.maximum.at(top, row, saddle)
        order = np.argsort(-top, kind="stable")
        a, b, saddle = pair[order] // flat.size, pair[order] % flat.size, top[order]
        self.ends = np.unique(np.concatenate([up[own], a, b]))
        self.a, self.b, self.saddle = np.searchsorted(self.ends, a), np.searchsorted(self.ends, b), saddle
        # by position in ends
        self.open = ~self.own[self.ends]
        self.open[np.searchsorted(self.ends, up[self.rim])] = True


def settle(height: list[float], is_open: list[bool], pairs: list[tuple[int, int, float, int]], h: float) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Fates of peaks, as far as one block knows them, and the saddles that the others need.

    ``pairs`` are (end, end, saddle, its rank) from the highest down. A group of ends without an open one knows all of
    its saddles, so where it meets a higher group first decides whether its peaks are h-maxima. It then is part of the
    end that it met: what leads on from it does so over lower saddles. An open group may belong to a higher peak than
    is seen, so what is higher than it, or as high, stays undecided. Of the saddles between groups that are not joined
    yet, all are kept that two undecided groups meet at; others close a circle of higher ones.

    Returns for each end 0 (undecided), 1 (an h-maximum) or 2 (swallowed), and the kept saddles (end, end, rank).
    """
    n = len(height)
    parent, part_of, fate, top, kept = list(range(n)), list(range(n)), [0] * n, list(height), []
    is_open, tops = list(is_open), [[i] for i in range(n)]
    for i, j, saddle, rank in pairs:
        low, high, met = find(parent, i), find(parent, j), j
        if low == high:
            continue
        if top[low] > top[high]:
            low, high, met = high, low, i
        if top[low] < top[high] and not is_open[low]:
            for peak in tops[low]:
                fate[peak], part_of[peak] = 2 if saddle > top[low] - h else 1, met
        else:
            kept.append((i, j, rank))
            is_open[high] = is_open[high] or is_open[low]
            if top[low] == top[high]:
                tops[high] += tops[low]
        parent[low] = high
    for i in range(n):
        if parent[i] == i and not is_open[i]:
            for peak in tops[i]:
                fate[peak], part_of[peak] = 1, i
    ends = [(find(part_of, i), find(part_of, j), rank) for i, j, rank in kept]
    return fate, [e for e in ends if e[0] != e[1]]


def _by_label(label: np.ndarray) -> list[tuple[int, int]]:
    """Runs of equal values."""
    if not len(label):
        return []
    cuts = (np.flatnonzero(label[1:] != label[:-1]) + 1).tolist()
    return [*zip([0, *cuts], [*cuts, len(label)])]


def _core(begin: list[int], size: tuple[int, ...], low: list[int], high: list[int]) -> np.ndarray:
    inside = [(np.arange(b, b + n) >= lo) & (np.arange(b, b + n) < hi) for b, n, lo, hi in zip(begin, size, low, high)]
    return inside[0][:, None, None] & inside[1][None, :, None] & inside[2][None, None, :]


class Rows:
    """Columns ``kind, label, a, b, val, at`` that grow by arrays."""

    def __init__(self):
        self.parts = []

    def add(self, kind: int, label: int, a: np.ndarray, b: np.ndarray, val: np.ndarray, at: np.ndarray) -> None:
        if len(a):
            self.parts.append((np.full(len(a), kind, np.int8), np.full(len(a), label, np.int64), a, b, val, at))

    def columns(self) -> dict[str, np.ndarray]:
        names = dict(kind=np.int8, label=np.int64, a=np.int64, b=np.int64, val=np.float64, at=np.int64)
        return {n: np.concatenate([p[k] for p in self.parts]) if self.parts else np.zeros(0, t) for k, (n, t) in enumerate(names.items())}


MAXIMA = "kind tinyint, label bigint, a bigint, b bigint, val double, at bigint"


def maxima(
    label: np.ndarray, coords: list[np.ndarray], value: np.ndarray, low: list[int], high: list[int], shape: tuple[int, int, int],
    weights: np.ndarray | None, h: float,
) -> dict[str, np.ndarray]:
    """h-maxima of the objects in the block from ``low`` up to ``high``, whose rows are in order of label.

    With ``weights`` the values are smoothed first, and FIELD rows have the smoothed values of the own cells; the rows reach as
    far beyond the block as the weights and one cell more. Without, the values are the heights, and reach one cell beyond it.

    MAXIMUM  cells ``a`` of h-maxima, ``val`` their height
    PEAK     undecided peak ``a``, ``val`` its height
    NODE     cell ``a`` that another block may see, and the end ``b`` of its climb
    LINK     saddle ``val`` at the cell ``at`` between ``a`` and ``b``
    LEVEL_CELL  cell ``a`` as high as the end ``b`` of its climb, which is not decided here
    """
    out = Rows()
    least, most = [max(0, x - 1) for x in low], [min(n, x + 1) for x, n in zip(high, shape)]
    for i, j in _by_label(label):
        cells, name = [c[i:j] for c in coords], int(label[i])
        begin = [int(c.min()) for c in cells]
        dense = np.full([int(c.max()) - b + 1 for c, b in zip(cells, begin)], -np.inf if weights is None else 0.0)
        dense[tuple(c - b for c, b in zip(cells, begin))] = value[i:j]
        if weights is not None:
            dense, begin = smoothed(dense, begin, least, most, shape, weights)
            dense = np.where(dense > 0, np.round(dense, DECIMALS), -np.inf)
        if not dense.size:
            continue
        core = _core(begin, dense.shape, low, high)

        def number(at: np.ndarray, begin=begin, size=dense.shape) -> np.ndarray:
            z, y, x = np.unravel_index(at, size)
            return ((z + begin[0]) * shape[1] + y + begin[1]) * shape[2] + x + begin[2]

        flat = dense.ravel()
        if weights is not None:
            own = np.ones(j - i, bool)
            for c, lo, hi in zip(cells, low, high):
                own &= (c >= lo) & (c < hi)
            at = np.ravel_multi_index([c[own] - b for c, b in zip(cells, begin)], dense.shape)
            there = number(at)
            out.add(FIELD, name, there, there, flat[at], there)
        relief = Relief(dense, core, 26)
        if not relief.own.any():
            continue
        ends = relief.ends
        height, peaks, saddles = flat[ends], number(ends), number(relief.at[relief.saddle])
        pairs = [*zip(relief.a.tolist(), relief.b.tolist(), flat[relief.at[relief.saddle]].tolist(), range(len(relief.a)))]
        fate, links = settle(height.tolist(), relief.open.tolist(), pairs, h)
        fate, mine = np.array(fate), relief.own[ends]
        level = np.flatnonzero(relief.own & (flat == flat[relief.up]))
        end = np.searchsorted(ends, relief.up[level])
        top = (fate[end] == 1) & (flat[level] >= h)
        out.add(MAXIMUM, name, number(level[top]), peaks[end[top]], flat[level[top]], peaks[end[top]])
        left = fate[end] == 0
        out.add(LEVEL_CELL, name, number(level[left]), peaks[end[left]], flat[level[left]], peaks[end[left]])
        undecided = (fate == 0) & mine
        out.add(PEAK, name, peaks[undecided], peaks[undecided], height[undecided], peaks[undecided])
        rim = number(relief.rim)
        out.add(NODE, name, rim, number(relief.up[relief.rim]), flat[relief.rim], rim)
        if links:
            a, b, k = np.array(links).T
            out.add(LINK, name, peaks[a], peaks[b], flat[relief.at[relief.saddle[k]]], saddles[k])
    return out.columns()


def voxel_maxima(
    label: np.ndarray, coords: list[np.ndarray], low: list[int], high: list[int], shape: tuple[int, int, int], weights: np.ndarray, h: float, halo: int
) -> dict[str, np.ndarray]:
    """``maxima`` of the smoothed distances of voxels, which reach ``halo`` cells further along the first axis and go whole along the others.

    A FAR row says that a distance may reach beyond those voxels.
    """
    reach = len(weights) // 2 + 1
    first, last = max(0, low[0] - reach - halo), min(shape[0], high[0] + reach + halo)
    inside = (coords[0] >= first) & (coords[0] < last) & (label != 0)
    for c, n in zip(coords[1:], shape[1:]):
        inside &= (c >= 0) & (c < n)
    label, (z, y, x) = label[inside], [c[inside] for c in coords]
    if not len(label):
        return Rows().columns()
    dense = np.zeros((last - first, *shape[1:]), np.int64)
    dense[z - first, y, x] = label
    squared = dense_squared(dense)[z - first, y, x]
    used = (z >= low[0] - reach) & (z < high[0] + reach)
    out = maxima(label[used], [c[used] for c in (z, y, x)], np.sqrt(squared[used]), low, high, shape, weights, h)
    if (first > 0 or last < shape[0]) and (squared[used] > (halo + 1) ** 2).any():
        out = {n: np.concatenate([c, [FAR if n == "kind" else 0]]).astype(c.dtype) for n, c in out.items()}
    return out


FLOODED = "label bigint, cell bigint, region bigint, rest boolean, z bigint, y bigint, x bigint, val double"


def flooded(
    label: np.ndarray, coords: list[np.ndarray], value: np.ndarray, marker: np.ndarray, told: np.ndarray, low: list[int], high: list[int], plane: tuple[int, int]
) -> dict[str, np.ndarray]:
    """Regions of the components that lie wholly in the block, flooded from their markers over faces of cells.

    Rows are in order of label; where ``told`` is set they name the marker of a cell, else its height. Own cells of other
    components come back without a region, with their coordinates and heights.
    """
    parts = []
    for i, j in _by_label(label):
        is_cell = ~told[i:j]
        if not is_cell.any():
            continue
        cells = [c[i:j][is_cell] for c in coords]
        begin = [int(c.min()) for c in cells]
        size = [int(c.max()) - b + 1 for c, b in zip(cells, begin)]
        dense = np.full(size, -np.inf)
        dense[tuple(c - b for c, b in zip(cells, begin))] = value[i:j][is_cell]
        relief = Relief(dense, _core(begin, dense.shape, low, high), 6)
        if not relief.own.any():
            continue
        flat, ends, rank, n = dense.ravel(), relief.ends, relief.rank, len(relief.ends)
        marked = np.full(flat.size, -1, np.int64)  # row of the marker of a cell
        rows = np.flatnonzero(told[i:j]) + i
        place = [c[rows] - b for c, b in zip(coords, begin)]
        inside = np.logical_and.reduce([(p >= 0) & (p < s) for p, s in zip(place, size)])
        marked[np.ravel_multi_index([p[inside] for p in place], size)] = rows[inside]
        marked[rank == 0] = -1
        wet = np.flatnonzero(relief.own & (marked >= 0))
        # a marker is a node of its own, joined to the basin it lies in at its height
        door = np.zeros(n, np.int64)
        np.maximum.at(door, np.searchsorted(ends, relief.up[wet]), rank[wet])
        level, is_open = _levels(relief, door)
        own = np.flatnonzero(relief.own)
        end = np.searchsorted(ends, relief.up[own])
        # the lowest cell of the best path from a marker, by rank; 0 where there is none
        entry = np.zeros(flat.size, np.int64)
        entry[own] = np.where(is_open[end], 0, np.minimum(rank[own], level[end]))
        to = np.arange(flat.size)
        later = np.flatnonzero((entry > 0) & (entry < rank))
        to[later] = relief.at[entry[later]]
        first = np.flatnonzero((entry > 0) & (entry == rank) & (marked < 0))
        if len(first):
            # among its neighbours only: their highest entry, which is another cell
            padded = np.zeros([s + 2 for s in size], np.int64)
            padded[1:-1, 1:-1, 1:-1] = entry.reshape(size)
            at = np.ravel_multi_index([c + 1 for c in np.unravel_index(first, size)], padded.shape)
            lines = padded.ravel()
            steps = [int(np.dot(s, (padded.shape[1] * padded.shape[2], padded.shape[2], 1))) for s in offsets(6)]
            best = np.max([lines[at + s] for s in steps], axis=0)
            to[first] = np.where(best > 0, relief.at[best], first)
        while True:
            further = to[to]
            if np.array_equal(further, to):
                break
            to = further
        root = marked[to[own]]
        done = (entry[own] > 0) & (root >= 0)
        rest = is_open[end]
        keep = done | rest
        z, y, x = (c + b for c, b in zip(np.unravel_index(own[keep], size), begin))
        parts.append((np.full(keep.sum(), label[i], np.int64), (z * plane[0] + y) * plane[1] + x, np.where(done, marker[root], 0)[keep], rest[keep], z, y, x, flat[own[keep]]))
    names = dict(label=np.int64, cell=np.int64, region=np.int64, rest=bool, z=np.int64, y=np.int64, x=np.int64, val=np.float64)
    return {name: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, t) for k, (name, t) in enumerate(names.items())}


def _levels(relief: Relief, door: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each end: rank of the saddle or marker over which a flood first enters its basin (0: none), and if its component is open."""
    n = len(relief.ends)
    steps = [(int(r), 0, k, -1) for k, r in enumerate(door) if r]
    steps += [(int(r), 1, i, j) for r, i, j in zip(relief.saddle.tolist(), relief.a.tolist(), relief.b.tolist())]
    parent, members, level, wet = list(range(n)), [[k] for k in range(n)], [0] * n, [False] * n
    for rank, _, i, j in sorted(steps, key=lambda s: (-s[0], s[1])):
        i = find(parent, i)
        if j < 0:
            if not wet[i]:
                for k in members[i]:
                    level[k] = rank
                wet[i] = True
            continue
        j = find(parent, j)
        if i == j:
            continue
        if wet[i] != wet[j]:
            for k in members[j if wet[i] else i]:
                level[k] = rank
        if len(members[i]) < len(members[j]):
            i, j = j, i
        members[i] += members[j]
        parent[j], members[j], wet[i] = i, [], wet[i] or wet[j]
    is_open = np.zeros(n, bool)
    root = np.array([find(parent, k) for k in range(n)], np.int64)
    is_open[root[relief.open]] = True
    return np.array(level, np.int64), is_open[root]
