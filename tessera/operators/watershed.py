"""Splitting objects by watershed, distributed over blocks of space.

Heights are smoothed distances to the background. Every cell climbs to its steepest
neighbour; inside a block that is an array operation, and the few paths that leave a
block are joined up by pointer jumping. The basins of the local maxima and the
saddles between them form a graph much smaller than the volume, on which the choice of
markers (h-maxima) and the level at which a flood first enters each basin are merges
along best edges. A cell is entered at its own height or at its basin's level, whichever
is lower, and takes the region of its neighbour that was entered first. No step gathers
an object in one task.

Heights are made distinct by the C-order cell number: of equal cells the lower number
is the higher one. The flood is then that of a priority queue, cell by cell.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import count_metric, materialize
from . import heights
from .distance import gaussian_weights, squared_distance
from .heights import find
from .keyed import lookup_join, with_index
from .morphology import _linear, max_label, object_sizes, voxel_components
from .shape import elongation, elongation_gate
from .stencil import AXES, EDGE, GROUP_CELLS, PIECE, Cells, box_of, offsets, per_block, per_box


class Basins:
    """Catchment basins of a height field.

    cells  (label, cell, to, val)  every cell and the block-local end of its climb
    nodes  (label, node, peak)     ends of local climbs -> local maximum
    peaks  (label, peak, val)
    edges  (label, a, b, saddle, at)  best saddle between two basins, a < b, and its cell
    """

    def __init__(self, field: DataFrame, plane: tuple[int, int], connectivity: int, edge: int = EDGE):
        half = offsets(connectivity, half=True)

        def kernel(cells: Cells) -> dict:
            value, name = cells.columns["val"], _linear(cells.coords, plane)
            up, best = np.arange(len(cells)), value.copy()
            pairs = []
            for step in half:
                at = cells.neighbour(step)
                here = np.flatnonzero(at >= 0)
                pairs.append((here, at[here]))
                for u, v in ((here, at[here]), (at[here], here)):
                    better = (value[v] > best[u]) | ((value[v] == best[u]) & (name[v] < name[up[u]]))
                    up[u[better]], best[u[better]] = v[better], value[v[better]]
            up[~cells.core] = np.flatnonzero(~cells.core)
            while True:
                further = up[up]
                if np.array_equal(further, up):
                    break
                up = further
            u, v = (np.concatenate(p) for p in zip(*pairs))
            # of two blocks that see a pair, the owner of the later cell reports it
            later = np.where(name[u] > name[v], u, v)
            keep = cells.core[later] & (up[u] != up[v])
            u, v = u[keep], v[keep]
            ends = np.sort(np.stack([up[u], up[v]], axis=1), axis=1)
            ends, row = np.unique(ends, axis=0, return_inverse=True)
            # a pair is as high as its lower cell; the highest pair is the saddle
            lower = np.where((value[u] < value[v]) | ((value[u] == value[v]) & (name[u] > name[v])), u, v)
            order = np.lexsort((name[lower], -value[lower], row.ravel()))
            top = lower[order[np.searchsorted(row.ravel()[order], np.arange(len(ends)))]]
            own = np.flatnonzero(cells.core)
            rim = np.zeros(len(cells), bool)
            for c in cells.local:
                rim |= (c == cells.pad) | (c == cells.pad + edge - 1)
            a = np.concatenate([own, ends[:, 0]])
            b = np.concatenate([up[own], ends[:, 1]])
            return {
                "cell": np.concatenate([np.ones(len(own), bool), np.zeros(len(ends), bool)]),
                "label": cells.columns["label"][a],
                "a": name[a],
                "b": name[b],
                "val": np.concatenate([value[own], value[top]]),
                "at": np.concatenate([name[own], name[top]]),
                # only rim cells and maxima can be the end of another block's climb
                "end": np.concatenate([rim[own] | (up[own] == own), np.zeros(len(ends), bool)]),
            }

        schema = "cell boolean, label bigint, a bigint, b bigint, val double, at bigint, end boolean"
        rows = materialize(per_block(field, kernel, schema, ["label", "val"], halo=1, edge=edge, layer="label"))
        self.cells = rows.where("cell").select("label", F.col("a").alias("cell"), F.col("b").alias("to"), "val")
        self.peaks = rows.where("cell and a = b").select("label", F.col("a").alias("peak"), "val")
        ends = rows.where("cell and end").select("label", F.col("a").alias("node"), F.col("b").alias("peak"))
        self.nodes = follow(ends, "node", "peak")
        links = rows.where("not cell").select("label", "a", "b", F.col("val").alias("saddle"), "at")
        self.edges = materialize(relink(links, self.nodes, "node", "peak"))


def follow(table: DataFrame, key: str, to: str, doublings: int = 3) -> DataFrame:
    """Pointer jumping: replace each ``to`` by the end of its chain within the label."""
    while True:
        step = table.select("label", key, to)
        for _ in range(doublings):
            nxt = step.select("label", F.col(key).alias(to), F.col(to).alias("_next"))
            joined = step.select("label", key, to).join(nxt, ["label", to], "left")
            moved = F.coalesce("_next", to)
            step = joined.select("label", key, moved.alias(to), (moved != F.col(to)).alias("_moved"))
        table, seen = materialize(step, F.coalesce(F.count_if("_moved"), F.lit(0)).alias("n"))
        table = table.drop("_moved")
        if not seen["n"]:
            return table


def relink(edges: DataFrame, mapping: DataFrame, key: str, to: str) -> DataFrame:
    """Move both ends of the edges along the mapping; keep the best edge per pair.

    Edges that know their first ends ``a0, b0`` keep them and are ranked by them where saddles are equal.
    """
    out = edges
    for end in ("a", "b"):
        side = mapping.select("label", F.col(key).alias(end), F.col(to).alias("_to"))
        out = out.join(side, ["label", end], "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
    first = [c for c in ("a0", "b0") if c in edges.columns]
    pair = out.where("a <> b").select("label", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "saddle", "at", *first)
    best = F.struct("saddle", *[(-F.col(c)).alias(c) for c in ("at", *first)])
    kept = pair.groupBy("label", "a", "b").agg(F.max(best).alias("_e"))
    return kept.select("label", "a", "b", F.col("_e.saddle").alias("saddle"), *[(-F.col(f"_e.{c}")).alias(c) for c in ("at", *first)])


def _best_edges(edges: DataFrame) -> DataFrame:
    """Each basin's best edge, in one total order over all edges: ``(label, a, b, saddle, at)``."""
    both = edges.unionByName(edges.select("label", F.col("b").alias("a"), F.col("a").alias("b"), "saddle", "at", "a0", "b0"))
    # the first ends tell edges apart, whatever their ends have been merged into
    rank = F.struct("saddle", *[(-F.col(c)).alias(c) for c in ("at", "a0", "b0")], "b")
    best = both.groupBy("label", "a").agg(F.max(rank).alias("_best"))
    return best.select("label", "a", F.col("_best.b").alias("b"), F.col("_best.saddle").alias("saddle"), (-F.col("_best.at")).alias("at"))


def _merge_rounds(edges: DataFrame, choose: Callable[[DataFrame], DataFrame]) -> list[DataFrame]:
    """Merge along best edges until ``choose`` accepts none; returns each round's merges.

    ``choose`` picks rows ``(label, a, b, ...)`` of the best edges: basin a joins b.
    """
    rounds = []
    edges = edges.select("label", "a", "b", "saddle", "at", F.col("a").alias("a0"), F.col("b").alias("b0"))
    while True:
        merges, seen = materialize(choose(_best_edges(edges)), count_metric())
        if not seen["n"]:
            return rounds
        ends = follow(merges.select("label", F.col("a").alias("node"), F.col("b").alias("peak")), "node", "peak")
        rounds.append(merges.join(ends.select("label", F.col("node").alias("a"), F.col("peak").alias("root")), ["label", "a"]))
        edges = materialize(relink(edges, ends, "node", "peak"))


# Objects with at most this many saddles are merged inside one task each; objects
# beyond it, however large, by the distributed rounds. Both give the same result.
TASK_SADDLES = 1 << 16


def _by_size(edges: DataFrame, task_saddles: int) -> tuple[DataFrame, DataFrame | None]:
    """Edges of objects with few saddles, and those of all others (None if there are none)."""
    counts, seen = materialize(
        edges.groupBy("label").agg(F.count(F.lit(1)).alias("n")), F.coalesce(F.max("n"), F.lit(0)).alias("most")
    )
    if seen["most"] <= task_saddles:
        return edges, None
    large = counts.where(F.col("n") > task_saddles)
    split = lookup_join(edges, large, "label", weight="n")
    return split.where("n is null").drop("n"), split.where("n is not null").drop("n")


def _descending(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Nodes, and edges from the highest saddle to the lowest: both ends as node positions, saddle and its cell."""
    a, b, saddle, at = (table.column(c).to_numpy() for c in ("a", "b", "saddle", "at"))
    order = np.lexsort((b, a, at, -saddle))
    nodes, ends = np.unique(np.concatenate([a[order], b[order]]), return_inverse=True)
    return nodes, ends[: len(a)], ends[len(a) :], saddle[order], at[order]


def _peak_heights(basins: Basins) -> dict[str, DataFrame]:
    return {end: basins.peaks.select("label", F.col("peak").alias(end), F.col("val").alias(f"_{end}")) for end in "ab"}


def _swallowed_in_task(edges: DataFrame, basins: Basins, h: float) -> DataFrame:
    """``(label, peak)`` of the peaks that are no h-maxima, one object per call."""
    ends = _peak_heights(basins)

    def kernel(table: pa.Table) -> pa.Table:
        nodes, u, v, saddle, _ = _descending(table)
        height = np.empty(len(nodes))
        for end in "ab":
            height[np.searchsorted(nodes, table.column(end).to_numpy())] = table.column(f"_{end}").to_numpy()
        parent, tops, gone = list(range(len(nodes))), [[i] for i in range(len(nodes))], []
        for i, j, s in zip(u.tolist(), v.tolist(), saddle.tolist()):
            i, j = find(parent, i), find(parent, j)
            if i == j:
                continue
            if height[tops[i][0]] < height[tops[j][0]]:
                i, j = j, i
            low = height[tops[j][0]]
            if height[tops[i][0]] == low:
                tops[i] += tops[j]
            elif s > low - h:
                gone += tops[j]
            parent[j] = i
        label = table.column("label")[0].as_py()
        return pa.table({"label": np.full(len(gone), label, np.int64), "peak": nodes[np.array(gone, int)]})

    joined = edges.join(ends["a"], ["label", "a"]).join(ends["b"], ["label", "b"])
    return joined.groupBy("label").applyInArrow(kernel, "label bigint, peak bigint")


def _swallowed_in_rounds(edges: DataFrame, basins: Basins, h: float) -> DataFrame:
    """The same by rounds of distributed merges, for objects of any size."""
    ends = _peak_heights(basins)

    def choose(best: DataFrame) -> DataFrame:
        joined = best.join(ends["a"], ["label", "a"]).join(ends["b"], ["label", "b"])
        higher = (F.col("_b") > F.col("_a")) | ((F.col("_b") == F.col("_a")) & (F.col("b") < F.col("a")))
        near = F.col("saddle") > F.col("_a") - F.lit(h)
        return joined.where(higher & near).select("label", "a", "b", (F.col("_b") > F.col("_a")).alias("strict"))

    merged = basins.peaks.select("label", F.col("peak").alias("a"), F.col("peak").alias("b"), F.lit(False).alias("strict")).limit(0)
    for more in _merge_rounds(edges, choose):
        merged = merged.unionByName(more.select("label", "a", "b", "strict"))
    merged = materialize(merged)
    known = frontier = merged.where("strict").select("label", F.col("a").alias("peak"))
    # equal peaks hang in chains; one falls if the peak it hangs on falls
    equal = merged.where("not strict")
    found = not equal.isEmpty()
    while found:
        on = frontier.select("label", F.col("peak").alias("b"))
        frontier, seen = materialize(equal.join(on, ["label", "b"]).select("label", F.col("a").alias("peak")), count_metric())
        known, found = known.unionByName(frontier), seen["n"]
    return known


def h_maxima(basins: Basins, h: float, task_saddles: int = TASK_SADDLES) -> DataFrame:
    """Peaks ``(label, peak, val)`` from which every path to a higher one descends by ``h``.

    Taken from the highest saddle down, a basin is swallowed where it meets a higher
    one less than ``h`` below its own peak. Peaks of equal height share one fate.
    """
    small, large = _by_size(basins.edges, task_saddles)
    swallowed = _swallowed_in_task(small, basins, h)
    if large is not None:
        swallowed = swallowed.unionByName(_swallowed_in_rounds(materialize(large), basins, h))
    return basins.peaks.where(F.col("val") >= h).join(swallowed, ["label", "peak"], "left_anti")


def _levels_in_task(edges: DataFrame, marked: DataFrame) -> DataFrame:
    """``(label, peak, saddle, at)``: the saddle over which a flood first enters each basin, one object per call."""
    flags = {end: marked.select("label", F.col("a").alias(end), F.lit(True).alias(f"_{end}")) for end in "ab"}

    def kernel(table: pa.Table) -> pa.Table:
        nodes, u, v, saddle, at = _descending(table)
        wet = np.zeros(len(nodes), bool)
        for end in "ab":
            wet[np.searchsorted(nodes, table.column(end).to_numpy())] = table.column(f"_{end}").to_numpy()
        level, wet = np.full(len(nodes), -1), wet.tolist()
        parent, members = list(range(len(nodes))), [[i] for i in range(len(nodes))]
        for k, (i, j) in enumerate(zip(u.tolist(), v.tolist())):
            i, j = find(parent, i), find(parent, j)
            if i == j or (wet[i] and wet[j]):
                continue
            if wet[i] or wet[j]:
                level[members[j if wet[i] else i]] = k
            if len(members[i]) < len(members[j]):
                i, j = j, i
            members[i] += members[j]
            parent[j], members[j], wet[i] = i, [], wet[i] or wet[j]
        found = np.flatnonzero(level >= 0)
        label = table.column("label")[0].as_py()
        return pa.table({"label": np.full(len(found), label, np.int64), "peak": nodes[found], "saddle": saddle[level[found]], "at": at[level[found]]})

    joined = edges.join(flags["a"], ["label", "a"], "left").join(flags["b"], ["label", "b"], "left")
    joined = joined.fillna(False, ["_a", "_b"])
    return joined.groupBy("label").applyInArrow(kernel, "label bigint, peak bigint, saddle double, at bigint")


def _levels_in_rounds(edges: DataFrame, marked: DataFrame) -> DataFrame:
    """The same by rounds of distributed merges, for objects of any size.

    A cluster without a marker joins another over its best saddle. Saddles along such joins only rise, so the
    lowest one that a basin's clusters have chosen, up to a marker, is where the flood came in.
    """

    def choose(best: DataFrame) -> DataFrame:
        free = best.join(marked, ["label", "a"], "left_anti")
        back = free.select("label", F.col("a").alias("b"), F.col("b").alias("_back"))
        joined = free.join(back, ["label", "b"], "left")
        # two clusters that choose each other: the one with the lower number stays
        stays = F.coalesce(F.col("_back") == F.col("a"), F.lit(False)) & (F.col("a") < F.col("b"))
        return joined.where(~stays).select("label", "a", "b", "saddle", "at")

    ends = edges.select("label", F.col("a").alias("peak")).unionByName(edges.select("label", F.col("b").alias("peak"))).distinct()
    entry = lambda saddle, at: F.struct((-F.col(saddle)).alias("down"), F.col(at).alias("at"))
    where = materialize(ends.join(marked.withColumnRenamed("a", "peak"), ["label", "peak"], "left_anti").withColumn("a", F.col("peak")).withColumn("entry", F.when(F.lit(False), F.struct(F.lit(0.0).alias("down"), F.lit(0).cast("bigint").alias("at")))))
    for merges in _merge_rounds(edges, choose):
        joined = where.join(merges.select("label", "a", "root", entry("saddle", "at").alias("_entry")), ["label", "a"], "left")
        where = materialize(joined.select("label", "peak", F.coalesce("root", "a").alias("a"), F.greatest("entry", "_entry").alias("entry")))
    return where.join(marked, ["label", "a"], "left_semi").select("label", "peak", (-F.col("entry.down")).alias("saddle"), F.col("entry.at").alias("at"))


def flood(field: DataFrame, plane: tuple[int, int], markers: DataFrame, edge: int = EDGE, task_saddles: int = TASK_SADDLES) -> DataFrame:
    """``(label, cell, region)`` for every cell of ``field`` some marker's flood reaches, over faces of cells.

    ``field(label, z, y, x, val)``, ``markers(label, cell, marker)``. The regions are those of a priority queue: the highest
    cell in it is taken out, and gives its region to its neighbours without one, which enter the queue.

    A flood reaches a cell at its entry: the lowest cell of the best path from a marker, itself included. So the entry of
    a cell is itself, or that of its basin's peak if that is lower. All cells with one entry have its region, and an entry
    that is no marker has the region of its neighbour with the highest entry; so regions are followed from entry to entry.

    A component of an object that lies in one block is flooded there; only those that reach over blocks go through the graph.
    """
    volume = (None, *plane)
    nothing, unknown = F.lit(0).cast("bigint"), F.lit(0.0)
    rows = field.select(*AXES, "label", "val", nothing.alias("marker"), F.lit(False).alias("told")).unionByName(
        markers.select(*_points(plane), "label", unknown.alias("val"), "marker", F.lit(True).alias("told"))
    )

    def kernel(coords: list, c: dict, low: list, high: list) -> dict:
        return heights.flooded(c["label"], coords, c["val"], c["marker"], c["told"], low, high, plane)

    near, seen = materialize(
        per_box(rows, kernel, heights.FLOODED, ["label", "val", "marker", "told"], "label", box_of(volume, edge), volume, halo=1),
        F.coalesce(F.count_if("rest"), F.lit(0)).alias("n"),
    )
    done = near.where("not rest").select("label", "cell", "region")
    if not seen["n"]:
        return done
    across = materialize(near.where("rest").select("label", *AXES, "val"))
    return done.unionByName(_flood_across(across, plane, markers, edge, task_saddles))


def _flood_across(field: DataFrame, plane: tuple[int, int], markers: DataFrame, edge: int, task_saddles: int) -> DataFrame:
    """The same for components of any size, by the graph of basins and saddles."""
    basins = Basins(field, plane, 6, edge)
    cells = materialize(basins.cells.join(basins.nodes.select("label", F.col("node").alias("to"), "peak"), ["label", "to"]).select("label", "cell", "peak", "val"))
    # a marker is a node of its own beside the basin it lies in, joined to it at its height
    doors = cells.join(markers.select("label", "cell"), ["label", "cell"], "left_semi").groupBy("label", "peak").agg(F.max(F.struct("val", (-F.col("cell")).alias("cell"))).alias("_m"))
    doors = materialize(doors.select("label", (F.col("_m.cell") - 1).alias("a"), F.col("peak").alias("b"), F.col("_m.val").alias("saddle"), (-F.col("_m.cell")).alias("at")))
    marked = doors.select("label", "a")
    small, large = _by_size(materialize(basins.edges.unionByName(doors)), task_saddles)
    levels = _levels_in_task(small, marked)
    if large is not None:
        levels = levels.unionByName(_levels_in_rounds(materialize(large), marked))
    entered = cells.join(materialize(levels), ["label", "peak"])
    own = (F.col("val") < F.col("saddle")) | ((F.col("val") == F.col("saddle")) & (F.col("cell") >= F.col("at")))
    entered = entered.select("label", "cell", F.when(own, F.col("val")).otherwise(F.col("saddle")).alias("entry_val"), F.when(own, F.col("cell")).otherwise(F.col("at")).alias("entry"))
    entered = entered.join(markers.select("label", "cell", F.lit(True).alias("marked")), ["label", "cell"], "left").fillna(False, ["marked"])

    def kernel(c: Cells) -> dict:
        name, entry, value, marked = _linear(c.coords, plane), c.columns["entry"], c.columns["entry_val"], c.columns["marked"]
        to, best = entry.copy(), np.full(len(c), -np.inf)
        first = np.flatnonzero((entry == name) & ~marked)
        for step in offsets(6):
            at = c.neighbour(step)[first]
            mine, at = first[at >= 0], at[at >= 0]
            better = (value[at] > best[mine]) | ((value[at] == best[mine]) & (entry[at] < to[mine]))
            to[mine[better]], best[mine[better]] = entry[at[better]], value[at[better]]
        # entries inside the block are followed at once; rows are in order of label and cell
        layer = np.cumsum(np.concatenate([[False], c.columns["label"][1:] != c.columns["label"][:-1]]))
        low, span = name.min(), name.max() - name.min() + 1
        place, wanted = layer * span + name - low, layer * span + to - low
        row = np.minimum(np.searchsorted(place, wanted), len(place) - 1)
        known = (to >= low) & (to < low + span) & (place[row] == wanted) & c.core[row]
        up = np.where(known, row, np.arange(len(c)))
        while True:
            further = up[up]
            if np.array_equal(further, up):
                break
            up = further
        return {"label": c.columns["label"][c.core], "cell": name[c.core], "to": to[up][c.core]}

    placed = entered.select(*_points(plane), "label", "entry", "entry_val", "marked")
    steps = materialize(per_block(placed, kernel, "label bigint, cell bigint, to bigint", ["label", "entry", "entry_val", "marked"], halo=1, edge=edge, layer="label"))
    ends = steps.join(steps.select("label", F.col("to").alias("cell")).distinct(), ["label", "cell"], "left_semi")
    ends = follow(ends.select("label", F.col("cell").alias("node"), F.col("to").alias("peak")), "node", "peak")
    region = ends.join(markers.select("label", F.col("cell").alias("peak"), F.col("marker").alias("region")), ["label", "peak"]).select("label", F.col("node").alias("to"), "region")
    return steps.join(materialize(region), ["label", "to"]).select("label", "cell", "region")


def _points(plane: tuple[int, int], cell: str = "cell") -> list:
    ny, nx = plane
    return [
        F.expr(f"{cell} div {ny * nx}").alias("z"),
        F.expr(f"{cell} div {nx} % {ny}").alias("y"),
        F.expr(f"{cell} % {nx}").alias("x"),
    ]


class _Undecided:
    """What no block could decide alone: peaks, and the saddles between them, as in ``Basins``."""

    def __init__(self, rows: DataFrame):
        of = lambda kind: rows.where(F.col("kind") == kind)
        self.peaks = of(heights.PEAK).select("label", F.col("a").alias("peak"), "val")
        self.nodes = follow(of(heights.NODE).select("label", F.col("a").alias("node"), F.col("b").alias("peak")), "node", "peak")
        links = of(heights.LINK).select("label", "a", "b", F.col("val").alias("saddle"), "at")
        self.edges = materialize(relink(links, self.nodes, "node", "peak"))


def _tops(rows: DataFrame, h: float, task_saddles: int) -> DataFrame:
    """``(label, cell, val)``: the cells of all h-maxima, of the rows that ``heights.maxima`` gave for all blocks."""
    rows, seen = materialize(rows.where(F.col("kind") != heights.FIELD), F.coalesce(F.count_if(F.col("kind") == heights.PEAK), F.lit(0)).alias("n"))
    found = rows.where(F.col("kind") == heights.MAXIMUM).select("label", F.col("a").alias("cell"), "val")
    if not seen["n"]:
        return found
    basins = _Undecided(rows)
    tops = materialize(h_maxima(basins, h, task_saddles)).withColumnRenamed("val", "_top")
    level = rows.where(F.col("kind") == heights.LEVEL_CELL).select("label", F.col("a").alias("cell"), F.col("b").alias("node"), "val")
    level = level.join(basins.nodes.select("label", "node", F.col("peak").alias("_peak")), ["label", "node"], "left").withColumn("peak", F.coalesce("_peak", "node"))
    return found.unionByName(level.join(tops, ["label", "peak"]).where("val = _top").select("label", "cell", "val"))


def maximum_cells(field: DataFrame, plane: tuple[int, int], h: float, edge: int = EDGE, task_saddles: int = TASK_SADDLES) -> DataFrame:
    """``(z, y, x, label, val)``: the cells of all h-maxima of ``field(label, z, y, x, val)``, over all 26 neighbours."""
    # heights beyond the last layer are none, so the number of layers does not matter
    volume = (1 << 40, *plane)

    def kernel(coords: list, c: dict, low: list, high: list) -> dict:
        return heights.maxima(c["label"], coords, c["val"], low, high, volume, None, h)

    rows = per_box(field, kernel, heights.MAXIMA, ["label", "val"], "label", box_of(volume, edge), volume, halo=1)
    return _tops(rows, h, task_saddles).select(*_points(plane), "label", "val")


def watershed_regions(
    voxels: DataFrame, shape: tuple[int, int, int], h: float, sigma: float, connectivity: int, edge: int = EDGE,
    task_saddles: int = TASK_SADDLES,
) -> tuple[DataFrame, DataFrame]:
    """``(seg_id, num_maxima)`` of objects with more than one maximum, and the regions of ``marked_regions``."""
    maxima, regions = marked_regions(voxels, shape, h, sigma, connectivity, edge, task_saddles)
    return maxima.drop("first"), regions


def _maxima_rows(voxels: DataFrame, shape: tuple[int, int, int], h: float, weights: np.ndarray, edge: int) -> DataFrame:
    """What ``heights.maxima`` gives for the smoothed distances of ``voxels``."""
    reach = len(weights) // 2 + 1
    if 0 < shape[1] * shape[2] * (PIECE + 2 * (EDGE + reach)) <= GROUP_CELLS and edge >= max(shape[1:]):
        # whole planes fit: a piece of the volume finds its distances itself, if none reaches beyond what it sees
        def whole(coords: list, c: dict, low: list, high: list) -> dict:
            return heights.voxel_maxima(c["seg_id"], coords, low, high, shape, weights, h, EDGE)

        pieces = per_box(voxels, whole, heights.MAXIMA, ["seg_id"], "seg_id", (PIECE, *shape[1:]), shape, (EDGE + reach, 0, 0))
        rows, seen = materialize(pieces, F.coalesce(F.count_if(F.col("kind") == heights.FAR), F.lit(0)).alias("n"))
        if not seen["n"]:
            return rows

    def kernel(coords: list, c: dict, low: list, high: list) -> dict:
        return heights.maxima(c["seg_id"], coords, np.sqrt(c["val"]), low, high, shape, weights, h)

    return materialize(per_box(squared_distance(voxels, shape), kernel, heights.MAXIMA, ["seg_id", "val"], "seg_id", box_of(shape, edge), shape, reach))


def marked_regions(
    voxels: DataFrame, shape: tuple[int, int, int], h: float, sigma: float, connectivity: int, edge: int = EDGE,
    task_saddles: int = TASK_SADDLES,
) -> tuple[DataFrame, DataFrame]:
    """Markers per object and the regions flooded from them.

    Returns (``(seg_id, num_maxima, first)``, ``(z, y, x, seg_id, region)``); regions exist only
    for objects with more than one marker, whose number is the C-order number of its
    first cell. ``connectivity`` decides which maximum cells form one marker. Smoothing spreads heights
    beyond an object; maxima there count (``first`` is the lowest number of all), but flood nothing.
    """
    plane = shape[1:]
    rows = _maxima_rows(voxels, shape, h, gaussian_weights(sigma) if sigma else np.ones(1), edge)
    inside = rows.where(F.col("kind") == heights.FIELD).select(*_points(plane, "a"), "label", "val")
    number = (F.col("z") * plane[0] + F.col("y")) * plane[1] + F.col("x")
    tops = _tops(rows, h, task_saddles).select(*_points(plane), "label")
    markers = materialize(
        voxel_components(materialize(tops), plane, connectivity, "label", edge).select("label", number.alias("cell"), F.col("component").alias("marker"))
    )
    counts = materialize(
        markers.select("label", "marker").distinct().groupBy("label").agg(F.count(F.lit(1)).alias("num_maxima"), F.min("marker").alias("first")).where("num_maxima > 1")
    )
    sized = counts.join(object_sizes(voxels).withColumnRenamed("seg_id", "label"), "label")
    several = lookup_join(inside, materialize(sized), "label", "inner", weight="size").select(*AXES, "label", "val")
    starts = lookup_join(markers, counts.select("label"), "label", "inner")
    flooded = flood(several, plane, materialize(starts), edge, task_saddles).select(*_points(plane), F.col("label").alias("seg_id"), "region")
    return counts.withColumnRenamed("label", "seg_id"), materialize(flooded)


def _rename(voxels: DataFrame, regions: DataFrame, parts: DataFrame, first_free: int) -> DataFrame:
    """Give each part in ``parts(seg_id, part, size)`` a fresh label; all other voxels keep theirs."""
    fresh = materialize(with_index(parts, ["seg_id", "part"], "_new", start=first_free))
    renamed = lookup_join(
        regions.select(*AXES, F.col("region").alias("part")), fresh.select("part", "size", "_new"), "part", "inner", weight="size"
    )
    joined = voxels.select(*AXES, "seg_id").join(renamed.select(*AXES, "_new"), list(AXES), "left")
    return joined.select(*AXES, "seg_id", F.coalesce("_new", "seg_id").cast("bigint").alias("new_label"))


def _sized_regions(regions: DataFrame) -> DataFrame:
    return materialize(regions.groupBy("seg_id", F.col("region").alias("part")).agg(F.count(F.lit(1)).alias("size")))


def split_by_watershed(
    voxels: DataFrame, shape: tuple[int, int, int], h: float = 2, min_size: int = 50, smoothing: float = 1, edge: int = EDGE
) -> tuple[DataFrame, DataFrame]:
    """Split objects of at least ``2 * min_size`` voxels into their watershed regions.

    Regions below ``min_size`` keep the object's label, and so does the first one that
    is large enough. Returns (``(z, y, x, seg_id, new_label)``, one row per object with
    more than one maximum: ``seg_id, num_maxima, valid_regions, accepted``).
    """
    sizes = materialize(object_sizes(voxels))
    large = lookup_join(voxels, sizes.where(F.col("size") >= 2 * min_size), "seg_id", "inner", weight="size")
    maxima, regions = watershed_regions(large.select(*AXES, "seg_id"), shape, h, smoothing, 6, edge)
    valid = _sized_regions(regions).where(F.col("size") >= min_size)
    per_object = valid.groupBy("seg_id").agg(F.count(F.lit(1)).alias("valid_regions"), F.min("part").alias("_first"))
    outcome = maxima.join(per_object, "seg_id", "left").select(
        "seg_id",
        "num_maxima",
        F.coalesce("valid_regions", F.lit(0)).cast("bigint").alias("valid_regions"),
        (F.coalesce("valid_regions", F.lit(0)) > 1).alias("accepted"),
    )
    fresh = lookup_join(valid, materialize(per_object.where("valid_regions > 1")), "seg_id", "inner").where("part <> _first")
    return _rename(voxels, regions, fresh.select("seg_id", "part", "size"), max_label(sizes) + 1), outcome


def split_by_watershed_elongation(
    voxels: DataFrame, shape: tuple[int, int, int], connectivity: int = 26, min_size: int = 100, validate: bool = True,
    h: float = 3, smoothing: float = 1, edge: int = EDGE,
) -> tuple[DataFrame, DataFrame]:
    """Split disconnected objects by component, connected ones by watershed.

    A watershed split counts only if the regions are clearly less elongated than the
    object (``validate``). The first component or region keeps the label whatever its
    size. Returns (``(z, y, x, seg_id, new_label)``, ``(seg_id, type)`` of changed objects).
    """
    sizes = materialize(object_sizes(voxels))
    large = materialize(
        lookup_join(voxels, sizes.where(F.col("size") >= min_size), "seg_id", "inner", weight="size").select(*AXES, "seg_id")
    )
    components = materialize(voxel_components(large, shape[1:], connectivity, edge=edge))
    pieces = _sized_regions(components.withColumnRenamed("component", "region"))
    shape_of = materialize(
        pieces.groupBy("seg_id").agg(
            F.count(F.lit(1)).alias("_pieces"), F.count_if(F.col("size") >= min_size).alias("_significant"),
            F.min("part").alias("_first"), F.sum("size").alias("_n"),
        )
    )
    loose = lookup_join(pieces, shape_of.where("_pieces > 1 and _significant > 1"), "seg_id", "inner")
    whole = shape_of.where("_pieces = 1").select("seg_id", "_n")
    single = lookup_join(large, whole, "seg_id", "inner", weight="_n").select(*AXES, "seg_id")
    maxima, regions = marked_regions(materialize(single), shape, h, smoothing, connectivity, edge)
    sized = _sized_regions(regions)
    if validate:
        rounder = elongation_gate(elongation(regions, ["seg_id", "region"]), elongation(single), min_size)
    else:
        rounder = maxima.select("seg_id")
    accepted = materialize(rounder)
    first = maxima.select("seg_id", F.col("first").alias("_first"))
    cut = lookup_join(lookup_join(sized, accepted, "seg_id", "inner"), first, "seg_id", "inner")
    columns = ["seg_id", "part", "size"]
    fresh = loose.where("part <> _first").select(*columns).unionByName(cut.where("part <> _first").select(*columns))
    fresh = fresh.where(F.col("size") >= min_size)
    both = regions.unionByName(
        lookup_join(components, shape_of.where("_pieces > 1").select("seg_id", "_n"), "seg_id", "inner", weight="_n").select(
            *AXES, "seg_id", F.col("component").alias("region")
        )
    )
    changes = loose.select("seg_id", F.lit("multi_component").alias("type")).distinct().unionByName(
        accepted.select("seg_id", F.lit("watershed_split").alias("type"))
    )
    return _rename(voxels, both, fresh, max_label(sizes) + 1), changes
