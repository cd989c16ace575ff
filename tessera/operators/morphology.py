"""Components, erosion, dilation, splitting and hole filling of labelled volumes.

Volumes are sparse rows ``(z, y, x, seg_id)``; background is not stored. ``plane`` is
the (y, x) extent, which turns a cell into its C-order number.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import contract, hook
from .keyed import lookup_join, with_index
from .stencil import AXES, EDGE, Cells, offsets, per_block

CELL = "z bigint, y bigint, x bigint"


def extent(voxels: DataFrame) -> tuple[int, int, int]:
    """Smallest shape that holds all stored voxels."""
    row = voxels.agg(*[(F.coalesce(F.max(a), F.lit(-1)) + 1).alias(a) for a in AXES]).first()
    return tuple(row)


def object_sizes(voxels: DataFrame, label: str = "seg_id") -> DataFrame:
    return voxels.where(F.col(label) != 0).groupBy(label).agg(F.count(F.lit(1)).alias("size"))


def _linear(coords, plane):
    return (coords[0] * plane[0] + coords[1]) * plane[1] + coords[2]


def voxel_components(
    voxels: DataFrame, plane: tuple[int, int], connectivity: int = 26, label: str = "seg_id", edge: int = EDGE
) -> DataFrame:
    """Add ``component``: the C-order number of the first voxel of the voxel's component.

    Each block labels its own voxels; voxels in the one-cell overlap of two blocks
    tie the blocks' components together, and only those ties enter the iterative
    contraction.
    """
    steps = offsets(connectivity, half=True)

    def kernel(cells: Cells) -> dict:
        u, v = [], []
        for step in steps:
            at = cells.same(step, label)
            here = np.flatnonzero(at >= 0)
            u.append(here)
            v.append(at[here])
        u, v = np.concatenate(u), np.concatenate(v)
        both = cells.core[u] & cells.core[v]
        root = hook(u[both], v[both], len(cells))
        names = _linear(cells.coords, plane)
        # both blocks see a tie; the one that owns the later voxel reports it
        cross = (cells.core[u] != cells.core[v]) & np.where(cells.core[u], names[u] > names[v], names[v] > names[u])
        inner = np.where(cells.core[u], u, v)[cross]
        outer = np.where(cells.core[u], v, u)[cross]
        keep = np.flatnonzero(cells.core)
        # voxel rows carry other = NULL; tie rows (voxel's component, foreign voxel) carry it
        return cells.take(
            np.concatenate([keep, outer]),
            **{
                label: np.concatenate([cells.columns[label][keep], cells.columns[label][outer]]),
                "node": names[np.concatenate([root[keep], root[inner]])],
                "tie": np.concatenate([np.zeros(len(keep), bool), np.ones(len(outer), bool)]),
            },
        )

    rows = materialize(
        per_block(voxels, kernel, f"{CELL}, {label} bigint, node bigint, tie boolean", [label], halo=1, edge=edge)
    )
    labelled = rows.where(~F.col("tie")).drop("tie")
    ties = rows.where("tie").select(*AXES, F.col("node").alias("other")).distinct()
    # the foreign end of a tie lies on a face of its block, so only the faces are looked up
    on_face = F.lit(False)
    for a in AXES:
        on_face = on_face | F.pmod(F.col(a), F.lit(edge)).isin(0, edge - 1)
    pairs = ties.join(labelled.where(on_face), list(AXES)).select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()
    roots = contract(pairs, "a", "b").select(F.col("id").alias("node"), F.col("root").alias("_root"))
    # a block-local component has at most edge^3 voxels, so no node is hot
    joined = labelled.join(roots, "node", "left")
    return joined.select(*AXES, label, F.coalesce("_root", "node").alias("component"))


def connectivity_by_label(components: DataFrame, label: str = "seg_id") -> DataFrame:
    """Components per label. Duplicates are removed by partial aggregation first."""
    return components.select(label, "component").distinct().groupBy(label).agg(F.count(F.lit(1)).alias("components"))


def connectivity_stats(by_label: DataFrame) -> DataFrame:
    objects = F.count(F.lit(1))
    parts = F.coalesce(F.sum("components"), F.lit(0)).cast("bigint")
    return by_label.agg(
        objects.alias("total_objects"),
        parts.alias("total_components"),
        F.count_if(F.col("components") > 1).alias("multi_part_objects"),
        F.when(objects > 0, parts / objects).otherwise(0.0).cast("double").alias("average_components_per_object"),
    )


def erode(voxels: DataFrame, iterations: int = 1, connectivity: int = 6, label: str = "seg_id", edge: int = EDGE) -> DataFrame:
    """Keep voxels whose whole neighbourhood has their label; beyond the volume is background."""
    steps = offsets(connectivity)

    def kernel(cells: Cells) -> dict:
        alive = _eroded(cells, steps, iterations, label)
        keep = np.flatnonzero(alive & cells.core)
        return cells.take(keep, **{label: cells.columns[label][keep]})

    return per_block(voxels, kernel, f"{CELL}, {label} bigint", [label], halo=iterations, edge=edge)


def _eroded(cells: Cells, steps, iterations: int, label: str) -> np.ndarray:
    around = [cells.same(step, label) for step in steps]
    alive = np.ones(len(cells), bool)
    for _ in range(iterations):
        alive = np.logical_and.reduce([alive] + [(at >= 0) & alive[at] for at in around])
    return alive


def dilate(
    marked: DataFrame, mask: DataFrame, iterations: int = 1, connectivity: int = 6, label: str = "seg_id",
    mark: str | None = None, edge: int = EDGE,
) -> DataFrame:
    """Grow the marked voxels inside the voxels of ``mask`` that have the same label.

    With ``mark``, every value of that column grows on its own: a voxel reached by
    several marks appears once per mark.
    """
    steps = offsets(connectivity)
    seed_mark = (F.col(mark) if mark else F.lit(0)).cast("bigint").alias("_mark")
    # mask and seeds travel as one stream of rows; a seed takes its label from the mask
    tagged = mask.select(*AXES, label, F.lit(0).cast("bigint").alias("_mark"), F.lit(False).alias("_seed")).unionByName(
        marked.select(*AXES, F.lit(0).cast("bigint").alias(label), seed_mark, F.lit(True).alias("_seed"))
    )
    name = mark or "_mark"

    def kernel(cells: Cells) -> dict:
        is_seed = cells.columns["_seed"]
        spot, seed = np.flatnonzero(~is_seed), np.flatnonzero(is_seed)
        keys = cells.key[spot]
        labels = cells.columns[label][spot]

        def find(wanted):
            at = np.searchsorted(keys, wanted)
            at[at == len(keys)] = 0
            return np.where(keys[at] == wanted, at, -1) if len(keys) else np.full(len(wanted), -1)

        start = find(cells.key[seed])
        pairs = np.unique(np.stack([start, cells.columns["_mark"][seed]], axis=1)[start >= 0], axis=0)
        if len(keys):
            around = [find(keys + cells.step(step)) for step in steps]
            around = [np.where((at >= 0) & (labels[at] == labels), at, -1) for at in around]
            for _ in range(iterations):
                grown = [pairs] + [np.stack([at[pairs[:, 0]], pairs[:, 1]], axis=1) for at in around]
                grown = np.concatenate(grown)
                pairs = np.unique(grown[grown[:, 0] >= 0], axis=0)
        at = spot[pairs[:, 0]]
        inside = cells.core[at]
        at, marks = at[inside], pairs[inside, 1]
        return cells.take(at, **{label: cells.columns[label][at], name: marks})

    grown = per_block(
        tagged, kernel, f"{CELL}, {label} bigint, {name} bigint", [label, "_mark", "_seed"], halo=iterations, edge=edge
    )
    return grown if mark else grown.drop(name)


def remove_small(voxels: DataFrame, min_size: int = 100, label: str = "seg_id") -> DataFrame:
    """Drop (set to background) every object with fewer than ``min_size`` voxels."""
    small = materialize(object_sizes(voxels, label).where(F.col("size") < min_size))
    kept = lookup_join(voxels, small, label, weight="size").where(F.col("size").isNull())
    return kept.select(*voxels.columns)


def removal_stats(sizes: DataFrame, min_size: int = 100) -> DataFrame:
    return sizes.agg(
        F.count(F.lit(1)).alias("total_objects"),
        F.count_if(F.col("size") < min_size).alias("objects_removed"),
        F.count_if(F.col("size") >= min_size).alias("objects_kept"),
        F.lit(min_size).cast("bigint").alias("min_size"),
    )


def max_label(voxels: DataFrame, label: str = "seg_id") -> int:
    return voxels.agg(F.coalesce(F.max(label), F.lit(0))).first()[0]


def number_new_parts(parts: DataFrame, first_free: int, label: str = "seg_id") -> DataFrame:
    """New labels for the parts of split objects: ``(label, part, size, new_label)``.

    The first part of an object keeps the object's label; all others get fresh ones
    in order of (object, part), unique over the whole volume.
    """
    firsts = parts.groupBy(label).agg(F.min("part").alias("_first"))
    marked = materialize(lookup_join(parts, firsts, label))
    fresh = with_index(marked.where("part <> _first"), [label, "part"], "new_label", start=first_free)
    kept = marked.where("part = _first").withColumn("new_label", F.col(label))
    return kept.unionByName(fresh).select(label, "part", "size", F.col("new_label").cast("bigint").alias("new_label"))


def split_by_erosion(
    voxels: DataFrame, plane: tuple[int, int], iterations: int = 1, connectivity: int = 26, min_size: int = 100,
    label: str = "seg_id", edge: int = EDGE,
) -> DataFrame:
    """Separate objects that fall apart when eroded: ``(z, y, x, label, new_label)``.

    A part is an eroded component grown back by ``iterations + 1`` steps inside its
    object; parts of at least ``min_size`` voxels count. Objects with fewer than two
    such parts stay as they are. In split objects a voxel takes the last part that
    reached it, and voxels no part reached become background (0).
    """
    sizes = materialize(object_sizes(voxels, label))
    large = lookup_join(voxels, sizes.where(F.col("size") >= min_size), label, "inner", weight="size").select(*AXES, label)
    core = erode(large, iterations, connectivity, label, edge)
    seeds = materialize(voxel_components(core, plane, connectivity, label, edge))
    grown = materialize(dilate(seeds, voxels, iterations + 1, connectivity, label, mark="component", edge=edge))
    parts = grown.groupBy(label, F.col("component").alias("part")).agg(F.count(F.lit(1)).alias("size"))
    parts = materialize(parts.where(F.col("size") >= min_size))
    split = parts.groupBy(label).agg(F.count(F.lit(1)).alias("_parts")).where("_parts > 1")
    split = materialize(split.join(sizes, label).select(label, "size"))
    numbered = materialize(
        number_new_parts(
            lookup_join(parts, split.select(label), label, "inner"), max_label(sizes, label) + 1, label
        )
    )
    won = lookup_join(
        grown.withColumnRenamed("component", "part"), numbered.select("part", "size", "new_label"), "part", "inner", weight="size"
    )
    won = won.groupBy(*AXES).agg(F.max_by("new_label", "part").alias("_won"))
    touched = split.select(label, "size", F.lit(True).alias("_split"))
    flagged = lookup_join(voxels.select(*AXES, label), touched, label, weight="size")
    kept = F.when(F.col("_split"), F.coalesce("_won", F.lit(0))).otherwise(F.col(label))
    return flagged.join(won, list(AXES), "left").select(*AXES, label, kept.cast("bigint").alias("new_label"))


def split_disconnected(
    components: DataFrame, min_size: int = 100, label: str = "seg_id"
) -> DataFrame:
    """Give the separate significant components of an object labels of their own.

    ``components`` is the output of ``voxel_components``. Objects with fewer than two
    components of ``min_size`` stay; in others, the object's first component and all
    small ones keep the label.
    """
    all_parts = materialize(
        components.groupBy(label, F.col("component").alias("part")).agg(F.count(F.lit(1)).alias("size"))
    )
    per_object = all_parts.groupBy(label).agg(
        F.min("part").alias("_first"), F.count_if(F.col("size") >= min_size).alias("_significant"), F.sum("size").alias("_total")
    ).where(f"_significant > 1 and _total >= {min_size}")
    renamed = lookup_join(all_parts, materialize(per_object), label, "inner").where(
        f"size >= {min_size} and part <> _first"
    )
    first_free = max_label(all_parts, label) + 1
    fresh = materialize(with_index(renamed, [label, "part"], "_new", start=first_free)).select("part", "size", "_new")
    joined = lookup_join(components.withColumnRenamed("component", "part"), fresh, "part", weight="size")
    return joined.select(*AXES, label, F.coalesce("_new", label).cast("bigint").alias("new_label"))


def split_details(split: DataFrame, label: str = "seg_id") -> DataFrame:
    """Objects that a split changed, with the number of labels they ended up with."""
    pairs = split.select(label, "new_label").where("new_label <> 0").distinct()
    return pairs.groupBy(label).agg(F.count(F.lit(1)).alias("new_components")).where("new_components > 1")


def split_summary(split: DataFrame, label: str = "seg_id") -> DataFrame:
    """One row: objects before and after a split, objects added and labels modified."""
    pairs = materialize(split.select(label, "new_label").distinct())
    one = F.lit(1).alias("_one")
    totals = pairs.agg(
        F.countDistinct(label).alias("initial_objects"),
        F.countDistinct(F.when(F.col("new_label") != 0, F.col("new_label"))).alias("final_objects"),
    )
    changed = split_details(pairs, label).agg(F.count(F.lit(1)).alias("labels_modified"))
    return totals.select("*", one).join(changed.select("*", one), "_one").select(
        "initial_objects", "final_objects", (F.col("final_objects") - F.col("initial_objects")).alias("objects_added"), "labels_modified"
    )


def label_adjacency(voxels: DataFrame, label: str = "seg_id", edge: int = EDGE) -> DataFrame:
    """Distinct pairs of different labels that share a voxel face: ``(a, b)`` with a < b.

    Each block reports every pair once, so hot labels are merged before the shuffle.
    """
    steps = offsets(6, half=True)

    def kernel(cells: Cells) -> dict:
        values = cells.columns[label]
        found = []
        for step in steps:
            at = cells.neighbour(step)
            here = np.flatnonzero((at >= 0) & (cells.core | cells.core[at]))
            found.append(np.stack([values[here], values[at[here]]], axis=1))
        pairs = np.concatenate(found)
        pairs = np.unique(np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1), axis=0)
        return {"a": pairs[:, 0], "b": pairs[:, 1]}

    return per_block(voxels, kernel, "a bigint, b bigint", [label], halo=1, edge=edge).distinct()


def densify(voxels: DataFrame, shape: tuple[int, int, int], label: str = "seg_id") -> DataFrame:
    """All cells of the volume, background as 0."""
    nz, ny, nx = shape
    cell = F.col("id")
    grid = voxels.sparkSession.range(nz * ny * nx).select(
        F.expr(f"id div {ny * nx}").alias("z"), F.expr(f"id div {nx} % {ny}").alias("y"), (cell % nx).alias("x")
    )
    return grid.join(voxels.select(*AXES, label), list(AXES), "left").withColumn(
        label, F.coalesce(label, F.lit(0)).cast("bigint")
    )


def _inside(inner: str, outer: str) -> Column:
    """Box ``inner`` lies strictly within box ``outer`` (column prefixes)."""
    test = F.lit(True)
    for a in AXES:
        test = test & (F.col(f"{inner}{a}0") > F.col(f"{outer}{a}0")) & (F.col(f"{inner}{a}1") < F.col(f"{outer}{a}1"))
    return test


def enclosed_regions(
    voxels: DataFrame, shape: tuple[int, int, int], label: str = "seg_id", edge: int = EDGE
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Which regions lie in holes of which objects.

    Returns (cells with their region, regions with label and size, pairs
    ``(owner, region)``). A region is a 6-connected set of cells of one value, be it
    background or another object. It lies in a hole of ``owner`` if every path from
    it to the border of the volume meets ``owner``. Such a region lies strictly
    inside the owner's bounding box and so do all regions on those paths, so the
    search only ever follows neighbours inside that box; the first one that leaves
    it proves the region open.
    """
    cells = materialize(voxel_components(densify(voxels, shape, label), shape[1:], 6, label, edge))
    cells = cells.withColumnRenamed("component", "region")
    box = [f(c).alias(f"{a}{i}") for a in AXES for i, f in ((0, F.min), (1, F.max)) for c in (a,)]
    regions = materialize(cells.groupBy("region", label).agg(F.count(F.lit(1)).alias("size"), *box))
    outer = regions.where(F.col(label) != 0).groupBy(F.col(label).alias("owner"))
    owners = materialize(
        outer.agg(*[f(f"{a}{i}").alias(f"o{a}{i}") for a in AXES for i, f in ((0, F.min), (1, F.max))])
    )
    touching = label_adjacency(cells, "region", edge)
    both = touching.unionByName(touching.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # a region on the border is in no hole, so it never needs its neighbours looked up
    interior = F.lit(True)
    for a, n in zip(AXES, shape):
        interior = interior & (F.col(f"{a}0") > 0) & (F.col(f"{a}1") < n - 1)
    boxes = [f"{a}{i}" for a in AXES for i in (0, 1)]
    start = regions.where(interior).select(F.col("region").alias("a"), F.col(label).alias("_from"), *[F.col(c).alias(f"f{c}") for c in boxes])
    towards = regions.select(F.col("region").alias("b"), F.col(label).alias("_to"), *[F.col(c).alias(f"t{c}") for c in boxes])
    links = materialize(lookup_join(both.join(start, "a"), towards, "b", "inner"))

    def bounded(pairs: DataFrame) -> DataFrame:
        return lookup_join(pairs, owners, "owner", "inner")

    first = links.where("_to <> 0").withColumn("owner", F.col("_to"))
    first = bounded(first).where(_inside("f", "o")).select("owner", F.col("a").alias("region")).distinct()
    frontier, found = materialize(first, F.count(F.lit(1)).alias("n"))
    known, steps = frontier, []
    while found["n"]:
        hops = bounded(frontier.join(links.withColumnRenamed("a", "region"), "region").where("_to <> owner"))
        hops = materialize(hops.select("owner", "region", F.col("b").alias("next"), _inside("t", "o").alias("inside")))
        steps.append(hops)
        escaped = hops.where("not inside").select("owner", "region").distinct()
        onward = hops.join(escaped, ["owner", "region"], "left_anti")
        fresh = onward.select("owner", F.col("next").alias("region")).distinct()
        frontier, found = materialize(fresh.join(known, ["owner", "region"], "left_anti"), F.count(F.lit(1)).alias("n"))
        known = materialize(known.unionByName(frontier))
    if not steps:
        return cells, regions, known
    hops = steps[0]
    for more in steps[1:]:
        hops = hops.unionByName(more)
    numbered = materialize(with_index(known, ["owner", "region"], "pair"))
    target = numbered.select("owner", F.col("region").alias("next"), F.col("pair").alias("other"))
    ties = hops.where("inside").join(numbered, ["owner", "region"]).join(target, ["owner", "next"])
    roots = contract(ties, "pair", "other").select(F.col("id").alias("pair"), "root")
    grouped = materialize(numbered.join(roots, "pair", "left").withColumn("root", F.coalesce("root", "pair")))
    escaped = hops.where("not inside").select("owner", "region").distinct()
    open_roots = escaped.join(grouped, ["owner", "region"]).select("root").distinct()
    closed = lookup_join(grouped, open_roots.withColumn("_open", F.lit(True)), "root").where(F.col("_open").isNull())
    return cells, regions, materialize(closed.select("owner", "region"))


def hole_counts(regions: DataFrame, closed: DataFrame) -> DataFrame:
    """Voxels in holes per object, enclosed objects included."""
    sized = lookup_join(closed, regions.select("region", "size"), "region", "inner")
    return sized.groupBy("owner").agg(F.sum("size").alias("hole_voxels"))


def fill_holes(voxels: DataFrame, shape: tuple[int, int, int], label: str = "seg_id", edge: int = EDGE) -> DataFrame:
    """Give the cells in an object's holes its label, in ascending label order.

    As each object with holes writes its whole filled body, the largest label that
    encloses a cell wins, and an enclosed object survives only if it has holes of
    its own and the larger label.
    """
    cells, regions, closed = enclosed_regions(voxels, shape, label, edge)
    writers = closed.select(F.col("owner").alias(label), F.lit(True).alias("_writes")).distinct()
    winners = closed.groupBy("region").agg(F.max("owner").alias("_owner"))
    changed = lookup_join(regions.select("region", label, "size").join(winners, "region"), writers, label)
    own = F.when(F.col("_writes"), F.col(label))
    changed = materialize(changed.select("region", "size", F.greatest("_owner", own).alias("_filled")))
    joined = lookup_join(cells, changed, "region", weight="size")
    return joined.select(*AXES, F.coalesce("_filled", label).alias(label)).where(F.col(label) != 0)
