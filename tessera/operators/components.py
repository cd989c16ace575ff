"""Connected components by alternating large-star / small-star contraction.

(Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .keyed import HOT_SHARE, lookup_join, with_index

# Edges whose stars are contracted together inside a task before the first shuffle.
LOCAL_EDGES = 1 << 20
# Below this many edges no vertex can be hot enough to need its own join branch.
SKEW_EDGES = 1 << 20


def hook(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Root (smallest member) of each of ``n`` nodes under the edges ``u[i] - v[i]``."""
    parent = np.arange(n)
    while len(u):
        a, b = parent[u], parent[v]
        open_ = a != b
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each bounded run of edges by stars with the same connectivity."""

    def contract(run: list[pa.RecordBatch]) -> pa.RecordBatch:
        u = np.concatenate([b.column(0).to_numpy() for b in run])
        v = np.concatenate([b.column(1).to_numpy() for b in run])
        ids, position = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = hook(position[: len(u)], position[len(u) :], len(ids))
        child = np.flatnonzero(root != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[child]), pa.array(ids[root[child]])], names=["u", "v"])

    run, size = [], 0
    for batch in batches:
        run.append(batch)
        size += batch.num_rows
        if size >= LOCAL_EDGES:
            yield contract(run)
            run, size = [], 0
    if run:
        yield contract(run)


def _star(grouped: DataFrame, large: bool, edges: int, skew_edges: int) -> DataFrame:
    """One star operation on ``(u, v)`` rows grouped by ``u``.

    Every neighbour of ``u`` (the larger ones if ``large``, else the smaller ones and
    ``u`` itself) is linked to the smallest of ``u`` and its neighbours. The minimum
    is a partial aggregate; the rows of hub vertices get it by broadcast.
    """
    minima = grouped.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"), F.count(F.lit(1)).alias("_n"))
    if edges <= skew_edges:
        joined = grouped.join(minima, "u")
    else:
        # fewer than 2 * HOT_SHARE hubs, as grouped has at most 2 * edges rows
        minima = materialize(minima)
        hubs = F.broadcast(minima.where(F.col("_n") * HOT_SHARE > F.lit(edges)))
        rest = grouped.join(hubs.select("u"), "u", "left_anti")
        joined = grouped.join(hubs, "u").unionByName(rest.join(minima, "u"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = linked.unionByName(minima.where("u <> m").select("u", F.col("m").alias("v")))
    return out.where("u <> v")


def contract(edges: DataFrame, a: str, b: str, skew_edges: int = SKEW_EDGES) -> DataFrame:
    """``(id, root)`` for every node with an edge to another, except the roots themselves.

    The root is the smallest id of the component. Each round also contracts what
    happens to lie in one partition. A node's smallest neighbour never grows, and
    shrinks somewhere in every round until all edges form stars; so a round that
    changes nothing is the last.
    """
    # ranges are drawn from a first look at the pairs
    pairs = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v"))
    stats = (F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"))

    def compact(rows: DataFrame) -> DataFrame:
        # the first distinct spreads the edges evenly and, when few are left, brings them together
        return rows.distinct().mapInArrow(_local_stars, "u bigint, v bigint").distinct()

    # ids that are close are often linked, so the first runs are ranges of ids
    near = pairs.repartitionByRange("v", "u").sortWithinPartitions("v", "u")
    current, seen = materialize(near.mapInArrow(_local_stars, "u bigint, v bigint").distinct(), *stats)
    leaves = None
    if seen["n"] > skew_edges:
        leaves, rest = _leaves(current)
        current, seen = materialize(compact(rest), *stats)
    while seen["n"]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        small_input = _star(both, True, 2 * seen["n"], skew_edges)
        if seen["n"] > skew_edges:
            small_input = materialize(small_input)
        following, found = materialize(compact(_star(small_input, False, seen["n"], skew_edges)), *stats)
        current = following
        if (found["n"], found["h"]) == (seen["n"], seen["h"]):
            break
        seen = found
    roots = current.select(F.col("u").alias("id"), F.col("v").alias("root"))
    if leaves is None:
        return roots
    joined = lookup_join(leaves, roots.select(F.col("id").alias("v"), "root"), "v")
    return joined.select("id", F.coalesce("root", "v").alias("root")).unionByName(roots)


def _leaves(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices with one edge, which leads to a smaller one, as ``(id, v)``; and the edges ``(u, v)`` of all others.

    A leaf is no root and links nothing, so it takes the root of ``v`` once that is known.
    """
    ends = edges.select(F.col("u").alias("id"), "v").unionByName(edges.select(F.col("v").alias("id"), F.lit(None).cast("bigint").alias("v")))
    degrees = materialize(ends.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("v")))
    others = degrees.where("n > 1 and v is not null").select(F.col("id").alias("u"))
    return degrees.where("n = 1 and v is not null").select("id", "v"), edges.join(others, "u", "left_semi")


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "vid", a: str = "src", b: str = "dst") -> DataFrame:
    """``(node, root)`` for every node; one without edges is its own component."""
    roots = contract(edges, a, b).withColumnRenamed("id", node)
    return nodes.select(node).join(roots, node, "left").withColumn("root", F.coalesce("root", node))


def number_components(labelled: DataFrame, root: str = "root", name: str = "component") -> tuple[DataFrame, DataFrame]:
    """Number the components 0,1,... by smallest member; returns (rows, numbering with sizes)."""
    sizes = labelled.groupBy(root).agg(F.count(F.lit(1)).alias("size"))
    return labelled, with_index(sizes, [root], name)
