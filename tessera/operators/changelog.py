"""Replaying an ordered log of edge additions and removals.

An edge's state is the number of its parallel copies. ``+`` turns c into max(c, 1)
and ``-`` turns c into max(c - 1, 0). Both have the form max(c - a, b), and so has
any sequence of them: a is the number of removals and b is 1 exactly if the last
operation was an addition. A group of log lines can therefore be summarised by
(removals, last operation) with ordinary partial aggregation; no edge's history is
ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .keyed import lookup_join

ADD, REMOVE = "+", "-"
# Log lines per (edge, stretch): bounds a window group, whatever an edge's share of the log.
STRETCH = 1 << 20

EDGE = ["src", "dst"]


def oriented(edges: DataFrame, directed: bool = False) -> DataFrame:
    """Undirected edges get one orientation: the smaller end first."""
    if directed:
        return edges
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    return edges.withColumn("_low", low).withColumn("dst", high).withColumn("src", F.col("_low")).drop("_low")


def classify(changes: DataFrame, vertices: DataFrame) -> DataFrame:
    """Log lines with both ends resolved to vertices and ``reason`` (NULL = valid line).

    ``changes(line_no, op, v1, v2)`` holds segment ids; of several vertices with the
    same segment id the last one counts.
    """
    ids = vertices.groupBy("seg_id").agg(F.max("vid").alias("vid"))
    first = ids.select(F.col("seg_id").alias("v1"), F.col("vid").alias("_a"))
    second = ids.select(F.col("seg_id").alias("v2"), F.col("vid").alias("_b"))
    joined = lookup_join(lookup_join(changes, first, "v1"), second, "v2")
    reason = (
        F.when(F.col("op").isNull() | ~F.col("op").isin(ADD, REMOVE), "invalid operation")
        .when(F.col("v1").isNull() | F.col("v2").isNull(), "missing vertex id")
        .when(F.col("_a").isNull() | F.col("_b").isNull(), "unknown vertex id")
    )
    return joined.select("line_no", "op", "v1", "v2", F.col("_a").alias("src"), F.col("_b").alias("dst"), reason.alias("reason"))


def rejected(lines: DataFrame) -> DataFrame:
    """The invalid ones of classified lines."""
    return lines.where(F.col("reason").isNotNull()).select("line_no", "op", "v1", "v2", "reason")


def valid(lines: DataFrame, directed: bool = False) -> DataFrame:
    """The valid ones of classified lines, as operations on edges."""
    return oriented(lines.where(F.col("reason").isNull()).select("line_no", "op", "src", "dst"), directed)


def rejects(changes: DataFrame, vertices: DataFrame) -> DataFrame:
    return rejected(classify(changes, vertices))


def valid_lines(changes: DataFrame, vertices: DataFrame, directed: bool = False) -> DataFrame:
    return valid(classify(changes, vertices), directed)


def _base(edges: DataFrame, directed: bool) -> DataFrame:
    copies = F.col("mult") if "mult" in edges.columns else F.lit(1)
    return oriented(edges, directed).groupBy(*EDGE).agg(F.sum(copies).cast("bigint").alias("base"))


def apply_changes(edges: DataFrame, changes: DataFrame, vertices: DataFrame, directed: bool = False) -> DataFrame:
    """The edges after the whole log: ``(src, dst, mult)`` with ``mult`` > 0."""
    log = (
        valid_lines(changes, vertices, directed)
        .groupBy(*EDGE)
        .agg(
            F.count_if(F.col("op") == REMOVE).alias("_removed"),
            F.max_by("op", "line_no").alias("_last"),
        )
    )
    copies = F.coalesce("base", F.lit(0)) - F.coalesce("_removed", F.lit(0))
    mult = F.greatest(copies, F.when(F.col("_last") == ADD, 1).otherwise(0)).cast("bigint")
    return _base(edges, directed).join(log, EDGE, "full").select(*EDGE, mult.alias("mult")).where("mult > 0")


def effective_changes(
    edges: DataFrame, changes: DataFrame, vertices: DataFrame, directed: bool = False, stretch: int = STRETCH
) -> DataFrame:
    """Valid log lines with ``before`` (copies before the line) and ``effective``.

    The log is cut into stretches of ``stretch`` line numbers. Inside one stretch
    running values come from a window; what the stretches before it contribute
    comes from their summaries.
    """
    lines = valid_lines(changes, vertices, directed).withColumn(
        "_stretch", F.floor(F.col("line_no") / F.lit(stretch)).cast("bigint")
    )
    lines = materialize(lines)
    removed = F.when(F.col("op") == REMOVE, 1).otherwise(0)
    sums = lines.groupBy(*EDGE, "_stretch").agg(
        F.sum(removed).alias("_removed"), F.max_by("op", "line_no").alias("_last")
    )
    earlier = Window.partitionBy(*EDGE).orderBy("_stretch")
    carried = sums.select(
        *EDGE,
        "_stretch",
        F.coalesce(F.sum("_removed").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_removed0"),
        F.lag("_last").over(earlier).alias("_last0"),
    ).join(_base(edges, directed), EDGE, "left")
    inside = Window.partitionBy(*EDGE, "_stretch").orderBy("line_no")
    run = lines.select(
        "*",
        F.coalesce(F.sum(removed).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_removed1"),
        F.lag("op").over(inside).alias("_last1"),
    )
    joined = run.join(carried, [*EDGE, "_stretch"])
    copies = F.coalesce("base", F.lit(0)) - F.col("_removed0") - F.col("_removed1")
    added = F.when(F.coalesce("_last1", "_last0") == ADD, 1).otherwise(0)
    before = F.greatest(copies, added).cast("bigint")
    effective = F.when(F.col("op") == ADD, before == 0).otherwise(before > 0)
    return joined.select("line_no", "op", *EDGE, before.alias("before"), effective.alias("effective"))


def apply_mergelist(edges: DataFrame, mergelist: DataFrame, vertices: DataFrame, directed: bool = False) -> DataFrame:
    """Add an edge for each ``(sub_id, obj_id)`` with two known ids, unless one is there already."""
    additions = mergelist.select(
        F.lit(0).cast("bigint").alias("line_no"), F.lit(ADD).alias("op"), F.col("sub_id").alias("v1"), F.col("obj_id").alias("v2")
    )
    return apply_changes(edges, additions, vertices, directed)
