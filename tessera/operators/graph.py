"""The segment graph: loading, components, lookup table, statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import prefixed_label
from ..session import materialize
from . import changelog
from .components import connected_components
from .keyed import lookup_join, with_index


def vertex_of_segment(vertices: DataFrame) -> DataFrame:
    """One vertex per segment id: of duplicates, the last."""
    return vertices.groupBy("seg_id").agg(F.max("vid").alias("vid"))


def known_edges(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges with both ends among the vertices."""
    # a lookup reads both its sides more than once
    edges, ids = materialize(edges), materialize(vertices.select("vid").distinct())
    both = materialize(lookup_join(edges, ids.select(F.col("vid").alias("src")), "src", "inner"))
    return lookup_join(both, ids.select(F.col("vid").alias("dst")), "dst", "inner").select(*edges.columns)


class SegmentGraph:
    """Vertices ``(vid, seg_id)`` and edges ``(src, dst, mult)`` with lazily derived components."""

    def __init__(self, vertices: DataFrame, edges: DataFrame, directed: bool = False):
        missing = {"vid", "seg_id"} - set(vertices.columns) | ({"src", "dst"} - set(edges.columns))
        if missing:
            raise ValueError(f"graph lacks the columns {sorted(missing)}")
        if "mult" not in edges.columns:
            edges = edges.withColumn("mult", F.lit(1).cast("bigint"))
        self.vertices, self.edges, self.directed = vertices, edges, directed
        self._components: DataFrame | None = None

    @classmethod
    def load(cls, spark: SparkSession, path: str, directed: bool = False) -> SegmentGraph:
        try:
            return cls(spark.read.parquet(f"{path}/vertices"), spark.read.parquet(f"{path}/edges"), directed)
        except Exception as exc:
            raise ValueError(f"cannot load graph: {exc}") from exc

    def save(self, path: str) -> str:
        self.vertices.write.mode("overwrite").parquet(f"{path}/vertices")
        self.edges.write.mode("overwrite").parquet(f"{path}/edges")
        note = f"Graph saved on: {datetime.now():%Y-%m-%d %H:%M:%S}"
        self.vertices.sparkSession.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/save_date_info"
        )
        return path

    def with_changes(self, changes: DataFrame) -> SegmentGraph:
        after = changelog.apply_changes(self.edges, changes, self.vertices, self.directed)
        return SegmentGraph(self.vertices, materialize(after), self.directed)

    def with_mergelist(self, mergelist: DataFrame) -> SegmentGraph:
        after = changelog.apply_mergelist(self.edges, mergelist, self.vertices, self.directed)
        return SegmentGraph(self.vertices, materialize(after), self.directed)

    @property
    def components(self) -> DataFrame:
        """``(vid, seg_id, root)`` for every vertex; root is the smallest vertex of the component."""
        if self._components is None:
            roots = connected_components(self.vertices, self.edges)
            self._components = materialize(self.vertices.select("vid", "seg_id").join(roots, "vid"))
        return self._components

    def component_sizes(self) -> DataFrame:
        return self.components.groupBy("root").agg(F.count(F.lit(1)).alias("size"))

    def component_of(self, seg_id: int) -> DataFrame:
        """All segment ids connected to ``seg_id``."""
        own = self.components.where(F.col("seg_id") == seg_id).agg(F.max_by("root", "vid")).first()[0]
        if own is None:
            raise ValueError(f"segment {seg_id} is not in the graph")
        return self.components.where(F.col("root") == own).select("seg_id").distinct()

    def lookup(self, prefixed: bool = True) -> DataFrame:
        """``(seg_id, label)``: component number by smallest vertex, optionally prefixed."""
        numbered = materialize(with_index(self.component_sizes(), ["root"], "component"))
        label = prefixed_label(F.col("component"), numbered.count()) if prefixed else F.col("component")
        # of several vertices with one segment id, the last decides
        owner = self.components.groupBy("seg_id").agg(F.max_by("root", "vid").alias("root"))
        table = numbered.select("root", "size", label.alias("label"))
        return lookup_join(owner, table, "root", weight="size").select("seg_id", "label")

    def size_histogram(self) -> DataFrame:
        return self.component_sizes().groupBy("size").agg(F.count(F.lit(1)).alias("components"))

    def statistics(self) -> DataFrame:
        """One row: vertices, edges, components, largest component, density."""
        shape = self.component_sizes().agg(
            F.coalesce(F.sum("size"), F.lit(0)).alias("num_vertices"),
            F.count(F.lit(1)).alias("num_components"),
            F.coalesce(F.max("size"), F.lit(0)).alias("largest_component_size"),
        )
        edges = self.edges.agg(F.coalesce(F.sum("mult"), F.lit(0)).alias("num_edges"))
        v, e = F.col("num_vertices").cast("double"), F.col("num_edges").cast("double")
        density = F.when(v > 1, 2 * e / (v * (v - 1))).otherwise(0.0)
        one = F.lit(1).alias("_one")
        return shape.select("*", one).join(edges.select("*", one), "_one").select(
            "num_vertices", "num_edges", "num_components", "largest_component_size", density.alias("density")
        )

    def isolated(self) -> DataFrame:
        """Segment ids of vertices without any edge; a self-loop counts as an edge."""
        ends = self.edges.select(F.explode(F.array("src", "dst")).alias("vid")).distinct()
        return self.vertices.join(ends, "vid", "left_anti").select("seg_id")
