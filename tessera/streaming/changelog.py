"""Keeping a segment graph and its components up to date while its change log grows.

The log is a folder that receives files of ``operation, id, id`` lines. What a micro-batch does to an edge is summarised
by (removals, last operation), and summaries of successive batches compose (see ``operators.changelog``). So a batch
writes the summaries of the edges it names, and the new roots of the vertices whose component it changed, and nothing
else; states are the base tables with the later deltas on top. From time to time ``compact`` writes a new base.

Every table of a batch lies in a folder named after it and is made from earlier batches only: a batch that is run again
after a failure overwrites its own result.
"""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.changelog import ADD, EDGE, REMOVE, classify, oriented, rejected, valid
from ..operators.components import connected_components, contract
from ..operators.keyed import lookup_join
from ..session import materialize
from ..sources.chunkfiles import open_folder
from ..sources.text import parse_changelog

_DELTAS = "src bigint, dst bigint, removed bigint, last string, batch bigint"
_ROOTS = "vid bigint, root bigint, batch bigint"
START = -1


def _batches(path: str) -> list[int]:
    """Numbers of the tables below ``path`` that are whole."""
    system, folder = open_folder(path)
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    names = [f.base_name.partition("=") for f in found if f.type == fs.FileType.Directory]
    return [int(n) for key, _, n in names if key == "batch" and system.get_file_info(f"{folder}/batch={n}/_SUCCESS").type == fs.FileType.File]


def _base(path: str, batch: int) -> int:
    return max((n for n in _batches(path) if n <= batch), default=START)


def _since(spark: SparkSession, path: str, schema: str, base: int, batch: int) -> DataFrame:
    """Rows of the batches after ``base`` up to ``batch``; folders of others are not read."""
    if not _batches(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).where(F.col("batch").between(base + 1, batch))


def edges_at(spark: SparkSession, graph: str, batch: int, directed: bool = False) -> DataFrame:
    """The edges ``(src, dst, mult)`` after micro-batch ``batch`` (-1: before the first)."""
    base = _base(f"{graph}/compact_edges", batch)
    edges = spark.read.parquet(f"{graph}/edges" if base == START else f"{graph}/compact_edges/batch={base}")
    if "mult" not in edges.columns:
        edges = edges.withColumn("mult", F.lit(1))
    held = oriented(edges, directed).select(*EDGE, F.col("mult").cast("bigint").alias("mult"), F.lit(0).cast("bigint").alias("removed"), F.lit(None).cast("string").alias("last"), F.lit(base).cast("bigint").alias("batch"))
    deltas = _since(spark, f"{graph}/deltas", _DELTAS, base, batch)
    if base == START and batch == START:
        return held.groupBy(*EDGE).agg(F.sum("mult").alias("mult")).where("mult > 0")
    both = held.unionByName(deltas.select(*EDGE, F.lit(0).cast("bigint").alias("mult"), "removed", "last", "batch"))
    state = both.groupBy(*EDGE).agg(F.sum("mult").alias("mult"), F.sum("removed").alias("removed"), F.max_by("last", "batch").alias("last"))
    return state.select(*EDGE, F.greatest(F.col("mult") - F.col("removed"), F.when(F.col("last") == ADD, 1).otherwise(0)).cast("bigint").alias("mult")).where("mult > 0")


def roots_at(spark: SparkSession, graph: str, batch: int) -> DataFrame:
    """``(vid, root)`` of every vertex after micro-batch ``batch``; the root is the component's smallest vertex."""
    base = _base(f"{graph}/compact_roots", batch)
    rows = spark.read.parquet(f"{graph}/compact_roots/batch={base}").select("vid", "root", F.lit(base).cast("bigint").alias("batch"))
    rows = rows.unionByName(_since(spark, f"{graph}/roots", _ROOTS, base, batch))
    return rows.groupBy("vid").agg(F.max_by("root", "batch").alias("root"))


def _write(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def compact(spark: SparkSession, graph: str, batch: int, directed: bool = False) -> None:
    """Write the state after ``batch`` as a new base, so that later states read no delta up to it."""
    edges, roots = edges_at(spark, graph, batch, directed), roots_at(spark, graph, batch)
    _write(edges, f"{graph}/compact_edges", batch)
    _write(roots, f"{graph}/compact_roots", batch)


def prepare(spark: SparkSession, graph: str, directed: bool = False) -> None:
    """Components of the graph before its first change; does nothing if they are there."""
    if START not in _batches(f"{graph}/compact_roots"):
        vertices = spark.read.parquet(f"{graph}/vertices").select("vid").distinct()
        _write(connected_components(vertices, edges_at(spark, graph, START, directed)), f"{graph}/compact_roots", START)


def _changed_roots(roots: DataFrame, after: DataFrame, gone: DataFrame, born: DataFrame) -> DataFrame:
    """``(vid, root)`` of the vertices whose root differs once the edges ``gone`` are away and the edges ``born`` are there.

    Only components that lost an edge are looked into; all others are merged by their roots.
    """
    split = materialize(lookup_join(roots, gone.select(F.col("src").alias("vid")).distinct(), "vid", "inner").select("root").distinct())
    inside = materialize(lookup_join(roots, split, "root", "inner").select("vid"))
    old_edges = after.join(born.select(*EDGE), EDGE, "left_anti")
    kept = lookup_join(old_edges.withColumnRenamed("src", "vid"), inside, "vid", "inner").select(F.col("vid").alias("src"), "dst")
    again = connected_components(inside, kept).withColumnRenamed("root", "now")
    current = materialize(lookup_join(roots, again, "vid").select("vid", "root", F.coalesce("now", "root").alias("now")))
    of = current.select("vid", F.col("now").alias("a"))
    ends = lookup_join(born.select(F.col("src").alias("vid"), "dst"), of, "vid", "inner").select("a", F.col("dst").alias("vid"))
    merged = contract(lookup_join(ends, of.withColumnRenamed("a", "b"), "vid", "inner"), "a", "b").select(F.col("id").alias("now"), F.col("root").alias("merged"))
    final = lookup_join(current, merged, "now").select("vid", "root", F.coalesce("merged", "now").alias("now"))
    return final.where("now <> root").select("vid", F.col("now").alias("root"))


def advance(batch: DataFrame, number: int, graph: str, directed: bool = False) -> None:
    """Write what the log lines ``batch`` (``line_no, op, v1, v2``) do to the state before batch ``number``."""
    spark = batch.sparkSession
    # a join with a large table of vertices reads its lines more than once, and so do the steps below
    lines = materialize(classify(materialize(batch), spark.read.parquet(f"{graph}/vertices")))
    delta = materialize(valid(lines, directed).groupBy(*EDGE).agg(F.count_if(F.col("op") == REMOVE).alias("removed"), F.max_by("op", "line_no").alias("last")))
    _write(rejected(lines), f"{graph}/rejects", number)
    _write(delta, f"{graph}/deltas", number)
    before = F.coalesce("mult", F.lit(0))
    after = F.greatest(before - F.col("removed"), F.when(F.col("last") == ADD, 1).otherwise(0))
    touched = materialize(delta.join(edges_at(spark, graph, number - 1, directed), EDGE, "left").select(*EDGE, (before > 0).alias("was"), (after > 0).alias("held")))
    gone, born = (touched.where(c).select(*EDGE) for c in ("was and not held", "held and not was"))
    roots = materialize(roots_at(spark, graph, number - 1))
    _write(_changed_roots(roots, edges_at(spark, graph, number, directed), gone, born), f"{graph}/roots", number)


def follow_changes(
    spark: SparkSession, folder: str, graph: str, checkpoint: str, directed: bool = False, files_per_batch: int | None = None, compact_every: int = 64
) -> StreamingQuery:
    """Apply new files of tab-separated ``operation, id, id`` lines to ``graph`` as they arrive.

    Files must arrive in log order, by time of change and then by name; a line's place is its file and its place there.
    Rejected lines of each batch are kept in ``graph/rejects`` with that place and the reason.
    """
    prepare(spark, graph, directed)
    reader = spark.readStream.schema("value string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    place = ("file_modification_time", "file_path", "file_block_start")
    lines = reader.text(folder).select(*[F.col(f"_metadata.{c}").alias(c) for c in place], "value")

    def take(batch: DataFrame, number: int) -> None:
        # a split is read in order by one task
        at = F.struct(*place, F.monotonically_increasing_id().alias("row")).alias("line_no")
        advance(parse_changelog(batch.select(at, "value")), number, graph, directed)
        if compact_every and number % compact_every == compact_every - 1:
            compact(batch.sparkSession, graph, number, directed)

    return lines.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
