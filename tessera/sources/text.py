"""Change logs, merge lists and id lists kept as text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import with_index

LINE = ["_file", "_split", "_row"]


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, value)`` in file order, without reading the file in one task.

    Rows of one split are read in order, and splits are told apart by their offset.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row"),
        "value",
    )
    return with_index(lines, LINE, "line_no").select("line_no", "value")


def parse_changelog(lines: DataFrame) -> DataFrame:
    """``line_no, op, v1, v2`` of the lines ``line_no, value`` that are not empty."""
    part = F.split("value", "\t")
    return lines.where("length(value) > 0").select(
        "line_no",
        F.get(part, 0).alias("op"),
        F.trim(F.get(part, 1)).try_cast("bigint").alias("v1"),
        F.trim(F.get(part, 2)).try_cast("bigint").alias("v2"),
    )


def read_changelog(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``operation, id, id`` lines without a header; ids may be missing."""
    return parse_changelog(numbered_lines(spark, path))


def read_mergelist(spark: SparkSession, path: str) -> DataFrame:
    """``(sub_id, obj_id)`` of a merge list with four lines per object.

    The first line of a record reads ``object todo immutable sub sub ...``; the other
    three hold coordinates, category and comment. The last object to claim a
    sub-object gets it.
    """
    heads = numbered_lines(spark, path).where("line_no % 4 = 0")
    words = heads.select("line_no", F.split(F.trim("value"), r"\s+").alias("w"))
    subs = words.select(
        "line_no", F.get("w", 0).cast("bigint").alias("obj_id"), F.explode(F.slice("w", 4, 1 << 30)).alias("sub_id")
    )
    return subs.groupBy(F.col("sub_id").cast("bigint").alias("sub_id")).agg(F.max_by("obj_id", "line_no").alias("obj_id"))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Whitespace-separated integers, without duplicates."""
    words = spark.read.text(path).select(F.explode(F.split(F.trim("value"), r"\s+")).alias("w")).where("w <> ''")
    return words.select(F.col("w").cast("bigint").alias("seg_id")).distinct()
