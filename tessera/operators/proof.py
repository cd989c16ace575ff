"""The proofreading table: status filters, coordinates and point lookups."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import DEFAULT_FACTORS, downsample_point, parse_coordinate
from ..session import materialize
from .dictionary import ids_at
from .keyed import BROADCAST_ROWS, at_most, lookup_join

log = logging.getLogger(__name__)

# Sheet headers, result headers and status words of existing workbooks.
SHEET_COLUMNS = {"redmine number": "Redmine Number", "Cell Name": "Cell Name", "coordinate": "Coordinate"}
CLIENT_STATUS, CLIENT_DONE, CLIENT_RESULT = "client status", "complete", "Client Status"
QA_DONE = "QA is completed"
ZONE_RESULT = "Zone Info"
UNKNOWN = -1


def empty_table(spark: SparkSession, status_result: str = CLIENT_RESULT) -> DataFrame:
    names = [*SHEET_COLUMNS.values(), status_result, ZONE_RESULT]
    return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names))


def filter_status(
    spark: SparkSession, sheets: dict[str, DataFrame], requested: list[str], status: str, done: str, result: str
) -> DataFrame:
    """Rows whose ``status`` equals ``done`` exactly, over the requested sheets in order.

    Sheets that are missing or lack the status column are skipped with a warning;
    other missing columns become NULL. The sheet name becomes the zone.
    """
    parts = []
    for name in requested:
        sheet = sheets.get(name)
        if sheet is None:
            log.warning("sheet %r not found", name)
            continue
        if status not in sheet.columns:
            log.warning("column %r not found in sheet %r", status, name)
            continue
        cells = [
            (F.col(f"`{src}`") if src in sheet.columns else F.lit(None)).cast("string").alias(dst)
            for src, dst in SHEET_COLUMNS.items()
        ]
        parts.append(
            sheet.where(F.col(f"`{status}`") == done).select(
                *cells, F.col(f"`{status}`").alias(result), F.lit(name).alias(ZONE_RESULT)
            )
        )
    if not parts:
        log.warning("no matching rows in any sheet")
        return empty_table(spark, result)
    return reduce(DataFrame.unionByName, parts)


def filter_client(spark: SparkSession, sheets: dict[str, DataFrame], requested: list[str]) -> DataFrame:
    return filter_status(spark, sheets, requested, CLIENT_STATUS, CLIENT_DONE, CLIENT_RESULT)


def filter_qa(spark: SparkSession, sheets: dict[str, DataFrame], requested: list[str], status: str) -> DataFrame:
    """Same for the quality-assurance status; ``status`` is the header the workbook uses for it."""
    return filter_status(spark, sheets, requested, status, QA_DONE, status)


def map_coordinates(table: DataFrame, strict: bool = True) -> DataFrame:
    return table.withColumn("Mapped_Coordinates", parse_coordinate(F.col("Coordinate"), strict))


def downsample_coordinates(table: DataFrame, factors=DEFAULT_FACTORS) -> DataFrame:
    if "Mapped_Coordinates" not in table.columns:
        raise ValueError("map the coordinates first")
    point = F.col("Mapped_Coordinates")
    return table.withColumns({f"Downsampled_Coordinate_{f}": downsample_point(point, f) for f in factors})


def _wanted_points(table: DataFrame) -> DataFrame:
    point = F.col("Mapped_Coordinates")
    return materialize(table.select(*[point[a].alias(f"_{a}") for a in "zyx"]).where(F.col("_z").isNotNull()).distinct())


def _answer(table: DataFrame, found: DataFrame, lookup: DataFrame) -> DataFrame:
    """``table`` with ``target_id`` and ``label`` from ``found`` (``_z, _y, _x, target_id`` for each distinct point)."""
    labels = lookup.select(F.col("seg_id").alias("target_id"), F.col("label").cast("bigint").alias("label"))
    answers = lookup_join(found, labels, "target_id").select(
        F.struct(F.col("_x").alias("x"), F.col("_y").alias("y"), F.col("_z").alias("z")).alias("Mapped_Coordinates"),
        F.coalesce("target_id", F.lit(UNKNOWN)).cast("bigint").alias("target_id"),
        F.coalesce("label", F.lit(UNKNOWN)).cast("bigint").alias("label"),
    )
    answers = materialize(answers)
    return lookup_join(table, answers, "Mapped_Coordinates").withColumns(
        {c: F.coalesce(c, F.lit(UNKNOWN)).cast("bigint") for c in ("target_id", "label")}
    ).select(*table.columns, "target_id", "label")


def point_lookup(table: DataFrame, voxels: DataFrame, lookup: DataFrame, shape: list[int] | None = None) -> DataFrame:
    """Add ``target_id`` (the id at the mapped coordinate) and ``label``; -1 where unknown.

    With ``shape`` (z,y,x), a coordinate inside the volume but on no stored voxel is
    background (id 0); without it, only stored voxels are known. Each point is the
    only key of its cell in ``voxels``; many rows asking for one cell (a hot key)
    are answered once, on the distinct points.
    """
    cells = voxels.select(
        F.col("z").alias("_z"), F.col("y").alias("_y"), F.col("x").alias("_x"), F.col("seg_id").alias("target_id")
    )
    axes = ["_z", "_y", "_x"]
    points = _wanted_points(table)
    # few points are taken to the voxels, so that the volume is scanned but not shuffled; it is scanned once
    wanted = F.broadcast(points) if at_most(points, BROADCAST_ROWS) else points
    found = points.join(materialize(cells.join(wanted, axes)), axes, "left")
    if shape is not None:
        inside = (
            F.col("_z").between(0, shape[0] - 1)
            & F.col("_y").between(0, shape[1] - 1)
            & F.col("_x").between(0, shape[2] - 1)
        )
        found = found.withColumn("target_id", F.coalesce("target_id", F.when(inside, F.lit(0))))
    return _answer(table, found, lookup)


def point_lookup_array(table: DataFrame, path: str, lookup: DataFrame) -> DataFrame:
    """``point_lookup`` on a stored array, of which only chunks that hold a point are opened; outside it the id is unknown."""
    points = _wanted_points(table)
    here = materialize(ids_at(points.selectExpr("_z as z", "_y as y", "_x as x"), path))
    found = points.join(here.selectExpr("z as _z", "y as _y", "x as _x", "seg_id as target_id"), ["_z", "_y", "_x"], "left")
    return _answer(table, found, lookup)


def save_table(table: DataFrame, path: str) -> str:
    """Write the processed table as CSV with a header; struct points become ``(x, y, z)`` text."""
    if table.isEmpty():
        raise ValueError("no processed rows to save")
    flat = [
        F.concat(F.lit("("), F.concat_ws(", ", *[F.col(f"`{f.name}`")[a].cast("string") for a in "xyz"]), F.lit(")")).alias(f.name)
        if f.dataType.typeName() == "struct"
        else F.col(f"`{f.name}`")
        for f in table.schema.fields
    ]
    table.select(*flat).write.mode("errorifexists").option("header", True).csv(path)
    return path
