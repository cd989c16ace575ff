"""Session defaults and lineage-cutting tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Runtime settings the operators rely on. All of them are session-level SQL
# settings, so they may also be applied to a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # what a Python worker holds of a table of blocks is bounded by bytes, not by rows
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def build_session(app_name: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tessera-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, *metrics) -> DataFrame | tuple[DataFrame, dict]:
    """Write ``df`` once as a table in the shared folder and read it back.

    This cuts lineage durably (a lost executor loses nothing) and gives Catalyst
    true sizes for later join choices. ``metrics`` are aliased aggregates taken
    while writing, so loops get their convergence test without a second job.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark).rstrip('/')}/tessera/{uuid.uuid4().hex}"
    observation = Observation() if metrics else None
    source = df.observe(observation, *metrics) if metrics else df
    source.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    return (table, observation.get) if metrics else table


def count_metric(name: str = "n"):
    return F.count(F.lit(1)).alias(name)
