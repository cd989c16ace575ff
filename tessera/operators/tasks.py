"""Chunk work as DataFrames: pending tasks, per-chunk kernels, task log, retry list."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The wording of the chunk error log.
ERROR_MARKERS = ("Error processing chunk", "Failed to load segment")
SLICE = r"slice\((\d+), (\d+), None\)"
SLICES = rf"\[{SLICE}, {SLICE}, {SLICE}\]"

LOG_SCHEMA = "task_id bigint, status string, error string, seconds double"
DONE, FAILED = "completed", "failed"


def latest_status(task_log: DataFrame) -> DataFrame:
    """One row per task: completed once it completed in any attempt, else failed."""
    return task_log.groupBy("task_id").agg(F.min("status").alias("status"), F.max("error").alias("error"))


def pending(tasks: DataFrame, task_log: DataFrame, task_id: str = "chunk_id") -> DataFrame:
    """Tasks without a completed entry in the log; failed ones count as pending."""
    done = task_log.where(F.col("status") == DONE).select(F.col("task_id").alias(task_id)).distinct()
    return tasks.join(done, task_id, "left_anti")


def failed(tasks: DataFrame, task_log: DataFrame, task_id: str = "chunk_id") -> DataFrame:
    """Tasks whose attempts have all failed."""
    bad = latest_status(task_log).where(F.col("status") == FAILED).select(F.col("task_id").alias(task_id))
    return tasks.join(bad, task_id, "left_semi")


def summary(tasks: DataFrame, task_log: DataFrame, task_id: str = "chunk_id") -> DataFrame:
    """Totals over the tasks: all, completed, failed, not started."""
    status = latest_status(task_log).withColumnRenamed("task_id", task_id)
    joined = tasks.select(task_id).join(status, task_id, "left")
    return joined.agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.count_if(F.col("status") == DONE).alias("completed_tasks"),
        F.count_if(F.col("status") == FAILED).alias("failed_tasks"),
        F.count_if(F.col("status").isNull()).alias("pending_tasks"),
    )


def run_tasks(tasks: DataFrame, work: Callable[[dict], None], retries: int = 3, task_id: str = "chunk_id") -> DataFrame:
    """Run ``work(row)`` for every task row on the executors; returns log rows.

    A task that raises is tried up to ``retries`` times in place and then logged as
    failed, so one bad chunk does not stop the others. Append the result to the
    task log; ``pending`` and ``failed`` give the rows of the next run.
    """

    def attempt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                started, error = time.monotonic(), None
                for _ in range(max(1, retries)):
                    try:
                        work(row)
                        error = None
                        break
                    except Exception as exc:  # the log is the place where failures surface
                        error = f"{type(exc).__name__}: {exc}"
                rows.append((row[task_id], FAILED if error else DONE, error, time.monotonic() - started))
            yield pd.DataFrame(rows, columns=["task_id", "status", "error", "seconds"])

    return tasks.mapInPandas(attempt, LOG_SCHEMA)


def map_blocks(
    blocks: DataFrame, kernels: dict[str, Callable[..., np.ndarray]] | Callable[..., np.ndarray], **options
) -> DataFrame:
    """Apply array kernels to every block (``idx, starts, shape, dtype, data``).

    One kernel replaces the block; a dict gives one output column pair per name.
    A block's output keeps its shape unless the kernel changes it; the output type
    is whatever the kernel returns.
    """
    many = kernels if isinstance(kernels, dict) else {"": kernels}
    columns = [
        f"{prefix}{column} {kind}"
        for name in many
        for prefix in [f"{name}_" if name else ""]
        for column, kind in (("shape", "array<bigint>"), ("dtype", "string"), ("data", "binary"))
    ]
    schema = "idx array<bigint>, starts array<bigint>, " + ", ".join(columns)

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for block in frame.itertuples(index=False):
                array = np.frombuffer(block.data, dtype=block.dtype).reshape([int(n) for n in block.shape])
                row = [block.idx, block.starts]
                for kernel in many.values():
                    result = np.ascontiguousarray(kernel(array, **options))
                    row += [list(result.shape), result.dtype.name, result.tobytes()]
                rows.append(row)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ["idx x", "starts x", *columns]])

    return blocks.select("idx", "starts", "shape", "dtype", "data").mapInPandas(apply, schema)


def retry_list(log_lines: DataFrame) -> DataFrame:
    """Chunk ranges of the failed chunks named in an error log (column ``value``)."""
    line = F.col("value")
    marked = F.lit(False)
    for marker in ERROR_MARKERS:
        marked = marked | line.contains(marker)
    bound = lambda g: F.regexp_extract(line, SLICES, g).cast("bigint")
    names = ["a0", "a1", "b0", "b1", "c0", "c1"]
    return log_lines.where(marked & line.rlike(SLICES)).select(*[bound(i + 1).alias(n) for i, n in enumerate(names)])


@contextmanager
def timed(label: str, report: Callable[[str], None] = print):
    started = time.monotonic()
    try:
        yield
    finally:
        report(f"{label}: {time.monotonic() - started:.2f} s")
