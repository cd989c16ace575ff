"""Folders of chunk files as a Spark data source: a sink that commits by task, and resumes.

A task writes each file in a folder of its own and moves it into place, so a repeated or speculative task does no harm.
Changes of the folder that all tasks share wait for each other; a file is one such change. When all its files are there the
task adds a list of them to ``_finished/<run>``; a job that ends well adds ``_SUCCESS``. A run that was killed leaves the
lists of its finished tasks, and the next one leaves those files out.

Paths are local ones or URIs of any file system that Arrow can open.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

SCHEMA = "name string, data binary"
_LISTS = "_finished"
_PARTIAL = "_partial"
_LIST_SCHEMA = "name string, bytes bigint"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path`` and the folder in it."""
    if "://" in path or path.startswith("file:"):
        system, folder = fs.FileSystem.from_uri(path)
        return system, folder.rstrip("/")
    return fs.LocalFileSystem(), str(path).rstrip("/")


def read_file(path: str, name: str) -> bytes | None:
    """Content of one file below ``path``, None if there is none."""
    system, folder = open_folder(path)
    try:
        with system.open_input_file(f"{folder}/{name}") as f:
            return f.read()
    except FileNotFoundError:
        return None


def write_file(system: fs.FileSystem, target: str, data: bytes) -> None:
    """Whole or not at all."""
    parent, _, name = target.rpartition("/")
    partial = f"{parent}/.{uuid.uuid4().hex}"
    try:
        stream = system.open_output_stream(partial)
    except FileNotFoundError:
        system.create_dir(parent, recursive=True)
        stream = system.open_output_stream(partial)
    with stream as f:
        f.write(data)
    system.move(partial, target)


@dataclass
class Written(WriterCommitMessage):
    files: int


class ChunkWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str):
        self.path, self.run = path, run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = open_folder(self.path)
        done, parents, own = [], set(), f"{folder}/{_PARTIAL}/{uuid.uuid4().hex}"
        system.create_dir(own, recursive=True)
        try:
            for batch in iterator:
                for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    data, parent = data.as_py(), f"{folder}/{name}".rpartition("/")[0]
                    if parent not in parents:
                        system.create_dir(parent, recursive=True)
                        parents.add(parent)
                    with system.open_output_stream(f"{own}/file") as f:
                        f.write(data)
                    system.move(f"{own}/file", f"{folder}/{name}")
                    done.append(json.dumps({"name": name, "bytes": len(data)}))
        finally:
            system.delete_dir(own)
        if done:
            write_file(system, f"{folder}/{_LISTS}/{self.run}/{uuid.uuid4().hex}.json", "\n".join(done).encode())
        return Written(len(done))

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = open_folder(self.path)
        write_file(system, f"{folder}/{_LISTS}/{self.run}/_SUCCESS", str(sum(m.files for m in messages if m)).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files of finished tasks stay, with their lists, for the next run."""


class ChunkFiles(DataSource):
    """``df.write.format("chunkfiles").mode("append").option("run", name).save(folder)`` for rows of ``name, data``."""

    @classmethod
    def name(cls) -> str:
        return "chunkfiles"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(self.options["path"], self.options.get("run", uuid.uuid4().hex))


def finished(spark: SparkSession, path: str, run: str = "*") -> DataFrame:
    """``(name, bytes)`` of the files that finished tasks have written; empty if there are none."""
    system, folder = open_folder(path)
    if system.get_file_info(f"{folder}/{_LISTS}").type == fs.FileType.NotFound:
        return spark.createDataFrame([], _LIST_SCHEMA)
    base = path.rstrip("/")
    return spark.read.schema(_LIST_SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(f"{base}/{_LISTS}" if run == "*" else f"{base}/{_LISTS}/{run}").distinct()


def save(files: DataFrame, path: str, resume: bool = False) -> DataFrame:
    """Write rows ``(name, data)`` as files below ``path``; returns ``(name, bytes)`` of all that this call finds finished.

    With ``resume``, files that an earlier run has finished are not written again; without it, its lists are removed first.
    """
    spark = files.sparkSession
    spark.dataSource.register(ChunkFiles)
    system, folder = open_folder(path)
    if not resume and system.get_file_info(f"{folder}/{_LISTS}").type != fs.FileType.NotFound:
        system.delete_dir(f"{folder}/{_LISTS}")
    rows = files.select("name", "data")
    if resume:
        rows = rows.join(finished(spark, path).select("name"), "name", "left_anti")
    rows.write.format("chunkfiles").mode("append").option("run", uuid.uuid4().hex).save(path)
    return finished(spark, path)
