"""Lookups on dense blocks: the distinct ids of a block are looked up, never its cells.

A lookup whose size has been proven small goes to every task as two sorted arrays, and blocks are translated where they
are read: one scan, no exchange, any number of outputs. Beyond that size each block is coded once (distinct ids, and
the narrowest codes that tell them apart), the distinct ids of all blocks are joined to the lookup, and each block gets
the values of its own ids back. What moves then is an entry for each id of a block and a byte or two for each cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..sources import chunkfiles, zarr2
from ..sources.blocks import BLOCK_ARROW, in_batches, rows_of
from ..sources.codecs import codec
from .keyed import BROADCAST_ROWS, at_most, lookup_join
from .relabel import _uint32, keep_labels
from .stencil import AXES

_LONGS = pa.list_(pa.int64())
_CODED = "idx array<bigint>, starts array<bigint>, shape array<bigint>, ids array<bigint>, code_type string, codes binary"


def coded_blocks(blocks: DataFrame) -> DataFrame:
    """``idx, starts, shape, ids, code_type, codes``: cells as positions in ``ids``, of which the first is always 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for idx, starts, shape, dtype, data in rows_of(batch):
                ids, codes = np.unique(np.frombuffer(data, dtype).astype(np.int64), return_inverse=True)
                # background leads, whether it occurs or not
                order = np.concatenate([[0], ids[ids != 0]])
                place = np.where(ids == 0, 0, np.cumsum(ids != 0))
                narrow = np.min_scalar_type(len(order) - 1)
                yield idx, starts, shape, order, narrow.name, place[codes.ravel()].astype(narrow).tobytes()

    out = pa.schema([("idx", _LONGS), ("starts", _LONGS), ("shape", _LONGS), ("ids", _LONGS), ("code_type", pa.string()), ("codes", pa.binary())])
    return blocks.select(*BLOCK_ARROW.names).mapInArrow(lambda batches: in_batches(run(batches), out), _CODED)


def _dense(values: np.ndarray, shape: list[int], dtype: str) -> tuple[list[int], str, bytes | None]:
    limits = np.iinfo(dtype)
    if len(values) and (values.min() < limits.min or values.max() > limits.max):
        raise OverflowError(f"value outside {dtype}")
    return shape, dtype, values.astype(dtype).tobytes() if values.any() else None


def translate(blocks: DataFrame, table: DataFrame, outputs: dict[str, str], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Replace the ids of ``blocks`` by columns of ``table``, each a volume of its own; all come from one scan.

    ``table`` has a unique integer ``seg_id`` and an integer column for every name in ``outputs``, which maps it to the
    stored type. Returns ``idx, starts`` and ``<name>_shape, <name>_dtype, <name>_data``. An unknown id, the background and
    NULL give 0. Where an output of a block would be all 0 its ``_data`` is NULL, since such chunks are not stored. A
    value that the type cannot hold is an error.
    """
    names = list(outputs)
    schema = "idx array<bigint>, starts array<bigint>" + "".join(f", {n}_shape array<bigint>, {n}_dtype string, {n}_data binary" for n in names)
    out = pa.schema([("idx", _LONGS), ("starts", _LONGS), *[(f"{n}_{c}", t) for n in names for c, t in (("shape", _LONGS), ("dtype", pa.string()), ("data", pa.binary()))]])
    table = table.where("seg_id is not null and seg_id <> 0").select("seg_id", *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in names])

    if at_most(table, broadcast_rows):
        known = table.orderBy("seg_id").toPandas()
        shipped = blocks.sparkSession.sparkContext.broadcast((known["seg_id"].to_numpy(), [known[n].to_numpy() for n in names]))

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            keys, values = shipped.value
            for batch in batches:
                for idx, starts, shape, dtype, data in rows_of(batch):
                    ids, codes = np.unique(np.frombuffer(data, dtype).astype(np.int64), return_inverse=True)
                    at = np.minimum(np.searchsorted(keys, ids), max(0, len(keys) - 1))
                    row = [idx, starts]
                    for name, column in zip(names, values, strict=True):
                        own = np.where(keys[at] == ids, column[at], 0) if len(keys) else np.zeros(len(ids), np.int64)
                        row += _dense(own[codes.ravel()], shape, outputs[name])
                    yield tuple(row)

        return blocks.select(*BLOCK_ARROW.names).mapInArrow(lambda batches: in_batches(look_up(batches), out), schema)

    coded = materialize(coded_blocks(blocks))
    entries = coded.select("idx", F.posexplode("ids").alias("at", "seg_id")).where("seg_id <> 0")
    found = lookup_join(entries, table, "seg_id", "inner", broadcast_rows=broadcast_rows)
    # a block has no more ids than cells
    values = materialize(found.groupBy("idx").agg(F.collect_list("at").alias("at"), *[F.collect_list(n).alias(n) for n in names]))

    def put_back(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for idx, starts, shape, ids, kind, data, at, *found in rows_of(batch):
                codes, row = np.frombuffer(data, kind), [idx, starts]
                for i, name in enumerate(names):
                    own = np.zeros(len(ids), np.int64)
                    if at is not None:
                        own[at] = found[i]
                    row += _dense(own[codes], shape, outputs[name])
                yield tuple(row)

    joined = coded.join(values, "idx", "left").select("idx", "starts", "shape", "ids", "code_type", "codes", "at", *names)
    return joined.mapInArrow(lambda batches: in_batches(put_back(batches), out), schema)


def one_output(translated: DataFrame, name: str) -> DataFrame:
    """The blocks of one output of ``translate`` that hold anything."""
    return translated.where(F.col(f"{name}_data").isNotNull()).select("idx", "starts", *[F.col(f"{name}_{c}").alias(c) for c in ("shape", "dtype", "data")])


def relabel_blocks(blocks: DataFrame, lookup: DataFrame, valid: DataFrame | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``translate`` with the output ``label``, and with ``filtered`` (labels in ``valid``, else 0) if ``valid`` is given."""
    table = lookup.select("seg_id", _uint32(F.coalesce(F.col("label").cast("bigint"), F.lit(0))).alias("label"))
    if valid is None:
        return translate(blocks, table, {"label": "uint32"}, broadcast_rows)
    return translate(blocks, keep_labels(table, valid), {"label": "uint32", "filtered": "uint32"}, broadcast_rows)


def keep_blocks(blocks: DataFrame, valid: DataFrame, dtype: str = "uint32", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``translate`` with the output ``filtered``: a cell's own value if it is in ``valid`` (one column), else 0."""
    ids = valid.select(F.col(valid.columns[0]).cast("bigint").alias("seg_id")).distinct()
    return translate(blocks, ids.withColumn("filtered", F.col("seg_id")), {"filtered": dtype}, broadcast_rows)


def mask_blocks(blocks: DataFrame, ids: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``translate`` with the output ``mask``: 1 where the id is in the list and not 0, else 0."""
    table = ids.select(F.col(ids.columns[0]).cast("bigint").alias("seg_id")).distinct()
    return translate(blocks, table.withColumn("mask", F.lit(1)), {"mask": "uint8"}, broadcast_rows)


def ids_at(points: DataFrame, path: str) -> DataFrame:
    """``(z, y, x, seg_id)`` for the distinct ``points`` (``z, y, x``) that lie inside the array at ``path``.

    Points meet in the chunk that holds them and only those chunks are opened, each once; absent chunks hold 0.
    """
    meta = zarr2.read_meta(path)
    shape, chunks, order = meta["shape"], meta["chunks"], meta.get("order", "C")
    dtype, separator = np.dtype(meta["dtype"]), meta.get("dimension_separator", ".")
    decode, _ = codec(meta.get("compressor"), dtype.itemsize)
    inside = F.lit(True)
    for a, n in zip(AXES, shape, strict=True):
        inside = inside & F.col(a).between(0, n - 1)
    keyed = points.select(*[F.col(a).cast("bigint").alias(a) for a in AXES]).where(inside).distinct()
    keyed = keyed.select(*AXES, *[F.floor(F.col(a) / F.lit(c)).alias(f"_b{a}") for a, c in zip(AXES, chunks)])

    def look(found: pa.Table) -> pa.Table:
        idx = [found.column(f"_b{a}")[0].as_py() for a in AXES]
        content = chunkfiles.read_file(path, separator.join(map(str, idx)))
        coords = [found.column(a) for a in AXES]
        values = np.zeros(found.num_rows, np.int64)
        if content is not None:
            cells = np.frombuffer(decode(content), dtype=dtype).reshape(chunks, order=order)
            values = cells[tuple(c.to_numpy() - i * n for c, i, n in zip(coords, idx, chunks))].astype(np.int64)
        return pa.table([*coords, pa.array(values)], names=[*AXES, "seg_id"])

    return keyed.groupBy(*[f"_b{a}" for a in AXES]).applyInArrow(look, "z bigint, y bigint, x bigint, seg_id bigint")
