"""Packing by power-of-two decomposition.

A document of ``n`` ids becomes pieces of binary length: as many of ``max_length`` as fit, then one for each bit that is
set in the rest, the largest first. Every piece is a sequence of its own, so no sequence crosses documents and none
needs padding; batches are made of one bucket of equal lengths. All work is one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import slices, small_batches, texts
from .subwords import TOKENIZER, encoder

MAX_LENGTH = 2048
END_ID = 1
_SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> np.ndarray:
    """All ids end to end, each text followed by ``end_id``."""
    out = np.full(len(ids) + len(lengths), end_id, ids.dtype)
    body = np.ones(len(out), bool)
    body[np.cumsum(lengths + 1) - 1] = False
    out[body] = ids
    return out


def binary_pieces(lengths: np.ndarray, max_length: int = MAX_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(text index, piece length) of all pieces, in the order of their ids."""
    bits = 1 << np.arange(max_length.bit_length() - 1)[::-1]
    counts = np.concatenate([(lengths // max_length)[:, None], (lengths[:, None] & bits) > 0], axis=1).astype(np.int64)
    owner = np.repeat(np.arange(len(lengths)), counts.sum(axis=1))
    kinds = np.tile(np.concatenate([[max_length], bits]), len(lengths))
    return owner, np.repeat(kinds, counts.ravel())


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", max_length: int = MAX_LENGTH, end_id: int = END_ID, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per sequence: ``doc_id, start, length, doc_tokens, ids, bucket, sequence_id, offset``.

    ``ids`` holds little-endian unsigned 32-bit ids, ``bucket`` is the binary logarithm of ``length``. The last four
    bits of ``sequence_id`` are the bucket, so sequences of one length can be told by their ids.
    A null or empty text is a document of the end id alone. Repeated rows are packed once each. Rows with a null key
    are packed like others. Other columns of ``docs`` are ignored. ``max_length`` must be a power of two.
    """
    if max_length < 1 or max_length & (max_length - 1) or max_length > 1 << 15:
        raise ValueError("max_length must be a power of two, 2**15 at most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, lengths = encoder(tokenizer).encode(texts(batch.column("text")))
            ids, lengths = with_end(ids, lengths, end_id).astype("<u4"), lengths + 1
            owner, sizes = binary_pieces(lengths, max_length)
            ends = np.cumsum(sizes)
            offsets = np.concatenate([[0], ends * 4]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner)),
                    pa.array(ends - sizes - (np.cumsum(lengths) - lengths)[owner]),
                    pa.array(sizes),
                    pa.array(lengths[owner]),
                    pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "ids"],
            )

    small_batches(docs.sparkSession)
    pieces = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, _SCHEMA)
    bucket = F.log2("length").cast("int")
    return pieces.withColumn("bucket", bucket).withColumn("sequence_id", F.monotonically_increasing_id() * 16 + bucket).withColumn("offset", F.lit(0).cast("bigint"))


def digest(packed: DataFrame) -> DataFrame:
    """The packed rows with a checksum in place of the ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
