"""Hard negatives by exact integer scores, with Four-Russians tables.

Vectors are floored to integers. Candidates are packed in blocks as bit planes: for each eight dimensions and each bit of
the two's complement, the bits of the eight components make a byte. For a block of anchors, a table holds the sums of all
256 subsets of each eight of their components; so a score is a sum of table entries chosen by a candidate's bytes, one for
each plane and eight dimensions, shifted by the plane's place and added. All scores are full and exact.

Blocks of anchors meet blocks of candidates in a join over slots. A first pass finds the positives among rows of an
anchor's label, a second one the negatives in the windows that these set. Only the best few of a block leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW_PERCENT = 50
HIGH_PERCENT = 95
# Rows of a block, so that a pair of blocks with 64 dimensions has 0.1 MB and its scores stay in the processor's cache.
CANDIDATES = 1024
ANCHORS = 128
# Candidates are dealt over slots of at most so many bytes, each of which meets all blocks of anchors.
_SLOT_BYTES = 64 << 20
_LEAST_SLOTS = 64
_BLOCK = "n int, dims int, ids binary, labels binary, body binary"
# What a task looks at together, so that memory does not grow with dimensions or windows: groups of eight dimensions, windows.
_GROUPS = 16
_WINDOWS_AT_ONCE = 64
_WINDOWS = ", owner binary, positive binary, score binary"
_EXACT = 1 << 53


def vectors(rows: DataFrame, key: str, vector: str, label: str, anchors: Column, scale: int) -> DataFrame:
    """``id, label, q, anchor``: one row for each id; of several rows with one id the least by label and vector."""
    q = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < math.inf), F.lit(False)))
    used = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite, F.lit(False)))
    used = used.select(F.col(key).cast("bigint").alias("id"), F.coalesce(anchors, F.lit(False)).alias("anchor"), F.struct(F.col(label).cast("bigint").alias("label"), q.alias("q")).alias("v"))
    return used.groupBy("id").agg(F.min("v").alias("v"), F.max("anchor").alias("anchor")).select("id", "anchor", "v.label", "v.q")


def _dense(column: pa.Array) -> np.ndarray:
    """Rows of equal width, a multiple of eight; shorter vectors go on with zeros."""
    lengths = np.asarray(column.value_lengths(), dtype=np.int64)
    flat = np.asarray(column.flatten(), dtype=np.int64)
    if len(flat) and max(-int(flat.min()), int(flat.max())) >= _EXACT:
        raise ValueError("components beyond 2**53 have no exact integer")
    out = np.zeros((len(lengths), max(8, -(-int(lengths.max(initial=0)) // 8) * 8)), np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    out[owner, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _blocks(batches: Iterator[pa.RecordBatch], size: int, body: Callable[[np.ndarray], bytes]) -> Iterator[pa.RecordBatch]:
    """Blocks of at most ``size`` rows in order of label and id."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        while sum(b.num_rows for b in held) >= size:
            table = pa.Table.from_batches(held)
            yield _block(table.slice(0, size), body)
            held = table.slice(size).to_batches()
    if sum(b.num_rows for b in held):
        yield _block(pa.Table.from_batches(held), body)


def _block(table: pa.Table, body: Callable[[np.ndarray], bytes]) -> pa.RecordBatch:
    ids, labels = (np.asarray(table.column(c), dtype="<i8") for c in ("id", "label"))
    order = np.lexsort((ids, labels))
    q = _dense(table.column("q").combine_chunks())[order]
    fields = {"n": pa.array([len(ids)], pa.int32()), "dims": pa.array([q.shape[1]], pa.int32())}
    data = {"ids": ids[order].tobytes(), "labels": labels[order].tobytes(), "body": body(q)}
    if "positive" in table.column_names:
        positive, limit = (table.column(c).combine_chunks() for c in ("positive", "limit"))
        # places of the owners in the sorted block
        place = np.repeat(np.argsort(order), np.asarray(positive.value_lengths()))
        data |= {"owner": place.astype("<i8").tobytes(), "positive": np.asarray(positive.flatten(), "<i8").tobytes(), "score": np.asarray(limit.flatten(), "<i8").tobytes()}
    fields |= {k: pa.array([v], pa.binary()) for k, v in data.items()}
    return pa.RecordBatch.from_arrays([*fields.values()], names=[*fields])


def bit_planes(q: np.ndarray) -> np.ndarray:
    """Bytes ``[plane, group of eight, row]`` of the rows' two's complement; the last plane is the sign."""
    most = max(int(q.max(initial=0)), -1 - int(q.min(initial=0)))
    bits = most.bit_length() + 1
    return np.stack([np.packbits(((q >> p) & 1).astype(np.uint8), axis=1).T for p in range(bits)])


def subset_sums(q: np.ndarray) -> np.ndarray:
    """``[group of eight, byte, row]``: sums of the components whose bits are set in the byte."""
    groups = q.reshape(len(q), -1, 8)
    most = int(np.abs(groups).sum(axis=(1, 2)).max(initial=0))  # no sum over one plane is larger
    out = np.zeros((groups.shape[1], 256, len(q)), np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)
    for bit in range(8):
        # np.packbits puts the first dimension in the highest bit
        out[:, 1 << bit : 2 << bit] = out[:, : 1 << bit] + groups[:, :, 7 - bit].T[:, None, :].astype(out.dtype)
    return out


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """``[candidate, anchor]``: a shift-add of table entries, from the sign plane down."""
    bits, groups, n = planes.shape
    groups = min(groups, sums.shape[0])  # beyond the shorter vectors all products are zero
    most = int(np.abs(sums[:, 255]).max(initial=0))
    bound = max(abs(int(sums.min(initial=0))), int(sums.max(initial=0)), most) * max(1, groups) << bits
    if bound >= 1 << 63:
        raise ValueError("scores beyond 64 bits")
    total = np.zeros((n, sums.shape[2]), np.int32 if bound < 1 << 31 else np.int64)
    # several groups of a plane in one look-up; no sum over one plane leaves the tables' type
    table = sums[:groups].reshape(groups * 256, sums.shape[2])
    at = planes[:, :groups].astype(np.intp) + np.arange(0, groups * 256, 256)[:, None]
    for p in range(bits - 1, -1, -1):
        part = table.take(at[p, :_GROUPS], axis=0, mode="clip").sum(axis=0, dtype=sums.dtype)
        for g in range(_GROUPS, groups, _GROUPS):
            part += table.take(at[p, g : g + _GROUPS], axis=0, mode="clip").sum(axis=0, dtype=sums.dtype)
        total <<= 1
        if p == bits - 1:
            total -= part
        else:
            total += part
    return total


def _read(pair: dict, side: str) -> tuple[np.ndarray, np.ndarray, bytes, int]:
    return np.frombuffer(pair[f"{side}ids"], "<i8"), np.frombuffer(pair[f"{side}labels"], "<i8"), pair[f"{side}body"], pair[f"{side}dims"]


def _planes(body: bytes, n: int, dims: int) -> np.ndarray:
    return np.frombuffer(body, np.uint8).reshape(-1, dims // 8, n)


def _best(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the ``most`` largest values of each row, the largest and first ones first; the type's least value is none."""
    none, rows = np.iinfo(values.dtype).min, np.arange(len(values))
    found = []
    for _ in range(min(most, values.shape[1])):
        place = values[rows].argmax(axis=1) if found else values.argmax(axis=1)
        there = values[rows, place] > none
        rows, place = rows[there], place[there]
        if not len(rows):
            break
        values[rows, place] = none
        found.append((rows, place))
    if not found:
        return rows[:0], rows[:0]
    row, place = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(row, kind="stable")
    return row[order], place[order]


def _positives(pair: dict, most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor id, other id, score) of each anchor's best rows of its label in the block."""
    ids, labels, body, dims = _read(pair, "c_")
    a_ids, a_labels, a_body, a_dims = _read(pair, "a_")
    planes, q = _planes(body, len(ids), dims), np.frombuffer(a_body, "<i8").reshape(len(a_ids), a_dims)
    for label in np.intersect1d(labels, a_labels):
        # a label's rows are in order of id, so that the first of equal scores is the smallest id
        c = slice(*np.searchsorted(labels, [label, label + 1]))
        a = slice(*np.searchsorted(a_labels, [label, label + 1]))
        score = np.ascontiguousarray(scores(planes[:, :, c], subset_sums(q[a])).T)
        left = np.where(ids[c] == a_ids[a][:, None], np.iinfo(score.dtype).min, score)
        anchor, candidate = _best(left, most)
        yield a_ids[a][anchor], ids[c][candidate], score[anchor, candidate].astype(np.int64)


def _negatives(pair: dict, most: int, low: int, high: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor id, positive id, positive score, other id, score) of the best rows of other labels in each positive's window."""
    ids, labels, body, dims = _read(pair, "c_")
    a_ids, a_labels, a_body, a_dims = _read(pair, "a_")
    q = np.frombuffer(a_body, "<i8").reshape(len(a_ids), a_dims)
    column, positive, limit = (np.frombuffer(pair[c], "<i8") for c in ("a_owner", "a_positive", "a_score"))
    # in order of id, so that the first of equal scores is the smallest id
    order = np.argsort(ids)
    ids, labels = ids[order], labels[order]
    score = np.ascontiguousarray(scores(_planes(body, len(order), dims)[:, :, order], subset_sums(q)).T)
    type_ = np.iinfo(score.dtype)
    score[labels == a_labels[:, None]] = type_.min
    # least and largest score of each window, in integers; windows with none are left out, and no score is the type's least
    lows, highs = -(-limit * low // 100), limit * high // 100
    fits = (lows <= highs) & (lows <= type_.max) & (highs > type_.min)
    column, positive, limit = (x[fits] for x in (column, positive, limit))
    lows, highs = (np.clip(x[fits], type_.min + 1, type_.max).astype(score.dtype)[:, None] for x in (lows, highs))
    for k in range(0, len(column), _WINDOWS_AT_ONCE):
        part = slice(k, k + _WINDOWS_AT_ONCE)
        values = score[column[part]]
        values[(values < lows[part]) | (values > highs[part])] = type_.min
        window, candidate = _best(values, most)
        window += k
        yield a_ids[column[window]], positive[window], limit[window], ids[candidate], score[column[window], candidate].astype(np.int64)


def _pairs(anchors: DataFrame, candidates: DataFrame, slots: int) -> DataFrame:
    """Each block of anchors with each block of candidates; a slot is a bounded number of the latter."""
    left = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), *[F.col(c).alias(f"a_{c}") for c in anchors.columns])
    right = candidates.select(F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int").alias("slot"), *[F.col(c).alias(f"c_{c}") for c in candidates.columns])
    return left.repartition(slots, "slot").join(right.repartition(slots, "slot"), "slot")


def _scored(pairs: DataFrame, find: Callable[[dict], Iterator[tuple[np.ndarray, ...]]], names: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                # what a pair of blocks gives leaves together
                found = [*find(batch.slice(i, 1).to_pylist()[0])]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found)], names=names)

    return pairs.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def mine(
    rows: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW_PERCENT, high: int = HIGH_PERCENT, block: int = CANDIDATES, anchor_block: int = ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``anchors`` is true.

    A score is the integer product of two vectors of ``floor(scale * x)``. An anchor's positives are its ``positives`` best
    other rows of the same label; for each, its ``negatives`` best rows of other labels with a score of ``low`` to ``high``
    percent of the positive's are returned. Equal scores go by smaller id. Every row is scored with every anchor.

    Rows with a null key, label, vector or component, or a component that is not finite, take no part. Rows that share a key
    count once (the least by label and vector). A shorter vector goes on with zeros. Labels are integers. An anchor
    without positives, a positive without negatives and an empty table give no rows. Components that as integers need
    more than 53 bits, and scores that need more than 64, are errors. Other columns of ``rows`` are ignored.
    """
    size = F.max(F.size("q") * (2 + F.log2(F.greatest(F.lit(1.0), F.array_max(F.transform("q", lambda x: F.abs(x).cast("double"))))))).alias("bits")
    table, found = materialize(vectors(rows, key, vector, label, anchors, scale), F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"), size)
    slots = max(1, min(-(-(found["n"] or 0) // block), _LEAST_SLOTS), math.ceil((found["n"] or 0) * (found["bits"] or 0) / 8 / _SLOT_BYTES))
    asked = table.where("anchor").select("id", "label", "q").repartition(max(1, (found["anchors"] or 0) // (8 * anchor_block)))
    packed = lambda q: bit_planes(q).tobytes()
    plain = lambda q: q.astype("<i8").tobytes()
    candidates = materialize(table.select("id", "label", "q").mapInArrow(lambda batches: _blocks(batches, block, packed), _BLOCK))
    blocks = materialize(asked.mapInArrow(lambda batches: _blocks(batches, anchor_block, plain), _BLOCK))

    best = _scored(_pairs(blocks, candidates, slots), lambda pair: _positives(pair, positives), ["anchor_id", "positive_id", "positive_score"])
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    best = materialize(best.withColumn("_place", place).where(F.col("_place") <= positives).drop("_place"))

    # the anchors anew, each with the windows that its positives set
    windows = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list("positive_id").alias("positive"), F.collect_list("positive_score").alias("limit"))
    asking = materialize(asked.join(windows, "id").mapInArrow(lambda batches: _blocks(batches, anchor_block, plain), _BLOCK + _WINDOWS))
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    mined = _scored(_pairs(asking, candidates, slots), lambda pair: _negatives(pair, negatives, low, high), names)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return mined.withColumn("rank", rank).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
