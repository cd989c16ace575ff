"""Removal of long repeated strings: every byte inside a ``length``-byte string that also starts anywhere else.

The method asked for, a suffix array by difference cover, moves a row for each byte of the corpus several times; see the
README for what that costs. This operator gives the same result by names instead of ranks:

1. Anchors. Of the ``length`` bytes from each start, the 32-byte piece with the smallest hash is the anchor; equal strings
   have equal anchors. Consecutive starts with one anchor are a run, about one for every 85 bytes. Only runs whose
   anchor occurs elsewhere can hold repeated strings.
2. Runs whose whole context occurs twice are repeated as they are. Where one anchor has several contexts, one run
   of each is looked at closer; all others are settled.
3. The strings of these runs get 64-bit names, and names are sorted and compared with their neighbours.

In 2 and 3 names travel in packed arrays, one row per slice of the corpus and bucket of names. A slice settles what
repeats inside it and sends each name once, so a string that fills the corpus weighs no more than one name per slice.
Copies of a text have one key, and its runs are made distinct wherever they meet, so they do not add up over copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .bytetext import Prefix, Texts, mix, slices, small_batches, texts

LENGTH = 200
_PIECE = 32
_SLICE = 1 << 20
# Bucket sizes, in names.
_BUCKET = 1 << 19
# Flags of a run: its starts are repeated; its strings are to be compared, and count once or as repeated already.
_REPEATED, _ONCE, _MANY = 1, 2, 4
_SETTLED = 255  # the weight of elements that need no comparison any more
_PACKED = "bucket int, docs binary, doc binary, name binary, context binary, start binary, size binary, weight binary"
# n_open: strings of the runs that are still to be compared.
_RUNS = "k1 bigint, k2 bigint, runs binary, n_open bigint"
# Runs of many documents in one row, as buckets hand them on.
_GATHERED = "part int, docs binary, counts binary, runs binary"
_REMOVED = T.StructType().add("n_bytes", "long").add("spans", T.ArrayType(T.StructType().add("start", "long").add("end", "long"))).add("kept", "binary")
_RUN = np.dtype([("start", "<u4"), ("size", "<u4"), ("flag", "<u4")])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    rows = -(-len(x) // width)
    padded = np.full(rows * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(x) - width + 1], ahead[width - 1 : len(x)])


def anchor_runs(data: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, first start in the text, starts, anchor name, context name) of every run of starts with one anchor."""
    piece = min(_PIECE, length)
    found = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2]
    if len(data) >= length:
        for low in range(0, len(data) - length + 1, _SLICE):
            part = data[low : low + _SLICE + length - 1]
            prefix = Prefix(part)
            count = len(part) - piece + 1
            names = (prefix.sums[piece:] - prefix.sums[:count]) * prefix.inverse[:count]
            # 40 bits of hash, then the place: the smallest is the leftmost of equal ones
            keys = (mix(names) >> np.uint64(24) << np.uint64(24)) | np.arange(count, dtype=np.uint64)
            where = (_sliding_min(keys, length - piece + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
            start = np.arange(len(where))
            owner = np.searchsorted(end, start + low, side="right")
            fits = start + low + length <= end[owner]
            opens = fits.copy()
            opens[1:] &= (where[1:] != where[:-1]) | (owner[1:] != owner[:-1])
            first = np.flatnonzero(opens)
            last = np.append(first[1:], len(where))
            ends = np.concatenate([[0], np.cumsum(fits)])
            size = ends[last] - ends[first]
            anchor = where[first]
            context = prefix.hashes(first, first + size + length - 1)
            context = mix(context ^ mix((anchor - first).astype(np.uint64) << np.uint64(32) | size.astype(np.uint64)))
            found.append((owner[first], first + low - begin[owner[first]], size, mix(~names[anchor]), context))  # mix(names[anchor]) is small, being a minimum
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _pack(docs: np.ndarray, doc, name, context, start, size, weight, buckets: int) -> Iterator[tuple]:
    """Elements as one row per bucket; negative buckets hold what is settled already."""
    if not len(name):
        return
    bucket = ((name >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    if weight[0] == _SETTLED:
        bucket[:] = -1 - bucket[0]
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=bucket.min() - 1))
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        rows = order[a:b]
        present, local = np.unique(doc[rows], return_inverse=True)
        yield (
            int(bucket[rows[0]]), docs[present].tobytes(), local.astype("<u4").tobytes(), name[rows].tobytes(), context[rows].tobytes(),
            np.diff(start[rows].astype("<u4"), prepend=np.uint32(0)).tobytes(), size[rows].astype("<u4").tobytes(), weight[rows].astype(np.uint8).tobytes(),
        )


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32() if n == "bucket" else pa.binary() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


_PACKED_NAMES = ["bucket", "docs", "doc", "name", "context", "start", "size", "weight"]


def _locally(name: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first element of each distinct (name, context), whether it occurs again) and that of every element."""
    order = np.lexsort((context, name))
    new = np.ones(len(order), bool)
    new[1:] = (name[order][1:] != name[order][:-1]) | (context[order][1:] != context[order][:-1])
    group = np.cumsum(new) - 1
    many = np.bincount(group, minlength=1)[group] > 1 if len(order) else np.zeros(0, bool)
    first, again = np.zeros(len(order), bool), np.zeros(len(order), bool)
    first[order[new]] = True
    again[order] = many
    return first, again


def _united(doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a run at its start, size) of each stretch of starts that runs of one document cover, by document and start."""
    order = np.lexsort((start, doc))
    base = doc[order].astype(np.int64) << 33  # more than any end
    begin = base + start[order]
    end = np.maximum.accumulate(begin + size[order])
    opens = np.ones(len(order), bool)
    opens[1:] = begin[1:] > end[:-1]
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(order))[: len(first)] - 1
    return order[first], end[last] - begin[first]


def _distinct(doc: np.ndarray, start: np.ndarray, size: np.ndarray, flag: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, start, size, flag) without what copies of a text have said already."""
    plain = np.flatnonzero(flag == _REPEATED)
    at, whole = _united(doc[plain], start[plain], size[plain])
    at = plain[at]
    others = np.unique(np.stack([x.astype(np.int64) for x in (doc, start, size, flag)], axis=1)[flag != _REPEATED], axis=0)
    found = np.concatenate([np.stack([doc[at].astype(np.int64), start[at], whole, flag[at]], axis=1), others])
    return tuple(found[np.lexsort((found[:, 1], found[:, 0]))].T)


def _keys(docs: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct document keys, and the key of each element."""
    keys, back = np.unique(docs, axis=0, return_inverse=True)
    return keys, back.ravel()[doc]


def _settle(docs, doc, name, context, start, size, weight, buckets) -> Iterator[tuple]:
    """Packed rows of a slice: repeats inside it are settled, and each distinct name goes on once."""
    docs, doc = _keys(docs, doc)
    first, again = _locally(name, context)
    settled = np.flatnonzero(again & (weight == 1))
    if len(settled):
        # runs that follow each other in a text are one, and so are those of its copies
        a, whole = _united(doc[settled], start[settled], size[settled])
        a = settled[a]
        yield from _pack(docs, doc[a], name[a], context[a], start[a], whole, np.full(len(a), _SETTLED), buckets)
    yield from _pack(docs, doc[first], name[first], context[first], start[first], size[first], np.where(again[first], 2, weight[first]), buckets)


def _gather(docs: np.ndarray, doc: np.ndarray, start: np.ndarray, size: np.ndarray, flag: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row per part of the document keys with the distinct runs of its documents."""
    docs, doc = _keys(docs, doc)
    doc, start, size, flag = _distinct(doc, start, size, flag)
    part = (docs[doc, 0] % parts).astype(np.int64)
    order = np.lexsort((start, doc, part))
    part, doc = part[order], doc[order]
    runs = np.zeros(len(order), _RUN)
    runs["start"], runs["size"], runs["flag"] = start[order], size[order], flag[order]
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    rows = []
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        first = np.flatnonzero(np.diff(doc[a:b], prepend=-1))
        rows.append((int(part[a]), docs[doc[a:b][first]].tobytes(), np.diff(np.append(first, b - a)).astype("<u4").tobytes(), runs[a:b].tobytes()))
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["part", "docs", "counts", "runs"])


def _by_doc(gathered: DataFrame, parts: int) -> DataFrame:
    """One row per document with all its distinct runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "part"):
            docs = np.concatenate([np.frombuffer(r["docs"], "<i8").reshape(-1, 2) for r in rows])
            counts = np.concatenate([np.frombuffer(r["counts"], "<u4") for r in rows])
            runs = np.concatenate([np.frombuffer(r["runs"], _RUN) for r in rows])
            keys, owner = _keys(docs, np.repeat(np.arange(len(docs)), counts))
            owner, *columns = _distinct(owner, runs["start"], runs["size"], runs["flag"])
            border = np.searchsorted(owner, np.arange(len(keys) + 1))
            runs = np.zeros(len(owner), _RUN)
            runs["start"], runs["size"], runs["flag"] = columns
            each = [runs[a:b] for a, b in zip(border[:-1], border[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([r.tobytes() for r in each], pa.binary()), pa.array([int(_open(r)["size"].sum()) for r in each], pa.int64())],
                names=["k1", "k2", "runs", "n_open"],
            )

    return gathered.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, _RUNS)


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows with one key, which come together."""
    held: list[dict] = []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}
            if held and row[key] != held[0][key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _open(runs: np.ndarray) -> np.ndarray:
    """The runs whose strings are to be compared."""
    return runs[(runs["flag"] & (_ONCE | _MANY)) > 0]


def _decide(packed: DataFrame, strings: bool, buckets: int, parts: int) -> DataFrame:
    """Runs, by document, after the names of each bucket have been sorted and compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "bucket"):
            docs = np.concatenate([np.frombuffer(r["docs"], "<i8").reshape(-1, 2) for r in rows])
            base = np.cumsum([0, *(len(r["docs"]) // 16 for r in rows)])
            doc = np.concatenate([np.frombuffer(r["doc"], "<u4") + b for r, b in zip(rows, base, strict=False)]).astype(np.int64)
            name, context = (np.concatenate([np.frombuffer(r[c], "<u8") for r in rows]) for c in ("name", "context"))
            start = np.concatenate([np.cumsum(np.frombuffer(r["start"], "<u4"), dtype=np.uint32) for r in rows])
            size = np.concatenate([np.frombuffer(r["size"], "<u4") for r in rows])
            weight = np.concatenate([np.frombuffer(r["weight"], np.uint8) for r in rows])
            if rows[0]["bucket"] < 0:
                yield _gather(docs, doc, start, size, np.full(len(doc), _REPEATED), parts)
                continue
            order = np.lexsort((context, name))
            n, c = name[order], context[order]
            new_name = np.ones(len(order), bool)
            new_name[1:] = n[1:] != n[:-1]
            new = new_name.copy()
            new[1:] |= c[1:] != c[:-1]
            group = np.cumsum(new) - 1
            total = np.bincount(group, weights=weight[order])[group]
            flag = np.where((total >= 2) & (weight[order] == 1), _REPEATED, 0)
            if not strings:
                # one run of each context of an anchor that has several
                contexts = np.bincount(np.cumsum(new_name) - 1, weights=new)[np.cumsum(new_name) - 1]
                flag = flag | np.where(new & (contexts > 1), np.where(total >= 2, _MANY, _ONCE), 0)
            keep = flag > 0
            picked = order[keep]
            if len(picked):
                yield _gather(docs, doc[picked], start[picked], size[picked], flag[keep], parts)

    decided = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, _GATHERED)
    return _by_doc(decided, parts)


def _keyed(docs: DataFrame) -> DataFrame:
    """With a key of the text: its hashes by two functions, and its length. Equal texts fare equally."""
    text = F.coalesce("text", F.lit(""))
    short = F.hash(text).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    return docs.withColumn("k1", F.xxhash64(text)).withColumn("k2", F.shiftleft(short, 31).bitwiseXOR(F.octet_length(text).cast("bigint")))


def _compressed(keyed: DataFrame) -> DataFrame:
    """With the bytes of the text compressed, as texts are what a shuffle weighs most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=3, write_checksum=False)
        for batch in slices(batches, limit=_SLICE):
            packed = [coder.compress((x or "").encode()) for x in batch.column("text").to_pylist()]
            columns = [pa.array(packed, pa.binary()) if n == "text" else c for n, c in zip(batch.schema.names, batch.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    schema = T.StructType([T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in keyed.schema.fields])
    return keyed.mapInArrow(run, schema)


def _restored(column: pa.Array) -> Texts:
    coder = zstandard.ZstdDecompressor()
    each = [coder.decompress(x) for x in column.to_pylist()]
    ends = np.cumsum([len(x) for x in each], dtype=np.int64)
    return Texts(np.frombuffer(b"".join(each), np.uint8), ends - [len(x) for x in each], ends, np.zeros(len(each), bool))


def repeated_runs(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """``k1, k2, runs, n_open``: the runs of starts of repeated strings, in two rows per text key at most."""
    long = keyed.where(F.octet_length("text") >= length).select("k1", "k2", "text")
    total = long.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(1, math.ceil(total / 85 / _BUCKET * 2))
    parts = max(1, math.ceil(total / (16 << 20)))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=_SLICE):
            t = texts(batch.column("text"))
            docs = np.stack([batch.column(k).to_numpy() for k in ("k1", "k2")], axis=1)
            doc, start, size, name, context = anchor_runs(t.data, t.start, t.end, length)
            if rows := [*_settle(docs, doc, name, context, start, size, np.ones(len(doc), np.int64), buckets)]:
                yield _batch(rows, _PACKED_NAMES)

    decided = materialize(_decide(long.mapInArrow(anchors, _PACKED), False, buckets, parts))

    open_names = decided.agg(F.sum("n_open").alias("n")).first()["n"] or 0
    buckets = max(1, math.ceil(open_names / _BUCKET))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=_SLICE // 4):
            t = _restored(batch.column("text"))
            docs = np.stack([batch.column(k).to_numpy() for k in ("k1", "k2")], axis=1)
            runs = [_open(np.frombuffer(b"".join(r), _RUN)) for r in batch.column("parts").to_pylist()]
            doc = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
            run = np.concatenate([np.zeros(0, _RUN), *runs])
            size = run["size"].astype(np.int64)
            start = np.repeat(run["start"].astype(np.int64) - (np.cumsum(size) - size), size) + np.arange(size.sum())
            weight = np.repeat(np.where(run["flag"] & _MANY, 2, 1), size)
            doc = np.repeat(doc, size)
            at = t.start[doc] + start
            name = Prefix(t.data).hashes(at, at + length)
            if rows := [*_settle(docs, doc, name, np.zeros(len(name), np.uint64), start, np.ones(len(name), np.int64), weight, buckets)]:
                yield _batch(rows, _PACKED_NAMES)

    closer = decided.where("n_open > 0").groupBy("k1", "k2").agg(F.collect_list("runs").alias("parts"))
    strings = _compressed(long).join(closer, ["k1", "k2"]).mapInArrow(names, _PACKED)
    return decided.unionByName(_decide(strings, True, buckets, parts))


def _with_runs(docs: DataFrame, length: int, text: str) -> DataFrame:
    """``row, text, parts``: the other columns, the compressed text and the repeated runs of each row of ``docs``."""
    small_batches(docs.sparkSession)
    rows = _keyed(docs.select(F.struct(*[F.col(c) for c in docs.columns if c != text]).alias("row"), F.col(text).cast("string").alias("text")))
    found = repeated_runs(rows, length).groupBy("k1", "k2").agg(F.collect_list("runs").alias("parts"))
    return _compressed(rows).join(found, ["k1", "k2"], "left").select("row", "text", "parts")


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.Array, np.ndarray, list[list[int]], list[bytes]]]:
    """(rows, their bytes, borders of the removed spans, what stays) of batches from ``_with_runs``."""
    for batch in slices(batches, limit=_SLICE // 4):
        t = _restored(batch.column("text"))
        borders, kept = [], []
        for i, parts in enumerate(batch.column("parts").to_pylist()):
            runs = np.frombuffer(b"".join(parts or []), _RUN)
            runs = runs[(runs["flag"] & _REPEATED) > 0]
            data = t.data[t.start[i] : t.end[i]]
            change = np.zeros(len(data) + 1, np.int64)
            np.add.at(change, runs["start"], 1)
            np.add.at(change, runs["start"].astype(np.int64) + runs["size"] + length - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            borders.append(np.flatnonzero(np.diff(gone, prepend=False, append=False)).tolist())
            kept.append(data[~gone].tobytes())
        yield batch.column("row"), t.end - t.start, borders, kept


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """``row, n_bytes, spans, kept``: for each row of ``docs`` its other columns, the removed spans, the bytes that stay.

    A byte is removed if a string of ``length`` bytes around it starts at two places or more of all texts, in one
    or several documents, overlapping or not. Null and empty texts have no bytes; repeated rows repeat each other.
    Columns of any name may be in ``docs``.
    """
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, n_bytes, borders, kept in _cut(batches, length):
            spans = [[{"start": a, "end": b} for a, b in zip(x[0::2], x[1::2], strict=True)] for x in borders]
            yield pa.RecordBatch.from_arrays([row, pa.array(n_bytes), pa.array(spans, span), pa.array(kept, pa.binary())], names=["row", "n_bytes", "spans", "kept"])

    joined = _with_runs(docs, length, text)
    return joined.mapInArrow(run, T.StructType([joined.schema["row"], *_REMOVED.fields]))


def without_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """``docs`` with the bytes that stay as text. Characters that a removed span cuts in two go with it.

    Texts are cut and decoded in one pass: a pass after another would hold a second Python worker for each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _, _, kept in _cut(batches, length):
            yield pa.RecordBatch.from_arrays([row, pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())], names=["row", "text"])

    joined = _with_runs(docs, length, text)
    out = joined.mapInArrow(run, T.StructType([joined.schema["row"], T.StructField("text", T.StringType())]))
    return out.select(*[F.col("text").alias(text) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])


def digest(removed: DataFrame, key: str = "doc_id") -> DataFrame:
    return removed.select(
        F.col("row").getField(key).alias(key), "n_bytes",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
