"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of the benchmark items. For all windows of one length there is a shift table over hashed
blocks of two words: how far the search may jump when a block of the text ends at the current word. Where the jump
is 0, the block is the end of some window; the bucket of that suffix hash is looked up, and the words of the window
are compared byte by byte. The search runs in lanes: each lane walks its own stretch of the text, all lanes jump
together in NumPy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytetext import ALNUM, LOWER, Prefix, Texts, mix, per_text, slices, small_batches, texts, tuple_hashes, word_borders

WINDOW = 13
# Text bytes of benchmark items that are searched for in one pass, and hence shipped to every task at once.
BLOCK_BYTES = 16 << 20
_TABLE_BITS = 20
_LANE = 512


@dataclass
class Words:
    """Words of texts: hashes, bytes end to end, where each word's bytes begin, words before each text and in all."""

    hashes: np.ndarray
    data: np.ndarray
    at: np.ndarray
    before: np.ndarray


def words_of(t: Texts) -> Words:
    data = LOWER[t.data]
    inside = ALNUM[data]
    start, end, before = word_borders(inside, t)
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=at[1:])
    return Words(Prefix(data).hashes(start, end), data[inside], at, before)


@dataclass
class Patterns:
    """Distinct windows of one length, with their shift table, suffix buckets, words and items."""

    length: int
    block: int
    shift: np.ndarray
    suffixes: np.ndarray
    whole: np.ndarray
    first: np.ndarray
    words: Words
    item_from: np.ndarray
    items: np.ndarray


def _block_hash(hashes: np.ndarray, last: np.ndarray, block: int) -> np.ndarray:
    return hashes[last] if block == 1 else mix(mix(hashes[last - 1]) + hashes[last])


def prepare(items: Texts, window: int = WINDOW) -> list[Patterns]:
    """The windows of items, by length; items with fewer words than ``window`` are one window."""
    w = words_of(items)
    counts = np.diff(w.before)
    out = []
    for length in np.unique(np.minimum(counts[counts > 0], window)).tolist():
        owners = np.flatnonzero(counts >= window if length == window else counts == length)
        per = counts[owners] - length + 1
        owner = np.repeat(owners, per)
        first = np.repeat(w.before[owners] - (np.cumsum(per) - per), per) + np.arange(per.sum())
        whole, distinct, back = np.unique(tuple_hashes(w.hashes, length)[first], return_index=True, return_inverse=True)
        block = min(2, length)
        shift = np.full(1 << _TABLE_BITS, length - block + 1, np.int64)
        starts = first[distinct]
        for place in range(block - 1, length):
            codes = _block_hash(w.hashes, starts + place, block) >> np.uint64(64 - _TABLE_BITS)
            np.minimum.at(shift, codes.astype(np.int64), length - 1 - place)
        pairs = np.unique(np.stack([back, owner], axis=1), axis=0)
        out.append(Patterns(
            length, block, shift, np.unique(_block_hash(w.hashes, starts + length - 1, block)), whole, starts, w,
            np.searchsorted(pairs[:, 0], np.arange(len(whole) + 1)), pairs[:, 1],
        ))
    return out


def _same_bytes(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether each pair of stretches of the given lengths is equal."""
    total = int(lengths.sum())
    pair = np.repeat(np.arange(len(lengths)), lengths)
    step = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    differs = a[a_at[pair] + step] != b[b_at[pair] + step]
    return np.bincount(pair[differs], minlength=len(lengths)) == 0


def search(w: Words, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(first word, pattern) of every occurrence of a pattern inside one text."""
    none = np.zeros(0, np.int64)
    if len(w.hashes) < p.length:
        return none, none
    lanes = np.arange(p.length - 1, len(w.hashes), _LANE)
    limit = np.minimum(lanes + _LANE, len(w.hashes))
    at, found = lanes, []
    while len(at):
        code = _block_hash(w.hashes, at, p.block)
        jump = p.shift[(code >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]
        end_of_some = jump == 0
        if end_of_some.any():
            place = np.searchsorted(p.suffixes, code[end_of_some])
            known = p.suffixes[np.minimum(place, len(p.suffixes) - 1)] == code[end_of_some]
            found.append(at[end_of_some][known])
        at = at + np.maximum(jump, 1)
        going = at < limit
        at, limit = at[going], limit[going]
    first = (np.concatenate(found) if found else none) - (p.length - 1)
    # inside one text
    text = np.searchsorted(w.before, first, side="right") - 1
    first = first[first + p.length <= w.before[text + 1]]
    if not len(first):
        return none, none
    h = w.hashes[first]
    for k in range(1, p.length):
        h = mix(h) + w.hashes[first + k]
    h = mix(h)
    which = np.minimum(np.searchsorted(p.whole, h), len(p.whole) - 1)
    first, which = first[p.whole[which] == h], which[p.whole[which] == h]
    # direct comparison: same word lengths, same bytes
    theirs = p.first[which]
    offsets = np.arange(p.length + 1)
    mine_at, their_at = w.at[first[:, None] + offsets], p.words.at[theirs[:, None] + offsets]
    equal = ((mine_at - mine_at[:, :1]) == (their_at - their_at[:, :1])).all(axis=1)
    first, which, mine_at, their_at = first[equal], which[equal], mine_at[equal], their_at[equal]
    same = _same_bytes(w.data, mine_at[:, 0], p.words.data, their_at[:, 0], mine_at[:, -1] - mine_at[:, 0])
    return first[same], which[same]


def hits(w: Words, patterns: list[Patterns], spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words covered by occurrences or by the given (first, end) spans, distinct (text, item row) pairs)."""
    change = np.zeros(len(w.hashes) + 1, np.int64)
    np.add.at(change, spans[:, 0], 1)
    np.add.at(change, spans[:, 1], -1)
    pairs = [np.zeros((0, 2), np.int64)]
    for p in patterns:
        first, which = search(w, p)
        np.add.at(change, first, 1)
        np.add.at(change, first + p.length, -1)
        text = np.searchsorted(w.before, first, side="right") - 1
        seen = np.unique(np.stack([text, which], axis=1), axis=0)
        n = p.item_from[seen[:, 1] + 1] - p.item_from[seen[:, 1]]
        rows = np.repeat(p.item_from[seen[:, 1]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pairs.append(np.stack([np.repeat(seen[:, 0], n), p.items[rows]], axis=1))
    return np.cumsum(change[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0)


def _runs(covered: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, end, runs before each text and in all) of the covered runs inside each text."""
    return word_borders(covered, Texts(covered, before[:-1], before[1:], covered[:0]))


_SPAN = T.StructType().add("first", "long").add("end", "long")
MATCH = T.StructType().add("n_words", "long").add("n_hit", "long").add("spans", T.ArrayType(_SPAN)).add("items", T.ArrayType(T.StringType()))


def match_windows(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, name: str = "_match") -> DataFrame:
    """``docs`` with a struct ``name``: words, words hit, hit spans (in words), and the items that occur.

    Null or empty texts have no words. Items without words, or without an id, match nothing; rows that repeat an item
    count once. An empty benchmark hits nothing. Other columns of ``docs`` are kept; ``name`` must not be among them.

    Items are shipped to tasks in blocks of at most ``block_bytes`` of text (or one item); the documents stream through
    one pass per block, so a benchmark of any size is searched whole.
    """
    spark = docs.sparkSession
    small_batches(docs.sparkSession)
    clean = benchmark.where(F.col(item).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item).cast("string").alias("item"), F.col(item_text).cast("string").alias("text")).distinct()
    total = clean.agg(F.sum(F.octet_length("text") + 64).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // (block_bytes // 2))) if total > block_bytes else 1
    schema = T.StructType([*docs.schema.fields, T.StructField(name, MATCH)])
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])
    out = docs
    for block in range(blocks):
        part = clean.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else clean
        rows = part.toArrow()  # bounded by block_bytes
        shipped = spark.sparkContext.broadcast((rows["item"].to_pylist(), prepare(texts(rows["text"]), window)))

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped, again=block > 0) -> Iterator[pa.RecordBatch]:
            names, patterns = shipped.value
            for batch in slices(batches, text):
                w = words_of(texts(batch.column(text)))
                old = batch.column(name).to_pylist() if again else []
                spans = [(s["first"] + w.before[i], s["end"] + w.before[i]) for i, m in enumerate(old) for s in m["spans"]]
                covered, pairs = hits(w, patterns, np.array(spans, np.int64).reshape(-1, 2))
                first, end, runs_before = _runs(covered, w.before)
                n_hit = per_text(covered, w.before)
                items: list[set[str]] = [set(m["items"]) for m in old] if again else [set() for _ in range(batch.num_rows)]
                for i, k in pairs.tolist():
                    items[i].add(names[k])
                base = np.repeat(w.before[:-1], np.diff(runs_before))
                span_rows = pa.StructArray.from_arrays([pa.array(first - base), pa.array(end - base)], names=["first", "end"])
                match = pa.StructArray.from_arrays(
                    [
                        pa.array(np.diff(w.before)), pa.array(n_hit),
                        pa.ListArray.from_arrays(pa.array(runs_before.astype(np.int32)), span_rows),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ],
                    names=["n_words", "n_hit", "spans", "items"],
                ).cast(kind)
                columns = [c for k, c in zip(batch.schema.names, batch.columns, strict=True) if k != name]
                yield pa.RecordBatch.from_arrays([*columns, match], names=[*(k for k in batch.schema.names if k != name), name])

        out = out.mapInArrow(run, schema)
    return out


def contaminated(match: str = "_match", percent: int = 5):
    """Whether hit words are at least ``percent`` per cent of all words."""
    m = F.col(match)
    return (m["n_hit"] > 0) & (m["n_hit"] * 100 >= m["n_words"] * percent)
