"""Near duplicates by b-bit MinHash.

Every text is a set of word shingles. Minima of 200 hash functions give 40 bands of five; texts that share a band are
candidates. Of each minimum two bits are kept and packed ("b-Bit Minwise Hashing", Li & Koenig, WWW 2010): equal pairs
of bits, corrected for chance, estimate the similarity of a candidate pair before its full sets are compared.

Texts with equal sets are one class from the start. In a band that many classes share, all are first compared with one
of them, the hub. Classes that this does not link with their hub are then compared with all others of the hub, in
blocks of bounded size: a block counts the shingles that its sets share and returns only a forest of links. So no pairs
are written out, and a group of near copies costs its strays times its size, in blocks.

A pair at the threshold 0.8 shares no band with probability (1 - 0.8**5)**40, about 1e-7, and falls below the bound on
the estimate (six standard errors under the threshold) with about 1e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import contract
from ..session import materialize
from .bytetext import LOWER, NOT_SPACE, Prefix, Texts, mix, slices, small_batches, texts, tuple_hashes, word_borders

ROWS, BANDS = 5, 40
HASHES = ROWS * BANDS
BITS = 2
_PER_WORD = 64 // BITS
_LONGS = -(-HASHES // _PER_WORD)
_RNG = np.random.default_rng(11)
_MULTIPLY = _RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
# Shingles hashed at once, so that a very long text needs no more memory than a short one.
_CHUNK = 1 << 14


def shingle_sets(t: Texts, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer than ``n`` words, but not none, has one shingle."""
    data = LOWER[t.data]
    start, end, before = word_borders(NOT_SPACE[data], t)
    words = Prefix(data).hashes(start, end)
    runs = tuple_hashes(words, n)
    out = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        elif b > a:
            out.append(mix(tuple_hashes(words[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(words[:0])
    return out


def minima(shingles: np.ndarray) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for a in range(0, len(low), _CHUNK):
        hashed = np.multiply.outer(_MULTIPLY, low[a : a + _CHUNK])
        hashed += _ADD[:, None]
        np.minimum(out, hashed.min(axis=1), out=out)
    return out


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(band hashes, packed low bits) of every set."""
    least = np.stack([minima(s) for s in sets]) if sets else np.zeros((0, HASHES), np.uint32)
    wide = mix(least.astype(np.uint64) + np.uint64(1))
    bands = np.zeros((len(sets), BANDS), np.uint64)
    for row in range(ROWS):
        bands = mix(bands + wide[:, row::ROWS])
    bands = mix(bands + np.arange(BANDS, dtype=np.uint64))
    low = np.zeros((len(sets), _LONGS * _PER_WORD), np.uint64)
    low[:, :HASHES] = (wide >> np.uint64(17)) & np.uint64((1 << BITS) - 1)
    shifts = np.arange(_PER_WORD, dtype=np.uint64) * np.uint64(BITS)
    packed = (low.reshape(-1, _LONGS, _PER_WORD) << shifts).sum(axis=2, dtype=np.uint64)
    return bands, packed


_SKETCH = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, bits array<bigint>"


def sketch(docs: DataFrame, words: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, set size, a 128-bit fingerprint of the set, band hashes and packed bits of each row."""

    def lists(rows: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel().view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(texts(batch.column("text")), words)
            bands, packed = _signatures(sets)
            a = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            b = np.array([mix(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(a), pa.array(b), lists(bands), lists(packed)],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "bits"],
            )

    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, _SKETCH)


def estimate(a: Column, b: Column) -> Column:
    """Similarity estimated from packed bits: the share of equal pairs of bits, corrected for equality by chance."""
    lanes = F.lit(0x5555555555555555)
    differ = None
    for k in range(_LONGS):
        x = a[k].bitwiseXOR(b[k])
        n = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(lanes))
        differ = n if differ is None else differ + n
    chance = 2.0**-BITS
    return ((HASHES - differ) / HASHES - chance) / (1 - chance)


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``(a, b)`` whose sizes and estimate do not rule out the threshold."""
    side = lambda s: classes.select(F.col("doc_id").alias(s), F.col("bits").alias(f"bits_{s}"), F.col("n_shingles").alias(f"n_{s}"))
    joined = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    threshold = percent / 100
    error = ((threshold + (1 - threshold) / 4) * (1 - threshold) * 0.75 / HASHES) ** 0.5 / 0.75
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return joined.where(sizes & (estimate(F.col("bits_a"), F.col("bits_b")) >= threshold - 6 * error)).select("a", "b")


def _enough(both, one, other, percent: int):
    return 100 * both >= percent * (one + other - both)


def _confirmed(pairs: DataFrame, held: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "text_b"):
                # pairs of one hub come together: its set is made once
                other = shingle_sets(texts(batch.column("text_b")), words)
                hubs = batch.column("a").to_pylist()
                firsts = [i for i, h in enumerate(hubs) if not i or h != hubs[i - 1]]
                sets = dict(zip([hubs[i] for i in firsts], shingle_sets(texts(batch.column("text_a").take(pa.array(firsts, pa.int64()))), words), strict=True))
                keep = [bool(_enough(len(np.intersect1d(sets[hub], s, assume_unique=True)), len(sets[hub]), len(s), percent)) for hub, s in zip(hubs, other, strict=True)]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(held.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    joined = joined.join(held.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


# Shingles of the sets of one block of strays, and of the sets they are compared with.
_STRAYS, _OTHERS = 1 << 16, 1 << 20


def forest(stray: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of links that connect what links between strays and any other set connect. Equal roots are connected."""
    chosen = np.flatnonzero(stray)
    if not len(chosen):  # no stray was dealt to this block: it holds no pair to compare
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate([sets[i] for i in chosen])
    of = np.repeat(np.arange(len(chosen)), sizes[chosen])
    order = np.argsort(flat, kind="stable")
    flat, of = flat[order], of[order]
    a, b = [], []
    for i, s in enumerate(sets):
        low, high = np.searchsorted(flat, s), np.searchsorted(flat, s, side="right")
        n = high - low
        shared = of[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        both = np.bincount(shared, minlength=len(chosen))
        found = np.flatnonzero((roots[chosen] != roots[i]) & _enough(both, sizes[i], sizes[chosen], percent))
        a.extend([i] * len(found))
        b.extend(chosen[found].tolist())
        if len(a) > 4 * len(sets):
            a, b = _spanning(a, b, roots)
    a, b = _spanning(a, b, roots)
    return np.array(a, np.int64), np.array(b, np.int64)


def _spanning(a: list[int], b: list[int], roots: np.ndarray) -> tuple[list[int], list[int]]:
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    kept = []
    for i, j in zip(a, b, strict=True):
        x, y = top(int(roots[i])), top(int(roots[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((i, j))
    return [i for i, _ in kept], [j for _, j in kept]


def _strays(grouped: DataFrame, held: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of classes that are not linked with their hub. ``grouped``: ``hub, doc_id, root, n_shingles, stray``."""
    sums = grouped.groupBy("hub").agg(F.sum(F.when(F.col("stray"), F.col("n_shingles"))).alias("s"), F.sum("n_shingles").alias("o"), F.count(F.lit(1)).alias("n"))
    sums = sums.where("s is not null and n > 1").select("hub", F.ceil(F.col("s") / _STRAYS).alias("s_blocks"), F.ceil(F.col("o") / _OTHERS).alias("o_blocks"))
    rows = grouped.join(sums, "hub")
    hashed = F.xxhash64("doc_id")
    s_block, o_block = F.pmod(hashed, "s_blocks"), F.pmod(hashed, "o_blocks")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    others = rows.select("hub", "doc_id", "root", F.lit(False).alias("stray"), every("s_blocks").alias("s"), o_block.alias("o"))
    strays = rows.where("stray").select("hub", "doc_id", "root", "stray", s_block.alias("s"), every("o_blocks").alias("o"))

    def run(table: pa.Table) -> pa.Table:
        sets = shingle_sets(texts(table["text"]), words)
        ids = table["doc_id"].to_numpy()
        a, b = forest(np.asarray(table["stray"]), table["root"].to_numpy(), sets, percent)
        return pa.table({"a": pa.array(np.minimum(ids[a], ids[b]), pa.int64()), "b": pa.array(np.maximum(ids[a], ids[b]), pa.int64())})

    return others.unionByName(strays).join(held, "doc_id").groupBy("hub", "s", "o").applyInArrow(run, "a bigint, b bigint")


def link(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per row of ``docs``.

    Texts are linked when their sets' intersection is at least ``percent`` per cent of their union; the component is
    the smallest ``doc_id`` reachable. Rows that share a ``doc_id`` are one document of which each text is linked (if
    their texts differ, the smallest text counts for the comparison of sets). A null or blank text has no shingles and
    is linked with nothing; a row with a null key is its own, with a null component.
    """
    small_batches(docs.sparkSession)
    plain = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    table = materialize(sketch(plain, words))
    sets = table.where("n_shingles > 0 and doc_id is not null")
    members = sets.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("class"))
    members = materialize(members)
    classes = materialize(sets.join(members.select(F.col("class").alias("doc_id")).distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("bits", "bands", "n_shingles")).alias("s")).select("doc_id", "s.*"))
    banded = classes.select("doc_id", "n_shingles", F.explode("bands").alias("band"))
    # a band's first class is the hub that all others are compared with
    shared = materialize(banded.groupBy("band").agg(F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    spokes = materialize(banded.join(shared, "band").groupBy("hub", "doc_id", "n_shingles").agg(F.max("n").alias("n")))
    # texts are dealt out by a join at every size: their share of the shuffle does not jump where a side gets small
    held = materialize(plain.join(spokes.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")))
    stars = materialize(_likely(spokes.where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")), classes, percent))
    linked = materialize(_confirmed(stars, held, words, percent))
    roots = materialize(contract(linked, "a", "b"))
    root_of = lambda name, key: roots.select(F.col("id").alias(key), F.col("root").alias(name))
    placed = spokes.where("n > 2 and doc_id <> hub").join(root_of("root", "doc_id"), "doc_id", "left").join(root_of("hub_root", "hub"), "hub", "left")
    placed = placed.withColumn("root", F.coalesce("root", "doc_id")).withColumn("stray", F.col("root") != F.coalesce("hub_root", "hub"))
    links = linked.unionByName(_strays(materialize(placed.select("hub", "doc_id", "root", "n_shingles", "stray")), held, words, percent))
    # equal keys with different texts join their classes
    doubled = sets.groupBy("doc_id").agg(F.count_distinct("set_a", "set_b", "n_shingles").alias("k")).where("k > 1").select("doc_id")
    same_key = sets.join(doubled, "doc_id", "left_semi").join(members, ["set_a", "set_b", "n_shingles"]).select(F.col("class").alias("a"), F.col("doc_id").alias("b"))
    found = materialize(contract(links.unionByName(same_key), "a", "b"))
    classed = members.join(found.select(F.col("id").alias("class"), "root"), "class", "left").select("set_a", "set_b", "n_shingles", F.coalesce("root", "class").alias("component_id"))
    known = sets.select("doc_id", "set_a", "set_b", "n_shingles").join(classed, ["set_a", "set_b", "n_shingles"]).select("doc_id", "n_shingles", "component_id")
    alone = table.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return known.unionByName(alone)


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest key.

    Of repeated rows with one key, one stays. Rows with a null key all stay.
    """
    kept = link(docs, words, percent, text, key).where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    kept = materialize(kept)
    single = kept.where("_rows = 1").select(F.col("doc_id").alias(key))
    repeated = kept.where("_rows > 1").select(F.col("doc_id").alias(key))
    # as in link, texts are dealt out by a join at every size
    once = docs.join(single.hint("merge"), key, "left_semi")
    several = docs.join(repeated, key, "left_semi").dropDuplicates([key])
    return once.unionByName(several).unionByName(docs.where(F.col(key).isNull()))
