"""Exact histogram of encoded lengths, from which totals for every context limit follow by suffix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .bytetext import slices, small_batches, texts
from .subwords import TOKENIZER, encoder

# Lengths are summed in blocks of so many; only one row per block meets in one task.
BLOCK = 1024


def histogram(docs: DataFrame, text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """``(length, n_docs)``: how many documents encode to ``length`` ids. A null or empty text has length 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in slices(batches):
            for n, k in zip(*np.unique(encoder(tokenizer).count(texts(batch.column("text"))), return_counts=True), strict=True):
                counts[int(n)] = counts.get(int(n), 0) + int(k)
        yield pa.RecordBatch.from_pydict({"length": pa.array(counts.keys(), pa.int64()), "n": pa.array(counts.values(), pa.int64())})

    small_batches(docs.sparkSession)
    local = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "length bigint, n bigint")
    return local.groupBy("length").agg(F.sum("n").alias("n_docs"))


def limits(counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """For each length that occurs, taken as a context limit, exact answers by suffix sums.

    ``docs_from, tokens_from``: documents of at least this length and their ids; ``truncated_tokens``: ids left if all
    texts are cut at this length; ``quantile``: share of documents of at most this length. Any limit between two
    lengths L1 < x < L2 keeps ``truncated(L2) - (L2 - x) * docs_from(L2)`` ids. No documents: no rows.
    """
    rows = materialize(counts.withColumn("tokens", F.col("length") * F.col("n_docs")).withColumn("block", F.floor(F.col("length") / block)))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = blocks.select("block", F.coalesce(F.sum("d").over(after), zero).alias("d_later"), F.coalesce(F.sum("t").over(after), zero).alias("t_later"))
    totals = blocks.agg(F.sum("d").alias("d_all"), F.sum("t").alias("t_all"))
    inside = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = (
        rows.withColumn("d_in", F.sum("n_docs").over(inside))
        .withColumn("t_in", F.sum("tokens").over(inside))
        .join(later, "block")
        .crossJoin(F.broadcast(totals))  # one row
        .withColumn("docs_from", F.col("d_in") + F.col("d_later"))
        .withColumn("tokens_from", F.col("t_in") + F.col("t_later"))
    )
    return out.select(
        "length", "n_docs", "docs_from", "tokens_from",
        (F.col("t_all") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("truncated_tokens"),
        ((F.col("d_all") - F.col("docs_from") + F.col("n_docs")) / F.col("d_all")).alias("quantile"),
    )
