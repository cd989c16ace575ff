"""Language identification by compression.

Each language has a Zstandard raw-content dictionary, made of pieces of its labelled texts. A text is compressed with
every dictionary; the smallest result names the language. Where the two smallest are too close, the prediction is
marked as rejected.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .bytetext import small_batches

# The dictionaries are fitted on a sample: so many distinct labelled texts of each language (all, if it has fewer), chosen
# by a hash of the text, and of each a piece of at most so many characters from its first letter. Dictionaries of all languages together have at most ALL_BYTES.
SAMPLE_DOCS = 400
PIECE_CHARS = 600
DICTIONARY_BYTES = 112 << 10
ALL_BYTES = 16 << 20
# A prediction is rejected if the second smallest is less than this share larger than the smallest.
MARGIN = 0.02
_LEVEL = 6
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def _plain(text: str) -> str:
    """Lower case, all but letters and their marks one blank; empty if there is no letter."""
    plain = _OTHER.sub(" ", text.lower()).strip()
    return plain if _LETTER.search(plain) else ""


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", sample_docs: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """Raw dictionary content of each label, the most frequent label first. Rows with a null text or label are not used.

    Which texts are taken depends on hashes of their content only, so the fit depends neither on partitioning nor on
    copies. Labels whose texts have no letters are not learned.
    """
    rows = labelled.select(F.col(label).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("lang is not null and text is not null")
    rows = rows.select("lang", F.substring(F.regexp_replace("text", r"\A[^\p{L}\p{M}]++", ""), 1, PIECE_CHARS).alias("piece"), F.xxhash64("text").alias("s"), F.xxhash64("text", F.lit(1)).alias("h")).where("piece <> ''")
    distinct = rows.groupBy("lang", "s", "h").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(distinct.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d")))
    per_label = min(DICTIONARY_BYTES, ALL_BYTES // max(1, counts.count()))
    share = F.pmod("s", F.lit(1 << 30)) / float(1 << 30)
    # the sum over languages is bounded by ALL_BYTES through per_label
    wanted = max(1, min(sample_docs, per_label * sample_docs // DICTIONARY_BYTES))
    # a few more than wanted of the distinct texts (the chance of fewer is below 1e-8), of which the first are taken
    some = rows.join(counts, "lang").where(share * F.col("d") <= F.lit(wanted + 6 * wanted**0.5 + 20)).select("lang", "piece", "s", "h", "n").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("s", F.lit(1 << 30)), "s", "h"))  # a bounded number by language
    picked = some.withColumn("_place", place).where(F.col("_place") <= wanted).select("lang", "piece", "h", "n")
    pieces: dict[str, list[str]] = defaultdict(list)
    for row in sorted(picked.toArrow().to_pylist(), key=lambda r: (-r["n"], r["lang"], r["h"], r["piece"])):
        if plain := _plain(row["piece"]):
            pieces[row["lang"]].append(plain)
    return {lang: " ".join(found).encode()[:per_label] for lang, found in pieces.items()}


def predict(docs: DataFrame, model: dict[str, bytes], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` without ``text``, with ``lang_pred, score, margin, rejected``.

    ``und`` with score 0 if the text is null or has no letter, or nothing was learned. The whole text is compressed.
    ``score`` compares the two smallest sizes: 0.5 if they are equal, towards 1 as they part. Equal smallest sizes go
    to the label learned from more texts.
    """
    spark = docs.sparkSession
    small_batches(docs.sparkSession)
    shipped = spark.sparkContext.broadcast([*model.items()])
    kept = [f for f in docs.schema.fields if f.name != text]
    schema = type(docs.schema)(kept).add("lang_pred", "string").add("score", "double").add("margin", "double").add("rejected", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = [lang for lang, _ in shipped.value]
        coders = []
        for _, content in shipped.value:
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=_LEVEL)
            coders.append(zstandard.ZstdCompressor(level=_LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False))
        for batch in batches:
            found: list[tuple] = []
            for value in batch.column(text).to_pylist():
                plain = _plain(value).encode() if value and labels else b""
                if not plain:
                    found.append(("und", 0.0, 0.0, True))
                    continue
                sizes = [len(coder.compress(plain)) for coder in coders]
                best = int(np.argmin(sizes))
                second = min((s for i, s in enumerate(sizes) if i != best), default=2 * sizes[best])
                gap = (second - sizes[best]) / sizes[best]
                found.append((labels[best], float(1 / (1 + np.exp(-50 * gap))), gap, gap < margin))
            columns = [c for k, c in zip(batch.schema.names, batch.columns, strict=True) if k != text]
            new = [pa.array([x[k] for x in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)
