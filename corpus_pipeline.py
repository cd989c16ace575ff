"""A training-data pipeline: quality rules, near duplicates, long repeats, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the docs of
the next one. All but the last keep the columns of ``documents``; each works on all that the stage before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, neardup, packing, quality, repeats
from tessera.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the base rules or the outlier test reject."""
    return quality.reject(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity 0.8 or more."""
    return neardup.deduplicate(docs, words=5, percent=80)


def long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without bytes of 200-byte strings that occur elsewhere; ``n_chars`` follows the text."""
    cut = repeats.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of which benchmark windows cover a twentieth of the words or more."""
    name = "_match"
    while name in docs.columns:
        name += "_"
    matched = decontaminate.match_windows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), name=name)
    return matched.where(~decontaminate.contaminated(name)).drop(name)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of binary length, with their ids."""
    packed = packing.pack(docs)
    return packed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("long repeats", long_repeats),
    ("decontamination", decontamination),
    ("packing", pack),
]

# Outlier estimates and subword ids have no SQL form; tests/llm holds the stages to brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
