"""Connected components with DataFrame functions only, for keys of any ordered type.

Alternating large-star and small-star steps (Kiveris et al., SoCC 2014). A key with many edges is no bottleneck: its
minimum is a partial aggregate, and the join that follows is one that adaptive execution splits by rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, root)`` for every key with an edge to another one; the root is the smallest key of the component."""
    measures = (F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"))
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    current, seen = materialize(pairs, *measures)
    while seen["n"]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        current, found = materialize(small, *measures)
        if (found["n"], found["h"]) == (seen["n"], seen["h"]):
            break
        seen = found
    roots = current.select(F.col("v").alias("id")).distinct().withColumn("root", F.col("id"))
    return current.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)
