"""Quality rules: text statistics, fixed base rules, and robust outliers per language and source.

For each language and source a minimum-covariance-determinant estimate (the mean and covariance of the half or more
of the rows whose covariance has the smallest determinant; Rousseeuw & Van Driessen, "A Fast Algorithm for the Minimum
Covariance Determinant Estimator", 1999) is found by concentration steps from two deterministic starts. Rows far from it
by Mahalanobis distance are rejected. DataFrame functions only: each step is two partial aggregates over a narrow table.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keyed import lookup_join
from ..session import materialize

_BLANK = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"
# Rows of a group that the estimate must cover, steps from each start, and rows below which a group is pooled.
COVER = 0.75
STEPS = 5
MIN_ROWS = 100
# A row is rejected when its squared distance exceeds the chi-square quantile of this probability (5 degrees).
TAIL = 1e-4
# Smallest standard deviation of each transformed statistic, in its own (logarithmic) unit; so a statistic that hardly
# varies in most rows of a group does not make small deviations look large.
FLOORS = (1.0, 0.15, 0.7, 0.7, 0.7)
_D = len(FLOORS)
_PLACE_BITS = 24
# Squared distances are counted in bins of this many per unit of their logarithm.
_BINS = 64
_BIN_LIMIT = 64 * 40


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` and with the long columns ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    Words are runs of other than ASCII white space. Null and empty texts have zero everywhere. Whole texts are used. The
    names of these columns, ``_w`` and ``_lines`` must not be in ``docs``.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    others = [F.col(c) for c in docs.columns if c != text]
    split = docs.select(
        *others,
        F.array_remove(F.split(t, _BLANK), "").alias("_w"),
        F.filter(F.split(t, r"\n"), lambda line: F.length(F.translate(line, " \t\n\x0b\f\r", "")) > 0).alias("_lines"),
        F.length(F.translate(t, " \t\n\x0b\f\r", "")).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, _SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )
    # 3-word windows: hash and the window's place in one long, so that a plain sort brings equal ones together; a place takes
    # 24 bits, or as many as the number of words needs
    bits = F.greatest(F.lit(_PLACE_BITS), F.length(F.bin(F.size("_w")))).cast("int")
    windows = F.when(
        F.size("_w") >= 3,
        F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.call_function("shiftleft", F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)), bits).bitwiseOR(i.cast("bigint"))),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        *[F.col(c) for c in docs.columns if c != text],
        "word_chars", "n_symbols", "_w",
        F.size("_w").cast("bigint").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.sort_array(windows).alias("_s"),
        bits.alias("_bits"),
    )
    alike = lambda array, same: F.filter(array, lambda x, i: same(x, F.get(array, i - 1)) | same(x, F.get(array, i + 1)))
    near = counted.withColumn("_c", alike("_s", lambda x, y: F.coalesce(F.call_function("shiftright", x, F.col("_bits")) == F.call_function("shiftright", y, F.col("_bits")), F.lit(False))))
    # equal hashes are confirmed on the words themselves
    place = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bits")) - 1).cast("int")
    exact = near.withColumn("_c", F.sort_array(F.transform("_c", lambda x: F.struct(F.concat_ws(" ", F.slice("_w", place(x) + 1, 3)).alias("w"), place(x).alias("i")))))
    places = exact.withColumn("_c", F.sort_array(F.transform(alike("_c", lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))), lambda x: x["i"])))
    covered = F.aggregate(F.transform("_c", lambda x, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), x - F.get("_c", i - 1)))), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return places.select(*[F.col(c) for c in docs.columns if c != text], "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def _vector() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    rate = lambda c: F.log1p(F.col(c) * 100 / n)
    return [F.log(n), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), rate("n_symbols"), rate("n_dup_lines"), rate("n_repeat_words")]


def chi_square(x: float, k: int) -> float:
    """P(chi-square with k degrees <= x), by the series of the incomplete gamma function."""
    a, h = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > 1e-17 * total:
        n += 1
        term *= h / n
        total += term
    return min(1.0, total * math.exp(a * math.log(h) - h - math.lgamma(a))) if h else 0.0


def chi_square_quantile(tail: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - chi_square(mid, k) > tail else (low, mid)
    return high


# Factor that makes the covariance of the innermost COVER of normal rows consistent.
_Q = chi_square_quantile(1 - COVER, _D)
_CONSISTENT = COVER / chi_square(_Q, _D + 2)


def _fine() -> Column:
    """Name of a row's language and source; a null is a value of its own."""
    return F.to_json(F.array("lang", "source"), {"ignoreNullFields": "false"})


def _groups(rows: DataFrame, min_rows: int) -> DataFrame:
    """``_fine, _g``: the group of each language and source; small ones are pooled by language, and small pools fall to all rows, ``*``.

    If there are fewer than ``min_rows`` rows in all, the group is null: there is no estimate.
    """
    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_n")).withColumn("_l", F.to_json(F.array("lang"), {"ignoreNullFields": "false"}))
    small = F.when(F.col("_n") < min_rows, F.col("_n")).otherwise(0)
    by_lang = sizes.groupBy("_l").agg(F.sum(small).alias("_n_lang"))
    rest = sizes.agg(F.sum("_n").alias("_n_all"))
    group = F.when(F.col("_n") >= min_rows, _fine()).when(F.col("_n_lang") >= min_rows, F.col("_l")).when(F.col("_n_all") >= min_rows, F.lit("*"))
    return sizes.join(by_lang, "_l").crossJoin(F.broadcast(rest)).select(_fine().alias("_fine"), group.alias("_g"))  # one row


_PAIRS = [(i, j) for i in range(_D) for j in range(i + 1)]


def _moments(rows: DataFrame) -> DataFrame:
    """``_g, _k``, means ``m*`` and covariances ``c*_*`` (with floors) of the given rows."""
    sums = rows.groupBy("_g", "_k").agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(_D)], *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in _PAIRS], F.count(F.lit(1)).alias("_n"))
    return sums.select("_g", "_k", "_n", *[f"m{i}" for i in range(_D)], *[(F.col(f"c{i}_{j}") * _CONSISTENT + (FLOORS[i] ** 2 if i == j else 0)).alias(f"c{i}_{j}") for i, j in _PAIRS])


def _factor(moments: DataFrame) -> DataFrame:
    """The estimates with the Cholesky factor ``l*_*`` of the covariance and the logarithm ``_det`` of its determinant."""
    out = moments
    for i in range(_D):
        for j in range(i + 1):
            inner = reduce(lambda a, b: a + b, [F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)], F.lit(0.0))
            value = F.sqrt(F.greatest(F.col(f"c{i}_{i}") - inner, F.lit(1e-12))) if i == j else (F.col(f"c{i}_{j}") - inner) / F.col(f"l{j}_{j}")
            out = out.withColumn(f"l{i}_{j}", value)
    det = reduce(lambda a, b: a + b, [2 * F.log(f"l{i}_{i}") for i in range(_D)])
    return out.select("_g", "_k", det.alias("_det"), *[f"m{i}" for i in range(_D)], *[f"l{i}_{j}" for i, j in _PAIRS])


def _distance(joined: DataFrame) -> DataFrame:
    """Adds the squared Mahalanobis distance ``_d2`` by forward substitution."""
    out = joined
    for i in range(_D):
        inner = reduce(lambda a, b: a + b, [F.col(f"l{i}_{k}") * F.col(f"_z{k}") for k in range(i)], F.lit(0.0))
        out = out.withColumn(f"_z{i}", (F.col(f"x{i}") - F.col(f"m{i}") - inner) / F.col(f"l{i}_{i}"))
    squared = reduce(lambda a, b: a + b, [F.col(f"_z{i}") * F.col(f"_z{i}") for i in range(_D)])
    return out.withColumn("_d2", squared).drop(*[f"_z{i}" for i in range(_D)])


def _inner(rows: DataFrame, estimates: DataFrame, cover: float) -> DataFrame:
    """The innermost ``cover`` of each group's rows, for each start; ties at the border are all in."""
    bin_ = F.least(F.greatest(F.floor(F.log(F.greatest(F.col("_d2"), F.lit(1e-12))) * _BINS), F.lit(-_BIN_LIMIT)), F.lit(_BIN_LIMIT)).cast("int")
    far = materialize(_distance(lookup_join(rows, materialize(estimates), "_g").select("_g", *[f"x{i}" for i in range(_D)], F.inline("_e"))).select("_g", "_k", *[f"x{i}" for i in range(_D)], bin_.alias("_b")))
    counts = far.groupBy("_g", "_k", "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_g", "_k")  # a group has a bounded number of bins
    ranked = counts.withColumn("_sum", F.sum("_n").over(w.orderBy("_b"))).withColumn("_all", F.sum("_n").over(w))
    border = ranked.where(F.col("_sum") >= F.col("_all") * cover).groupBy("_g", "_k").agg(F.min("_b").alias("_top"))
    keyed = border.select(F.concat_ws("\n", F.col("_k").cast("string"), "_g").alias("_gk"), "_top")
    return lookup_join(far.withColumn("_gk", F.concat_ws("\n", F.col("_k").cast("string"), "_g")), materialize(keyed), "_gk").where("_b <= _top").drop("_gk", "_b", "_top")


def estimate(vectors: DataFrame, cover: float = COVER, steps: int = STEPS) -> DataFrame:
    """``_g``, means and Cholesky factor of each group's minimum-covariance-determinant estimate.

    ``vectors``: ``_g`` (not null) and ``x0..``. Starts: all rows of the group; and its coordinate-wise medians with
    unit spread. Each start is concentrated ``steps`` times; the one with the smaller determinant is taken.
    """
    width = 256
    cells = vectors.select("_g", F.posexplode(F.array(*[F.round(F.col(f"x{i}") * width).cast("bigint") for i in range(_D)])).alias("_i", "_cell"))
    counts = cells.groupBy("_g", "_i", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_g", "_i")  # cells are bounded: logarithms of counts, in steps of 1/256
    ranked = counts.withColumn("_sum", F.sum("_n").over(w.orderBy("_cell"))).withColumn("_all", F.sum("_n").over(w))
    medians = ranked.where(F.col("_sum") * 2 >= F.col("_all")).groupBy("_g", "_i").agg((F.min("_cell") / width).alias("_m"))
    middle = medians.groupBy("_g").agg(*[F.max(F.when(F.col("_i") == i, F.col("_m"))).alias(f"m{i}") for i in range(_D)])
    start = middle.select("_g", F.lit(1).alias("_k"), *[f"m{i}" for i in range(_D)], *[F.lit(FLOORS[i] if i == j else 0.0).alias(f"c{i}_{j}") for i, j in _PAIRS])
    whole = _moments(vectors.withColumn("_k", F.lit(0))).drop("_n")
    estimates = _factor(whole.unionByName(start))
    for _ in range(steps):
        estimates = _factor(_moments(_inner(vectors, _by_group(estimates), cover)))
    best = F.struct("_det", "_k", *[f"m{i}" for i in range(_D)], *[f"l{i}_{j}" for i, j in _PAIRS])
    return estimates.groupBy("_g").agg(F.min(best).alias("_e")).select("_g", "_e.*").drop("_det", "_k")


def _by_group(estimates: DataFrame) -> DataFrame:
    """One row per group, with the list of its estimates."""
    return estimates.groupBy("_g").agg(F.collect_list(F.struct(*[c for c in estimates.columns if c != "_g"])).alias("_e"))


def judge(stats: DataFrame, min_rows: int = MIN_ROWS, cover: float = COVER, steps: int = STEPS, tail: float = TAIL) -> DataFrame:
    """``stats`` (from ``statistics``, with ``lang`` and ``source``) with ``base_failed, distance, kept``.

    Rows that fail the base rules take no part in the estimates and have no distance. Rows whose
    group and language are below ``min_rows`` are judged by the estimate over all rows; if the table is below it, they
    have none and are kept. An empty table gives an empty result. The names of the new columns, ``x0`` to ``x4`` and names that
    begin with an underscore must not be in ``stats``.
    """
    table = materialize(stats.withColumn("base_failed", base_failed()))
    passed = table.where("not base_failed").select("lang", "source", *[x.alias(f"x{i}") for i, x in enumerate(_vector())])
    groups = materialize(_groups(passed, min_rows))
    taught = lookup_join(passed.withColumn("_fine", _fine()), groups, "_fine").where("_g is not null").select("_g", *[f"x{i}" for i in range(_D)])
    taught = materialize(taught)
    if not taught.where("_g = '*'").isEmpty():
        taught = taught.where("_g <> '*'").unionByName(taught.withColumn("_g", F.lit("*")))
    estimates = materialize(estimate(taught, cover, steps))
    # a row's verdict needs its statistics and its group's estimate: no row is moved but where the groups are very many
    placed = lookup_join(table.withColumn("_fine", F.when(~F.col("base_failed"), _fine())), groups, "_fine")
    told = lookup_join(placed.select(*table.columns, "_g", *[x.alias(f"x{i}") for i, x in enumerate(_vector())]), estimates, "_g")
    told = _distance(told).select(*table.columns, F.col("_d2").alias("distance"))
    return told.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi_square_quantile(tail, _D), F.lit(True)))


def reject(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", **limits) -> DataFrame:
    """The rows of ``docs`` that are kept, with its columns, whatever their names.

    Rows are judged one by one: repeated rows share their fate, a null or empty text fails the base rules, null languages
    and sources are values of their own, an empty table stays empty. Rows are written once with their statistics.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"), F.col(f"`{text}`").alias("text"))
    kept = judge(statistics(whole), **limits).where("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
