"""Fill-in-the-middle: texts cut at two points and put together for infilling, by one counted-quantifier match a text.

A per-row pattern ``(unit{a}+)(unit{b-a}+)(rest)`` with possessive counted groups captures prefix, middle and suffix in
one match, and the replacement of that match is the output. A unit is a code point. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1"
# Of a hundred texts so many are cut, and of these so many give the suffix first.
CUT_PERCENT = 90
SPM_PERCENT = 20
# Units are counted in runs of this length, so that a long text is not an array of its characters.
_RUN = 64


def units(text: Column) -> Column:
    """Code points of ``text``, by counting matches: whole runs, then what is left one by one."""
    runs = F.regexp_count(text, F.lit(f"(?s).{{{_RUN}}}+"))
    both = F.regexp_count(text, F.lit(f"(?s).{{{_RUN}}}+|."))
    return both.cast("bigint") + runs.cast("bigint") * (_RUN - 1)


def draws(key: Column, seed: str = SEED) -> list[Column]:
    """Four numbers below 2**32 that depend on ``key`` alone (a null key counts as empty)."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(hashed, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def transform(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: str = SEED, cut_percent: int = CUT_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``, one row per row of ``docs``.

    ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain``: texts that are empty, spell
    one of the marks, or are drawn to stay as they are; these have no lengths of prefix and middle. A null text is empty, a
    null key draws like an empty one, repeated rows give repeated rows, and an empty table an empty result. Whole texts
    are cut, whatever their length. Other columns of ``docs``, also of the names used here, are ignored.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    counted = rows.select("*", units(F.col("text")).alias("n"))
    x, y = F.pmod(h1, F.col("n") + 1), F.pmod(h2, F.col("n") + 1)
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("n") == 0) | marked | (h3 % 100 >= cut_percent)
    drawn = counted.select("*", F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm").alias("form"), F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    pattern = F.concat(F.lit(r"(?s)\A(.{"), F.col("a"), F.lit("}+)(.{"), F.col("b") - F.col("a"), F.lit(r"}+)(.*+)\z"))
    layout = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    cut = F.col("form") != "plain"
    return drawn.select(
        "doc_id", "n", "form",
        F.when(cut, F.col("a")).alias("prefix_chars"),
        F.when(cut, F.col("b") - F.col("a")).alias("middle_chars"),
        F.when(cut, F.regexp_replace("text", pattern, layout)).otherwise(F.col("text")).alias("output"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text that gave ``output``, from it and its form alone. Marks occur in it once each, so they are its borders."""
    between = lambda left, right: F.substring_index(F.substring_index(output, left, -1), right, 1)
    middle = F.substring_index(output, MIDDLE, -1)
    prefix = F.when(form == "psm", between(PREFIX, SUFFIX)).otherwise(between(PREFIX, MIDDLE))
    suffix = F.when(form == "psm", between(SUFFIX, MIDDLE)).otherwise(between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))


def digest(transformed: DataFrame) -> DataFrame:
    """The rows with hashes of the output and of the text restored from it in place of the output."""
    return transformed.select(
        *[c for c in transformed.columns if c != "output"],
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
