"""Column expressions: coordinates, intensities, label ids, sizes, layer types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal what existing data sets use.
INTENSITY_MIN = 34939
INTENSITY_MAX = 36096
TRAILING_JUNK = r"[^\d,\s]+$"
LABEL_PREFIX = 9
DEFAULT_FACTORS = (2, 3, 4, 5)
MEMORY_FACTOR = 3.0
ITEM_SIZES = {
    "bool": 1, "int8": 1, "uint8": 1, "int16": 2, "uint16": 2,
    "int32": 4, "uint32": 4, "float32": 4, "int64": 8, "uint64": 8, "float64": 8,
}


def parse_coordinate(text: Column, strict: bool = True) -> Column:
    """``'x,y,z'`` with optional trailing junk -> ``struct<x,y,z>``.

    Malformed text raises when ``strict``; otherwise it becomes NULL.
    """
    cleaned = F.trim(F.regexp_replace(text, TRAILING_JUNK, ""))
    parts = F.split(cleaned, ",")
    numbers = [F.trim(F.get(parts, i)).try_cast("bigint") for i in range(3)]
    valid = (F.size(parts) == 3) & numbers[0].isNotNull() & numbers[1].isNotNull() & numbers[2].isNotNull()
    point = F.struct(*[n.alias(axis) for n, axis in zip(numbers, "xyz")])
    message = F.concat(F.lit("invalid coordinate, expected 'x,y,z': "), F.coalesce(text, F.lit("NULL")))
    return F.when(valid, point).otherwise(F.raise_error(message) if strict else F.lit(None))


def downsample_point(point: Column, factor: int) -> Column:
    """Floor division of every axis (towards minus infinity, not towards zero)."""
    axes = [F.floor(point[a] / F.lit(factor)).cast("bigint").alias(a) for a in "xyz"]
    return F.when(point.isNotNull(), F.struct(*axes))


def normalize_u8(value: Column, low: int = INTENSITY_MIN, high: int = INTENSITY_MAX) -> Column:
    """Clip to ``[low, high]``, stretch to 0..255 and truncate."""
    if high == low:
        raise ValueError("intensity range is empty")
    v = value.cast("double")
    clipped = F.least(F.greatest(v, F.lit(float(low))), F.lit(float(high)))
    return F.floor((clipped - low) / (high - low) * 255).cast("smallint")


def prefixed_label(index: Column, components: int) -> Column:
    """Component number 0..n-1 -> ``9 * 10^digits(n) + number``."""
    return (index + F.lit(LABEL_PREFIX * 10 ** len(str(components)))).cast("bigint")


def layer_type(dtype: Column) -> Column:
    """Integer arrays are segmentations, except uint8, which is image data."""
    is_int = dtype.rlike("^u?int(8|16|32|64)$") & (dtype != "uint8")
    return F.when(is_int, "segmentation").otherwise("image")


def memory_estimate(shape: Column, dtype: Column, factor: float = MEMORY_FACTOR) -> Column:
    cells = F.aggregate(shape, F.lit(1).cast("bigint"), lambda acc, n: acc * n.cast("bigint"))
    sizes = F.create_map(*[F.lit(v) for kv in ITEM_SIZES.items() for v in kv])
    return F.floor(cells * F.try_element_at(sizes, dtype) * F.lit(factor)).cast("bigint")


def parse_tuple(text: Column) -> Column:
    """``'a,b,c'`` -> array of int; junk raises (ANSI cast)."""
    return F.transform(F.split(text, ","), lambda part: F.trim(part).cast("int"))
