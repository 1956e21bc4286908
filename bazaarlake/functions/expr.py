"""Expressions with the warehouse semantics the models need, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(28, 9)

# The code points of the Unicode White_Space property.
WHITE_SPACE = "".join(
    chr(point)
    for point in [
        *range(0x0009, 0x000E),
        0x0020,
        0x0085,
        0x00A0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    ]
)


def clean_text(col: Column) -> Column:
    """Strip all Unicode white space at both ends (Spark's own trim strips blanks only)."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def lower_text(col: Column) -> Column:
    return F.lower(clean_text(col))


def blank_to(col: Column, default: str) -> Column:
    """The cleaned text, or the default where it is NULL or blank."""
    return F.coalesce(F.nullif(clean_text(col), F.lit("")), F.lit(default))


def safe_cast(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """NULL instead of an error; fractional numbers round half up when cast to an integer."""
    if isinstance(target, T.LongType) and isinstance(source, T.FractionalType):
        return F.round(col).try_cast(target)
    return col.try_cast(target)


def exact_avg(col: Column) -> Column:
    """Mean of a decimal as a double: one rounding, taken after the exact sum."""
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL when the divisor is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def days_between(later: Column, earlier: Column) -> Column:
    """Difference of calendar dates (UTC session); the time of day does not count."""
    return F.date_diff(F.to_date(later), F.to_date(earlier)).cast("long")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole elapsed seconds."""
    return F.timestamp_diff("SECOND", earlier, later)


def record_hash(*keys: Column) -> Column:
    """SHA-256 (hex) over the key values joined by a bar; NULL is written as None."""
    parts = [F.coalesce(key.cast("string"), F.lit("None")) for key in keys]
    return F.sha2(F.concat_ws("|", *parts), 256)
