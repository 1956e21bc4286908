"""Words of texts as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed: what separates words where only letters, digits and characters beyond ASCII belong to words.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Array of the lower-cased words of a text, empty for null."""
    return F.array_remove(F.split(lowered(text), NOT_WORD), "")
