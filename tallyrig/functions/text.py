"""Small text expressions shared by the core operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy_name(value: Column) -> Column:
    """A name without case, surrounding blanks and kind of separator; '' becomes null.

    Runs of characters that are neither letters nor digits become one ``_``.
    """
    joined = F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}]+", "_")
    return F.nullif(F.regexp_replace(joined, r"^_+|_+$", ""), F.lit(""))


def is_fresh(is_new: Column, time: Column) -> Column:
    """Whether a frame is fresh: marked new and with a usable time."""
    marked = F.lower(F.regexp_replace(is_new, r"^\s+|\s+$", "")).isin("1", "true", "yes")
    return F.coalesce(marked, F.lit(False)) & time.isNotNull() & ~F.isnan(time)
