"""Rounding, version strings, derived keys and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAJOR_MINOR = r"(\d+\.\d+)\.\d+\.\d+"


def half_even(value: Column, digits: int) -> Column:
    """Round half to even on the scaled value, as data-frame libraries do."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def version_part(version: Column, part: int) -> Column:
    """One numeric part of a ``major.minor`` string; NULL when it is not a number."""
    return F.split_part(version, F.lit("."), F.lit(part)).try_cast("int")


def version_order(version: str = "game_version") -> list[Column]:
    """Sort keys that put 15.10 after 15.9 and unknown versions last."""
    return [version_part(F.col(version), p).asc_nulls_last() for p in (1, 2)]


def major_minor(build: Column) -> Column:
    """``major.minor`` out of a four-part build string; NULL when there is none."""
    return F.nullif(F.regexp_extract(build, MAJOR_MINOR, 1), F.lit(""))


def joined_key(*parts: Column) -> Column:
    """Parts joined by ``_``; NULL if any part is NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("_"))
        pieces.append(part.cast("string"))
    return F.concat(*pieces)


def day_window(ts: Column, day: Column) -> Column:
    """True inside the UTC day before ``day`` (half-open).

    The bounds are dates, which take on the column's own type, so the filter reaches the scan.
    """
    end = day.cast("date")
    return (ts >= F.date_sub(end, 1)) & (ts < end)


def flag(condition: Column) -> Column:
    """1 or 0; an unknown condition counts as 0."""
    return F.when(condition, 1).otherwise(0)
