"""Which stored days hold children of an incident, as bit arrays of key hashes.

A child mostly stands on its incident's own day, which a run reads anyway. The index
of a day holds the others, its strays: one array of ``2 ** BITS`` bits of which only
the 64-bit cells with a bit set are rows. A run asks the cells of its incidents' keys.
It may be told a day too many, where two keys share a bit, and never one too few.

A day with one row ``UNKNOWN`` is named to every run. It is written before the day's
incidents or children change, and the day's cells after that, so that a run that died
in between loses no child. An incident's key stands for one stored day; if two days
store it, the children on either are at home there, and only a rebuild joins them all.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32
#: The cell of a day that is named to every run.
UNKNOWN = -1
CELL_COLUMNS = "cell bigint, bits bigint"


def _place(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - BITS)


def cells(keys: DataFrame, key: str, *by: str) -> DataFrame:
    """``cell, bits`` of the keys' array, one per combination of ``by``."""
    place = _place(F.col(key))
    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    placed = keys.select(*by, place.alias("place"))
    return placed.groupBy(*by, F.shiftright("place", 6).alias("cell")).agg(F.bit_or(bit).alias("bits"))


def strays(children: DataFrame, incidents: DataFrame, key: str, day: str) -> DataFrame:
    """The cells of each day's children whose incident is not stored on that day."""
    at_home = incidents.select(key, day)
    return cells(children.select(key, day).join(at_home, [key, day], "left_anti"), key, day)


def unknown_day(like: DataFrame) -> DataFrame:
    """The one row of a day whose children are not known."""
    return like.sparkSession.range(1).select(
        F.lit(UNKNOWN).cast("bigint").alias("cell"), F.lit(-1).cast("bigint").alias("bits")
    )


def named_days(index: DataFrame, incidents: DataFrame, key: str, day: str) -> list[dt.date]:
    """The days that may hold strays of the incidents: one row each at most."""
    asked = cells(incidents, key).select("cell", F.col("bits").alias("asked"))
    met = index.join(asked, "cell").filter(F.col("bits").bitwiseAND(F.col("asked")) != 0)
    unknown = index.filter(F.col("cell") == UNKNOWN)
    found = met.select(day).union(unknown.select(day)).distinct().collect()
    return sorted(r[0] for r in found)
