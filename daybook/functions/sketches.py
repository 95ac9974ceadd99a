"""Distinct-key sketches: built per group, merged later, combined as sets, and read as
an estimate with bounds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: 2^12 = 4096 entries. Up to that many keys the count is exact.
LOG_ENTRIES = 12


def key_sketch(key: Column, log_entries: int = LOG_ENTRIES) -> Column:
    """Aggregate: a theta sketch of the keys of a group, nulls skipped."""
    return F.theta_sketch_agg(key, log_entries)


def merged_sketch(sketch: Column, log_entries: int = LOG_ENTRIES) -> Column:
    """Aggregate: the sketch of the union of several groups' keys."""
    return F.theta_union_agg(sketch, log_entries)


def distinct_estimate(sketch: Column) -> Column:
    return F.theta_sketch_estimate(sketch)


# --- sets of keys ------------------------------------------------------------


@dataclass(frozen=True)
class KeySet:
    """An expression over named sets of keys: ``&`` both, ``|`` either, ``-`` only the
    first. It is evaluated on stored sketches, without the keys."""

    name: str | None = None
    operation: str | None = None
    parts: tuple[KeySet, ...] = ()

    def __and__(self, other: KeySet) -> KeySet:
        return KeySet(operation="and", parts=(self, other))

    def __or__(self, other: KeySet) -> KeySet:
        return KeySet(operation="or", parts=(self, other))

    def __sub__(self, other: KeySet) -> KeySet:
        return KeySet(operation="without", parts=(self, other))

    def names(self) -> set[str]:
        return {self.name} if self.name else set().union(*(p.names() for p in self.parts))

    def sketch(self, named: dict[str, Column], log_entries: int = LOG_ENTRIES) -> Column:
        """The sketch of the expression, given one for each name."""
        if self.name is not None:
            return named[self.name]
        left, right = (p.sketch(named, log_entries) for p in self.parts)
        if self.operation == "and":
            return F.theta_intersection(left, right)
        if self.operation == "or":
            return F.theta_union(left, right, log_entries)
        return F.theta_difference(left, right)


# --- what a sketch is sure of ------------------------------------------------

# Places in a stored sketch, from 1. The first byte has the 8-byte words of
# its head; the second its version. Version 3 has the retained count in 4 bytes after the
# first word and theta in the third one; version 4 has theta in the second word and then
# the count in as many bytes as the fifth byte says. One key alone has no count.
_WORDS, _VERSION, _COUNT_BYTES, _FLAGS = 1, 2, 5, 6
_PACKED, _EMPTY_FLAG = 4, 4
_WHOLE_THETA = 2.0**63


def _byte(sketch: Column, place: Column | int) -> Column:
    place = F.lit(place) if isinstance(place, int) else place
    return F.conv(F.hex(F.substring(sketch, place, F.lit(1))), 16, 10).cast("bigint")


def _number(sketch: Column, start: int, size: Column | int, most: int) -> Column:
    """An unsigned number of ``size`` bytes, the lowest first."""
    size = F.lit(size) if isinstance(size, int) else size
    total = F.lit(0).cast("bigint")
    for i in range(most):
        byte = F.coalesce(_byte(sketch, start + i), F.lit(0)) * (1 << 8 * i)
        total = total + F.when(F.lit(i) < size, byte).otherwise(0)
    return total


def retained_keys(sketch: Column) -> Column:
    """How many hashes a sketch holds."""
    words, count_bytes = _byte(sketch, _WORDS), _byte(sketch, _COUNT_BYTES)
    packed = _byte(sketch, _VERSION) == _PACKED
    empty = _byte(sketch, _FLAGS).bitwiseAND(F.lit(_EMPTY_FLAG)) != 0
    return (
        F.when(packed & (words == 1), _number(sketch, 9, count_bytes, 4))
        .when(packed, _number(sketch, 17, count_bytes, 4))
        .when(words > 1, _number(sketch, 9, 4, 4))
        .when(empty, 0)
        .otherwise(1)
    )


def retained_share(sketch: Column) -> Column:
    """The share of all hashes that the sketch would hold; 1 if it holds them all."""
    words, packed = _byte(sketch, _WORDS), _byte(sketch, _VERSION) == _PACKED
    start = F.when(packed & (words >= 2), 9).when(~packed & (words >= 3), 17)
    # The highest byte stands last and is below 128.
    theta = F.concat(*(F.substring(sketch, start + i, F.lit(1)) for i in reversed(range(8))))
    value = F.conv(F.hex(theta), 16, 10).cast("double") / _WHOLE_THETA
    return F.when(start.isNull(), 1.0).otherwise(value)


def key_bounds(sketch: Column, deviations: float = 3.0) -> Column:
    """``lower, upper``: whole numbers between which the count of keys is, both the
    exact count while all hashes are held.

    A share p of n keys is held, k on average n * p with variance n * p * (1 - p); the
    bounds are the n for which k lies that many deviations off.
    """
    k, p = retained_keys(sketch), retained_share(sketch)
    half = F.lit(float(deviations)) * F.sqrt(p * (1 - p))
    root = F.sqrt(half * half + 4 * p * k)
    upper, lower = F.pow((half + root) / (2 * p), 2), F.pow((root - half) / (2 * p), 2)
    whole = p >= 1
    return F.struct(
        F.when(whole, k).otherwise(F.greatest(F.floor(lower), k)).cast("bigint").alias("lower"),
        F.when(whole, k).otherwise(F.ceil(upper)).cast("bigint").alias("upper"),
    )
