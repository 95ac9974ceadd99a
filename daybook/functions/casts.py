"""Typed casts that answer null where the text does not read as the type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.times import DEFAULT_ZONE, local_to_utc, parse_local

# The type names a schema may use.
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
}

_BLANK = r"[\s\p{Cntrl}]*"
_WHOLE_PART = rf"^{_BLANK}([+-]?[0-9]+)([.][0-9]*)?{_BLANK}$"
_NO_WHOLE_PART = rf"^{_BLANK}[+-]?[.][0-9]*{_BLANK}$"
_MAY_BE_NUMBER = "(?i)[0-9]|nan|inf"


def type_named(name: str) -> T.DataType:
    try:
        return TYPE_NAMES[name.lower()]
    except KeyError:
        raise ValueError(f"unknown type: {name}") from None


def whole_number(text: Column, target: T.DataType) -> Column:
    """Integer text, or decimal text cut at the point (``12.7`` reads as 12).

    The patterns keep other text from the cast, which is slow when it fails.
    """
    whole = F.regexp_extract(text, _WHOLE_PART, 1)
    zero = F.when(text.rlike(_NO_WHOLE_PART), F.lit(0).cast(target))
    return F.when(whole != "", whole.try_cast(target)).otherwise(zero)


def floating_point(text: Column, target: T.DataType) -> Column:
    """Text as a float or double; only tried where it may be a number."""
    return F.when(text.rlike(_MAY_BE_NUMBER), text.try_cast(target))


def cast_value(
    value: Column, source: T.DataType, target: T.DataType, zone: str = DEFAULT_ZONE
) -> Column:
    if isinstance(target, T.TimestampType):
        local = parse_local(value) if isinstance(source, T.StringType) else value.cast(target)
        return local_to_utc(local, zone)
    if source == target:
        return value
    if isinstance(target, T.StringType):
        return value.cast(target)
    if isinstance(source, T.StringType) and isinstance(target, (T.IntegerType, T.LongType)):
        return whole_number(value, target)
    if isinstance(source, T.StringType) and isinstance(target, (T.FloatType, T.DoubleType)):
        return floating_point(value, target)
    return value.try_cast(target)
