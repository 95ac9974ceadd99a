"""Messy text to flags and amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.casts import floating_point

# What the source writes, and what each spelling means.
YES_WORDS = ("y", "true", "1", "yes")
DEPLOYED = "deployed"
NOT_DEPLOYED = "not deploy"
OPEN_BAND = "OVER"
CAPPED_BAND = "OR LESS"
CAPPED_BAND_LOW = 1
RANGE_MARK = "-"

# Every character that counts as blank at the ends of a value.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_FIRST_NUMBER = "([0-9]+)"
_SECOND_NUMBER = "[0-9]+[^0-9]+([0-9]+)"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def yes_no(text: Column) -> Column:
    """Null stays null; any text that is not a yes is false."""
    return F.lower(strip(text.cast("string"))).isin(*YES_WORDS)


def airbag_state(text: Column) -> Column:
    """True, false or unknown. The first test wins, so ``NOT DEPLOYED`` is true."""
    lowered = F.lower(text)
    return F.when(lowered.contains(DEPLOYED), F.lit(True)).when(
        lowered.contains(NOT_DEPLOYED), F.lit(False)
    )


def _bare(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def _is_open(text: Column) -> Column:
    return strip(F.upper(_bare(text))).startswith(OPEN_BAND)


def _is_capped(text: Column) -> Column:
    return F.upper(_bare(text)).contains(CAPPED_BAND)


def _is_range(text: Column) -> Column:
    return text.contains(RANGE_MARK)


def _number(text: Column, pattern: str) -> Column:
    """The captured digits as a number; null where there are none or too many.

    A cast that fails is far slower than one not tried.
    """
    digits = F.regexp_extract(_bare(text), pattern, 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def amount_low(text: Column) -> Column:
    first, second = _number(text, _FIRST_NUMBER), _number(text, _SECOND_NUMBER)
    floor = F.lit(CAPPED_BAND_LOW).cast("bigint")
    return (
        F.when(_is_open(text), first)
        .when(_is_capped(text), F.when(first.isNotNull(), floor))
        .when(_is_range(text), F.when(second.isNotNull(), first))
        .otherwise(first)
    )


def amount_high(text: Column) -> Column:
    first, second = _number(text, _FIRST_NUMBER), _number(text, _SECOND_NUMBER)
    return (
        F.when(_is_open(text), F.lit(None).cast("bigint"))
        .when(_is_capped(text), first)
        .when(_is_range(text), F.when(first.isNotNull(), second))
        .otherwise(first)
    )


def amount_band(text: Column) -> Column:
    """``struct(low, high)``; an open band has no high, unreadable text neither."""
    return F.struct(amount_low(text).alias("low"), amount_high(text).alias("high"))


def amount_estimate(text: Column) -> Column:
    """Midpoint of a closed band, the lower end of an open one."""
    first, second = _number(text, _FIRST_NUMBER), _number(text, _SECOND_NUMBER)

    def middle(low: Column, high: Column) -> Column:
        return F.call_function("div", F.try_add(low, high), F.lit(2))

    estimate = (
        F.when(_is_open(text), first)
        .when(_is_capped(text), middle(F.lit(CAPPED_BAND_LOW).cast("bigint"), first))
        .when(_is_range(text), middle(first, second))
        .otherwise(first)
    )
    return estimate.try_cast("int")


def amount_unreadable(text: Column) -> Column:
    """A band that announces numbers and then gives none that fit."""
    announced = _is_open(text) | _is_capped(text) | text.rlike(f"{RANGE_MARK}|[0-9]")
    return F.coalesce(announced & amount_estimate(text).isNull(), F.lit(False))


def number_or_null(text: Column) -> Column:
    """Text as a double if it reads as one; empty text does not."""
    return floating_point(text, T.DoubleType())


def filled(text: Column) -> Column:
    """Neither null nor empty; never null itself."""
    return text.isNotNull() & (text != F.lit(""))
