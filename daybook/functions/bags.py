"""Bags: lists that keep duplicates, carried as ``array<struct<value, n>>``.

A bag of a hot key has one entry per distinct value however many rows it
stands for, so it can be shuffled and grouped by. ``as_list`` writes it out as
the sorted list with duplicates; two bags are equal exactly when their sorted
lists are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BAG_TYPE = "array<struct<value:string,n:bigint>>"


def empty_bag() -> Column:
    return F.array().cast(BAG_TYPE)


def _entry(value: Column, n: Column) -> Column:
    return F.struct(value.alias("value"), n.alias("n"))


def bag_of_flag(flag: Column) -> Column:
    """Aggregate: the bag of a boolean column as text, without collecting it."""

    def entries(text: str, n: Column) -> Column:
        return F.when(n > 0, F.array(_entry(F.lit(text), n)).cast(BAG_TYPE)).otherwise(empty_bag())

    return F.concat(entries("false", F.count_if(~flag)), entries("true", F.count_if(flag)))


def collected_bag(value: Column, n: Column) -> Column:
    """Aggregate: the bag of rows already counted per value, nulls left out."""
    # when() without otherwise() is null, which collecting leaves out
    return F.sort_array(F.collect_list(F.when(value.isNotNull(), _entry(value, n))))


def repeat_bag(bag: Column, times: Column) -> Column:
    return F.transform(
        bag, lambda e: F.struct(e["value"].alias("value"), (e["n"] * times).alias("n"))
    )


def as_list(bag: Column) -> Column:
    """The bag as a sorted list with every duplicate written out."""
    repeated = F.flatten(F.transform(bag, lambda e: F.array_repeat(e["value"], e["n"].cast("int"))))
    return F.when(F.array_max(bag["n"]) == 1, bag["value"]).otherwise(repeated)
