"""Per-incident aggregates of participants and vehicles.

Every aggregate combines on the map side. An incident that owns a large share
of all rows therefore reaches its reducer as a few rows per map task, and lists
with duplicates travel as counts per value (``functions.bags``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import bags
from daybook.functions.text import filled, number_or_null

KEY = "crash_record_id"


@dataclass(frozen=True)
class AgeBand:
    """Both ends included; either may be open."""

    name: str
    low: int | None = None
    high: int | None = None

    def holds(self, age: Column) -> Column:
        if self.low is None:
            return age <= self.high
        return age >= self.low if self.high is None else age.between(self.low, self.high)


# The bands and the threshold. Ages 5 to 9 are in no band.
AGE_BANDS = (
    AgeBand("is_age_below_5", high=4),
    AgeBand("is_age_10s", 10, 19),
    AgeBand("is_age_20s", 20, 29),
    AgeBand("is_age_30s", 30, 39),
    AgeBand("is_age_40s", 40, 49),
    AgeBand("is_age_50s", 50, 59),
    AgeBand("is_age_senior", low=60),
)
DRUNK_ABOVE = 0.08

_KINDS = {"vehicle_use": 0, "make": 1}


def any_match(predicate: Column) -> Column:
    """Aggregate: does any row of the group match; null counts as no match."""
    return F.max(F.coalesce(predicate, F.lit(False)))


def distinct_list(value: Column) -> Column:
    """Aggregate: the sorted distinct values, nulls dropped, ``[]`` if none."""
    return F.sort_array(F.collect_set(value))


def age_flags(age: Column, bands: tuple[AgeBand, ...] = AGE_BANDS) -> list[Column]:
    return [any_match(band.holds(age)).alias(band.name) for band in bands]


def participant_flags(alcohol_column: str = "bac_result") -> list[Column]:
    drunk = number_or_null(F.col(alcohol_column).cast("string")) > DRUNK_ABOVE
    return [
        any_match(F.col("cell_phone_use")).alias("is_cell_phone_use"),
        any_match(drunk).alias("is_drunk"),
    ]


def participant_aggregate(people: DataFrame, alcohol_column: str = "bac_result") -> DataFrame:
    """One row per incident; the airbag list as a bag."""
    return people.groupBy(KEY).agg(
        *participant_flags(alcohol_column),
        distinct_list(F.col("hospital")).alias("list_of_hospital"),
        distinct_list(F.col("sex")).alias("list_of_gender"),
        *age_flags(F.col("age")),
        bags.bag_of_flag(F.col("airbag_deployed")).alias("list_of_airbag_deployed"),
    )


def vehicle_aggregate(vehicles: DataFrame) -> DataFrame:
    """One row per incident; uses and makes as bags.

    Rows are dealt by incident, use and make to tasks of bounded size before any are
    grouped, however large the source's splits are; equal rows beyond that size are
    dealt to several. The grouping spreads an incident over reducers by each use and
    each make, counted as rows. Only its distinct values move on to the incident's own
    reducer, as rows: lists of parts of them would be wider and have to be merged.
    """
    spread = F.xxhash64(KEY, "vehicle_use", "make")
    dealt = vehicles.select(
        KEY,
        "vehicle_use",
        "make",
        F.col("fire_i").alias("fire"),
        filled(F.col("hazmat_class")).alias("hazmat"),
        F.col("occupant_cnt").alias("occupants"),
        spread.alias("combination"),
    ).hint("rebalance", "combination")

    def entry(kind: str, *measures: Column) -> Column:
        fields = zip(measures, ("fire", "hazmat", "occupants"), strict=True)
        return F.struct(
            F.lit(_KINDS[kind]).alias("kind"),
            F.col(kind).alias("value"),
            *[measure.alias(name) for measure, name in fields],
        )

    nothing, number = F.lit(None), dealt.schema["occupants"].dataType
    entries = F.array(
        entry("vehicle_use", F.col("fire"), F.col("hazmat"), F.col("occupants")),
        entry("make", nothing.cast("boolean"), nothing.cast("boolean"), nothing.cast(number)),
    )
    per_value = (
        dealt.select(KEY, F.inline(entries))
        .groupBy(KEY, "kind", "value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bool_or("fire").alias("fire"),
            F.bool_or("hazmat").alias("hazmat"),
            F.sum("occupants").alias("occupants"),
        )
    )

    def bag(kind: str) -> Column:
        return bags.collected_bag(F.when(F.col("kind") == _KINDS[kind], F.col("value")), F.col("n"))

    return per_value.repartition(KEY).groupBy(KEY).agg(
        bag("vehicle_use").alias("vehicle_uses"),
        bag("make").alias("vehicle_makes"),
        F.bool_or("fire").alias("fire_happened"),
        F.bool_or("hazmat").alias("hazmat_involved"),
        F.sum("occupants").alias("num_people_involved"),
    )


def sorted_bag(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Per group, the sorted list of a column with duplicates kept."""
    counted = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    bag = bags.collected_bag(F.col(value), F.col("n"))
    grouped = counted.repartition(*keys).groupBy(*keys).agg(bag.alias("bag"))
    return grouped.select(*keys, bags.as_list(F.col("bag")).alias(name))
