"""The three chained rollups, as functions of DataFrames.

Lists with duplicates are bags (counts per value) inside a chain and sorted
lists at its end; ``lists=False`` keeps the bags, for incidents with more rows
than one list can hold.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import bags
from daybook.functions.sketches import KeySet, distinct_estimate, key_bounds, key_sketch, merged_sketch
from daybook.functions.times import utc_day
from daybook.operators.aggregates import KEY, participant_aggregate, vehicle_aggregate

# Output columns, in order.
INCIDENT_COLUMNS = {
    "crash_date": "crash_date",
    "crash_record_id": "crash_record_id",
    "is_am": "is_am",
    "damage": "damage_estimate",
    "number_injured": "injuries_total",
    "number_fatal": "injuries_fatal",
    "weather_condition": "weather_condition",
    "lighting_condition": "lighting_condition",
    "is_hit_run": "hit_and_run_i",
    "street_name": "street_name",
    "lat": "latitude",
    "lon": "longitude",
    "road_defect": "road_defect",
}
CUBE_DIMENSIONS = (
    "crash_day", "lat", "lon", "list_of_hospital", "list_of_gender",
    "list_of_airbag_deployed", "vehicle_uses", "vehicle_makes", "is_am",
    "weather_condition", "lighting_condition", "is_hit_run", "street_name",
    "road_defect", "is_cell_phone_use", "is_drunk", "is_age_below_5", "is_age_10s",
    "is_age_20s", "is_age_30s", "is_age_40s", "is_age_50s", "is_age_senior",
    "fire_happened", "hazmat_involved",
)
CUBE_MEASURES = {
    "total_people_involved": "num_people_involved",
    "total_injured": "number_injured",
    "total_fatal": "number_fatal",
    "total_damage": "damage",
}
SKETCH = "crashes_set_sketch"

_BAGS = ("list_of_airbag_deployed", "vehicle_uses", "vehicle_makes")


def _is_bag(rows: DataFrame, column: str) -> bool:
    return rows.schema[column].dataType.simpleString() == bags.BAG_TYPE


def with_lists(rows: DataFrame) -> DataFrame:
    """Write bags out as sorted lists; a missing bag stays null."""
    return rows.withColumns(
        {c: bags.as_list(F.col(c)) for c in _BAGS if c in rows.columns and _is_bag(rows, c)}
    )


def _of_incidents(rows: DataFrame, incidents: DataFrame, narrow: bool) -> DataFrame:
    """If the incidents are few (a day of them), drop other rows before grouping."""
    return rows.join(incidents.select(KEY), KEY, "left_semi") if narrow else rows


def people_summary(
    incidents: DataFrame,
    people: DataFrame,
    alcohol_column: str = "bac_result",
    narrow: bool = False,
    lists: bool = True,
) -> DataFrame:
    """Incidents with what their participants add up to, nulls if there are none.

    Participants are aggregated before they are joined: a key with very many
    of them is one row by then, and the join needs no second exchange.
    """
    header = incidents.select(*[F.col(source).alias(c) for c, source in INCIDENT_COLUMNS.items()])
    added = participant_aggregate(_of_incidents(people, incidents, narrow), alcohol_column)
    summary = header.join(added, KEY, "left").select(
        *INCIDENT_COLUMNS, *[c for c in added.columns if c != KEY]
    )
    return with_lists(summary) if lists else summary


def vehicle_summary(
    summary: DataFrame, vehicles: DataFrame, narrow: bool = False, lists: bool = True
) -> DataFrame:
    """The summary with what its vehicles add up to.

    Equal summary rows become one row whose vehicles count once per copy, as
    grouping the joined rows would have it. Vehicles are aggregated first, so
    the summary is not repeated per vehicle.
    """
    copies = F.col("copies")
    # Partitioned by incident, the grouping and the join share one exchange.
    by_incident = summary.repartition(KEY)
    distinct = by_incident.groupBy(*summary.columns).agg(F.count(F.lit(1)).alias("copies"))
    joined = distinct.join(vehicle_aggregate(_of_incidents(vehicles, summary, narrow)), KEY, "left")

    def bag(name: str) -> Column:
        found = F.coalesce(F.col(name), bags.empty_bag())
        return F.when(copies == 1, found).otherwise(bags.repeat_bag(found, copies)).alias(name)

    enriched = joined.select(
        *summary.columns,
        bag("vehicle_uses"),
        bag("vehicle_makes"),
        "fire_happened",
        F.coalesce("hazmat_involved", F.lit(False)).alias("hazmat_involved"),
        (F.col("num_people_involved") * copies).alias("num_people_involved"),
    )
    return with_lists(enriched) if lists else enriched


def cube(
    summary: DataFrame,
    dimensions: Iterable[str] = CUBE_DIMENSIONS,
    measures: dict[str, str] | None = None,
    lists: bool = True,
) -> DataFrame:
    """Measures and a sketch of incident ids per combination of dimensions.

    A missing list (no participants) and an empty one are different groups.
    """
    dimensions = list(dimensions)
    measures = CUBE_MEASURES if measures is None else measures
    rolled = (
        summary.withColumn("crash_day", utc_day(F.col("crash_date")))
        .groupBy(*dimensions)
        .agg(
            *[F.sum(source).alias(name) for name, source in measures.items()],
            key_sketch(F.col(KEY)).alias(SKETCH),
        )
    )
    return with_lists(rolled) if lists else rolled


def incident_cube(
    incidents: DataFrame,
    people: DataFrame,
    vehicles: DataFrame,
    dimensions: Iterable[str] = CUBE_DIMENSIONS,
    lists: bool = True,
) -> DataFrame:
    """All three rollups as one plan, for a full rebuild without stored stages."""
    summary = vehicle_summary(
        people_summary(incidents, people, lists=False), vehicles, lists=False
    )
    return cube(summary, dimensions, lists=lists)


def merge_cube(
    cube_rows: DataFrame, dimensions: Iterable[str], measures: Iterable[str] = tuple(CUBE_MEASURES)
) -> DataFrame:
    """Coarser groups of a stored cube, with the incidents of each counted."""
    return (
        cube_rows.groupBy(*dimensions)
        .agg(
            *[F.sum(name).alias(name) for name in measures],
            merged_sketch(F.col(SKETCH)).alias(SKETCH),
        )
        .withColumn("crashes", distinct_estimate(F.col(SKETCH)))
    )


def merged_days(parts: DataFrame) -> DataFrame:
    """The cube of whole UTC days, from the partial cubes of the local days they span.

    A part is a cube of one local day's incidents, by UTC day like the cube, so sums are
    summed and sketches united; no incident is grouped again.
    """
    return parts.groupBy(*CUBE_DIMENSIONS).agg(
        *[F.sum(name).alias(name) for name in CUBE_MEASURES],
        merged_sketch(F.col(SKETCH)).alias(SKETCH),
    )


def incident_sets(
    cube_rows: DataFrame,
    sets: dict[str, Column],
    asked: dict[str, KeySet],
    dimensions: Iterable[str] = (),
    deviations: float = 3.0,
) -> DataFrame:
    """Per group of a stored cube, how many incidents each expression has, with bounds.

    ``sets`` names conditions on the cube's rows. Their sketches are merged in one pass;
    the expressions are then worked out on the merged sketches alone.
    """
    used = set().union(*(e.names() for e in asked.values()))
    if missing := used - sets.keys():
        raise ValueError(f"sets not named: {sorted(missing)}")
    merged = cube_rows.groupBy(*dimensions).agg(
        *[merged_sketch(F.when(sets[n], F.col(SKETCH))).alias(f"__{n}") for n in sorted(used)]
    )
    named = {n: F.col(f"__{n}") for n in used}
    found = merged.withColumns({f"__of_{n}": e.sketch(named) for n, e in asked.items()})
    columns = []
    for name in asked:
        sketch = F.col(f"__of_{name}")
        bounds = key_bounds(sketch, deviations)
        columns += [
            distinct_estimate(sketch).alias(name),
            bounds["lower"].alias(f"{name}_lower"),
            bounds["upper"].alias(f"{name}_upper"),
        ]
    return found.select(*dimensions, *columns)
