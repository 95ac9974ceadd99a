"""The registered queries. Dates, times and lists leave as text."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import bags, sketches, text, times
from daybook.operators import aggregates, conform, transforms
from daybook.plans import days, lattice, pipeline, quarantine, rollups
from daybook.session import shared_folder
from daybook.sources import landing, tables
from daybook.sources.schemas import TABLES, TableSpec
from workload import sql, standins
from workload.registry import query
from workload.standins import Tables

DAY = dt.date(2024, 1, 15)
KEY = aggregates.KEY


def shown(rows: DataFrame) -> DataFrame:
    """Lists joined, dates and times as text, so both engines print them alike."""

    def plain(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            value = F.array_join(value, ",")
        elif isinstance(field.dataType, T.TimestampType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        return value.alias(field.name)

    return rows.select(*[plain(f) for f in rows.schema.fields])


# --- landing -------------------------------------------------------------


@query(
    """
    SELECT event_id, user_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'
    """
)
def landing_day_extract(t: Tables) -> DataFrame:
    wanted = ["event_id", "user_id", "event_type", "event_id"]
    return landing.extract_day(t.events, "ts", DAY, wanted)


@query(
    """
    SELECT year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day,
           count(*) AS landed, count(DISTINCT CAST(ts AS DATE)) AS dates
    FROM events GROUP BY ALL
    """
)
def landing_counts(t: Tables) -> DataFrame:
    root = shared_folder(t.spark, "landing")
    landing.land_days(standins.raw_events(t), root, "TS", rows_per_file=1_000_000)
    return (
        landing.read_days(t.spark, root)
        .groupBy("year", "month", "day")
        .agg(
            F.count(F.lit(1)).alias("landed"),
            F.count_distinct(F.substring("TS", 1, 10)).alias("dates"),
        )
    )


@query(
    """
    SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
           count(*) AS landed, true AS none_too_large, true AS split
    FROM events GROUP BY ALL
    """
)
def landing_files(t: Tables) -> DataFrame:
    """A day's rows are cut into files of 20 rows at most, in one job for all days."""
    root, most = shared_folder(t.spark, "landing"), 20
    landing.land_days(standins.raw_events(t), root, "TS", rows_per_file=most)
    rows = landing.read_days(t.spark, root)
    parts = [F.format_string(f"%0{n}d", c).alias(c) for c, n in (("year", 4), ("month", 2), ("day", 2))]
    files = rows.select(*parts, F.input_file_name().alias("file"))
    sizes = files.groupBy("year", "month", "day", "file").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("year", "month", "day").agg(
        F.sum("n").alias("landed"),
        (F.max("n") <= most).alias("none_too_large"),
        (F.count(F.lit(1)) >= F.ceil(F.sum("n") / most)).alias("split"),
    )


# --- conforming ----------------------------------------------------------


@query(
    f"""
    SELECT event_id, {sql.stamp(sql.utc("ts"))} AS ts, user_id::INTEGER AS user_id, value,
           trunc(value)::INTEGER AS whole,
           ([12, 7, -3, NULL, 0, NULL, NULL, NULL]::INTEGER[])[(event_id % 8) + 1] AS loose,
           {sql.yes_no(sql.YES_NO_TEXT)} AS active_i, event_type AS kind,
           NULL::VARCHAR AS not_delivered
    FROM events
    """
)
def conform_typed(t: Tables) -> DataFrame:
    schema = T.StructType.fromDDL(standins.EVENT_COLUMNS)
    return shown(conform.conform(standins.raw_events(t), schema))


@query(
    """
    SELECT count(*) AS rows, count(*) FILTER (event_id % 11 = 5) AS event_id,
           count(*) FILTER (event_id % 9 = 2) AS ts, count(*) FILTER (event_id % 7 = 1) AS whole,
           count(*) FILTER (event_id % 8 IN (3, 5, 7)) AS loose, 0::BIGINT AS active_i
    FROM events
    """
)
def conform_rejects(t: Tables) -> DataFrame:
    """A flag has no unreadable text: whatever is not a yes is a no."""
    schema = T.StructType.fromDDL(standins.EVENT_COLUMNS)
    raw, event = standins.raw_events(t), F.col("EVENT_ID").cast("bigint")
    raw = raw.withColumns(
        {
            "EVENT_ID": F.when(event % 11 == 5, "no number").otherwise(F.col("EVENT_ID")),
            "TS": F.when(event % 9 == 2, "yesterday").otherwise(F.col("TS")),
            "WHOLE": F.when(event % 7 == 1, "n/a").otherwise(F.col("WHOLE")),
        }
    )
    counts = conform.reject_counts(raw, schema)
    wanted = ["event_id", "ts", "whole", "loose", "active_i"]
    return raw.agg(
        F.count(F.lit(1)).alias("rows"), *[counts[name].alias(name) for name in wanted]
    )


@query(
    f"""
    SELECT event_id, damage, estimate AS damage_estimate, {sql.stamp(sql.utc("ts"))} AS crash_date,
           hour({sql.utc("ts")}) < 12 AS is_am, {sql.yes_no(sql.YES_NO_TEXT)} AS hit_and_run_i
    FROM ({sql.amounts(f"SELECT *, {sql.AMOUNT_TEXT} AS damage, damage AS txt FROM events")})
    """
)
def incident_transform(t: Tables) -> DataFrame:
    raw = standins.raw_datasets(t)["crashes"]
    typed = transforms.transform("crashes", raw, TABLES["crashes"].schema)
    return shown(
        typed.select(
            F.col(KEY).cast("bigint").alias("event_id"),
            "damage",
            "damage_estimate",
            "crash_date",
            "is_am",
            "hit_and_run_i",
        )
    )


@query(
    f"""
    SELECT event_id::VARCHAR AS person_id, (user_id % 90)::INTEGER AS age,
           {sql.AIRBAG_TEXT} AS airbag_deployed_txt,
           {sql.airbag(sql.AIRBAG_TEXT)} AS airbag_deployed,
           {sql.YES_NO_TEXT} AS cell_phone_use_txt,
           {sql.yes_no(sql.YES_NO_TEXT)} AS cell_phone_use
    FROM events
    """
)
def participant_transform(t: Tables) -> DataFrame:
    raw = standins.raw_datasets(t)["crashes_people"]
    typed = transforms.transform("crashes_people", raw, TABLES["crashes_people"].schema)
    return typed.select(
        "person_id",
        "age",
        "airbag_deployed_txt",
        "airbag_deployed",
        "cell_phone_use_txt",
        "cell_phone_use",
    )


@query(
    f"""
    SELECT event_id AS crash_unit_id, (event_id // 3)::VARCHAR AS crash_record_id,
           {sql.stamp(sql.utc("ts"))} AS crash_date, event_type AS vehicle_use,
           user_id % 6 AS occupant_cnt, {sql.yes_no(sql.YES_NO_TEXT)} AS fire_i
    FROM events
    """
)
def vehicle_transform(t: Tables) -> DataFrame:
    raw = standins.raw_datasets(t)["crashes_vehicles"]
    typed = transforms.transform("crashes_vehicles", raw, TABLES["crashes_vehicles"].schema)
    wanted = ["crash_unit_id", KEY, "crash_date", "vehicle_use", "occupant_cnt", "fire_i"]
    return shown(typed.select(*wanted))


# --- scalar functions ----------------------------------------------------


@query(f"SELECT event_id, {sql.yes_no(sql.YES_NO_TEXT)} AS flag FROM events")
def normalize_yes_no(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", text.yes_no(standins.cycled(standins.YES_NO_TEXTS)).alias("flag")
    )


@query(f"SELECT event_id, {sql.airbag(sql.AIRBAG_TEXT)} AS flag FROM events")
def normalize_airbag(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", text.airbag_state(standins.cycled(standins.AIRBAG_TEXTS)).alias("flag")
    )


@query(
    f"""
    SELECT event_id, low, high
    FROM ({sql.amounts(f"SELECT *, {sql.AMOUNT_TEXT} AS txt FROM events")})
    """
)
def amount_band(t: Tables) -> DataFrame:
    bands = t.events.select("event_id", text.amount_band(standins.amount_text()).alias("band"))
    return bands.select("event_id", "band.low", "band.high")


@query(
    f"""
    SELECT event_id, estimate,
           coalesce(estimate IS NULL AND (contains(band, 'OVER') OR contains(band, 'OR LESS')
                    OR contains(band, '-') OR len(n) > 0), FALSE) AS unreadable
    FROM ({sql.amounts(f"SELECT *, {sql.AMOUNT_TEXT} AS txt FROM events")})
    """
)
def amount_estimate(t: Tables) -> DataFrame:
    amount = standins.amount_text()
    return t.events.select(
        "event_id",
        text.amount_estimate(amount).alias("estimate"),
        text.amount_unreadable(amount).alias("unreadable"),
    )


@query(
    f"""
    SELECT event_id, hour({sql.utc("ts")}) < 12 AS utc_morning, hour(ts) < 12 AS local_morning
    FROM events
    """
)
def morning_flag(t: Tables) -> DataFrame:
    stored = times.local_to_utc(F.col("ts").cast("timestamp"))
    return t.events.select(
        "event_id",
        times.is_morning(stored).alias("utc_morning"),
        times.is_morning(stored, times.DEFAULT_ZONE).alias("local_morning"),
    )


@query(
    f"""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS day,
           {sql.stamp(sql.utc("o_orderdate"))} AS starts,
           {sql.stamp(sql.utc("o_orderdate + INTERVAL 1 DAY"))} AS ends,
           {sql.stamp(sql.utc("o_orderdate + INTERVAL 86399 SECOND"))} AS closed_end,
           count(*) AS incidents
    FROM orders GROUP BY ALL
    """
)
def local_day_bounds(t: Tables) -> DataFrame:
    counted = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("incidents")
    )
    day = F.col("day")
    return shown(
        counted.select(
            "day",
            times.local_day_start(day).alias("starts"),
            times.local_day_end(day).alias("ends"),
            times.local_day_end(day, closed=True).alias("closed_end"),
            "incidents",
        )
    )


# --- filters and joins ---------------------------------------------------


@query(
    """
    SELECT event_type, count(*) AS events FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-15 06:00:00' AND TIMESTAMP '2024-01-16 05:59:59'
    GROUP BY event_type
    """
)
def time_range_count(t: Tables) -> DataFrame:
    """A day's closed bounds, as literals."""
    bounds = days.DayBounds(DAY, closed_end=True)
    instants = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return (
        instants.filter(bounds.contains(F.col("ts")))
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("events"))
    )


@query(
    """
    SELECT event_type, count(*) AS events FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-15 06:00:00' AND TIMESTAMP '2024-01-16 05:59:59'
    GROUP BY event_type
    """
)
def parameter_table_filter(t: Tables) -> DataFrame:
    """The same bounds from a one-row table."""
    parameters = days.parameters_table(t.spark, days.DayBounds(DAY, closed_end=True))
    instants = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return (
        days.within_parameters(instants, parameters, "ts")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("events"))
    )


@query(
    """
    SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate)
    FROM orders WHERE o_orderkey = 7
    """
)
def point_lookup(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.filter(F.col("o_orderkey") == 7).withColumn("o_orderdate", day)


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    """
)
def semi_join_participants(t: Tables) -> DataFrame:
    chosen = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    return t.lineitem.join(
        chosen, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


# --- aggregates ----------------------------------------------------------


@query(f"SELECT crash_record_id, {sql.any_match(sql.FLAGS)} FROM ({sql.PEOPLE}) GROUP BY ALL")
def any_match_flags(t: Tables) -> DataFrame:
    return standins.people(t).groupBy(KEY).agg(*aggregates.participant_flags())


@query(f"SELECT crash_record_id, {sql.any_match(sql.AGE_BANDS)} FROM ({sql.PEOPLE}) GROUP BY ALL")
def age_bands(t: Tables) -> DataFrame:
    return standins.people(t).groupBy(KEY).agg(*aggregates.age_flags(F.col("age")))


@query(
    f"""
    SELECT crash_record_id, {sql.joined(sql.distinct("hospital"))} AS hospitals,
           {sql.joined(sql.distinct("sex"))} AS genders
    FROM ({sql.PEOPLE}) GROUP BY crash_record_id
    """
)
def sorted_distinct_list(t: Tables) -> DataFrame:
    lists = standins.people(t).groupBy(KEY).agg(
        aggregates.distinct_list(F.col("hospital")).alias("hospitals"),
        aggregates.distinct_list(F.col("sex")).alias("genders"),
    )
    return shown(lists)


@query(
    f"""
    SELECT crash_record_id, {sql.joined(sql.bag("vehicle_use"))} AS vehicle_uses
    FROM ({sql.VEHICLES}) GROUP BY crash_record_id
    """
)
def sorted_bag(t: Tables) -> DataFrame:
    return shown(
        aggregates.sorted_bag(standins.vehicles(t), [KEY], "vehicle_use", "vehicle_uses")
    )


@query(
    f"""
    SELECT crash_record_id, {sql.joined(sql.bag("airbag"))} AS list_of_airbag_deployed
    FROM ({sql.PEOPLE}) GROUP BY crash_record_id
    """
)
def airbag_bag(t: Tables) -> DataFrame:
    counted = standins.people(t).groupBy(KEY).agg(
        bags.bag_of_flag(F.col("airbag_deployed")).alias("bag")
    )
    return shown(counted.select(KEY, bags.as_list(F.col("bag")).alias("list_of_airbag_deployed")))


@query(sql.people_aggregate(sql.PEOPLE))
def participant_aggregate(t: Tables) -> DataFrame:
    return shown(rollups.with_lists(aggregates.participant_aggregate(standins.people(t))))


@query(sql.vehicle_aggregate(sql.VEHICLES))
def vehicle_aggregate(t: Tables) -> DataFrame:
    return shown(rollups.with_lists(aggregates.vehicle_aggregate(standins.vehicles(t))))


# --- rollups -------------------------------------------------------------


def _stamped(select: str) -> str:
    return f"SELECT * REPLACE ({sql.stamp('crash_date')} AS crash_date) FROM ({select})"


@query(_stamped(sql.people_summary(sql.INCIDENTS, sql.PEOPLE)))
def incident_people_summary(t: Tables) -> DataFrame:
    return shown(rollups.people_summary(standins.incidents(t), standins.people(t)))


@query(_stamped(sql.vehicle_summary(sql.INCIDENTS, sql.PEOPLE, sql.VEHICLES)))
def incident_vehicle_summary(t: Tables) -> DataFrame:
    summary = rollups.people_summary(standins.incidents(t), standins.people(t), lists=False)
    return shown(rollups.vehicle_summary(summary, standins.vehicles(t)))


def _counted(cube: DataFrame) -> DataFrame:
    estimate = sketches.distinct_estimate(F.col(rollups.SKETCH))
    return cube.withColumn("crashes", estimate).drop(rollups.SKETCH)


@query(sql.cube(sql.vehicle_summary(sql.INCIDENTS, sql.PEOPLE, sql.VEHICLES)))
def incident_cube(t: Tables) -> DataFrame:
    cube = rollups.incident_cube(standins.incidents(t), standins.people(t), standins.vehicles(t))
    return shown(_counted(cube))


_FEW_DIMENSIONS = ["crash_day", "weather_condition", "is_drunk", "hazmat_involved"]


@query(
    f"""
    SELECT strftime(crash_date, '%Y-%m-%d') AS crash_day, weather_condition, is_drunk,
           hazmat_involved, sum(num_people_involved)::BIGINT AS total_people_involved,
           sum(number_injured)::BIGINT AS total_injured, sum(number_fatal)::BIGINT AS total_fatal,
           sum(damage)::BIGINT AS total_damage, count(DISTINCT crash_record_id) AS crashes
    FROM ({sql.vehicle_summary(sql.INCIDENTS, sql.PEOPLE, sql.VEHICLES)}) GROUP BY ALL
    """
)
def incident_cube_few_dimensions(t: Tables) -> DataFrame:
    """Groups of several incidents: the cube over a choice of its dimensions."""
    cube = rollups.incident_cube(
        standins.incidents(t), standins.people(t), standins.vehicles(t), _FEW_DIMENSIONS
    )
    return shown(_counted(cube))


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def sketch_estimate(t: Tables) -> DataFrame:
    sketch = sketches.key_sketch(F.col("user_id"))
    return t.events.groupBy("event_type").agg(sketches.distinct_estimate(sketch).alias("users"))


@query(
    f"""
    SELECT weather_condition, street_name, is_hit_run,
           sum(total_people_involved)::BIGINT AS total_people_involved,
           sum(total_injured)::BIGINT AS total_injured, sum(total_fatal)::BIGINT AS total_fatal,
           sum(total_damage)::BIGINT AS total_damage, sum(crashes)::BIGINT AS crashes
    FROM ({sql.cube(sql.vehicle_summary(sql.INCIDENTS, sql.PEOPLE, sql.VEHICLES))})
    GROUP BY ALL
    """
)
def sketch_rollup(t: Tables) -> DataFrame:
    cube = rollups.incident_cube(
        standins.incidents(t), standins.people(t), standins.vehicles(t), lists=False
    )
    merged = rollups.merge_cube(cube, ["weather_condition", "street_name", "is_hit_run"])
    return merged.drop(rollups.SKETCH)


_SETS = """
    SELECT weather_condition, street_name, crash_record_id, is_hit_run, hazmat_involved,
           fire_happened, is_drunk
    FROM (CHAIN)
""".replace("CHAIN", sql.vehicle_summary(sql.INCIDENTS, sql.PEOPLE, sql.VEHICLES))


def _in_both(kind: str, first: str, second: str) -> str:
    ids = f"SELECT weather_condition, street_name, crash_record_id FROM ({_SETS}) WHERE"
    return f"{ids} {first} {kind} {ids} {second}"


def _per_group(name: str, ids: str) -> str:
    return f"""(SELECT weather_condition, street_name, count(*) AS {name} FROM ({ids}) GROUP BY ALL)"""


@query(
    f"""
    SELECT weather_condition, street_name, {", ".join(
        f"coalesce({n}, 0) AS {n}, coalesce({n}, 0) AS {n}_lower, coalesce({n}, 0) AS {n}_upper"
        for n in ("hit_hazmat", "either", "dangerous", "neither")
    )}
    FROM (SELECT DISTINCT weather_condition, street_name FROM ({_SETS}))
    LEFT JOIN {_per_group("hit_hazmat", _in_both("INTERSECT", "is_hit_run", "hazmat_involved"))}
      USING (weather_condition, street_name)
    LEFT JOIN {_per_group("either", _in_both("UNION", "is_hit_run", "hazmat_involved"))}
      USING (weather_condition, street_name)
    LEFT JOIN {_per_group("dangerous", "(" + _in_both("INTERSECT", "is_hit_run", "hazmat_involved") + ") EXCEPT "
      + f"SELECT weather_condition, street_name, crash_record_id FROM ({_SETS}) WHERE fire_happened")}
      USING (weather_condition, street_name)
    LEFT JOIN {_per_group("neither", _in_both("EXCEPT", "true", "(is_hit_run OR is_drunk)"))}
      USING (weather_condition, street_name)
    """
)
def sketch_set_algebra(t: Tables) -> DataFrame:
    """Sets of incidents worked out on the stored sketches of the cube, with bounds."""
    cube = rollups.incident_cube(
        standins.incidents(t), standins.people(t), standins.vehicles(t), lists=False
    )
    hit, hazmat, fire, drunk, all_ = (
        sketches.KeySet(n) for n in ("hit", "hazmat", "fire", "drunk", "all")
    )
    conditions = {
        "hit": F.col("is_hit_run"),
        "hazmat": F.col("hazmat_involved"),
        "fire": F.col("fire_happened"),
        "drunk": F.col("is_drunk"),
        "all": F.lit(True),
    }
    asked = {
        "hit_hazmat": hit & hazmat,
        "either": hit | hazmat,
        "dangerous": (hit & hazmat) - fire,
        "neither": all_ - (hit | drunk),
    }
    return rollups.incident_sets(cube, conditions, asked, ["weather_condition", "street_name"])


# --- stored tables and the pipeline --------------------------------------


def _warehouse(t: Tables, label: str) -> pipeline.Warehouse:
    folder = shared_folder(t.spark, label)
    return pipeline.Warehouse(t.spark, folder.rsplit("/", 1)[1].replace("-", "_"), folder)


@query(
    f"""
    SELECT strftime(ts, '%Y-%m-%d') AS service_day, count(*) AS events,
           {sql.stamp("min(" + sql.utc("ts") + ")")} AS first,
           {sql.stamp("max(" + sql.utc("ts") + ")")} AS last
    FROM events GROUP BY service_day
    """
)
def day_replace_roundtrip(t: Tables) -> DataFrame:
    """Store all local days, then replace two neighbours: neither loses the other's evening."""
    spec = TableSpec("typed_events", standins.EVENT_COLUMNS, time_column="ts", key_column=None)
    warehouse = _warehouse(t, "replace")
    warehouse.ensure("typed_events", spec)
    stored = warehouse.table("typed_events")
    typed = conform.conform(standins.raw_events(t), spec.schema)
    dated = typed.withColumn("service_day", times.local_day(F.col("ts")))
    tables.replace_days(dated, stored, spec)
    for day in (DAY, DAY + dt.timedelta(days=1)):
        tables.replace_day(dated.filter(F.col("service_day") == F.lit(day)), stored, spec, day)
    return shown(
        tables.read_table(t.spark, stored, spec)
        .groupBy("service_day")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.min("ts").alias("first"),
            F.max("ts").alias("last"),
        )
    )


_NEXT_DAY = DAY + dt.timedelta(days=1)


@query(
    f"""
    SELECT strftime(ts, '%Y-%m-%d') AS service_day, count(*) AS events,
           min(event_id::VARCHAR) AS least_id, sum(user_id)::DECIMAL(20, 0)::VARCHAR AS users,
           count(DISTINCT event_type) AS kinds, 0::BIGINT AS sources
    FROM events
    WHERE NOT (ts::DATE = DATE '{DAY}' AND event_id % 2 = 1)
      AND NOT (ts::DATE = DATE '{_NEXT_DAY}' AND event_id % 3 > 0)
    GROUP BY service_day
    """
)
def foreign_table_replace(t: Tables) -> DataFrame:
    """A table made elsewhere, of other order and types, with a column more and several
    fewer than declared: all of it, one day and some days of it are written by name."""
    spec = TableSpec("typed_events", standins.EVENT_COLUMNS, time_column="ts", key_column=None)
    warehouse = _warehouse(t, "foreign")
    stored = warehouse.table("typed_events")
    t.spark.sql(f"CREATE DATABASE {warehouse.database} LOCATION '{warehouse.location}'")
    t.spark.sql(
        f"CREATE TABLE {stored} (kind string, source string, user_id decimal(20,0), event_id string,"
        " service_day date) USING parquet PARTITIONED BY (service_day)"
    )
    spec = warehouse.ensure("typed_events", spec)
    raw = standins.raw_events(t)
    typed = conform.conform(raw.withColumn("service_day", F.to_date(F.substring("TS", 1, 10))), spec.stored_schema)
    event, day = F.col("event_id").cast("bigint"), F.col("service_day")
    tables.replace_all(typed, stored, spec)
    tables.replace_day(typed.filter((day == F.lit(DAY)) & (event % 2 == 0)), stored, spec, DAY)
    tables.replace_days(typed.filter((day == F.lit(_NEXT_DAY)) & (event % 3 == 0)), stored, spec, [_NEXT_DAY])
    return shown(
        tables.read_table(t.spark, stored, spec)
        .groupBy("service_day")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.min("event_id").alias("least_id"),
            F.sum("user_id").cast("decimal(20,0)").cast("string").alias("users"),
            F.count_distinct("kind").alias("kinds"),
            F.count("source").alias("sources"),
        )
    )


def _raw_incidents(where: str = "") -> str:
    return f"""
    SELECT event_id::VARCHAR AS crash_record_id,
           {sql.utc("date_trunc('milliseconds', ts)")} AS crash_date,
           hour({sql.utc("ts")}) < 12 AS is_am, estimate AS damage,
           (user_id % 4)::INTEGER AS number_injured, (user_id % 2)::INTEGER AS number_fatal,
           event_type AS weather_condition, NULL::VARCHAR AS lighting_condition,
           {sql.yes_no(sql.YES_NO_TEXT)} AS is_hit_run, NULL::VARCHAR AS street_name,
           41.5::DOUBLE AS lat, NULL::DOUBLE AS lon, NULL::VARCHAR AS road_defect
    FROM ({sql.amounts(f"SELECT *, {sql.AMOUNT_TEXT} AS txt FROM events {where}")})
"""


_RAW_PEOPLE = f"""
    SELECT (event_id // 2)::VARCHAR AS crash_record_id, (user_id % 90)::INTEGER AS age,
           NULL::VARCHAR AS hospital, event_type AS sex,
           ([0.05, 0.2, NULL, NULL, NULL]::DOUBLE[])[(event_id % 5) + 1] AS bac,
           ({sql.airbag(sql.AIRBAG_TEXT)})::VARCHAR AS airbag,
           {sql.yes_no(sql.YES_NO_TEXT)} AS cell_phone_use
    FROM events
"""
_RAW_VEHICLES = f"""
    SELECT (event_id // 3)::VARCHAR AS crash_record_id, event_type AS vehicle_use,
           'MAKE ' || (user_id % 5) AS make, {sql.yes_no(sql.YES_NO_TEXT)} AS fire,
           user_id % 6 AS occupants, event_id % 3 = 1 AS hazmat
    FROM events
"""


@query(sql.cube(sql.vehicle_summary(_raw_incidents(), _RAW_PEOPLE, _RAW_VEHICLES)))
def pipeline_rebuild(t: Tables) -> DataFrame:
    """Raw text to stored cube through every table, all days at once."""
    warehouse = _warehouse(t, "pipeline")
    root = f"{warehouse.location}/raw"
    for name, rows in standins.raw_datasets(t).items():
        landing.land_days(rows, f"{root}/{name}", "crash_date", rows_per_file=1_000_000)
    for dataset in pipeline.DATASETS:
        pipeline.ingest_days(warehouse, root, dataset)
    pipeline.rebuild(warehouse)
    return shown(_counted(warehouse.read("crashes_cube")))


_SPOILED = """
    SELECT event_id, ts, user_id,
           CASE event_id % 7 WHEN 1 THEN '1,' || (100 + user_id % 800) WHEN 2 THEN 'many'
                WHEN 3 THEN '99999999999' WHEN 4 THEN NULL ELSE (user_id % 4)::VARCHAR END AS injuries,
           CASE WHEN event_id % 11 = 5 THEN 'yesterday' END AS police
    FROM events WHERE ts >= DATE 'FIRST' AND ts < DATE 'LAST'
""".replace("FIRST", str(DAY)).replace("LAST", str(DAY + dt.timedelta(days=2)))


def _spoiled(t: Tables) -> tuple[pipeline.Warehouse, str, pipeline.Dataset]:
    """Two landed days with values that cannot be read, each of them ingested."""
    warehouse, event = _warehouse(t, "quarantine"), F.col("crash_record_id").cast("bigint")
    user = F.col("user_id")
    raw = t.events.select(
        F.col("event_id").cast("string").alias("crash_record_id"),
        F.date_format("ts", times.LOCAL_PATTERN).alias("crash_date"),
        "user_id",
    )
    case = event % 7
    raw = raw.select(
        "crash_record_id",
        "crash_date",
        F.when(case == 1, F.concat(F.lit("1,"), (user % 800 + 100).cast("string")))
        .when(case == 2, "many")
        .when(case == 3, "99999999999")
        .when(case != 4, (user % 4).cast("string"))
        .alias("injuries_total"),
        F.when(event % 11 == 5, "yesterday").alias("date_police_notified"),
    )
    only, root = pipeline.Dataset("crashes"), f"{warehouse.location}/raw"
    for day in (DAY, DAY + dt.timedelta(days=1)):
        pipeline.land_datasets({"crashes": raw}, root, day, [only])
        quarantine.ingest_day(warehouse, root, day, only)
    return warehouse, root, only


@query(
    f"""
    SELECT strftime(ts, '%Y-%m-%d') AS service_day, 'injuries_total' AS "column", injuries AS raw,
           CASE event_id % 7 WHEN 3 THEN 'out of range of int' ELSE 'no int' END AS reason,
           count(*) AS cells
    FROM ({_SPOILED}) WHERE event_id % 7 IN (1, 2, 3) GROUP BY ALL
    UNION ALL
    SELECT strftime(ts, '%Y-%m-%d'), 'date_police_notified', police, 'no timestamp', count(*)
    FROM ({_SPOILED}) WHERE police IS NOT NULL GROUP BY ALL
    """
)
def quarantine_cells(t: Tables) -> DataFrame:
    """The values of two ingested days that could not be read, with their reasons."""
    warehouse, *_ = _spoiled(t)
    cells = warehouse.read(quarantine.cells_table("crashes"))
    return shown(
        cells.groupBy("service_day", "column", "raw", "reason").agg(F.count(F.lit(1)).alias("cells"))
    )


@query(
    f"""
    SELECT event_id::VARCHAR AS crash_record_id, strftime(ts, '%Y-%m-%d') AS service_day,
           CASE WHEN event_id % 7 IN (2, 3, 4) THEN NULL
                ELSE replace(injuries, ',', '')::INTEGER END AS injuries_total,
           (CASE WHEN event_id % 7 IN (2, 3) THEN 1 ELSE 0 END + CASE WHEN police IS NULL THEN 0 ELSE 1 END)
             ::BIGINT AS cells_left
    FROM ({_SPOILED})
    """
)
def quarantine_replay(t: Tables) -> DataFrame:
    """Rejected numbers read again by a rule that knows thousands separators: those move
    into their rows, and what is still unreadable stays."""
    warehouse, _, only = _spoiled(t)

    def with_separators(rows: DataFrame, schema: T.StructType, zone: str) -> DataFrame:
        if "injuries_total" in rows.columns:
            rows = rows.withColumn("injuries_total", F.replace("injuries_total", F.lit(",")))
        return transforms.transform("crashes", rows, schema, zone)

    quarantine.replay(warehouse, only, [DAY, DAY + dt.timedelta(days=1)], with_separators)
    stored = warehouse.read("crashes")
    hashed = stored.withColumn("digest", quarantine.row_digest(warehouse.ensure("crashes")))
    cells = warehouse.read(quarantine.cells_table("crashes"))
    left = cells.groupBy("service_day", "digest").agg(F.count(F.lit(1)).alias("cells_left"))
    joined = hashed.join(left, ["service_day", "digest"], "left").select(
        "crash_record_id", "service_day", "injuries_total", F.coalesce("cells_left", F.lit(0)).alias("cells_left")
    )
    return shown(joined)


_QUESTIONS = (
    ("weather_condition", "is_hit_run"),
    ("crash_day", "weather_condition"),
    ("is_hit_run", "fire_happened", "hazmat_involved"),
)


def _question(dimensions: tuple[str, ...]) -> str:
    keys = ", ".join(
        f"{d}::VARCHAR AS {d}" if d in dimensions else f"NULL::VARCHAR AS {d}"
        for d in ("crash_day", "weather_condition", "is_hit_run", "fire_happened", "hazmat_involved")
    )
    return f"""
    SELECT {keys}, sum(total_people_involved)::BIGINT AS total_people_involved,
           sum(total_injured)::BIGINT AS total_injured, sum(total_fatal)::BIGINT AS total_fatal,
           sum(total_damage)::BIGINT AS total_damage, sum(crashes)::BIGINT AS crashes
    FROM (CUBE) GROUP BY ALL
    """


@query(
    " UNION ALL ".join(map(_question, _QUESTIONS)).replace(
        "CUBE", sql.cube(sql.vehicle_summary(_raw_incidents(), _RAW_PEOPLE, _RAW_VEHICLES))
    )
)
def cube_lattice(t: Tables) -> DataFrame:
    """Questions to the stored cube, answered by the smaller views stored for them."""
    warehouse = _warehouse(t, "lattice")
    pipeline.land_and_ingest_days(warehouse, standins.raw_datasets(t), f"{warehouse.location}/raw")
    pipeline.rebuild(warehouse)
    questions = {frozenset(q): 1.0 for q in _QUESTIONS}
    views = lattice.stored_views(warehouse, questions, most=2)
    answers = []
    for asked in _QUESTIONS:
        found = views.merge(list(asked)).drop(rollups.SKETCH)
        for name in set().union(*_QUESTIONS):
            value = F.col(name).cast("string") if name in asked else F.lit(None).cast("string")
            found = found.withColumn(name, value)
        answers.append(found)
    return answers[0].unionByName(answers[1]).unionByName(answers[2])


_RUN_DAYS = [DAY + dt.timedelta(days=n) for n in range(3)]
_IN_RUN_DAYS = f"WHERE ts >= DATE '{_RUN_DAYS[0]}' AND ts < DATE '{_RUN_DAYS[-1] + dt.timedelta(days=1)}'"


@query(sql.cube(sql.vehicle_summary(_raw_incidents(_IN_RUN_DAYS), _RAW_PEOPLE, _RAW_VEHICLES)))
def daily_run(t: Tables) -> DataFrame:
    """Three local days landed, ingested and rolled up one by one, the second again.

    People and vehicles of all days are stored before, so a day's incidents have
    children on other days; the run finds them without reading all days.
    """
    warehouse = _warehouse(t, "daily")
    root, sources = f"{warehouse.location}/raw", standins.raw_datasets(t)
    pipeline.land_and_ingest_days(warehouse, sources, root)
    for day in (*_RUN_DAYS, _RUN_DAYS[1]):
        pipeline.run_day(warehouse, sources, root, days.DayBounds(day))
    return shown(_counted(warehouse.read("crashes_cube")))


@query(
    """
    SELECT count(*) FILTER (event_id % 10 NOT IN (3, 7)) AS landed,
           count(*) FILTER (event_id % 10 IN (3, 7)) AS undated,
           count(*) FILTER (event_id % 10 NOT IN (3, 7)) AS ingested,
           count(*) FILTER (event_id % 10 NOT IN (3, 7) AND event_id % 13 IN (REJECTED))
             AS amounts_rejected,
           count(*) FILTER (event_id % 10 NOT IN (3, 7) AND event_id % 6 = 4) AS counts_rejected
    FROM events
    """.replace("REJECTED", "8, 9, 10, 12")
)
def landed_and_rejected(t: Tables) -> DataFrame:
    """The counts a backfill reports, taken while it writes."""
    warehouse, event = _warehouse(t, "counted"), F.col("crash_record_id").cast("bigint")
    raw = standins.raw_datasets(t)["crashes"].withColumns(
        {
            "crash_date": F.when(event % 10 == 3, "yesterday").when(event % 10 != 7, F.col("crash_date")),
            "injuries_total": F.when(event % 6 == 4, "some").otherwise(F.col("injuries_total")),
        }
    )
    done = pipeline.land_and_ingest_days(
        warehouse, {"crashes": raw}, f"{warehouse.location}/raw", [pipeline.Dataset("crashes")]
    )
    landed, ingested = done["crashes"]
    found = [landed.rows, landed.undated, ingested.rows]
    found += [ingested.rejects.get(c, 0) for c in ("damage_estimate", "injuries_total")]
    names = ("landed", "undated", "ingested", "amounts_rejected", "counts_rejected")
    return t.spark.createDataFrame([tuple(found)], ", ".join(f"{n} bigint" for n in names))


@query(
    f"""
    SELECT strftime(h, '%Y-%m-%d') AS service_day, count(*) AS incidents,
           sum(user_id % 4)::BIGINT AS injured, count(*) FILTER (h = date_trunc('day', h)) AS at_midnight
    FROM (SELECT date_trunc('hour', ts) AS h, user_id FROM events)
    WHERE h >= DATE '{_RUN_DAYS[0]}' AND h < DATE '{_RUN_DAYS[2]}' GROUP BY service_day
    """
)
def sql_stage_rerun(t: Tables) -> DataFrame:
    """Two local days through a stage of SQL text, the first again; hours are full,
    so many incidents stand at midnight, which is the next day's."""
    warehouse = _warehouse(t, "stages")
    crashes = t.events.select(
        F.col("event_id").cast("string").alias("crash_record_id"),
        F.date_format(F.date_trunc("hour", "ts"), times.LOCAL_PATTERN).alias("crash_date"),
        F.pmod("user_id", F.lit(4)).cast("string").alias("injuries_total"),
    )
    only = [pipeline.Dataset("crashes")]
    pipeline.land_and_ingest_days(warehouse, {"crashes": crashes}, f"{warehouse.location}/raw", only)
    stages = pipeline.load_sql_stages(os.path.join(os.path.dirname(__file__), "stages.json"))
    for day in (_RUN_DAYS[0], _RUN_DAYS[1], _RUN_DAYS[0]):
        pipeline.run_stages(warehouse, days.DayBounds(day), stages)
    midnight = F.col("crash_date") == times.local_day_start(F.col("service_day"))
    rows = warehouse.read("crashes_people_summary").groupBy("service_day")
    return shown(
        rows.agg(
            F.count(F.lit(1)).alias("incidents"),
            F.sum("number_injured").alias("injured"),
            F.count_if(midnight).alias("at_midnight"),
        )
    )
