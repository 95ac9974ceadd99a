"""Incident-shaped frames made from the supplied tables.

Orders stand for incidents, their line items for participants and, with the
part, for vehicles. Event rows stand for a raw extract in text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.times import LOCAL_PATTERN


class Tables:
    """The Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")


def _key(column: str) -> Column:
    return F.col(column).cast("string").alias("crash_record_id")


def incidents(t: Tables) -> DataFrame:
    hour = F.make_dt_interval(F.lit(0), F.pmod("o_custkey", F.lit(20)).cast("int"))
    when = (F.col("o_orderdate") + hour).cast("timestamp")
    return t.orders.select(
        _key("o_orderkey"),
        when.alias("crash_date"),
        (F.hour(when) < 12).alias("is_am"),
        F.floor("o_totalprice").cast("int").alias("damage_estimate"),
        F.pmod("o_custkey", F.lit(4)).cast("int").alias("injuries_total"),
        F.pmod("o_custkey", F.lit(2)).cast("int").alias("injuries_fatal"),
        F.col("o_orderpriority").alias("weather_condition"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("lighting_condition"),
        (F.col("o_orderstatus") == "F").alias("hit_and_run_i"),
        F.concat(F.lit("STREET "), F.pmod("o_custkey", F.lit(7)).cast("string")).alias(
            "street_name"
        ),
        (F.pmod("o_custkey", F.lit(3)) / F.lit(8.0) + F.lit(41.0)).alias("latitude"),
        (F.lit(-87.0) - F.pmod("o_custkey", F.lit(5)) / F.lit(8.0)).alias("longitude"),
        F.when(F.pmod("o_custkey", F.lit(3)) > 0, F.lit("NO DEFECTS")).alias("road_defect"),
    )


def people(t: Tables) -> DataFrame:
    tax = F.col("l_tax")
    return t.lineitem.select(
        _key("l_orderkey"),
        (F.col("l_quantity").cast("int") * 2 - 1).alias("age"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("hospital"),
        F.col("l_linestatus").alias("sex"),
        F.when(F.col("l_discount") == 0, F.lit(""))
        .otherwise(F.col("l_discount").cast("string"))
        .alias("bac_result"),
        F.when(tax > 0.04, F.lit(True)).when(tax > 0.02, F.lit(False)).alias("airbag_deployed"),
        F.when(F.col("l_suppkey") % 3 > 0, F.col("l_suppkey") % 3 == 1).alias("cell_phone_use"),
    )


def vehicles(t: Tables) -> DataFrame:
    kind = F.col("p_type")
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        _key("l_orderkey"),
        F.when(kind != "MEDIUM", kind).alias("vehicle_use"),
        F.col("p_brand").alias("make"),
        F.when(F.col("l_tax") > 0.01, F.col("l_tax") >= 0.08).alias("fire_i"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).cast("bigint").alias("occupant_cnt"),
        F.when(kind == "PROMO", F.lit("")).when(kind == "SMALL", F.lit("x")).alias("hazmat_class"),
    )


def cycled(choices: list[Column | str | None], by: str = "event_id") -> Column:
    """One of ``choices`` per row, in turn of a whole-number column."""
    texts = [c if isinstance(c, Column) else F.lit(c) for c in choices]
    return F.element_at(
        F.array(*[c.cast("string") for c in texts]),
        (F.pmod(F.col(by), F.lit(len(texts))) + 1).cast("int"),
    )


# Spellings of flags and bands, good and bad, that event rows take in turn.
YES_NO_TEXTS = ["Y", "y", "YES", "TRUE", " true ", "1", "N", "NO", "FALSE", "maybe", "", None, "\tyes\n"]
AIRBAG_TEXTS = [
    "DEPLOYED, FRONT", "DePLOYED", "DID not DEPLOY", "NOT DEPLOYED", "DEPLOYMENT UNKNOWN",
    "NOT APPLICABLE", None,
]


def amount_text() -> Column:
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    return cycled(
        [
            F.concat(F.lit("OVER $1,"), user),
            F.concat(F.lit("$"), user, F.lit(" - $1,"), event),
            F.concat(user, F.lit("  -  "), event),
            F.concat(F.lit(" $"), event, F.lit(" or less ")),
            F.concat(F.lit("$"), event),
            F.concat(F.lit("over $"), user),
            "UNKNOWN FORMAT", None, "OVER", "OR LESS", "5 -", "", "$99,999,999,999",
        ]
    )


def raw_events(t: Tables) -> DataFrame:
    """Events as an extract delivers them: text only, names in upper case."""
    return t.events.select(
        F.col("event_id").cast("string").alias("EVENT_ID"),
        F.date_format("ts", LOCAL_PATTERN).alias("TS"),
        F.col("user_id").cast("string").alias("USER_ID"),
        F.col("value").cast("string").alias("VALUE"),
        F.col("value").cast("string").alias("WHOLE"),
        cycled(["12", " 7 ", "-3.9", "abc", ".5", "99999999999", None, "1e3"]).alias("LOOSE"),
        cycled(YES_NO_TEXTS).alias("ACTIVE_I"),
        F.col("event_type").alias("KIND"),
        F.col("props").alias("NOT_DECLARED"),
    )


EVENT_COLUMNS = """
    event_id bigint, ts timestamp, user_id int, value double, whole int, loose int,
    active_i boolean, kind string, not_delivered string
"""


def raw_datasets(t: Tables) -> dict[str, DataFrame]:
    """Events as the three raw extracts.

    Each event is an incident; as a participant it belongs to the event of half
    its number, as a vehicle to that of a third, so late events have neither.
    """
    event, user = F.col("event_id"), F.col("user_id")
    when = F.date_format("ts", LOCAL_PATTERN).alias("crash_date")
    halved = F.floor(event / 2).cast("string").alias("crash_record_id")
    thirds = F.floor(event / 3).cast("string").alias("crash_record_id")
    crashes = t.events.select(
        event.cast("string").alias("crash_record_id"),
        when,
        amount_text().alias("damage"),
        F.pmod(user, F.lit(4)).cast("string").alias("injuries_total"),
        F.pmod(user, F.lit(2)).cast("string").alias("injuries_fatal"),
        F.col("event_type").alias("weather_condition"),
        cycled(YES_NO_TEXTS).alias("hit_and_run_i"),
        F.lit("41.5").alias("latitude"),
    )
    people = t.events.select(
        event.cast("string").alias("person_id"),
        halved,
        when,
        F.pmod(user, F.lit(90)).cast("string").alias("age"),
        F.col("event_type").alias("sex"),
        cycled(["0.05", "0.2", "", "n/a", None]).alias("bac_result"),
        cycled(AIRBAG_TEXTS).alias("airbag_deployed"),
        cycled(YES_NO_TEXTS).alias("cell_phone_use"),
    )
    vehicles = t.events.select(
        event.cast("string").alias("crash_unit_id"),
        thirds,
        when,
        F.col("event_type").alias("vehicle_use"),
        F.concat(F.lit("MAKE "), F.pmod(user, F.lit(5)).cast("string")).alias("make"),
        F.pmod(user, F.lit(6)).cast("string").alias("occupant_cnt"),
        cycled(YES_NO_TEXTS).alias("fire_i"),
        cycled(["", "3", None]).alias("hazmat_class"),
    )
    return {"crashes": crashes, "crashes_people": people, "crashes_vehicles": vehicles}
