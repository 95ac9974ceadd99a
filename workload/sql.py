"""SQL for the stand-ins, shared by the expected results.

Written against the supplied tables alone; nothing is taken from the library.
"""

from __future__ import annotations

BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def cycled(choices: list[str | None], by: str = "event_id") -> str:
    """A list index; ``None`` is null and text is quoted unless it starts with ``=``."""
    items = [
        "NULL" if c is None else c[1:] if c.startswith("=") else "'" + c.replace("'", "''") + "'"
        for c in choices
    ]
    return f"([{', '.join(items)}]::VARCHAR[])[({by} % {len(items)}) + 1]"


YES_NO_TEXT = cycled(
    ["Y", "y", "YES", "TRUE", " true ", "1", "N", "NO", "FALSE", "maybe", "", None,
     "=chr(9) || 'yes' || chr(10)"]
)
AIRBAG_TEXT = cycled(
    ["DEPLOYED, FRONT", "DePLOYED", "DID not DEPLOY", "NOT DEPLOYED", "DEPLOYMENT UNKNOWN",
     "NOT APPLICABLE", None]
)
AMOUNT_TEXT = cycled(
    ["='OVER $1,' || user_id", "='$' || user_id || ' - $1,' || event_id",
     "=user_id || '  -  ' || event_id", "=' $' || event_id || ' or less '", "='$' || event_id",
     "='over $' || user_id", "UNKNOWN FORMAT", None, "OVER", "OR LESS", "5 -", "",
     "$99,999,999,999"]
)


def yes_no(text: str) -> str:
    return (
        f"CASE WHEN {text} IS NULL THEN NULL"
        f" ELSE lower(trim({text}, {BLANKS})) IN ('y', 'true', '1', 'yes') END"
    )


def airbag(text: str) -> str:
    return (
        f"CASE WHEN contains(lower({text}), 'deployed') THEN TRUE"
        f" WHEN contains(lower({text}), 'not deploy') THEN FALSE END"
    )


def amounts(rows: str) -> str:
    """``rows`` (with column ``txt``) plus ``low``, ``high`` and ``estimate``."""
    return f"""
        SELECT *, CASE WHEN high IS NULL THEN low ELSE (low + high) // 2 END AS middle,
               CASE WHEN middle <= 2147483647 THEN middle::INTEGER END AS estimate
        FROM (
            SELECT *,
                CASE WHEN band LIKE 'OVER%' THEN n[1]
                     WHEN contains(band, 'OR LESS') THEN CASE WHEN len(n) > 0 THEN 1 END
                     WHEN contains(band, '-') THEN CASE WHEN len(n) > 1 THEN n[1] END
                     ELSE n[1] END AS low,
                CASE WHEN band LIKE 'OVER%' THEN NULL
                     WHEN contains(band, 'OR LESS') THEN n[1]
                     WHEN contains(band, '-') THEN n[2]
                     ELSE n[1] END AS high
            FROM (
                SELECT *, trim(upper(replace(txt, ',', '')), {BLANKS}) AS band,
                       regexp_extract_all(band, '[0-9]+')::BIGINT[] AS n
                FROM ({rows})
            )
        )
    """


def utc(local: str) -> str:
    return f"timezone('UTC', timezone('America/Chicago', {local}))"


def stamp(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S')"


def joined(values: str) -> str:
    return f"array_to_string({values}, ',')"


def bag(value: str) -> str:
    return f"coalesce(list_sort(list({value}) FILTER ({value} IS NOT NULL)), [])"


def distinct(value: str) -> str:
    return f"coalesce(list_sort(list(DISTINCT {value}) FILTER ({value} IS NOT NULL)), [])"


AGE_BANDS = {
    "is_age_below_5": "age < 5",
    "is_age_10s": "age BETWEEN 10 AND 19",
    "is_age_20s": "age BETWEEN 20 AND 29",
    "is_age_30s": "age BETWEEN 30 AND 39",
    "is_age_40s": "age BETWEEN 40 AND 49",
    "is_age_50s": "age BETWEEN 50 AND 59",
    "is_age_senior": "age >= 60",
}
FLAGS = {"is_cell_phone_use": "cell_phone_use", "is_drunk": "bac > 0.08"}


def any_match(predicates: dict[str, str]) -> str:
    return ", ".join(f"bool_or(coalesce({p}, FALSE)) AS {n}" for n, p in predicates.items())


INCIDENTS = """
    SELECT o_orderkey::VARCHAR AS crash_record_id,
           o_orderdate + to_hours((o_custkey % 20)::INTEGER) AS crash_date,
           o_custkey % 20 < 12 AS is_am,
           floor(o_totalprice)::INTEGER AS damage,
           (o_custkey % 4)::INTEGER AS number_injured,
           (o_custkey % 2)::INTEGER AS number_fatal,
           o_orderpriority AS weather_condition,
           nullif(o_orderstatus, 'P') AS lighting_condition,
           o_orderstatus = 'F' AS is_hit_run,
           'STREET ' || (o_custkey % 7) AS street_name,
           41.0::DOUBLE + (o_custkey % 3) / 8.0::DOUBLE AS lat,
           -87.0::DOUBLE - (o_custkey % 5) / 8.0::DOUBLE AS lon,
           CASE WHEN o_custkey % 3 > 0 THEN 'NO DEFECTS' END AS road_defect
    FROM orders
"""
PEOPLE = """
    SELECT l_orderkey::VARCHAR AS crash_record_id,
           l_quantity::INTEGER * 2 - 1 AS age,
           nullif(l_returnflag, 'N') AS hospital,
           l_linestatus AS sex,
           nullif(l_discount, 0) AS bac,
           CASE WHEN l_tax > 0.04 THEN 'true' WHEN l_tax > 0.02 THEN 'false' END AS airbag,
           CASE WHEN l_suppkey % 3 > 0 THEN l_suppkey % 3 = 1 END AS cell_phone_use
    FROM lineitem
"""
VEHICLES = """
    SELECT l_orderkey::VARCHAR AS crash_record_id,
           nullif(p_type, 'MEDIUM') AS vehicle_use,
           p_brand AS make,
           CASE WHEN l_tax > 0.01 THEN l_tax >= 0.08 END AS fire,
           CASE WHEN l_linenumber < 7 THEN l_linenumber END AS occupants,
           coalesce(p_type = 'SMALL', FALSE) AS hazmat
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
"""


def people_aggregate(people: str) -> str:
    return f"""
        SELECT crash_record_id, {any_match(FLAGS)},
               {joined(distinct("hospital"))} AS list_of_hospital,
               {joined(distinct("sex"))} AS list_of_gender,
               {any_match(AGE_BANDS)},
               {joined(bag("airbag"))} AS list_of_airbag_deployed
        FROM ({people}) GROUP BY crash_record_id
    """


def vehicle_aggregate(vehicles: str) -> str:
    return f"""
        SELECT crash_record_id,
               {joined(bag("vehicle_use"))} AS vehicle_uses,
               {joined(bag("make"))} AS vehicle_makes,
               bool_or(fire) AS fire_happened,
               bool_or(hazmat) AS hazmat_involved,
               sum(occupants)::BIGINT AS num_people_involved
        FROM ({vehicles}) GROUP BY crash_record_id
    """


def people_summary(incidents: str, people: str) -> str:
    return f"""
        SELECT i.*, a.* EXCLUDE (crash_record_id)
        FROM ({incidents}) i LEFT JOIN ({people_aggregate(people)}) a USING (crash_record_id)
    """


def vehicle_summary(incidents: str, people: str, vehicles: str) -> str:
    return f"""
        SELECT s.*, coalesce(vehicle_uses, '') AS vehicle_uses,
               coalesce(vehicle_makes, '') AS vehicle_makes, fire_happened,
               coalesce(hazmat_involved, FALSE) AS hazmat_involved, num_people_involved
        FROM ({people_summary(incidents, people)}) s
        LEFT JOIN ({vehicle_aggregate(vehicles)}) v USING (crash_record_id)
    """


# Of the dimensions only the day is computed.
DIMENSIONS = """
    lat, lon, list_of_hospital, list_of_gender, list_of_airbag_deployed, vehicle_uses,
    vehicle_makes, is_am, weather_condition, lighting_condition, is_hit_run, street_name,
    road_defect, is_cell_phone_use, is_drunk, is_age_below_5, is_age_10s, is_age_20s,
    is_age_30s, is_age_40s, is_age_50s, is_age_senior, fire_happened, hazmat_involved
"""


def cube(summary: str) -> str:
    return f"""
        SELECT strftime(crash_date, '%Y-%m-%d') AS crash_day, {DIMENSIONS},
               sum(num_people_involved)::BIGINT AS total_people_involved,
               sum(number_injured)::BIGINT AS total_injured,
               sum(number_fatal)::BIGINT AS total_fatal,
               sum(damage)::BIGINT AS total_damage,
               count(DISTINCT crash_record_id) AS crashes
        FROM ({summary}) GROUP BY ALL
    """
