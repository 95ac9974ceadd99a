"""Declared tables: columns, key, time column and the day they are kept by."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T

from daybook.sources.day_index import CELL_COLUMNS

SERVICE_DAY = "service_day"
CUBE_DAY = "crash_day"


@dataclass(frozen=True)
class TableSpec:
    """``columns`` is DDL without the day column, which Spark keeps last.

    ``stored`` says that they are those of the catalog's table, not only declared.
    """

    name: str
    columns: str
    day_column: str = SERVICE_DAY
    time_column: str | None = "crash_date"
    key_column: str | None = "crash_record_id"
    stored: bool = False

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @cached_property
    def stored_schema(self) -> T.StructType:
        day = T.StructField(self.day_column, T.DateType())
        return T.StructType([*self.schema.fields, day])


# Column names, order and types of the tables queries rely on.
CRASHES_COLUMNS = """
    workers_present_i boolean, work_zone_type string, work_zone_i boolean,
    weather_condition string, trafficway_type string, traffic_control_device string,
    street_no int, street_name string, street_direction string,
    statements_taken_i boolean, sec_contributory_cause string,
    roadway_surface_cond string, road_defect string, prim_contributory_cause string,
    posted_speed_limit int, photos_taken_i boolean, num_units int,
    not_right_of_way_i boolean, most_severe_injury string, longitude double,
    location string, lighting_condition string, latitude double, lane_cnt int,
    intersection_related_i boolean, injuries_unknown int, injuries_total int,
    injuries_reported_not_evident int, injuries_non_incapacitating int,
    injuries_no_indication int, injuries_incapacitating int, injuries_fatal int,
    hit_and_run_i boolean, dooring_i boolean, device_condition string, damage string,
    damage_estimate int, crash_type string, crash_record_id string, crash_month int,
    crash_hour int, crash_day_of_week int, crash_date_est_i boolean,
    crash_date timestamp, date_police_notified timestamp, beat_of_occurrence int,
    alignment string, report_type string, first_crash_type string, is_am boolean
"""

CRASHES_PEOPLE_COLUMNS = """
    person_id string, person_type string, crash_record_id string, vehicle_id string,
    crash_date timestamp, seat_no int, city string, state string, zipcode string,
    sex string, age int, drivers_license_state string, drivers_license_class string,
    safety_equipment string, airbag_deployed boolean, airbag_deployed_txt string,
    ejection string, injury_classification string, hospital string, ems_agency string,
    ems_run_no string, driver_action string, driver_vision string,
    physical_condition string, pedpedal_action string, pedpedal_visibility string,
    pedpedal_location string, bac_result string, bac_result_value double,
    cell_phone_use boolean, cell_phone_use_txt string
"""

# hazmat_report_no is a number by its name, so it stays text.
CRASHES_VEHICLES_COLUMNS = """
    crash_unit_id bigint, crash_record_id string, crash_date timestamp, unit_no bigint,
    unit_type string, num_passengers bigint, vehicle_id bigint, cmrc_veh_i boolean,
    make string, model string, lic_plate_state string, vehicle_year string,
    vehicle_defect string, veh_type_i boolean, vehicle_use string,
    travel_direction string, maneuver string, towed_i boolean, fire_i boolean,
    occupant_cnt bigint, exceed_speed_limit_i boolean, towed_by string, towed_to string,
    area_00_i boolean, area_01_i boolean, area_02_i boolean, area_03_i boolean,
    area_04_i boolean, area_05_i boolean, area_06_i boolean, area_07_i boolean,
    area_08_i boolean, area_09_i boolean, area_10_i boolean, area_11_i boolean,
    area_12_i boolean, area_99_i boolean, first_contact_point string, cmv_id bigint,
    usdot_no string, ccmc_no string, ilcc_no string, commercial_src string, gvwr string,
    carrier_name string, carrier_state string, carrier_city string,
    hazmat_placards_i boolean, hazmat_name string, un_no string, hazmat_present_i boolean,
    hazmat_report_i boolean, hazmat_report_no string, hazmat_viol_cause_crash_i boolean,
    mcs_viol_cause_crash_i boolean, idot_permit_no string, wide_load_i boolean,
    trailer1_width string, trailer2_width string, trailer1_length bigint,
    trailer2_length bigint, total_vehicle_length string, axle_cnt bigint,
    vehicle_config string, cargo_body_type string, load_type string,
    hazmat_out_of_service_i boolean, mcs_out_of_service_i boolean, hazmat_class string
"""

PEOPLE_SUMMARY_COLUMNS = """
    crash_date timestamp, crash_record_id string, is_am boolean, damage int,
    number_injured int, number_fatal int, weather_condition string,
    lighting_condition string, is_hit_run boolean, street_name string, lat double,
    lon double, road_defect string, is_cell_phone_use boolean, is_drunk boolean,
    list_of_hospital array<string>, list_of_gender array<string>,
    is_age_below_5 boolean, is_age_10s boolean, is_age_20s boolean, is_age_30s boolean,
    is_age_40s boolean, is_age_50s boolean, is_age_senior boolean,
    list_of_airbag_deployed array<string>
"""

# Sums are bigint: an int overflows on a large enough group.
VEHICLE_SUMMARY_COLUMNS = PEOPLE_SUMMARY_COLUMNS.rstrip() + """,
    vehicle_uses array<string>, vehicle_makes array<string>, fire_happened boolean,
    hazmat_involved boolean, num_people_involved bigint
"""

CUBE_COLUMNS = """
    is_am boolean, total_damage bigint, total_injured bigint, total_fatal bigint,
    weather_condition string, lighting_condition string, is_hit_run boolean,
    street_name string, lat double, lon double, road_defect string,
    is_cell_phone_use boolean, is_drunk boolean, list_of_hospital array<string>,
    list_of_gender array<string>, is_age_below_5 boolean, is_age_10s boolean,
    is_age_20s boolean, is_age_30s boolean, is_age_40s boolean, is_age_50s boolean,
    is_age_senior boolean, list_of_airbag_deployed array<string>,
    vehicle_uses array<string>, vehicle_makes array<string>, fire_happened boolean,
    hazmat_involved boolean, total_people_involved bigint, crashes_set_sketch binary
"""

# The cube of each local day's incidents, from which the days of the cube are merged.
CUBE_PARTS = "crashes_cube_parts"

# Which days hold the children of incidents of other days: kept beside each child
# table, so that a day's run reads only those days of it.
CHILD_DAYS = {"crashes_people": "crashes_people_days", "crashes_vehicles": "crashes_vehicles_days"}
# What has been finished, of which inputs, by day.
LEDGER = "run_ledger"
LEDGER_COLUMNS = "step string, inputs string, output string, files string, report string"

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec("crashes", CRASHES_COLUMNS),
        TableSpec("crashes_people", CRASHES_PEOPLE_COLUMNS),
        TableSpec("crashes_vehicles", CRASHES_VEHICLES_COLUMNS),
        TableSpec("crashes_people_summary", PEOPLE_SUMMARY_COLUMNS),
        TableSpec("crashes_people_vehicle_summary", VEHICLE_SUMMARY_COLUMNS),
        *(
            TableSpec(name, CELL_COLUMNS, time_column=None, key_column=None)
            for name in CHILD_DAYS.values()
        ),
        TableSpec(
            CUBE_PARTS, f"{CUBE_DAY} date, {CUBE_COLUMNS}", time_column=None, key_column=None
        ),
        TableSpec(LEDGER, LEDGER_COLUMNS, time_column=None, key_column="step"),
        TableSpec(
            "crashes_cube", CUBE_COLUMNS, day_column=CUBE_DAY, time_column=None, key_column=None
        ),
    )
}
