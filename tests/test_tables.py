from concurrent.futures import ThreadPoolExecutor
import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.functions.times import local_day
from daybook.sources.schemas import TABLES, TableSpec
from daybook.sources.tables import (
    ensure_table, in_catalog, read_table, replace_all, replace_day, replace_days,
)

SPEC = TableSpec("t", "id string, crash_date timestamp", key_column="id")
FIRST, SECOND, THIRD = (dt.date(2024, 4, day) for day in (19, 20, 21))


@pytest.fixture
def table(spark, request):
    name = "t_" + request.node.name.split("[")[0]
    ensure_table(spark, name, SPEC)
    return name


def hours(spark, day):
    """One row per local hour of the day, with its UTC instant."""
    start = dt.datetime.combine(day, dt.time(5))
    rows = [(f"{day}#{h}", start + dt.timedelta(hours=h)) for h in range(24)]
    return spark.createDataFrame(rows, "id string, crash_date timestamp")


def counts(spark, table):
    rows = read_table(spark, table, SPEC).groupBy("service_day").count().collect()
    return {r["service_day"]: r["count"] for r in rows}


def test_declared_schemas(spark):
    sizes = {name: len(spec.schema.fields) for name, spec in TABLES.items()}
    # the cube's 30 columns include its day
    assert sizes == {
        "crashes": 50, "crashes_people": 31, "crashes_vehicles": 69,
        "crashes_people_summary": 25, "crashes_people_vehicle_summary": 30, "crashes_cube": 29,
        "crashes_people_days": 2, "crashes_vehicles_days": 2, "run_ledger": 5, "crashes_cube_parts": 30,
    }
    assert len(TABLES["crashes_cube"].stored_schema.fields) == 30


def test_neighbouring_days_keep_their_evenings(spark, table):
    for day in (FIRST, SECOND, FIRST):
        replace_day(hours(spark, day), table, SPEC, day)
    assert counts(spark, table) == {FIRST: 24, SECOND: 24}


def test_empty_rerun_empties_only_its_day(spark, table):
    for day in (FIRST, SECOND):
        replace_day(hours(spark, day), table, SPEC, day)
    replace_day(hours(spark, FIRST).filter("id = 'none'"), table, SPEC, FIRST)
    assert counts(spark, table) == {SECOND: 24}


def dated(rows):
    return rows.withColumn("service_day", local_day(F.col("crash_date")))


def test_replace_present_days(spark, table):
    both = hours(spark, FIRST).union(hours(spark, SECOND))
    replace_days(dated(both), table, SPEC)
    replace_days(dated(hours(spark, SECOND).limit(3)), table, SPEC)
    assert counts(spark, table) == {FIRST: 24, SECOND: 3}


def test_replace_named_days(spark, table):
    three = hours(spark, FIRST).union(hours(spark, SECOND)).union(hours(spark, THIRD))
    replace_days(dated(three), table, SPEC)
    # the third day has rows and is not named: nothing is written
    rows = dated(hours(spark, SECOND).limit(3).union(hours(spark, THIRD).limit(1)))
    with pytest.raises(Exception, match="rows outside the replaced days"):
        replace_days(rows, table, SPEC, [FIRST, SECOND])
    assert counts(spark, table) == {FIRST: 24, SECOND: 24, THIRD: 24}
    # the first day is named and has no rows now
    replace_days(dated(hours(spark, SECOND).limit(3)), table, SPEC, [FIRST, SECOND])
    assert counts(spark, table) == {SECOND: 3, THIRD: 24}
    nothing = dated(hours(spark, SECOND)).join(spark.range(0), F.lit(True), "left_semi")
    replace_days(nothing, table, SPEC, [SECOND])
    assert counts(spark, table) == {THIRD: 24}


def test_replace_all(spark, table):
    replace_day(hours(spark, FIRST), table, SPEC, FIRST)
    replace_all(dated(hours(spark, SECOND)), table, SPEC)
    assert counts(spark, table) == {SECOND: 24}


def test_writes_need_no_session_setting(spark, table):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    for mode in ("static", "dynamic"):
        spark.conf.set(key, mode)
        replace_day(hours(spark, THIRD), table, SPEC, THIRD)
        replace_days(dated(hours(spark, FIRST)), table, SPEC)
        assert counts(spark, table) == {FIRST: 24, THIRD: 24}
        replace_all(dated(hours(spark, THIRD)), table, SPEC)
        assert counts(spark, table) == {THIRD: 24}
        assert spark.conf.get(key) == mode
    spark.conf.set(key, before)


def test_two_writes_at_once(spark, table):
    replace_day(hours(spark, SECOND), table, SPEC, SECOND)
    with ThreadPoolExecutor(2) as pool:
        jobs = [pool.submit(replace_days, dated(hours(spark, d)), table, SPEC, [d]) for d in (FIRST, THIRD)]
        for job in jobs:
            job.result()
    assert counts(spark, table) == {FIRST: 24, SECOND: 24, THIRD: 24}


def test_columns_go_by_name(spark, table):
    replace_day(hours(spark, FIRST).select("crash_date", "id"), table, SPEC, FIRST)
    assert read_table(spark, table, SPEC, [FIRST]).filter("id = '2024-04-19#0'").count() == 1


def test_days_prune_the_scan(spark, table):
    replace_day(hours(spark, FIRST), table, SPEC, FIRST)
    plan = read_table(spark, table, SPEC, [FIRST])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(service_day" in plan


def test_existing_folder_is_picked_up(spark, tmp_path):
    place = str(tmp_path / "kept")
    ensure_table(spark, "kept_one", SPEC, place)
    replace_day(hours(spark, FIRST), "kept_one", SPEC, FIRST)
    ensure_table(spark, "kept_two", SPEC, place)
    assert counts(spark, "kept_two") == {FIRST: 24}


def test_emptied_days_leave_no_files(spark, tmp_path):
    place = str(tmp_path / "emptied")
    ensure_table(spark, "emptied_one", SPEC, place)
    for day in (FIRST, SECOND, THIRD):
        replace_day(hours(spark, day), "emptied_one", SPEC, day)
    replace_day(hours(spark, FIRST).limit(0), "emptied_one", SPEC, FIRST)
    replace_days(dated(hours(spark, THIRD)), "emptied_one", SPEC, [SECOND, THIRD])
    assert counts(spark, "emptied_one") == {THIRD: 24}
    ensure_table(spark, "emptied_two", SPEC, place)
    assert counts(spark, "emptied_two") == {THIRD: 24}
    assert spark.read.parquet(place).count() == 24


@pytest.mark.parametrize("options", ["", " OPTIONS ('partitionOverwriteMode' = 'static')"])
def test_tables_made_elsewhere_keep_their_other_days(spark, options):
    """A table whose DDL does not declare overwriting by partition."""
    name = f"t_elsewhere_{len(options)}"
    spark.sql(
        f"CREATE TABLE {name} (id string, crash_date timestamp, service_day date)"
        f" USING parquet{options} PARTITIONED BY (service_day)"
    )
    for day in (FIRST, SECOND):
        replace_day(hours(spark, day), name, SPEC, day)
    ensure_table(spark, name, SPEC)
    replace_days(dated(hours(spark, SECOND).limit(3)), name, SPEC, [SECOND])
    assert counts(spark, name) == {FIRST: 24, SECOND: 3}
    replace_days(dated(hours(spark, THIRD)), name, SPEC)
    assert counts(spark, name) == {FIRST: 24, SECOND: 3, THIRD: 24}


WRITERS = {
    "replace_day": lambda rows, table, day: replace_day(rows, table, SPEC, day),
    "replace_days": lambda rows, table, day: replace_days(rows.withColumn("service_day", F.lit(day)), table, SPEC, [day]),
    "replace_all": lambda rows, table, day: replace_all(rows.withColumn("service_day", F.lit(day)), table, SPEC),
}


@pytest.mark.parametrize("writer", WRITERS)
def test_tables_of_other_columns_are_written_by_name(spark, writer):
    """Another order, one column more and one fewer than declared, another type."""
    name = f"t_foreign_{writer}"
    spark.sql(
        f"CREATE TABLE {name} (note string, ID bigint, more struct<a:int,b:array<string>>, service_day date)"
        " USING parquet PARTITIONED BY (service_day)"
    )
    spec = TableSpec("t", "id string, crash_date timestamp, note string", key_column="id")
    rows = spark.createDataFrame([("7", "seven", dt.datetime(2024, 4, 19))], "id string, note string, crash_date timestamp")
    ensure_table(spark, name, spec)
    WRITERS[writer](rows, name, FIRST)
    assert [tuple(r) for r in spark.table(name).collect()] == [("seven", 7, None, FIRST)]
    assert in_catalog(spark, name, spec).schema.names == ["note", "ID", "more"]


def test_table_of_other_partitions_is_refused(spark):
    spark.sql("CREATE TABLE t_unpartitioned (id string, crash_date timestamp, service_day date) USING parquet")
    with pytest.raises(ValueError, match="partitioned by nothing, not by service_day"):
        replace_day(hours(spark, FIRST), "t_unpartitioned", SPEC, FIRST)
