"""Every registered query against its SQL, at the smallest scale."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as driver
from workload import registry

FOLDER = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def oracle():
    with duckdb.connect() as connection:
        for path in pathlib.Path(FOLDER).glob("*.parquet"):
            connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
        yield connection


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", driver.oracle_sql())
def test_query(spark, oracle, name):
    got = driver.queries()[name](spark, FOLDER)
    expected = oracle.sql(driver.oracle_sql()[name])
    assert {c: TYPES[t] for c, t in got.dtypes} == {
        c: str(t) for c, t in zip(expected.columns, expected.types, strict=True)
    }
    rows = [tuple(r) for r in got.collect()]
    assert rows
    assert by_name(got.columns, rows) == by_name(expected.columns, expected.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


# These write tables before they return.
STORED = {
    "day_replace_roundtrip", "pipeline_rebuild", "landing_counts", "landing_files", "daily_run",
    "landed_and_rejected", "sql_stage_rerun", "foreign_table_replace", "quarantine_cells",
    "quarantine_replay", "cube_lattice",
}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - STORED))
def test_plan_stays_in_the_jvm(spark, name):
    text = plan(driver.queries()[name](spark, FOLDER))
    for node in ("Python", "CartesianProduct", "NestedLoop", "SinglePartition"):
        if name == "conform_rejects" and node == "SinglePartition":
            continue  # one row of counts
        assert node not in text, node


def test_day_reaches_the_scan(spark):
    text = plan(driver.queries()["landing_day_extract"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-15T00:00)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_large_chain_shuffles_by_incident(spark):
    """Beyond the broadcast limit the summary is shuffled once, for both joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(driver.queries()["incident_cube"](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # incidents, people; vehicles by combination, by value and by incident; the
    # cube; and the two sides of the stand-in's join of line items with parts
    assert text.count("Exchange hashpartitioning") == 8
