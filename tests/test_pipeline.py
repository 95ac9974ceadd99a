import datetime as dt
import json
import shutil

import pytest
from pyspark.sql import functions as F

from daybook.functions.sketches import distinct_estimate
from daybook.plans import pipeline, rollups
from daybook.plans.days import DayBounds
from daybook.plans.pipeline import Dataset, Stage, Warehouse
from daybook.sources.schemas import CHILD_DAYS, LEDGER

DAYS = [dt.date(2024, 4, day) for day in (19, 20, 21)]


def raw_sources(spark, first=DAYS[0], days=3, per_day=24):
    """One incident per local hour, two people and up to two vehicles each."""
    start = dt.datetime.combine(first, dt.time())
    crashes, people, vehicles = [], [], []
    for k in range(days * per_day):
        when = (start + dt.timedelta(hours=k)).strftime("%Y-%m-%dT%H:%M:%S.000")
        crashes.append((f"c{k}", when, "OVER $1,500" if k % 2 else "$500", str(k % 3), "Y" if k % 5 else None))
        for n in range(2):
            people.append((f"p{k}.{n}", f"c{k}", when, str(k * 7 % 90), "M", "DEPLOYED" if n else None))
        for n in range(k % 3):
            vehicles.append((str(k * 10 + n), f"c{k}", when, "TAXI", "FORD", "2", "3" if k % 4 else ""))
    return {
        "crashes": spark.createDataFrame(
            crashes,
            "crash_record_id string, crash_date string, damage string, injuries_total string,"
            " hit_and_run_i string",
        ),
        "crashes_people": spark.createDataFrame(
            people,
            "person_id string, crash_record_id string, crash_date string, age string, sex string,"
            " airbag_deployed string",
        ),
        "crashes_vehicles": spark.createDataFrame(
            vehicles,
            "crash_unit_id string, crash_record_id string, crash_date string,"
            " vehicle_use string, make string, occupant_cnt string, hazmat_class string",
        ),
    }


def content(warehouse, name):
    rows = warehouse.read(name)
    if rollups.SKETCH in rows.columns:
        rows = rows.withColumn(rollups.SKETCH, distinct_estimate(F.col(rollups.SKETCH)))
    return sorted(repr(tuple(r)) for r in rows.select(*sorted(rows.columns)).collect())


ROLLUPS = ["crashes_people_summary", "crashes_people_vehicle_summary", "crashes_cube"]


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    """Three days run one after the other."""
    root = str(tmp_path_factory.mktemp("raw"))
    warehouse = Warehouse(spark, "daily", str(tmp_path_factory.mktemp("daily")))
    sources = raw_sources(spark)
    counts = [pipeline.run_day(warehouse, sources, root, DayBounds(day)) for day in DAYS]
    return warehouse, root, sources, counts


def test_counts(daily):
    warehouse, _, _, counts = daily
    assert [c["num_recs_crashes"] for c in counts] == [24, 24, 24]
    assert [c["num_recs_crashes_people"] for c in counts] == [48, 48, 48]
    assert warehouse.read("crashes").count() == 72
    assert warehouse.read("crashes_people_summary").count() == 72


def test_days_are_whole_in_every_table(daily):
    warehouse, *_ = daily
    rows = warehouse.read("crashes").groupBy("service_day").count().collect()
    assert {r["service_day"]: r["count"] for r in rows} == dict.fromkeys(DAYS, 24)
    cube = warehouse.read("crashes_cube")
    total = cube.agg(F.sum(distinct_estimate(F.col(rollups.SKETCH)))).first()[0]
    assert total == 72
    # three local days reach into a fourth UTC day
    assert cube.select("crash_day").distinct().count() == 4


def test_daily_runs_equal_a_rebuild(spark, daily, tmp_path):
    warehouse, root, _, _ = daily
    other = Warehouse(spark, "rebuilt", str(tmp_path))
    for dataset in pipeline.DATASETS:
        pipeline.ingest_days(other, root, dataset)
    pipeline.rebuild(other)
    for name in ["crashes", "crashes_people", "crashes_vehicles", *ROLLUPS]:
        assert content(warehouse, name) == content(other, name), name


def test_rerunning_a_day_changes_nothing(daily):
    warehouse, root, sources, _ = daily
    before = {name: content(warehouse, name) for name in ROLLUPS}
    pipeline.run_day(warehouse, sources, root, DayBounds(DAYS[1]))
    assert {name: content(warehouse, name) for name in ROLLUPS} == before


def test_a_day_that_became_empty(spark, tmp_path):
    warehouse = Warehouse(spark, "emptied", str(tmp_path / "wh"))
    root, sources = str(tmp_path / "raw"), raw_sources(spark, days=2)
    for day in DAYS[:2]:
        pipeline.run_day(warehouse, sources, root, DayBounds(day))
    left = {n: s.filter(F.col("crash_date") < "2024-04-20") for n, s in sources.items()}
    pipeline.run_day(warehouse, left, root, DayBounds(DAYS[1]))
    for name in ROLLUPS[:2]:
        assert warehouse.read(name).count() == 24
    cube = warehouse.read("crashes_cube")
    assert cube.agg(F.sum(distinct_estimate(F.col(rollups.SKETCH)))).first()[0] == 24
    assert cube.agg(F.max("crash_day")).first()[0] == dt.date(2024, 4, 20)


def test_late_children_are_found_and_the_scan_is_pruned(spark, tmp_path):
    """A participant stored days later counts; days without children are not read."""
    warehouse, root = Warehouse(spark, "late", str(tmp_path / "wh")), str(tmp_path / "raw")
    sources = raw_sources(spark, days=3, per_day=4)
    late = spark.createDataFrame(
        [("late", "c0", "2024-04-21T10:00:00.000", "30", "F", None)], sources["crashes_people"].schema
    )
    sources["crashes_people"] = sources["crashes_people"].unionByName(late)
    for name, rows in sources.items():
        pipeline.land_days(rows, f"{root}/{name}", "crash_date")
    for dataset in pipeline.DATASETS:
        pipeline.ingest_days(warehouse, root, dataset)
    bounds = DayBounds(DAYS[0])
    pipeline.run_stages(warehouse, bounds)
    row = warehouse.read("crashes_people_summary").filter("crash_record_id = 'c0'").first()
    assert row["list_of_gender"] == ["F", "M"]
    people = pipeline.STAGES[0].result(warehouse, bounds)
    plan = people._jdf.queryExecution().executedPlan().toString()
    assert "IN (2024-04-19,2024-04-21)" in plan or "2024-04-20" not in plan.split("crashes_people")[1]
    vehicles = pipeline.STAGES[1].result(warehouse, bounds)
    plan = vehicles._jdf.queryExecution().executedPlan().toString()
    assert "service_day" in plan and "2024-04-21" not in plan
    # only the late child is no neighbour of its incident
    assert [r["service_day"] for r in warehouse.read("crashes_people_days").collect()] == [DAYS[2]]
    assert warehouse.read("crashes_vehicles_days").count() == 0


def test_sql_stage_keeps_its_neighbours(spark, tmp_path):
    """Both ends of the day are its own: midnight belongs to the next day alone."""
    warehouse = Warehouse(spark, "neighbours", str(tmp_path / "wh"))
    rows = [("a", "2024-04-20T12:00:00.000"), ("m", "2024-04-21T00:00:00.000"), ("b", "2024-04-21T07:00:00.000")]
    source = {"crashes": spark.createDataFrame(rows, "crash_record_id string, crash_date string")}
    for day in DAYS[1:]:
        pipeline.land_datasets(source, str(tmp_path / "raw"), day, [Dataset("crashes")])
        pipeline.ingest_day(warehouse, str(tmp_path / "raw"), day, Dataset("crashes"))
    sql = """SELECT crash_date, crash_record_id FROM IDENTIFIER(:database || '.crashes')
             WHERE crash_date >= :start_time AND crash_date <= :end_time"""
    path = tmp_path / "stages.json"

    def run(day, text=sql, **more):
        stage = {"name": "crashes_people_summary", "sql": text, **more}
        path.write_text(json.dumps({"cubelets": [stage]}))
        pipeline.run_stages(warehouse, DayBounds(day), pipeline.load_sql_stages(str(path)))
        stored = warehouse.read("crashes_people_summary")
        return {(r["crash_record_id"], r["service_day"]) for r in stored.collect()}

    both = {("a", DAYS[1]), ("m", DAYS[2]), ("b", DAYS[2])}
    assert [run(day) for day in (DAYS[1], DAYS[2], DAYS[1])] == [{("a", DAYS[1])}, both, both]
    with pytest.raises(Exception, match="rows outside the replaced days"):
        run(DAYS[1], sql.replace("<= :end_time", "<= :end_before"))
    assert run(DAYS[1]) == both
    assert run(DAYS[2], sql + " AND 1 = 0") == {("a", DAYS[1])}
    with pytest.raises(ValueError, match="unknown choice of days"):
        run(DAYS[1], replaces="all")


def test_debug_output_does_not_count(spark, daily, tmp_path, monkeypatch, capsys):
    _, root, _, _ = daily
    reports = []
    for number, switch in enumerate(("false", "true")):
        monkeypatch.setenv("DAYBOOK_DEBUG", switch)
        warehouse = Warehouse(spark, f"debug_{number}", str(tmp_path / str(number)))
        reports.append([pipeline.ingest_day(warehouse, root, DAYS[0], d) for d in pipeline.DATASETS])
    assert reports[0] == reports[1] and reports[0][0].rows == 24
    assert "-- crashes" in capsys.readouterr().out


def test_bulk_and_daily_agree_on_bad_times(spark, tmp_path):
    rows = [(str(i), t) for i, t in enumerate(
        ["2024-04-20T10:00:00.000", "2024-04-20T99", "yesterday", None, "2024-04-20", "2024-04-21T00:00:00.000"]
    )]
    source = {"crashes": spark.createDataFrame(rows, "crash_record_id string, crash_date string")}
    only, root = Dataset("crashes"), str(tmp_path)
    day_wise = Warehouse(spark, "times_daily", f"{root}/a")
    for day in DAYS[1:]:
        pipeline.land_datasets(source, f"{root}/raw_a", day, [only])
        pipeline.ingest_day(day_wise, f"{root}/raw_a", day, only)
    bulk = Warehouse(spark, "times_bulk", f"{root}/b")
    landed = pipeline.land_days(source["crashes"], f"{root}/raw_b/crashes", "crash_date")
    assert (landed.rows, landed.undated) == (3, 3)
    report = pipeline.ingest_days(bulk, f"{root}/raw_b", only)
    assert (report.rows, report.rejects) == (3, {"crash_date": 1})
    assert content(day_wise, "crashes") == content(bulk, "crashes")
    # neither damage nor amounts were delivered
    assert bulk.read("crashes").filter("damage_estimate IS NULL").count() == 3


def test_declared_raw_columns(spark, tmp_path):
    dataset = Dataset("crashes_vehicles", raw_columns="crash_unit_id string, make string, axle_cnt string")
    root = str(tmp_path / "raw")
    pipeline.land_day(spark.createDataFrame([("1", "FORD")], "crash_unit_id string, make string"),
                      f"{root}/crashes_vehicles", DAYS[0])
    warehouse = Warehouse(spark, "declared", str(tmp_path / "wh"))
    pipeline.ingest_day(warehouse, root, DAYS[0], dataset)
    row = warehouse.read("crashes_vehicles").first()
    assert (row["crash_unit_id"], row["make"], row["axle_cnt"]) == (1, "FORD", None)


def test_stage_reads_only_its_day(daily):
    warehouse, *_ = daily
    rows = pipeline.STAGES[0].result(warehouse, DayBounds(DAYS[0]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(service_day" in plan
    assert "GreaterThanOrEqual(crash_date,2024-04-19 05:00" in plan


def test_sql_stages(spark, daily, tmp_path):
    warehouse, root, _, _ = daily
    other = Warehouse(spark, "sqlstages", str(tmp_path / "wh"))
    for dataset in pipeline.DATASETS:
        pipeline.ingest_days(other, root, dataset)
    summary = """
        SELECT c.crash_date, c.crash_record_id, c.is_am, c.damage_estimate AS damage,
               c.injuries_total AS number_injured, sort_array(array_agg(p.sex)) AS list_of_gender
        FROM IDENTIFIER(:database || '.crashes') c
        LEFT JOIN IDENTIFIER(:database || '.crashes_people') p USING (crash_record_id)
        WHERE c.crash_date >= {start} AND c.crash_date <= {end}
        GROUP BY ALL
    """
    for start, end in (
        (":start_time", ":end_time"),
        ("(SELECT start_time FROM job_params)", "(SELECT end_time FROM job_params)"),
    ):
        path = tmp_path / "stages.json"
        text = summary.replace("{start}", start).replace("{end}", end)
        later = """
            SELECT date(crash_date) AS crash_day, list_of_gender, sum(damage) AS total_damage,
                   theta_sketch_agg(crash_record_id, 12) AS crashes_set_sketch
            FROM IDENTIFIER(:database || '.crashes_people_summary') GROUP BY ALL;
        """
        path.write_text(json.dumps({"cubelets": [
            {"name": "crashes_people_summary", "sql": text},
            {"name": "crashes_cube", "sql": later},
        ]}))
        pipeline.run_stages(other, DayBounds(DAYS[1]), pipeline.load_sql_stages(str(path)))
        stored = other.read("crashes_people_summary")
        assert stored.count() == 24
        assert {r[0] for r in stored.select("service_day").distinct().collect()} == {DAYS[1]}
        # 24 hours from 05:00: even numbers are 500, odd ones 1500
        cube = other.read("crashes_cube")
        assert cube.agg(F.sum("total_damage")).first()[0] == 12 * 500 + 12 * 1500
        assert cube.count() == 2


def test_unknown_stage_table(daily):
    warehouse, *_ = daily
    with pytest.raises(ValueError, match="no declared table named nothing"):
        pipeline.run_stages(warehouse, DayBounds(DAYS[0]), [Stage("nothing", sql="SELECT 1")])


def test_failing_dataset_ends_the_run(daily):
    warehouse, root, *_ = daily
    with pytest.raises(Exception, match="(?i)path does not exist|PATH_NOT_FOUND"):
        pipeline.ingest_datasets(warehouse, root + "/none", DAYS[0])


def test_golden_record(spark, tmp_path):
    raw = spark.createDataFrame(
        [("k", "2024-04-20T15:40:00.000", "2024-04-20T15:52:00.000", "30", "Y", None, "OVER $1,500",
          "666", "2", "0", "3", "15", "7", "4", "41.885801756029", "-87.64532786346",
          ([-87.64532786346, 41.885801756029], "Point"), "LAKE ST"),
         ("bad", "yesterday", None, "fast", "", "N", "OVER", None, None, None, None, None, None,
          None, None, None, None, None)],
        "CRASH_RECORD_ID string, crash_date string, date_police_notified string,"
        " posted_speed_limit string, intersection_related_i string, hit_and_run_i string,"
        " damage string, street_no string, num_units string, injuries_total string,"
        " injuries_no_indication string, crash_hour string, crash_day_of_week string,"
        " crash_month string, latitude string, longitude string,"
        " location struct<coordinates:array<double>,type:string>, street_name string",
    )
    day, root = dt.date(2024, 4, 20), str(tmp_path / "raw")
    pipeline.land_day(raw, f"{root}/crashes", day)
    warehouse = Warehouse(spark, "golden", str(tmp_path / "wh"))
    report = pipeline.ingest_day(warehouse, root, day, Dataset("crashes"))
    assert report.rows == 2
    assert report.rejects == {"crash_date": 1, "posted_speed_limit": 1, "damage_estimate": 1}
    rows = {r["crash_record_id"]: r for r in warehouse.read("crashes").collect()}
    got = rows["k"]
    assert got["crash_date"] == dt.datetime(2024, 4, 20, 20, 40)
    assert got["date_police_notified"] == dt.datetime(2024, 4, 20, 20, 52)
    expected = {
        "crash_date_est_i": None, "posted_speed_limit": 30, "lane_cnt": None,
        "intersection_related_i": True, "hit_and_run_i": None, "damage": "OVER $1,500",
        "damage_estimate": 1500, "street_no": 666, "street_name": "LAKE ST", "num_units": 2,
        "injuries_total": 0, "injuries_no_indication": 3, "crash_hour": 15,
        "crash_day_of_week": 7, "crash_month": 4, "latitude": 41.885801756029,
        "longitude": -87.64532786346, "is_am": False, "service_day": day,
        "location": "{[-87.64532786346, 41.885801756029], Point}",
    }
    assert {name: got[name] for name in expected} == expected
    # unreadable values are null and the row is kept, in the day it was landed for
    bad = rows["bad"]
    assert bad["crash_date"] is None and bad["is_am"] is None and bad["service_day"] == day
    assert bad["intersection_related_i"] is False and bad["hit_and_run_i"] is False


def test_closed_end(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", "2024-04-20T23:59:59.000"), ("b", "2024-04-20T23:59:59.500")],
        "crash_record_id string, crash_date string",
    )
    sources, only = {"crashes": rows}, [Dataset("crashes")]
    for closed, n in ((False, 2), (True, 1)):
        counts = pipeline.land_datasets(
            sources, str(tmp_path), DAYS[1], only, closed_end=closed
        )
        assert counts == {"num_recs_crashes": n}


def test_untransformed_dataset(spark, tmp_path):
    from daybook.sources.schemas import TableSpec

    spec = TableSpec("plain", "id string, note string", time_column="t", key_column="id")
    rows = spark.createDataFrame([("1", "2024-04-20T01:00:00.000", "x")], "id string, t string, other string")
    root = str(tmp_path / "raw")
    dataset = Dataset("plain", time_column="t", columns=("id", "t", "id"))
    assert pipeline.land_datasets({"plain": rows}, root, DAYS[1], [dataset]) == {"num_recs_plain": 1}
    warehouse = Warehouse(spark, "plain_db", str(tmp_path / "wh"))
    assert pipeline.ingest_day(warehouse, root, DAYS[1], dataset, spec=spec).rows == 1
    assert tuple(spark.table("plain_db.plain").first()) == ("1", None, DAYS[1])


def test_stored_children_without_index_are_found(spark, tmp_path):
    """A warehouse that holds days from before the index and the ledger loses no child."""
    warehouse, root = Warehouse(spark, "keyless", str(tmp_path / "wh")), str(tmp_path / "raw")
    sources = raw_sources(spark, days=2)
    early = spark.createDataFrame(
        [("early", "c30", "2024-04-19T10:00:00.000", "30", "F", None)], sources["crashes_people"].schema
    )
    sources["crashes_people"] = sources["crashes_people"].unionByName(early)
    pipeline.run_day(warehouse, sources, root, DayBounds(DAYS[0]))
    for name in (*CHILD_DAYS.values(), LEDGER):
        spark.sql(f"DROP TABLE {warehouse.table(name)}")
        shutil.rmtree(tmp_path / "wh" / name)
    pipeline.run_day(warehouse, sources, root, DayBounds(DAYS[1]))
    row = warehouse.read("crashes_people_summary").filter("crash_record_id = 'c30'").first()
    assert row["list_of_gender"] == ["F", "M"]
    assert {r["service_day"] for r in warehouse.read("crashes_people_days").collect()} == {DAYS[0]}
