"""What the ledger, the index of children and the manifest prove, and what a failure leaves."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_pipeline import DAYS, ROLLUPS, content, raw_sources

from daybook.plans import ledger as ledgers
from daybook.plans import pipeline
from daybook.plans.days import DayBounds
from daybook.plans.pipeline import Warehouse
from daybook.sources import day_index, landing, manifest
from daybook.sources.schemas import CHILD_DAYS


class Fault(Exception):
    pass


class Writes:
    """Counts the writes of a run, and ends it at one of them."""

    def __init__(self, monkeypatch):
        self.left = None
        for place, name in (
            (pipeline, "land_day"),
            (pipeline, "replace_day"),
            (pipeline, "replace_days"),
            (pipeline, "replace_all"),
            (ledgers, "replace_day"),
            (manifest, "write_day"),
        ):
            monkeypatch.setattr(place, name, self.counted(getattr(place, name)))

    def counted(self, write):
        def run(*args, **kwargs):
            if self.left is not None:
                self.left -= 1
                if self.left < 0:
                    raise Fault(write.__name__)
            return write(*args, **kwargs)

        return run


def late(spark, sources, key, when, name):
    rows = spark.createDataFrame([(name, key, when, "30", "F", None)], sources["crashes_people"].schema)
    return sources | {"crashes_people": sources["crashes_people"].unionByName(rows)}


def few(sources, keys):
    return {n: rows.filter(F.col("crash_record_id").isin(keys)) for n, rows in sources.items()}


def test_a_fault_between_any_two_writes_loses_nothing(spark, tmp_path, monkeypatch):
    """The second run of a day, of other rows than the first, dies before its first write,
    is run again and dies before its second, and so on to the last."""
    before = few(raw_sources(spark, days=2), ["c0", "c2", "c25", "c26"])
    after = late(spark, before, "c25", "2024-04-19T10:00:00.000", "stray")
    after = late(spark, after, "c0", "2024-04-19T10:00:00.000", "own")
    after["crashes"] = after["crashes"].filter("crash_record_id <> 'c2'")
    found = {}
    for name, most in (("faultless", False), ("faulty", True)):
        warehouse, root = Warehouse(spark, name, str(tmp_path / name)), str(tmp_path / f"raw_{name}")
        for day in DAYS[:2]:
            pipeline.run_day(warehouse, before, root, DayBounds(day))
        writes, faults = Writes(monkeypatch), 0
        # Six writes land the day; from the fourteenth on its tables are proven, and the
        # writes of the stages follow the landing.
        for n in (*range(14), *range(7, 30)) if most else (None,):
            writes.left = n
            try:
                pipeline.run_day(warehouse, after, root, DayBounds(DAYS[0]))
                break
            except Fault:
                faults += 1
        writes.left = None
        assert faults >= 17 or not most
        # The neighbour's incident got a child on the day that was run.
        pipeline.run_stages(warehouse, DayBounds(DAYS[1]))
        tables = ["crashes", "crashes_people", "crashes_vehicles", *CHILD_DAYS.values(), *ROLLUPS]
        found[name] = {table: content(warehouse, table) for table in tables}
    assert found["faulty"] == found["faultless"]
    assert any("'c25'" in r and "'F', 'M'" in r for r in found["faulty"]["crashes_people_summary"])


def test_a_failed_fill_of_the_index_is_filled_again(spark, tmp_path, monkeypatch):
    warehouse, root = Warehouse(spark, "unfilled", str(tmp_path / "wh")), str(tmp_path / "raw")
    sources = few(raw_sources(spark, days=2), ["c0", "c30"])
    sources = late(spark, sources, "c0", "2024-04-20T10:00:00.000", "late")
    pipeline.land_and_ingest_days(warehouse, sources, root)
    writes = Writes(monkeypatch)
    writes.left = 0
    with pytest.raises(Fault):
        pipeline.run_stages(warehouse, DayBounds(DAYS[0]))
    assert spark.catalog.tableExists(warehouse.table("crashes_people_days"))
    writes.left = None
    pipeline.run_stages(warehouse, DayBounds(DAYS[0]))
    row = warehouse.read("crashes_people_summary").filter("crash_record_id = 'c0'").first()
    assert row["list_of_gender"] == ["F", "M"]


def test_a_rerun_of_equal_rows_writes_nothing_but_the_landing(spark, tmp_path, monkeypatch):
    warehouse, root = Warehouse(spark, "equal", str(tmp_path / "wh")), str(tmp_path / "raw")
    sources, bounds = raw_sources(spark, days=1, per_day=3), DayBounds(DAYS[0])
    pipeline.run_day(warehouse, sources, root, bounds)
    first = pipeline.ingest_datasets(warehouse, root, DAYS[0])
    writes = Writes(monkeypatch)
    writes.left = 6
    pipeline.run_day(warehouse, sources, root, bounds)  # other files, the same rows
    assert pipeline.ingest_datasets(warehouse, root, DAYS[0]) == first
    assert first["crashes"].rows == 3
    writes.left = None
    # A table written by hand is no longer proven.
    stored = warehouse.read("crashes", [DAYS[0]]).drop("service_day").limit(1)
    spec = warehouse.ensure("crashes")
    pipeline.replace_day(spark.createDataFrame(stored.collect(), spec.schema), warehouse.table("crashes"), spec, DAYS[0])
    pipeline.run_day(warehouse, sources, root, bounds)
    assert warehouse.read("crashes").count() == 3


def test_bits_name_every_day_and_few_others(spark):
    rows = [(f"k{i}", dt.date(2024, 1, 1) + dt.timedelta(days=i % 50)) for i in range(5000)]
    children = spark.createDataFrame(rows, "key string, day date")
    at_home = children.filter("day = DATE'2024-01-01'")
    cells = day_index.strays(children, at_home, "key", "day").cache()
    assert cells.filter("day = DATE'2024-01-01'").count() == 0
    unknown = day_index.unknown_day(cells).withColumn("day", F.lit(dt.date(2030, 1, 1)))
    index = cells.unionByName(unknown.select(*cells.columns))
    asked = children.filter("key IN ('k1', 'k51', 'k7', 'k50', 'none')").select("key")
    named = day_index.named_days(index, asked, "key", "day")
    assert named == [dt.date(2024, 1, 2), dt.date(2024, 1, 8), dt.date(2030, 1, 1)]


def bytes_read(rows):
    """What the files that a plan reads hold."""
    import os

    return sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in rows.inputFiles())


def test_a_days_run_reads_no_more_for_more_days(spark, tmp_path):
    """The index of days without strays has no bytes, and no other day is read."""
    sizes = []
    for days in (2, 8):
        warehouse = Warehouse(spark, f"stored_{days}", str(tmp_path / f"wh{days}"))
        sources = few(raw_sources(spark, days=days), [f"c{24 * d}" for d in range(days)])
        pipeline.land_and_ingest_days(warehouse, sources, str(tmp_path / f"raw{days}"))
        bounds = DayBounds(DAYS[0])
        pipeline.run_stages(warehouse, bounds, pipeline.STAGES[:2])
        ledger = warehouse.ledger()
        reads = [stage.reads(warehouse, bounds, ledger) for stage in pipeline.STAGES[:2]]
        assert [r[c] for r, c in zip(reads, CHILD_DAYS, strict=True)] == [[DAYS[0]], [DAYS[0]]]
        tables = {name: wanted for found in reads for name, wanted in found.items()}
        size = sum(bytes_read(warehouse.read(name, wanted)) for name, wanted in tables.items())
        index = [warehouse.read(name) for name in CHILD_DAYS.values()]
        sizes.append((size, sum(map(bytes_read, index))))
    assert sizes[0] == sizes[1] and sizes[0][1] == 0


# --- the manifest ------------------------------------------------------------


def test_columns_join_in_any_order():
    fields = [
        T.StructType.fromDDL("a int, b struct<x:string>"),
        T.StructType.fromDDL("A bigint, c array<float>"),
        T.StructType.fromDDL("b struct<x:string,y:int>, c array<double>, d void"),
        T.StructType.fromDDL("d date"),
    ]
    whole = {"a": "bigint", "b": "struct<x:string,y:int>", "c": "array<double>", "d": "date"}
    for order in (fields, fields[::-1], fields[2:] + fields[:2], fields + fields):
        joined = manifest.joined_columns(order)
        assert {f.name.lower(): f.dataType.simpleString() for f in joined.fields} == whole
    with pytest.raises(ValueError, match="column b.x was landed as string and as int"):
        manifest.joined_columns([fields[0], T.StructType.fromDDL("b struct<x:int>")])


@pytest.fixture
def landed(spark, tmp_path):
    """Three days of two shapes, each with a late row of an earlier time."""
    root = str(tmp_path / "raw")
    for n, day in enumerate(DAYS):
        rows = [(str(n), f"{day}T0{h}:00:00.000") for h in range(4)]
        rows += [(f"late{n}", f"2024-0{n + 1}-01T00:00:00.000")]
        columns = "id string, t string" if n else "id string, t string, first_only string"
        wide = spark.createDataFrame(rows, "id string, t string").selectExpr(
            "*", *(["'x' AS first_only"] if not n else [])
        )
        assert [f.name for f in wide.schema.fields] == [c.split()[0] for c in columns.split(", ")]
        landing.land_day(wide.repartitionByRange(2, "t"), root, day, time_column="t")
    return root


def test_days_are_read_without_opening_a_file(spark, landed, monkeypatch):
    opened = []
    reader = type(spark.read)
    plain = reader.option
    monkeypatch.setattr(reader, "option", lambda self, k, v: opened.append(k) or plain(self, k, v))
    rows = landing.read_days(spark, landed)
    assert "mergeSchema" not in opened
    assert rows.columns == ["id", "t", "first_only", "year", "month", "day"]
    assert rows.count() == 15 and rows.filter("first_only = 'x' AND day = 19").count() == 5
    assert landing.read_day(spark, landed, DAYS[1]).columns == ["id", "t"]
    assert "mergeSchema" not in opened


def test_files_no_manifest_speaks_for_are_opened(spark, landed):
    """A day landed by an earlier version, and one whose landing died before its manifest."""
    path = landing.dated_path(landed, DAYS[1])
    spark.createDataFrame([("9", "x", 5)], "id string, t string, extra int").write.mode("overwrite").parquet(path)
    rows = landing.read_days(spark, landed)
    assert rows.schema["extra"].dataType == T.IntegerType() and rows.count() == 11
    assert landing.day_identity(spark, landed, DAYS[1]).startswith("files ")
    assert not landing.day_identity(spark, landed, DAYS[0]).startswith("files ")


def test_a_days_identity_is_that_of_its_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", None)], "x string, y int")
    found = set()
    for n, frame in enumerate((rows, rows.orderBy("x", ascending=False), rows.union(rows.limit(1)), rows.drop("y"))):
        root = str(tmp_path / str(n))
        landing.land_day(frame, root, DAYS[0])
        found.add(landing.day_identity(spark, root, DAYS[0]))
    assert len(found) == 3


def test_a_range_of_times_reads_only_files_that_hold_some(spark, landed):
    def asked(start, end):
        rows = landing.read_range(spark, landed, "t", start, end)
        return sorted(r["id"] for r in rows.collect()), len(rows.inputFiles())

    every = len(landing.read_days(spark, landed).inputFiles())
    assert asked("2024-02-01T00:00:00.000", "2024-02-02T00:00:00.000") == (["late1"], 2)
    found, files = asked("2024-04-20T02:00:00.000", "2024-04-21T01:00:00.000")
    assert found == ["1", "1", "2"] and files < every
    assert asked("2025", "2026")[0] == []
    assert asked("2024", "2025") == (sorted(["0", "1", "2"] * 4 + ["late0", "late1", "late2"]), every)


def test_bulk_landing_keeps_a_manifest(spark, tmp_path):
    root = str(tmp_path / "raw")
    rows = spark.createDataFrame(
        [(str(h), f"2024-04-{d}T0{h}:00:00.000") for d in (19, 20) for h in range(5)], "id string, t string"
    )
    landing.land_days(rows, root, "t")
    kept = {r["day"]: (r["rows"], r["first"]) for r in manifest.read(spark, root).collect()}
    assert kept == {19: (5, "2024-04-19T00:00:00.000"), 20: (5, "2024-04-20T00:00:00.000")}
    found = landing.read_range(spark, root, "t", "2024-04-20T03", "2024-04-21")
    assert found.count() == 2 and len(found.inputFiles()) == 1
