"""Rejected cells beside their rows, and what a replay makes of them."""

import datetime as dt

from pyspark.sql import functions as F

from daybook.operators.transforms import transform
from daybook.plans import pipeline, quarantine
from daybook.plans.pipeline import Dataset, Warehouse
from daybook.sources import landing

DAYS = [dt.date(2024, 4, day) for day in (19, 20)]
ONLY = Dataset("crashes")
ROWS = [
    # equal but for their rejected text, once readable by the later rules and once not
    ("same", "2024-04-19T10:00:00.000", "1,000", None, "$5"),
    ("same", "2024-04-19T10:00:00.000", "many", None, "$5"),
    ("same", "2024-04-19T10:00:00.000", "1,000", None, "$5"),
    ("same", "2024-04-19T10:00:00.000", None, None, "$5"),
    ("two", "noon", "2,000", "x", "OVER"),
    ("two", "noon", "99999999999", "x", "OVER"),
    ("late", "19.04.2024 11:00", "3", None, None),
    ("fine", "2024-04-19T11:00:00.000", "4", "41.5", "$500 OR LESS"),
]
COLUMNS = "crash_record_id string, crash_date string, injuries_total string, latitude string, damage string"


def later_rules(rows, schema, zone):
    """Commas between thousands, days written another way, and OVER as OVER $1."""
    present = set(rows.columns)
    if "injuries_total" in present:
        rows = rows.withColumn("injuries_total", F.replace("injuries_total", F.lit(",")))
    if "crash_date" in present:
        iso = F.regexp_replace("crash_date", r"^(\d\d)\.(\d\d)\.(\d{4}) (\d\d:\d\d)$", r"$3-$2-$1T$4:00.000")
        rows = rows.withColumn("crash_date", iso)
    if "damage" in present:
        rows = rows.withColumn("damage", F.when(F.col("damage") == "OVER", "OVER $1").otherwise(F.col("damage")))
    return transform("crashes", rows, schema, zone)


def stored(warehouse):
    return sorted(repr(tuple(r)) for r in warehouse.read("crashes").drop("damage").collect())


def cells(warehouse):
    table = warehouse.read(quarantine.cells_table("crashes"))
    return sorted(tuple(r) for r in table.select("service_day", "digest", "column", "raw", "reason").collect())


def test_replay_equals_a_clean_ingest(spark, tmp_path):
    root = str(tmp_path / "raw")
    raw = spark.createDataFrame(ROWS, COLUMNS)
    for day in DAYS:
        landing.land_day(raw, f"{root}/crashes", day)
    old = Warehouse(spark, "replayed", str(tmp_path / "old"))
    new = Warehouse(spark, "ingested_clean", str(tmp_path / "new"))
    counts = [quarantine.ingest_day(old, root, day, ONLY) for day in DAYS]
    assert (counts[0].rows, counts[0].cells) == (8, 12)
    plain = Warehouse(spark, "ingested_plain", str(tmp_path / "plain"))
    for day in DAYS:
        report = pipeline.ingest_day(plain, root, day, ONLY)
        quarantine.ingest_day(new, root, day, ONLY, later_rules)
    assert sum(report.rejects.values()) == 12
    assert stored(old) == stored(plain)
    reasons = {(c, raw): reason for _, _, c, raw, reason in cells(old)}
    assert reasons == {
        ("injuries_total", "1,000"): "no int",
        ("injuries_total", "2,000"): "no int",
        ("injuries_total", "many"): "no int",
        ("injuries_total", "99999999999"): "out of range of int",
        ("crash_date", "noon"): "no timestamp",
        ("crash_date", "19.04.2024 11:00"): "no timestamp",
        ("latitude", "x"): "no double",
        ("damage_estimate", "OVER"): "no int",
    }
    assert quarantine.replay(old, ONLY, DAYS) == 0  # by the same rules nothing moves
    assert stored(old) == stored(plain)
    moved = quarantine.replay(old, ONLY, DAYS, later_rules)
    assert moved == len(DAYS) * (len(ROWS) - 2)
    assert stored(old) == stored(new)
    left = [sorted((c[0], *c[2:]) for c in cells(w)) for w in (old, new)]
    assert left[0] == left[1] and len(left[0]) == 12
    late = old.read("crashes", [DAYS[0]]).filter("crash_record_id = 'late'").first()
    assert late["crash_date"] == dt.datetime(2024, 4, 19, 16) and late["is_am"] is False


def test_nothing_to_replay(spark, tmp_path):
    root = str(tmp_path / "raw")
    landing.land_day(spark.createDataFrame(ROWS[-1:], COLUMNS), f"{root}/crashes", DAYS[0])
    warehouse = Warehouse(spark, "nothing_rejected", str(tmp_path / "wh"))
    assert quarantine.ingest_day(warehouse, root, DAYS[0], ONLY) == quarantine.Quarantined(1, 0)
    assert quarantine.replay(warehouse, ONLY, DAYS) == 0
    landing.land_day(spark.createDataFrame([], COLUMNS), f"{root}/crashes", DAYS[1])
    assert quarantine.ingest_day(warehouse, root, DAYS[1], ONLY) == quarantine.Quarantined(0, 0)
