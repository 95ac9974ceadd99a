"""Which coarser cubes are stored, and which one answers."""

import os

from pyspark.sql import functions as F
from test_pipeline import DAYS, raw_sources

from daybook.plans import lattice, pipeline, rollups
from daybook.plans.pipeline import Warehouse


def sets(*names):
    return frozenset(names)


def test_choice_is_greedy_by_rows_saved():
    whole = sets(*"abcd")
    sizes = {whole: 1000, sets(*"abc"): 500, sets(*"ab"): 100, sets("a"): 10, sets("d"): 990, sets(*"cd"): 1000}
    asked = {sets("a"): 1.0, sets(*"ab"): 1.0, sets("c"): 1.0, sets("d"): 1.0}
    # abc: 500 each for three; then ab: 400 each for two; then a: 90 for one, d: 10
    assert lattice.chosen_views(sizes, asked, 2) == [sets(*"ab"), sets(*"abc")]
    assert lattice.chosen_views(sizes, asked, 9) == [sets(*"ab"), sets(*"abc"), sets("a"), sets("d")]
    assert lattice.chosen_views(sizes, asked | {sets("d"): 1000.0}, 1) == [sets("d")]
    assert lattice.chosen_views(sizes, {sets(*"cd"): 5.0}, 3) == []
    assert lattice.chosen_views(sizes, {}, 3) == []


def size_of(rows):
    return sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in rows.inputFiles())


def test_views_answer_as_the_cube_does(spark, tmp_path):
    warehouse, root = Warehouse(spark, "views", str(tmp_path / "wh")), str(tmp_path / "raw")
    sources = raw_sources(spark, days=2, per_day=24)
    pipeline.land_and_ingest_days(warehouse, sources, root)
    pipeline.rebuild(warehouse)
    asked = {sets("is_hit_run"): 3.0, sets("crash_day", "is_am"): 1.0, sets("list_of_gender"): 1.0}
    views = lattice.stored_views(warehouse, asked, 2)
    assert views.views and all("crash_day" in v for v in views.views.values())

    def answers():
        for question in asked:
            names = sorted(question)
            found = views.merge(names).drop(rollups.SKETCH).collect()
            full = rollups.merge_cube(warehouse.read("crashes_cube"), names).drop(rollups.SKETCH).collect()
            assert sorted(map(repr, found)) == sorted(map(repr, full))

    answers()
    source = views.source(["is_hit_run"])
    assert source != "crashes_cube" and views.source(["street_name"]) == "crashes_cube"
    assert size_of(warehouse.read(source)) < size_of(warehouse.read("crashes_cube"))
    # days of the cube change, and one of them becomes empty
    cube = warehouse.read("crashes_cube").filter(F.col("crash_day") > F.lit(DAYS[0])).limit(5)
    spec, days = warehouse.ensure("crashes_cube"), [DAYS[0], DAYS[1]]
    kept = spark.createDataFrame(cube.collect(), cube.schema).withColumn("crash_day", F.lit(DAYS[1]))
    pipeline.replace_days(kept, warehouse.table("crashes_cube"), spec, days)
    views.refresh(days)
    answers()
