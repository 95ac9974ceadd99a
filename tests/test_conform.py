import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import types as T

from daybook.functions.casts import type_named
from daybook.operators.conform import align, cast_columns, conform, debug_frame, reject_counts
from daybook.operators.transforms import counted_transform, transform
from daybook.sources.schemas import TABLES

NAMES = {
    "string": "string", "int": "int", "bool": "bool", "float": "float", "double": "double",
    "timestamp": "timestamp", "long": "long", "bool_i": "boolean",
}
ROW = ("a", "1", "True", "1.0", "1.0", "2023-01-01T17:30:01.000", "1362341280", "N")


def test_every_type(spark):
    rows = spark.createDataFrame([ROW], list(NAMES))
    got = cast_columns(rows, NAMES).first()
    assert tuple(got) == (
        "a", 1, True, 1.0, 1.0, dt.datetime(2023, 1, 1, 23, 30, 1), 1362341280, False,
    )
    assert [f.dataType for f in cast_columns(rows, NAMES).schema] == [
        type_named(kind) for kind in NAMES.values()
    ]


def test_typed_nulls_stay_null(spark):
    schema = T.StructType([T.StructField(n, type_named(k)) for n, k in NAMES.items()])
    rows = spark.createDataFrame([(None,) * len(NAMES)], schema)
    assert all(v is None for v in cast_columns(rows, NAMES).first())


def test_unknown_type():
    with pytest.raises(ValueError, match="unknown type: decimal"):
        type_named("decimal")
    assert type_named("BIGINT") == T.LongType()


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("12.7", 12), ("-3.9", -3), (" 7 ", 7), ("abc", None), ("1e3", None), (".5", 0),
     ("99999999999", None), ("+4", 4), ("", None), ("-", None), ("1.2.3", None), ("-0.9", 0),
     ("2147483647.9", 2147483647), ("2147483648.0", None), (None, None)],
)
def test_text_as_int(spark, raw, expected):
    rows = spark.createDataFrame([(raw,)], "x string")
    assert cast_columns(rows, {"x": "int"}).first()["x"] == expected


@pytest.mark.parametrize(
    ("raw", "utc"),
    [
        ("2024-04-20T15:40:00.000", "2024-04-20 20:40:00"),
        ("2024-01-20T15:40:00.000", "2024-01-20 21:40:00"),
        ("2024-03-10T02:30:00.000", "2024-03-10 08:30:00"),  # skipped by the clocks
        ("2024-11-03T01:30:00.000", "2024-11-03 06:30:00"),  # happens twice
        ("2024-04-20 15:40:00", None),
        ("not a time", None),
    ],
)
def test_local_time(spark, raw, utc):
    rows = spark.createDataFrame([(raw,)], "t string")
    got = cast_columns(rows, {"t": "timestamp"}).first()["t"]
    assert (str(got) if got else None) == utc


def test_zone_is_a_parameter(spark):
    rows = spark.createDataFrame([("2024-04-20T15:40:00.000",)], "t string")
    got = cast_columns(rows, {"t": "timestamp"}, "Asia/Tokyo").first()["t"]
    assert got == dt.datetime(2024, 4, 20, 6, 40)


def test_align_adds_drops_and_orders(spark):
    rows = spark.createDataFrame([(1, "x", "gone")], "B int, a string, extra string")
    schema = T.StructType.fromDDL("a string, missing array<string>, b bigint")
    got = align(rows, schema)
    assert got.columns == ["a", "missing", "b"]
    assert [f.dataType for f in got.schema] == [f.dataType for f in schema]
    assert tuple(got.first()) == ("x", None, 1)


def test_columns_that_differ_only_in_case(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        rows = spark.createDataFrame([("1", "2")], "a string, A string")
        with pytest.raises(ValueError, match="differ only in case"):
            cast_columns(rows, {"a": "int"})
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_incident_transform(spark):
    rows = spark.createDataFrame(
        [("over $1500", "2023-01-01T17:30:01.000"), ("$500", "2024-04-20T08:00:00.000"), (None, None)],
        "damage string, crash_date string",
    )
    schema = {"damage": "string", "crash_date": "timestamp"}
    first, second, third = transform("crashes", rows, schema).collect()
    assert tuple(first) == ("over $1500", dt.datetime(2023, 1, 1, 23, 30, 1), 1500, False)
    # 08:00 local is 13:00 UTC, the hour the flag goes by
    assert (second["damage_estimate"], second["is_am"]) == (500, False)
    assert tuple(third) == (None, None, None, None)


def test_participant_transform(spark):
    rows = spark.createDataFrame(
        [("DID NOT DEPLOY", "Y")], "AIRBAG_DEPLOYED string, cell_phone_use string"
    )
    schema = {"airbag_deployed": "boolean", "cell_phone_use": "boolean"}
    got = transform("crashes_people", rows, schema).first()
    assert got["airbag_deployed"] is False and got["airbag_deployed_txt"] == "DID NOT DEPLOY"
    assert got["cell_phone_use"] is True and got["cell_phone_use_txt"] == "Y"
    partial = transform("crashes_people", rows.select("cell_phone_use"), schema)
    assert partial.columns == ["cell_phone_use", "cell_phone_use_txt"]


def test_transform_names(spark):
    rows = spark.range(1)
    assert transform(None, rows, {}) is rows
    with pytest.raises(ValueError, match="unknown transform"):
        transform("nothing", rows, {})


def test_nested_location_becomes_text(spark):
    rows = spark.createDataFrame(
        [(([-87.64532786346, 41.885801756029], "Point"),)],
        "location struct<coordinates:array<double>,type:string>",
    )
    got = conform(rows, TABLES["crashes"].schema).first()["location"]
    assert got == "{[-87.64532786346, 41.885801756029], Point}"


def test_reject_counts(spark):
    rows = spark.createDataFrame(
        [("1", "2024-04-20T15:40:00.000"), ("x", "never"), (None, None)], "n string, t string"
    )
    counts = reject_counts(rows, {"n": "int", "t": "timestamp", "absent": "int"})
    got = rows.agg(*[c.alias(n) for n, c in counts.items()]).first()
    assert got.asDict() == {"n": 1, "t": 1}


def counted(rows, name):
    seen = Observation()
    typed = counted_transform(name, rows, TABLES[name].schema, seen)
    assert not any(c.startswith("__") for c in typed.columns)
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    typed.write.format("noop").mode("overwrite").save()
    return {n.removeprefix("rejected."): c for n, c in seen.get.items() if c}, plan


def test_unreadable_amounts_are_rejects(spark):
    rows = spark.createDataFrame([("OVER",), ("OVER $5",), ("UNKNOWN",), (None,)], "damage string")
    assert counted(rows, "crashes")[0] == {"rows": 4, "damage_estimate": 1}


def test_unknown_airbag_text_is_no_reject(spark):
    rows = spark.createDataFrame([("NOT APPLICABLE", "x")], "airbag_deployed string, age string")
    assert counted(rows, "crashes_people")[0] == {"rows": 1, "age": 1}


def test_values_are_cast_once(spark):
    rows = spark.createDataFrame([("k", "30"), ("l", "fast")], "crash_record_id string, age string")
    rows = rows.repartition(2)
    counts, plan = counted(rows, "crashes_people")
    assert counts == {"rows": 2, "age": 1}
    assert plan.count("try_cast") == 1 or plan.count("TRY") == 1 or plan.count("regexp_extract") == 1


def test_align_under_any_setting(spark):
    rows = spark.createDataFrame([(3_000_000_000,)], "n bigint")
    schema = T.StructType.fromDDL("n int")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for setting in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", setting)
            with pytest.raises(Exception, match="n: a value does not fit int"):
                align(rows, schema).collect()
            assert align(rows.selectExpr("n - 2999999990 AS n"), schema).first()["n"] == 10
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_debug_output_needs_the_switch(spark, capsys, monkeypatch):
    debug_frame(spark.range(1), "quiet")
    assert capsys.readouterr().out == ""
    monkeypatch.setenv("DAYBOOK_DEBUG", "TRUE")
    debug_frame(spark.range(1), "loud")
    out = capsys.readouterr().out
    assert "loud" in out and "id: long" in out
