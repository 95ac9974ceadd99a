import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sources.landing import (
    dated_path, extract_day, land_day, land_days, read_day, read_days,
)

DAY = dt.date(2024, 4, 20)


def files(root, day=DAY):
    return glob.glob(f"{dated_path(root, day)}/*.parquet")


def test_dated_path():
    assert dated_path("/data", dt.date(2023, 10, 1)) == "/data/year=2023/month=10/day=01"
    assert dated_path("s3a://b/data/", DAY) == "s3a://b/data/year=2024/month=04/day=20"


@pytest.mark.parametrize("kind", ["string", "timestamp_ntz", "timestamp"])
def test_extract_day(spark, kind):
    texts = [
        "2024-04-19T23:59:59.999", "2024-04-20T00:00:00.000", "2024-04-20T23:59:59.000",
        "2024-04-20T23:59:59.500", "2024-04-21T00:00:00.000",
    ]
    rows = spark.createDataFrame([(t, 1, 2) for t in texts], "t string, a int, b int")
    if kind != "string":
        rows = rows.withColumn("t", F.col("t").cast(kind))
    assert extract_day(rows, "t", DAY).count() == 3
    assert extract_day(rows, "t", DAY, closed_end=True).count() == 2
    assert extract_day(rows, "t", DAY, ["b", "a", "b"]).columns == ["b", "a"]


def test_rows_per_file_and_rerun(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(283, numPartitions=1)
    for _ in range(2):
        assert land_day(rows, root, DAY, rows_per_file=101) == 283
        assert len(files(root)) == 3
        assert read_day(spark, root, DAY).count() == 283


def test_empty_rerun_empties_the_day(spark, tmp_path):
    root, other = str(tmp_path), DAY + dt.timedelta(days=1)
    land_day(spark.range(5), root, DAY)
    land_day(spark.range(7), root, other)
    assert land_day(spark.range(5).filter("id > 9"), root, DAY) == 0
    assert read_day(spark, root, DAY).count() == 0
    assert read_day(spark, root, other).count() == 7


def test_files_with_different_columns(spark, tmp_path):
    path = dated_path(str(tmp_path), DAY)
    spark.createDataFrame([("1", "x")], "a string, b string").write.parquet(path)
    spark.createDataFrame([("2", "y")], "a string, c string").write.mode("append").parquet(path)
    merged = read_day(spark, str(tmp_path), DAY)
    assert sorted(merged.columns) == ["a", "b", "c"]
    declared = T.StructType.fromDDL("a string, b string, c string, d string")
    got = {tuple(r) for r in read_day(spark, str(tmp_path), DAY, declared).collect()}
    assert got == {("1", "x", None, None), ("2", None, "y", None)}


def test_land_all_days_at_once(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.sql(
        "SELECT id, date_format(TIMESTAMP'2024-04-20 00:00:00' + make_interval(0,0,0,0,id),"
        " \"yyyy-MM-dd'T'HH:mm:ss.SSS\") AS t FROM range(72)"
    )
    land_days(rows, root, "t", rows_per_file=10)
    land_days(rows.filter("id >= 24 AND id < 30"), root, "t")
    counts = {r["day"]: r["count"] for r in read_days(spark, root).groupBy("day").count().collect()}
    assert counts == {20: 24, 21: 6, 22: 24}
    assert len(files(root)) >= 3
