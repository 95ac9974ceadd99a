"""Land local days of a source as dated Parquet with a manifest, and read them back."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sources import manifest
from daybook.sources.checksums import checksum_of, watched

# Rows per landed file unless the caller says otherwise. A source's page size
# (some thousands) would make far too many files of a large day.
ROWS_PER_FILE = 1_000_000

#: Folder of rows without a readable time; readers of the days pass it over.
UNDATED = "_undated"

_PARTS = ("year", "month", "day")
_PART_PATTERNS = {"year": "yyyy", "month": "MM", "day": "dd"}


def dated_path(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/year={day:%Y}/month={day:%m}/day={day:%d}"


def _day_filter(rows: DataFrame, time_column: str, day: dt.date, closed_end: bool) -> Column:
    """Bounds as literals of the column's own type, so they reach the scan."""
    following = day + dt.timedelta(days=1)
    value = F.col(time_column)
    data_type = rows.schema[time_column].dataType
    if isinstance(data_type, T.StringType):
        start, end = F.lit(f"{day}T00:00:00"), F.lit(f"{following}T00:00:00")
        closed = F.lit(f"{day}T23:59:59.000")
    else:
        start = F.lit(f"{day} 00:00:00").cast(data_type)
        end = F.lit(f"{following} 00:00:00").cast(data_type)
        closed = F.lit(f"{day} 23:59:59").cast(data_type)
    return (value >= start) & ((value <= closed) if closed_end else (value < end))


def extract_day(
    rows: DataFrame,
    time_column: str,
    day: dt.date,
    columns: list[str] | None = None,
    closed_end: bool = False,
) -> DataFrame:
    """The day's rows, by wall-clock time, with only the columns asked for."""
    kept = rows.filter(_day_filter(rows, time_column, day, closed_end))
    return kept.select(*dict.fromkeys(columns)) if columns else kept


def land_day(
    rows: DataFrame,
    root: str,
    day: dt.date,
    rows_per_file: int = ROWS_PER_FILE,
    time_column: str | None = None,
) -> int:
    """Write a day's extract in place of an earlier one; the number of rows.

    An empty extract leaves an empty day behind. Count and checksum are taken as the
    rows are written, so the source is read once. The manifest follows the files; it
    has their range of times if the time column is named.
    """
    written, path = Observation(), dated_path(root, day)
    time = F.col(f"`{time_column}`").cast("string") if time_column else F.lit(None).cast("string")
    (
        watched(rows, written, F.min(time).alias("first"), F.max(time).alias("last"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", "snappy")
        .parquet(path)
    )
    seen = written.get
    whole = (seen["rows"], seen["first"], seen["last"])
    manifest.write_day(
        rows.sparkSession, root, path, rows.schema, time_column, checksum_of(written), whole
    )
    return seen["rows"]


def day_identity(spark: SparkSession, root: str, day: dt.date) -> str:
    """Equal for equal rows of a landed day, where its manifest knows their checksum,
    and else for the same files only."""
    path = dated_path(root, day)
    names = {os.path.basename(f) for f in manifest.files_below(spark, path)}
    kept = manifest.read(spark, root, path)
    known = {r["file"]: r["content"] for r in kept.collect()} if kept is not None else {}
    contents = set(known.values())
    if names and known.keys() == names and len(contents) == 1 and None not in contents:
        columns = manifest.merged_columns(spark, sorted(names), kept).simpleString()
        return f"{contents.pop()} {columns}"
    return f"files {manifest.digest(names)}"


@dataclass(frozen=True)
class Landed:
    """Rows landed by day, and rows of no day."""

    rows: int
    undated: int


def land_days(
    rows: DataFrame, root: str, time_column: str, rows_per_file: int = ROWS_PER_FILE
) -> Landed:
    """Write every day present in ``rows`` in one job, replacing those days.

    Days are gathered before the write so that a task has few of them open;
    a day too large for one task is split over several. Rows whose time is null
    or names no day are left out, as a day's extract leaves them out, and kept in
    the folder ``UNDATED`` beside the days. Both counts are taken after the last
    exchange, as the rows are written.
    """
    value = F.col(time_column)
    if isinstance(rows.schema[time_column].dataType, T.StringType):
        # By its text, as a day's extract compares it.
        day = F.substring(value, 1, 10)
        is_day = F.try_to_timestamp(day, F.lit("yyyy-MM-dd")).isNotNull()
        held = F.when(is_day & (value >= F.concat(day, F.lit("T00:00:00"))), day)
        parts = {p: F.element_at(F.split(held, "-"), i) for i, p in enumerate(_PARTS, 1)}
    else:
        parts = {p: F.date_format(value, _PART_PATTERNS[p]) for p in _PARTS}
    dated, schema = rows.withColumns(parts), rows.schema
    seen, left = Observation(), Observation()
    (
        dated.filter(F.col("year").isNull())
        .drop(*_PARTS)
        .observe(left, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .parquet(f"{root.rstrip('/')}/{UNDATED}")
    )
    (
        dated.filter(F.col("year").isNotNull())
        .hint("rebalance", *_PARTS)
        .observe(
            seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.struct(*_PARTS)).alias("days")
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", "snappy")
        .partitionBy(*_PARTS)
        .parquet(root)
    )
    days = [tuple(d) for d in seen.get["days"] or []]  # one for each day landed
    if days:
        manifest.write_days(rows.sparkSession, root, days, schema, time_column)
    return Landed(seen.get["rows"], left.get["rows"])


def read_day(
    spark: SparkSession, root: str, day: dt.date, schema: T.StructType | None = None
) -> DataFrame:
    """One landed day; only its folder is listed.

    Files of a day may differ in columns. Those of the manifest are merged without
    opening a file; a declared ``schema`` stands instead of them.
    """
    path = dated_path(root, day)
    if schema is None:
        files = manifest.files_below(spark, path)
        schema = manifest.merged_columns(spark, files, manifest.read(spark, root, path))
    return spark.read.schema(schema).parquet(path)


def _dated(schema: T.StructType) -> T.StructType:
    parts = [T.StructField(p, T.IntegerType()) for p in _PARTS]
    return T.StructType([*schema.fields, *parts])


def read_days(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """All landed days, with partition columns ``year``, ``month`` and ``day``."""
    if schema is None:
        files = manifest.files_below(spark, root)
        schema = manifest.merged_columns(spark, files, manifest.read(spark, root))
    return spark.read.schema(_dated(schema)).parquet(root)


def read_range(spark: SparkSession, root: str, time_column: str, start: str, end: str) -> DataFrame:
    """Rows of all landed days whose time text is from ``start`` on and before ``end``.

    Files are chosen by the range of times in the manifest before any is opened, so
    rows that a source delivered late are found on whatever day they were landed.
    Files without a known range are read.
    """
    files = manifest.files_below(spark, root)
    kept = manifest.read(spark, root)
    schema = _dated(manifest.merged_columns(spark, files, kept))
    without = (F.col("rows") == 0) | (F.col("last") < start) | (F.col("first") >= end)
    left_out = set()
    if kept is not None:  # a job may give files of several days one name
        place = F.format_string("year=%04d/month=%02d/day=%02d/%s", *_PARTS, "file")
        left_out = {r[0] for r in kept.filter(without).select(place).collect()}
    chosen = [f for f in files if "/".join(f.split("/")[-4:]) not in left_out]
    if not chosen:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", root).parquet(*chosen)
    return rows.filter((F.col(time_column) >= start) & (F.col(time_column) < end))
