"""What was landed, beside the files: their columns, rows and range of times.

``<root>/_manifest`` has a row for each landed file, kept by day like the files. A
reader of many days merges the columns written there and opens no file for it; a reader
of a range of times leaves out the files that hold none of it. A file's name is unique
to the job that wrote it, so a manifest speaks for the files that are there under the
names it has, whatever became of a run in between: other files are opened as before.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER = "_manifest"
PARTS = ("year", "month", "day")
COLUMNS = "file string, rows bigint, first string, last string, columns string, content string"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def joined_type(left: T.DataType, right: T.DataType, at: str = "") -> T.DataType:
    """The narrowest type that reads both; the order of the two does not matter."""
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        return joined_columns([left, right], f"{at}." if at else "")
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        return T.ArrayType(joined_type(left.elementType, right.elementType, at))
    kinds = {type(left), type(right)}
    if kinds <= set(_WHOLE):
        return max(left, right, key=lambda t: _WHOLE.index(type(t)))
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    raise ValueError(f"column {at} was landed as {left.simpleString()} and as {right.simpleString()}")


def joined_columns(schemas: Iterable[T.StructType], within: str = "") -> T.StructType:
    """The columns of any of the schemas, by name; the same for any order but theirs."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            name = field.name.lower()
            held = found.get(name, field)
            kind = joined_type(held.dataType, field.dataType, within + field.name)
            found[name] = T.StructField(held.name, kind)
    return T.StructType(list(found.values()))


def names_in(rows: DataFrame) -> list[str]:
    """The files that ``rows`` would read; their listing is all that is used."""
    return sorted(rows.inputFiles())


def digest(files: Iterable[str]) -> str:
    """Tells sets of files apart, by day and by names that no two jobs give."""
    names = sorted("/".join(f.split("/")[-2:]) for f in files)
    return hashlib.sha256("\0".join(names).encode()).hexdigest()


def files_below(spark: SparkSession, path: str) -> list[str]:
    return names_in(spark.read.schema("unread string").parquet(path))


def _described(rows: DataFrame, time_column: str | None, *by: str) -> DataFrame:
    """``file, rows, first, last`` of landed rows; only the time column is read."""
    time = F.col(f"`{time_column}`").cast("string") if time_column else F.lit(None).cast("string")
    held = rows.select(*by, F.col("_metadata.file_name").alias("file"), time.alias("time"))
    return held.groupBy(*by, "file").agg(
        F.count(F.lit(1)).alias("rows"), F.min("time").alias("first"), F.max("time").alias("last")
    )


def _completed(described: DataFrame, schema: T.StructType, content: str | None) -> DataFrame:
    return described.withColumns(
        {"columns": F.lit(schema.json()), "content": F.lit(content).cast("string")}
    )


def write_day(
    spark: SparkSession,
    root: str,
    day_path: str,
    schema: T.StructType,
    time_column: str | None,
    content: str | None,
    whole: tuple[int, str | None, str | None],
) -> None:
    """The manifest of one landed day, in place of an earlier one.

    ``whole`` has the day's rows and range of times; only if they stand in several
    files is the time column read again."""
    place = f"{root.rstrip('/')}/{FOLDER}/{day_path[len(root.rstrip('/')) + 1:]}"
    names = [os.path.basename(f) for f in files_below(spark, day_path)]
    if len(names) == 1:
        described = spark.createDataFrame([(names[0], *whole)], "file string, rows bigint, first string, last string")
    else:
        found = _described(spark.read.schema(schema).parquet(day_path), time_column)
        # An empty file has columns and no rows.
        listed = spark.createDataFrame([(n,) for n in names], "file string")
        described = listed.join(found, "file", "left").fillna({"rows": 0})
    kept = _completed(described, schema, content).select(*T.StructType.fromDDL(COLUMNS).names)
    kept.coalesce(1).write.mode("overwrite").parquet(place)


def write_days(
    spark: SparkSession, root: str, days: Iterable[tuple[str, str, str]], schema: T.StructType, time_column: str
) -> None:
    """The manifests of days landed in one job."""
    dated = T.StructType([*schema.fields, *(T.StructField(p, T.StringType()) for p in PARTS)])
    paths = ["/".join([root.rstrip("/"), *map("=".join, zip(PARTS, d, strict=True))]) for d in days]
    rows = spark.read.schema(dated).option("basePath", root).parquet(*paths)
    described = _completed(_described(rows, time_column, *PARTS), schema, None)
    (
        described.select(*T.StructType.fromDDL(COLUMNS).names, *PARTS)
        .hint("rebalance", *PARTS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTS)
        .parquet(f"{root.rstrip('/')}/{FOLDER}")
    )


def read(spark: SparkSession, root: str, day_path: str | None = None) -> DataFrame | None:
    """The manifest's rows, of one day or of all; ``None`` if there is none."""
    place = f"{root.rstrip('/')}/{FOLDER}"
    if day_path is not None:
        place += f"/{day_path[len(root.rstrip('/')) + 1:]}"
    try:
        return spark.read.schema(COLUMNS).parquet(place)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def merged_columns(spark: SparkSession, files: list[str], manifest: DataFrame | None) -> T.StructType:
    """The columns of the files; only those that no manifest speaks for are opened."""
    known: dict[str, str] = {}
    if manifest is not None:
        known = {r["file"]: r["columns"] for r in manifest.select("file", "columns").collect()}
    present = sorted({known[n] for n in map(os.path.basename, files) if n in known})
    schemas = [T.StructType.fromJson(json.loads(text)) for text in present]
    others = [f for f in files if os.path.basename(f) not in known]
    if others:
        schemas.append(spark.read.option("mergeSchema", "true").parquet(*others).schema)
    return joined_columns(schemas)
