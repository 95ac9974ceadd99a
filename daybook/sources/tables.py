"""Partitioned Parquet tables of the catalog, replaced a day at a time.

The catalog's schema rules: rows are written by column name in the order and types the
table has, columns it lacks are left out, and those the rows lack are null.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.operators.conform import align
from daybook.sources.checksums import watched
from daybook.sources.schemas import TableSpec

log = logging.getLogger(__name__)


def ensure_table(
    spark: SparkSession, table: str, spec: TableSpec, location: str | None = None
) -> None:
    """Create the table from its declared schema unless the catalog has it.

    With a ``location`` that already holds days, those are picked up. A table that
    exists without the declaration to overwrite by partition is given it.
    """
    if spark.catalog.tableExists(table):
        _declare_overwrite(spark, table)
        return
    log.info("creating table %s", table)
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in spec.stored_schema.fields
    )
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet"
        " OPTIONS ('partitionOverwriteMode' = 'dynamic')"
        f" PARTITIONED BY (`{spec.day_column}`){place}"
    )
    if location:
        # Appending no rows makes the folder if it is new and changes nothing if not.
        nothing = spark.createDataFrame([], spec.stored_schema)
        nothing.write.mode("append").partitionBy(spec.day_column).parquet(location)
        spark.catalog.recoverPartitions(table)


def in_catalog(spark: SparkSession, table: str, spec: TableSpec) -> TableSpec:
    """``spec`` with the columns that the catalog's table has, whoever made it."""
    if spec.stored:
        return spec
    rows = spark.sql(f"DESCRIBE TABLE {table}").collect()
    names = [r["col_name"] for r in rows]
    start = names.index("# Partition Information") + 2 if "# Partition Information" in names else len(names)
    days = [n for n in names[start:] if n]
    if [d.lower() for d in days] != [spec.day_column.lower()]:
        raise ValueError(f"{table} is partitioned by {days or 'nothing'}, not by {spec.day_column}")
    fields = [f for f in spark.table(table).schema.fields if f.name.lower() != spec.day_column.lower()]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return replace(spec, columns=columns, stored=True)


def _declare_overwrite(spark: SparkSession, table: str) -> None:
    """Without the option an overwrite of some days would delete all others."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    stored = described.filter("col_name = 'Storage Properties'").select("data_type").first()
    if "partitionoverwritemode=dynamic" not in (stored[0].lower() if stored else ""):
        log.info("declaring table %s to overwrite by partition", table)
        spark.sql(f"ALTER TABLE {table} SET SERDEPROPERTIES ('partitionOverwriteMode' = 'dynamic')")


def replace_day(
    rows: DataFrame, table: str, spec: TableSpec, day: dt.date, seen: Observation | None = None
) -> None:
    """Make ``rows`` the whole of one day; no rows means an empty day.

    Only that day's folder is touched, and a rerun gives the same table. ``seen`` gets
    the checksum of what is written.
    """
    aligned = align(rows, in_catalog(rows.sparkSession, table, spec).schema)
    if seen is not None:
        aligned = watched(aligned, seen)
    rows.sparkSession.sql(
        f"INSERT OVERWRITE {table} PARTITION (`{spec.day_column}` = DATE'{day}')"
        " SELECT * FROM {aligned}",
        aligned=aligned,
    )


def _empty(spark: SparkSession, table: str, spec: TableSpec, days: Iterable[dt.date]) -> None:
    for day in days:
        replace_day(spark.createDataFrame([], spec.schema), table, spec, day)


def replace_days(
    rows: DataFrame,
    table: str,
    spec: TableSpec,
    days: Iterable[dt.date] | None = None,
    gathered: bool = False,
    seen: Observation | None = None,
) -> None:
    """Replace the days present in ``rows``, which carry the day column.

    ``gathered`` says that a day's rows already stand in few tasks; ``seen`` gets the
    checksum of what is written.

    With ``days`` named, a row of any other day is an error that leaves the
    table as it was, and named days without rows are emptied. New days go in
    first, so a failed run loses nothing. The table itself is declared to
    overwrite by partition, so no session setting is touched.
    """
    spark, day_column = rows.sparkSession, F.col(spec.day_column)
    aligned = align(rows, in_catalog(spark, table, spec).stored_schema)
    named = sorted(set(days)) if days is not None else []
    if days is not None:
        stray = F.raise_error(
            F.concat(F.lit(f"{table}: rows outside the replaced days, on "), day_column.cast("string"))
        )
        inside = F.coalesce(day_column.isin(named), F.lit(False))
        aligned = aligned.withColumn(
            spec.day_column, F.when(inside, day_column).otherwise(stray.cast("date"))
        )
    # A day goes to few files, a large day to several tasks. Counting after
    # that exchange keeps the counts right when a task has to run again.
    held = aligned if gathered else aligned.hint("rebalance", day_column)
    written = Observation()
    if named:
        held = held.observe(
            written, *[F.count_if(day_column == F.lit(d)).alias(d.isoformat()) for d in named]
        )
    if seen is not None:
        held = watched(held, seen)
    held.write.insertInto(table, overwrite=True)
    _empty(spark, table, spec, [day for day in named if not written.get[day.isoformat()]])


def replace_all(rows: DataFrame, table: str, spec: TableSpec) -> None:
    """Make ``rows``, which carry the day column, the whole table."""
    spark, day_column = rows.sparkSession, F.col(spec.day_column)
    stored = spark.table(table).select(day_column).distinct().collect()
    written = Observation()
    aligned = align(rows, in_catalog(spark, table, spec).stored_schema)
    gathered = aligned.hint("rebalance", day_column)
    gathered.observe(written, F.collect_set(day_column).alias("days")).write.insertInto(
        table, overwrite=True
    )
    new = set(written.get["days"] or [])
    _empty(spark, table, spec, sorted(r[0] for r in stored if r[0] and r[0] not in new))


def day_files(
    spark: SparkSession, table: str, spec: TableSpec, days: Iterable[dt.date]
) -> list[str]:
    """The files of some days as the catalog has them now; nothing is opened."""
    spark.catalog.refreshTable(table)
    return sorted(read_table(spark, table, spec, days).inputFiles())


def read_table(
    spark: SparkSession, table: str, spec: TableSpec, days: Iterable[dt.date] | None = None
) -> DataFrame:
    """A catalog table, or only the named days of it."""
    rows = spark.table(table)
    return rows if days is None else rows.filter(F.col(spec.day_column).isin(list(days)))
