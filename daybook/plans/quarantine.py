"""Values that could not be read, kept beside the day's rows and read again later.

An ingest with quarantine scans the raw day once: typed rows and the cells rejected in
them are staged together, and both tables are written from there. A cell knows its
column, its raw text, the reason and the stored row it belongs to, by that row's digest;
of equal rows each has cells of its own.

When the rules of reading change, a replay reads the cells alone again. Those readable
now move into their rows, with the columns made of them, and leave the quarantine; the
table is then that of a clean ingest by the new rules, and so is what stays behind.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.text import amount_unreadable
from daybook.functions.times import DEFAULT_ZONE
from daybook.operators.conform import align, target_types
from daybook.operators.transforms import PARTICIPANT_FLAGS, transform
from daybook.plans.pipeline import Dataset, Warehouse
from daybook.session import shared_folder
from daybook.sources.landing import read_day
from daybook.sources.schemas import SERVICE_DAY, TableSpec
from daybook.sources.tables import replace_day, replace_days

#: Reads raw columns, those that are there, into the columns of a schema.
Rules = Callable[[DataFrame, T.StructType, str], DataFrame]

CELLS = "row bigint, digest array<bigint>, column string, raw string, reason string"
_RAW = "__raw_"
#: Rejected values that a table keeps as an estimate made of another column's text.
MADE_OF = {"damage_estimate": "damage"}


def cells_table(name: str) -> str:
    return f"{name}_rejects"


def _digest(columns: Iterable[str]) -> Column:
    values = [F.col(f"`{c}`") for c in sorted(columns)]
    return F.array(F.xxhash64(*values), F.xxhash64(*values, F.lit(1)))


def row_digest(spec: TableSpec) -> Column:
    """What cells call a stored row by."""
    return _digest(spec.schema.names)


def _reason(raw: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.NumericType):
        number = raw.try_cast("decimal(38,9)").isNotNull()
        return F.when(number, f"out of range of {kind.simpleString()}").otherwise(f"no {kind.simpleString()}")
    return F.lit(f"no {kind.simpleString()}")


def rules_of(dataset: Dataset) -> Rules:
    return lambda rows, schema, zone: transform(dataset.transform, rows, schema, zone)


def with_rejects(
    raw: DataFrame, spec: TableSpec, name: str, rules: Rules, zone: str = DEFAULT_ZONE
) -> DataFrame:
    """The typed columns of the spec, and ``rejects``: column, raw text and reason of
    every value that is present and could not be read."""
    present, fields = {c.lower(): c for c in raw.columns}, target_types(spec.schema)
    flags = PARTICIPANT_FLAGS if name == "crashes_people" else {}
    texts = [
        c
        for c in fields
        if c in present and c not in flags and isinstance(raw.schema[present[c]].dataType, T.StringType)
    ]
    beside = raw.withColumns({f"{_RAW}{c}": F.col(present[c]) for c in texts})
    typed = rules(beside, spec.schema, zone)
    lost = {c: F.col(f"{_RAW}{c}").isNotNull() & F.col(c).isNull() for c in texts}
    raws = {c: F.col(f"{_RAW}{c}") for c in texts}
    for made, source in MADE_OF.items():
        if made in fields and source in texts and made in typed.columns:
            raws[made] = F.col(f"{_RAW}{source}")
            lost[made] = F.col(made).isNull() & amount_unreadable(raws[made])
    cells = [
        F.when(
            lost[c],
            F.struct(F.lit(c).alias("column"), raws[c].alias("raw"), _reason(raws[c], fields[c]).alias("reason")),
        )
        for c in lost
    ]
    none = F.lit(None).cast("array<struct<column:string,raw:string,reason:string>>")
    rejects = F.filter(F.array(*cells), lambda c: c.isNotNull()) if cells else none
    found = typed.withColumn("__rejects", rejects)
    whole = T.StructType([*spec.schema.fields, T.StructField("__rejects", found.schema["__rejects"].dataType)])
    return align(found, whole).withColumnRenamed("__rejects", "rejects")


@dataclass(frozen=True)
class Quarantined:
    rows: int
    cells: int


def _cells_spec(warehouse: Warehouse, name: str) -> TableSpec:
    table = cells_table(name)
    return warehouse.ensure(table, TableSpec(table, CELLS, time_column=None, key_column="row"))


def ingest_day(
    warehouse: Warehouse,
    root: str,
    day: dt.date,
    dataset: Dataset,
    rules: Rules | None = None,
    zone: str = DEFAULT_ZONE,
) -> Quarantined:
    """Type one landed day into its table, and its rejected cells into theirs."""
    name, spark = dataset.name, warehouse.spark
    spec, cells_spec = warehouse.ensure(name), _cells_spec(warehouse, name)
    raw = read_day(spark, f"{root.rstrip('/')}/{name}", day, dataset.raw_schema)
    typed = with_rejects(raw, spec, name, rules or rules_of(dataset), zone)
    path = shared_folder(spark, "quarantine")
    typed.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    staged = spark.read.parquet(path)
    replace_day(staged.drop("row", "rejects"), warehouse.table(name), spec, day)
    cells = staged.filter(F.size("rejects") > 0).select(
        "row", _digest(spec.schema.names).alias("digest"), F.inline("rejects")
    )
    replace_day(cells, warehouse.table(cells_table(name)), cells_spec, day)
    stored = warehouse.read(cells_table(name), [day]).count()
    return Quarantined(warehouse.read(name, [day]).count(), stored)


def replay(
    warehouse: Warehouse,
    dataset: Dataset,
    days: Iterable[dt.date],
    rules: Rules | None = None,
    zone: str = DEFAULT_ZONE,
) -> int:
    """Read the days' rejected cells again; how many have left the quarantine.

    The days' rows are rewritten in one job, staged first, so a run that dies leaves
    them or has rewritten them whole. Only cells are read again, never raw files.
    """
    name, spark, days = dataset.name, warehouse.spark, sorted(set(days))
    spec, cells_spec = warehouse.ensure(name), _cells_spec(warehouse, name)
    names = spec.schema.names
    cells = warehouse.read(cells_table(name), days)
    columns = [r[0] for r in cells.select("column").distinct().collect()]  # of the spec's
    if not columns:
        return 0
    raw_names = {c: MADE_OF.get(c, c) for c in columns}
    key = [SERVICE_DAY, "row", "digest"]
    wide = cells.groupBy(*key).agg(
        *(
            F.max(F.when(F.col("column").isin([c for c, n in raw_names.items() if n == raw]), F.col("raw"))).alias(raw)
            for raw in sorted(set(raw_names.values()))
        )
    )
    copies = Window.partitionBy(SERVICE_DAY, "digest").orderBy("row")
    again = (rules or rules_of(dataset))(wide, spec.schema, zone)
    made = [c for c in names if c in again.columns and c not in key]
    again = again.select(*key, F.row_number().over(copies).alias("copy"), *(F.col(c).alias(f"__{c}") for c in made))

    stored = warehouse.read(name, days).withColumn("digest", _digest(names))
    of_equal = Window.partitionBy(SERVICE_DAY, "digest").orderBy(F.lit(0))
    # Only rows that have cells are numbered; all others have no partner anyway.
    with_cells = stored.join(cells.select(SERVICE_DAY, "digest").distinct(), [SERVICE_DAY, "digest"], "left_semi")
    others = stored.join(cells.select(SERVICE_DAY, "digest").distinct(), [SERVICE_DAY, "digest"], "left_anti")
    numbered = with_cells.withColumn("copy", F.row_number().over(of_equal))
    met = numbered.join(again, [SERVICE_DAY, "digest", "copy"], "left")
    values = [
        (F.coalesce(F.col(c), F.col(f"__{c}")) if c in made else F.col(c)).alias(c) for c in names
    ]
    changed = met.select(*values, SERVICE_DAY, "row")
    path = shared_folder(spark, "replay")
    changed.unionByName(others.select(*names, SERVICE_DAY, F.lit(None).cast("bigint").alias("row"))).write.parquet(path)
    staged = spark.read.parquet(path)

    # A cell stays while its column is still null in its row.
    rows = staged.filter(F.col("row").isNotNull()).withColumn("now", _digest(names))
    is_null = F.map_from_arrays(
        F.array(*map(F.lit, columns)), F.array(*(F.col(f"`{c}`").isNull() for c in columns))
    )
    left = cells.join(rows.select(SERVICE_DAY, "row", "now", is_null.alias("null")), [SERVICE_DAY, "row"])
    left = left.filter(F.col("null")[F.col("column")]).select(
        "row", F.col("now").alias("digest"), "column", "raw", "reason", SERVICE_DAY
    )
    kept_path = shared_folder(spark, "replay")
    left.write.parquet(kept_path)
    before, kept = cells.count(), spark.read.parquet(kept_path)
    replace_days(staged.drop("row"), warehouse.table(name), spec, days)
    replace_days(kept, warehouse.table(cells_table(name)), cells_spec, days)
    return before - kept.count()
