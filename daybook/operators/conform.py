"""Bring untyped rows to a declared schema, each step one projection."""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.casts import cast_value, type_named
from daybook.functions.text import yes_no
from daybook.functions.times import DEFAULT_ZONE

log = logging.getLogger(__name__)

# Fixed value: columns whose name ends so hold yes/no text.
FLAG_SUFFIX = "_i"
DEBUG_SWITCH = "DAYBOOK_DEBUG"

Schema = T.StructType | Mapping[str, str]


def target_types(schema: Schema) -> dict[str, T.DataType]:
    """Lower-case column name to type, from a table schema or type names."""
    if isinstance(schema, T.StructType):
        return {f.name.lower(): f.dataType for f in schema.fields}
    return {name.lower(): type_named(kind) for name, kind in schema.items()}


def _source_types(rows: DataFrame) -> dict[str, T.DataType]:
    types = {f.name.lower(): f.dataType for f in rows.schema.fields}
    if len(types) < len(rows.columns):
        raise ValueError(f"columns differ only in case: {rows.columns}")
    return types


def cast_expressions(
    rows: DataFrame, schema: Schema, zone: str = DEFAULT_ZONE
) -> dict[str, Column]:
    """The typed expression of every schema column that is present."""
    source = _source_types(rows)
    targets = target_types(schema)
    absent = [name for name in targets if name not in source]
    if absent:
        log.info("columns not in the batch, to be null: %s", ", ".join(absent))
    casts = {}
    for name, target in targets.items():
        if name not in source:
            continue
        if name.endswith(FLAG_SUFFIX) and isinstance(target, T.BooleanType):
            casts[name] = yes_no(F.col(name))
        elif name.endswith(FLAG_SUFFIX):
            casts[name] = cast_value(yes_no(F.col(name)), T.BooleanType(), target, zone)
        else:
            casts[name] = cast_value(F.col(name), source[name], target, zone)
    return casts


def cast_columns(rows: DataFrame, schema: Schema, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Type the schema's columns, yes/no flags included; keep the others as is."""
    casts = cast_expressions(rows, schema, zone)
    return rows.select(
        *[casts.get(name.lower(), F.col(name)).alias(name.lower()) for name in rows.columns]
    )


def align(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its order and types; absent ones null.

    A number that does not fit its column is an error under any session setting.
    """
    source = _source_types(rows)

    def fitted(field: T.StructField) -> Column:
        if field.name.lower() not in source:
            return F.lit(None).cast(field.dataType)
        value, own = F.col(field.name), source[field.name.lower()]
        if own == field.dataType:
            return value
        if not isinstance(own, T.NumericType) or not isinstance(field.dataType, T.NumericType):
            return value.cast(field.dataType)
        cast = value.try_cast(field.dataType)
        lost = F.raise_error(F.lit(f"{field.name}: a value does not fit {field.dataType.simpleString()}"))
        return F.when(value.isNotNull() & cast.isNull(), lost.cast(field.dataType)).otherwise(cast)

    return rows.select(*[fitted(f).alias(f.name) for f in schema.fields])


def conform(rows: DataFrame, schema: T.StructType, zone: str = DEFAULT_ZONE) -> DataFrame:
    return align(cast_columns(rows, schema, zone), schema)


def reject_counts(
    rows: DataFrame, schema: Schema, zone: str = DEFAULT_ZONE
) -> dict[str, Column]:
    """Per column, the aggregate that counts values present but unreadable."""
    source = _source_types(rows)
    return {
        name: F.count_if(F.col(name).isNotNull() & typed.isNull())
        for name, typed in cast_expressions(rows, schema, zone).items()
        if isinstance(source[name], T.StringType)
    }


def debug_frame(rows: DataFrame, name: str, count: int = 5) -> None:
    """Print schema and first rows, only when the environment asks for it."""
    if os.environ.get(DEBUG_SWITCH, "").lower() == "true":
        print(f"-- {name}")
        rows.printSchema()
        rows.show(count, truncate=False)
