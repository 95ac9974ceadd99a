"""From a raw batch to the columns of its table, one function per table."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.text import airbag_state, amount_estimate, amount_unreadable, yes_no
from daybook.functions.times import DEFAULT_ZONE, is_morning
from daybook.operators.conform import Schema, cast_columns, target_types

log = logging.getLogger(__name__)

Transform = Callable[..., DataFrame]


def incident_transform(
    rows: DataFrame, schema: Schema, zone: str = DEFAULT_ZONE, morning_zone: str | None = None
) -> DataFrame:
    """Typed incidents with the amount estimate and the morning flag.

    The flag goes by the stored UTC hour unless ``morning_zone`` is given.
    """
    typed = cast_columns(rows, schema, zone)
    absent = {"damage": "string", "crash_date": "timestamp"}
    typed = typed.withColumns(
        {c: F.lit(None).cast(t) for c, t in absent.items() if c not in typed.columns}
    )
    return typed.withColumns(
        {
            "damage_estimate": amount_estimate(F.col("damage")),
            "is_am": is_morning(F.col("crash_date"), morning_zone),
        }
    )


# Columns kept both as a flag and as the text it was read from.
PARTICIPANT_FLAGS: dict[str, Callable[[Column], Column]] = {
    "airbag_deployed": airbag_state,
    "cell_phone_use": yes_no,
}


def participant_transform(
    rows: DataFrame, schema: Schema, zone: str = DEFAULT_ZONE
) -> DataFrame:
    present = {name.lower() for name in rows.columns}
    read = {}
    for name, flag in PARTICIPANT_FLAGS.items():
        if name in present:
            read[f"{name}_txt"] = F.col(name)
            read[name] = flag(F.col(name))
    return cast_columns(rows.withColumns(read) if read else rows, schema, zone)


def vehicle_transform(rows: DataFrame, schema: Schema, zone: str = DEFAULT_ZONE) -> DataFrame:
    return cast_columns(rows, schema, zone)


TRANSFORMS: dict[str, Transform] = {
    "crashes": incident_transform,
    "crashes_people": participant_transform,
    "crashes_vehicles": vehicle_transform,
}


def transform(
    name: str | None, rows: DataFrame, schema: Schema, zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Apply the named transform; without a name the rows pass unchanged."""
    if name is None:
        log.warning("no transform named; rows pass unchanged")
        return rows
    if name not in TRANSFORMS:
        raise ValueError(f"unknown transform: {name}; known: {sorted(TRANSFORMS)}")
    return TRANSFORMS[name](rows, schema, zone)


#: Prefix of the raw values that stand beside the typed ones while rejects are counted.
_RAW = "__raw_"


def counted_transform(
    name: str | None, rows: DataFrame, schema: Schema, seen: Observation, zone: str = DEFAULT_ZONE
) -> DataFrame:
    """The named transform, with ``rows`` and a count of unreadable values per
    column observed as the rows go by. Every value is cast once."""
    present = {c.lower(): c for c in rows.columns}
    fields = target_types(schema) if name is not None else {}
    flags = PARTICIPANT_FLAGS if name == "crashes_people" else {}
    texts = [
        c for c in fields
        if c in present and c not in flags and isinstance(rows.schema[present[c]].dataType, T.StringType)
    ]
    amount = name == "crashes" and "damage" in present
    beside = rows.withColumns({f"{_RAW}{c}": F.col(present[c]) for c in texts})
    typed = transform(name, beside, schema, zone)
    counts = {
        c: F.count_if(F.col(f"{_RAW}{c}").isNotNull() & F.col(c).isNull()) for c in texts
    }
    if amount:
        counts["damage_estimate"] = F.count_if(amount_unreadable(F.col("damage")))
    watched = typed.observe(
        seen, F.count(F.lit(1)).alias("rows"), *[n.alias(f"rejected.{c}") for c, n in counts.items()]
    )
    return watched.drop(*(f"{_RAW}{c}" for c in texts))
