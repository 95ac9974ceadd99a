"""The run day and its bounds."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.times import DEFAULT_ZONE

PARAMETERS_VIEW = "job_params"


def run_day(
    argument: str | None = None,
    zone: str = DEFAULT_ZONE,
    now: dt.datetime | None = None,
) -> dt.date:
    """The day named by ``yyyy-mm-dd``, else yesterday as seen in ``zone``."""
    if argument:
        return dt.datetime.strptime(argument, "%Y-%m-%d").date()
    local = now.astimezone(ZoneInfo(zone)) if now else dt.datetime.now(ZoneInfo(zone))
    return local.date() - dt.timedelta(days=1)


@dataclass(frozen=True)
class DayBounds:
    """A local calendar day as UTC instants, half-open unless ``closed_end``.

    A closed end is 23:59:59 itself, so later fractions of that second are out.
    """

    day: dt.date
    zone: str = DEFAULT_ZONE
    closed_end: bool = False

    def _instant(self, day: dt.date, time: dt.time) -> dt.datetime:
        local = dt.datetime.combine(day, time, tzinfo=ZoneInfo(self.zone))
        return local.astimezone(dt.timezone.utc)

    @property
    def start(self) -> dt.datetime:
        return self._instant(self.day, dt.time.min)

    @property
    def end(self) -> dt.datetime:
        if self.closed_end:
            return self._instant(self.day, dt.time(23, 59, 59))
        return self._instant(self.day + dt.timedelta(days=1), dt.time.min)

    @property
    def last(self) -> dt.datetime:
        """The last instant of the day, itself included."""
        return self.end if self.closed_end else self.end - dt.timedelta(microseconds=1)

    def contains(self, instant: Column) -> Column:
        """Literal bounds, so the scan can prune on them."""
        end = F.lit(self.end)
        upper = instant <= end if self.closed_end else instant < end
        return (instant >= F.lit(self.start)) & upper

    def utc_days(self) -> list[dt.date]:
        """Every UTC calendar day the local day has a part in."""
        first = self.start.date()
        return [first + dt.timedelta(days=n) for n in range((self.last.date() - first).days + 1)]

    def sql_args(self) -> dict[str, object]:
        """``end_time`` is the last instant (``<=``), ``end_before`` the first after (``<``)."""
        return {
            "start_time": self.start,
            "end_time": self.last,
            "end_before": self.last + dt.timedelta(microseconds=1),
            "service_day": self.day,
        }


def parameters_table(spark: SparkSession, bounds: DayBounds) -> DataFrame:
    """The bounds as a one-row table, both ends included."""
    return spark.createDataFrame(
        [(bounds.start, bounds.last)], "start_time timestamp, end_time timestamp"
    )


def publish_parameters(spark: SparkSession, bounds: DayBounds) -> None:
    """Let SQL text read the bounds as view ``job_params``."""
    parameters_table(spark, bounds).createOrReplaceTempView(PARAMETERS_VIEW)


def within_parameters(rows: DataFrame, parameters: DataFrame, time_column: str) -> DataFrame:
    """Rows inside the range of a one-row parameter table, both ends included.

    The bounds are scalar subqueries: read once, before the scan, and no join.
    """
    start, end = (parameters.select(c).scalar() for c in ("start_time", "end_time"))
    return rows.filter(F.col(time_column).between(start, end))
