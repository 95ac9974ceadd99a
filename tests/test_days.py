import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.functions import times
from daybook.plans.days import (
    DayBounds, parameters_table, publish_parameters, run_day, within_parameters,
)

UTC = dt.timezone.utc


def test_run_day():
    assert run_day("2023-10-02") == dt.date(2023, 10, 2)
    now = dt.datetime(2024, 1, 2, 3, 0, tzinfo=UTC)  # still 1 January in the default zone
    assert run_day(now=now) == dt.date(2023, 12, 31)
    assert run_day(zone="UTC", now=now) == dt.date(2024, 1, 1)
    assert run_day(zone="UTC") == dt.datetime.now(UTC).date() - dt.timedelta(days=1)
    with pytest.raises(ValueError):
        run_day("02.10.2023")


@pytest.mark.parametrize(
    ("day", "hours"), [("2024-03-10", 23), ("2024-04-20", 24), ("2024-11-03", 25)]
)
def test_length_of_a_local_day(spark, day, hours):
    bounds = DayBounds(dt.date.fromisoformat(day))
    assert bounds.end - bounds.start == dt.timedelta(hours=hours)
    column = F.lit(dt.date.fromisoformat(day))
    got = spark.range(1).select(
        times.local_day_start(column).alias("s"), times.local_day_end(column).alias("e")
    )
    start, end = got.first()
    assert (start, end) == (bounds.start.replace(tzinfo=None), bounds.end.replace(tzinfo=None))


def test_bounds():
    bounds = DayBounds(dt.date(2024, 4, 20))
    assert bounds.start == dt.datetime(2024, 4, 20, 5, tzinfo=UTC)
    assert bounds.utc_days() == [dt.date(2024, 4, 20), dt.date(2024, 4, 21)]
    closed = DayBounds(dt.date(2024, 4, 20), closed_end=True)
    assert closed.end == dt.datetime(2024, 4, 21, 4, 59, 59, tzinfo=UTC)
    assert DayBounds(dt.date(2024, 4, 20), "UTC").utc_days() == [dt.date(2024, 4, 20)]


def test_fractions_of_the_last_second(spark):
    rows = spark.sql("SELECT TIMESTAMP'2024-04-21 04:59:59.5' AS t")
    day = dt.date(2024, 4, 20)
    t = F.col("t")
    assert rows.filter(DayBounds(day).contains(t)).count() == 1
    assert rows.filter(DayBounds(day, closed_end=True).contains(t)).count() == 0


def test_bounds_as_a_table(spark):
    bounds = DayBounds(dt.date(2024, 4, 20), closed_end=True)
    rows = spark.sql(
        "SELECT explode(array(TIMESTAMP'2024-04-20 04:59:59', TIMESTAMP'2024-04-20 05:00:00',"
        " TIMESTAMP'2024-04-21 04:59:59', TIMESTAMP'2024-04-21 05:00:00')) AS t"
    )
    chosen = within_parameters(rows, parameters_table(spark, bounds), "t")
    assert chosen.count() == 2
    assert "Join" not in chosen._jdf.queryExecution().executedPlan().toString()
    publish_parameters(spark, bounds)
    assert spark.table("job_params").first()["start_time"] == dt.datetime(2024, 4, 20, 5)
