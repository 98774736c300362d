"""The calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.dates import (
    CALENDAR_END,
    CALENDAR_START,
    calendar_attributes,
    corrected_attributes,
    date_id,
    date_of_id,
)


def days(spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` to ``end``: CalendarID, CalendarDate."""
    if spark is None:
        raise ValueError("SparkSession cannot be None")
    if end < start:
        raise ValueError("the calendar runs forward")
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range((end - start).days + 1).select(
        date_id(day).alias("CalendarID"), day.alias("CalendarDate")
    )


def calendar(
    spark: SparkSession,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
    corrected: bool = False,
    created: dt.datetime | None = None,
) -> DataFrame:
    """The calendar dimension between two dates.

    Ids count days from the first calendar day whatever the range, so they come
    from date arithmetic and not from a global row number.
    """
    date = F.col("CalendarDate")
    attributes = calendar_attributes(date)
    if corrected:
        attributes |= corrected_attributes(date)
    stamp = F.lit(created) if created else F.current_timestamp()
    return days(spark, start, end).select(
        "CalendarID",
        "CalendarDate",
        *[expr.alias(name) for name, expr in attributes.items()],
        stamp.alias("CreatedDate"),
    )


def with_calendar(facts: DataFrame, id_column: str, role: str, *names: str) -> DataFrame:
    """Add calendar attributes of one date role, named ``{role}{attribute}``.

    Ids count days, so the attributes follow from the id: no join, and a date
    before or after the stored calendar keeps its own. A NULL id has NULLs.
    """
    date = date_of_id(F.col(id_column))
    known = {"CalendarDate": date, **calendar_attributes(date)}
    return facts.withColumns({f"{role}{name}": known[name] for name in names})
