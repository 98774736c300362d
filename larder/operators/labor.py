"""Shifts, hours worked, payroll and daily labour cost."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.dates import date_id, minutes_between, seconds_between
from larder.functions.money import amount

# Hourly pay in cents, and the days of a schedule.
HOURLY_CENTS = 1500
SCHEDULE_DAYS = 30


def shifts(punches: DataFrame, years_back: int = 0) -> DataFrame:
    """One row per employee and day: first and last reading of the clock.

    A day with a single reading is still open: its clock-out time is NULL.
    """
    time = F.col("PunchTime")
    return (
        punches.groupBy("EmployeeID", F.to_date(time).alias("_day"))
        .agg(
            F.min(time).alias("ClockInTime"),
            F.max(time).alias("_last"),
        )
        .select(
            "EmployeeID",
            date_id(F.add_months("_day", -12 * years_back)).alias("ClockInDateID"),
            "ClockInTime",
            F.when(F.col("_last") > F.col("ClockInTime"), F.col("_last")).alias("ClockOutTime"),
        )
    )


def hours_worked(worked: DataFrame, now: dt.datetime) -> DataFrame:
    """Minutes and hours of each shift; an open shift runs until ``now``."""
    until = F.coalesce(F.col("ClockOutTime"), F.lit(str(now)).cast("timestamp_ntz"))
    minutes = minutes_between(F.col("ClockInTime"), until)
    return worked.withColumn("TotalMinutes", minutes).withColumn(
        "TotalHoursWorked", F.col("TotalMinutes").cast("double") / F.lit(60.0)
    )


def _worked_seconds() -> Column:
    return F.coalesce(seconds_between(F.col("ClockInTime"), F.col("ClockOutTime")), F.lit(0))


def pay(seconds: Column, hourly_cents: Column) -> Column:
    """Gross pay rounded half up to cents, in whole-number arithmetic."""
    cents = F.floor((seconds * hourly_cents + 1800) / 3600)
    return (cents.cast("decimal(18,0)") / 100).cast("decimal(18,2)")


def payroll(worked: DataFrame, hourly_cents: int = HOURLY_CENTS) -> DataFrame:
    """Shifts, hours and gross pay per employee."""
    return (
        worked.groupBy("EmployeeID")
        .agg(F.count("*").alias("Shifts"), F.sum(_worked_seconds()).alias("WorkedSeconds"))
        .withColumn("HoursWorked", F.col("WorkedSeconds").cast("double") / F.lit(3600.0))
        .withColumn("GrossPay", pay(F.col("WorkedSeconds"), F.lit(hourly_cents)))
    )


def daily_labor(worked: DataFrame, employees: DataFrame) -> DataFrame:
    """Labour hours and cost per store and day, at each employee's own rate."""
    seconds = F.col("_seconds")
    return (
        worked.withColumn("_seconds", _worked_seconds())
        .join(employees.select("EmployeeID", "LocationID", "HourlyCents"), "EmployeeID")
        .groupBy("LocationID", F.col("ClockInDateID").alias("OrderDateID"))
        .agg(
            F.sum(seconds).alias("_seconds"),
            F.sum(seconds * F.col("HourlyCents")).alias("_cost"),
        )
        .select(
            "LocationID",
            "OrderDateID",
            (F.col("_seconds").cast("double") / F.lit(3600.0)).alias("TotalLaborHours"),
            pay(F.col("_cost"), F.lit(1)).alias("TotalLaborCost"),
        )
    )


def attendance(employees: DataFrame, worked: DataFrame, first_date_id: int | None, last_date_id: int | None) -> DataFrame:
    """A row for every employee and day between two days, with the minutes worked.

    The days are exploded inside each row: no cross join. Without days there are no rows.
    """
    day = F.explode(F.sequence(F.lit(first_date_id).cast("int"), F.lit(last_date_id).cast("int")))
    planned = employees.select("EmployeeID", "LocationID", day.alias("ShiftDateID"))
    minutes = worked.select("EmployeeID", F.col("ClockInDateID").alias("ShiftDateID"), "TotalMinutes")
    return planned.join(minutes, ["EmployeeID", "ShiftDateID"], "left").select(
        "EmployeeID",
        "LocationID",
        "ShiftDateID",
        F.col("TotalMinutes").isNotNull().cast("int").alias("IsPresent"),
        F.coalesce("TotalMinutes", F.lit(0)).alias("TotalMinutes"),
    )


def with_rates(employees: DataFrame) -> DataFrame:
    """Hourly rate by employee number: 15.00 to 22.50 in steps of 2.50."""
    cents = (F.col("EmployeeID") % 4) * 250 + HOURLY_CENTS
    return employees.withColumn("HourlyCents", cents).withColumn(
        "HourlyRate", (amount(cents) / 100).cast("decimal(6,2)")
    )
