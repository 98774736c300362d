"""Date ids, calendar attributes and time differences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

CALENDAR_START = dt.date(1980, 1, 1)
CALENDAR_END = dt.date(2080, 12, 31)
FIRST_FISCAL_MONTH = 4


def calendar_id(date: dt.date) -> int:
    return (date - CALENDAR_START).days + 1


def date_id(date: Column) -> Column:
    """Surrogate id of a date: 1 on the first calendar day, no lookup needed."""
    return F.date_diff(date, F.lit(CALENDAR_START)) + 1


def date_of_id(calendar_id_col: Column) -> Column:
    return F.date_add(F.lit(CALENDAR_START), calendar_id_col - 1)


def flag(condition: Column) -> Column:
    return condition.cast("int")


def iso_weekday(date: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(date) + 1


def fiscal_year(date: Column) -> Column:
    """A fiscal year starts in April and is named after the year it ends in."""
    return F.year(date) + flag(F.month(date) >= FIRST_FISCAL_MONTH)


def calendar_attributes(date: Column) -> dict[str, Column]:
    """The calendar columns that follow from the date alone.

    ISO year, quarter flags and fiscal month/quarter follow the stored contract
    (calendar year, constant 0, three months ahead); ``corrected_attributes``
    gives the values their names promise.
    """
    weekday = iso_weekday(date)
    ahead = F.add_months(date, 3)
    day, month = F.dayofmonth(date), F.month(date)
    return {
        "Year": F.year(date),
        "Quarter": F.quarter(date),
        "Month": month,
        "MonthName": F.date_format(date, "MMMM"),
        "Day": day,
        "DayOfWeek": weekday,
        "DayName": F.date_format(date, "EEEE"),
        "WeekOfYear": F.weekofyear(date),
        "ISOYear": F.year(date),
        "ISOWeek": F.weekofyear(date),
        "IsWeekend": flag(weekday >= 6),
        "IsHoliday": F.lit(0),
        "HolidayName": F.lit(None).cast("string"),
        "IsMonthStart": flag(day == 1),
        "IsMonthEnd": flag(F.last_day(date) == date),
        "IsQuarterStart": F.lit(0),
        "IsQuarterEnd": F.lit(0),
        "IsYearStart": flag((day == 1) & (month == 1)),
        "IsYearEnd": flag((day == 31) & (month == 12)),
        "FiscalYear": fiscal_year(date),
        "FiscalMonth": F.month(ahead),
        "FiscalQuarter": F.quarter(ahead),
        "DayOfYear": F.dayofyear(date),
    }


def corrected_attributes(date: Column) -> dict[str, Column]:
    behind = F.add_months(date, 1 - FIRST_FISCAL_MONTH)
    quarter_start = F.trunc(date, "quarter")
    return {
        "ISOYear": F.extract(F.lit("YEAROFWEEK"), date),
        "ISOWeek": F.weekofyear(date),
        "IsQuarterStart": flag(quarter_start == date),
        "IsQuarterEnd": flag(F.last_day(F.add_months(quarter_start, 2)) == date),
        "FiscalYear": fiscal_year(date),
        "FiscalMonth": F.month(behind),
        "FiscalQuarter": F.quarter(behind),
    }


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed, not full minutes elapsed."""
    return F.timestamp_diff("MINUTE", F.date_trunc("MINUTE", start), F.date_trunc("MINUTE", end))


def seconds_between(start: Column, end: Column) -> Column:
    """Difference of the whole-second clock readings."""
    return F.timestamp_diff("SECOND", F.date_trunc("SECOND", start), F.date_trunc("SECOND", end))
