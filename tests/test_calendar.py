import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.functions import dates
from larder.operators.calendar import calendar, with_calendar


@pytest.fixture(scope="module")
def full(spark):
    return calendar(spark, created=dt.datetime(2024, 1, 1)).cache()


def test_span_and_ids(full):
    got = full.agg(
        F.count("*"), F.min("CalendarID"), F.max("CalendarID"), F.count_distinct("CalendarID"),
        F.min("CalendarDate"), F.max("CalendarDate"),
    ).first()
    assert tuple(got) == (36891, 1, 36891, 36891, dt.date(1980, 1, 1), dt.date(2080, 12, 31))
    assert len(full.columns) == 26


def test_known_ids(full):
    known = {10000: "2007-05-18", 14000: "2018-04-30", 14611: "2020-01-01", 15342: "2022-01-01",
             20000: "2034-10-03", 20050: "2034-11-22", 30000: "2062-02-18"}
    rows = full.where(F.col("CalendarID").isin(*known)).collect()
    assert {r.CalendarID: str(r.CalendarDate) for r in rows} == known
    for key, date in known.items():
        assert dates.calendar_id(dt.date.fromisoformat(date)) == key


def test_attributes_against_python(full):
    for r in full.where("Year IN (1999, 2000, 2016, 2080)").collect():
        d = r.CalendarDate
        assert (r.Year, r.Month, r.Day) == (d.year, d.month, d.day)
        assert r.Quarter == (d.month + 2) // 3
        assert r.DayOfWeek == d.isoweekday() and r.DayName == d.strftime("%A")
        assert r.MonthName == d.strftime("%B")
        assert r.ISOWeek == r.WeekOfYear == d.isocalendar()[1]
        assert r.ISOYear == d.year
        assert r.IsWeekend == int(d.isoweekday() >= 6)
        assert r.IsMonthEnd == int((d + dt.timedelta(1)).day == 1)
        assert r.FiscalYear == d.year + (d.month >= 4)
        assert r.FiscalMonth == (d.month + 2) % 12 + 1
        assert r.DayOfYear == d.timetuple().tm_yday
        assert (r.IsQuarterStart, r.IsQuarterEnd, r.IsHoliday, r.HolidayName) == (0, 0, 0, None)


def test_corrected_attributes(spark):
    for r in calendar(spark, dt.date(2015, 1, 1), dt.date(2016, 12, 31), corrected=True).collect():
        d = r.CalendarDate
        assert (r.ISOYear, r.ISOWeek) == d.isocalendar()[:2]
        assert r.IsQuarterStart == int(d.day == 1 and d.month in (1, 4, 7, 10))
        tomorrow = d + dt.timedelta(1)
        assert r.IsQuarterEnd == int(tomorrow.day == 1 and tomorrow.month in (1, 4, 7, 10))
        assert r.FiscalMonth == (d.month - 4) % 12 + 1
        assert r.FiscalQuarter == (r.FiscalMonth + 2) // 3


def test_leap_days(full):
    days = full.where("Month = 2 AND Day = 29").select("Year").collect()
    years = {r.Year for r in days}
    assert 2000 in years and 2001 not in years and 2024 in years
    assert full.where("Year = 2020 AND Month = 1").count() == 31
    assert full.where("Year = 2021 AND Month = 2").count() == 28


def test_no_single_partition_window(full):
    assert "Window" not in full._jdf.queryExecution().toString()


def test_guards(spark):
    with pytest.raises(ValueError, match="SparkSession cannot be None"):
        calendar(None)
    with pytest.raises(ValueError):
        calendar(spark, dt.date(2020, 1, 2), dt.date(2020, 1, 1))


def test_role_playing_joins(spark):
    facts = spark.createDataFrame([(1, 366), (14611, 14976)], "OrderDateID int, ShipDateID int")
    joined = with_calendar(facts, "OrderDateID", "Order", "Year")
    joined = with_calendar(joined, "ShipDateID", "Ship", "Year", "DayOfYear")
    rows = {(r.OrderYear, r.ShipYear, r.ShipDayOfYear) for r in joined.collect()}
    assert rows == {(1980, 1980, 366), (2020, 2020, 366)}


def test_time_differences(spark):
    rows = [
        (dt.datetime(2024, 1, 1, 9, 0, 59), dt.datetime(2024, 1, 1, 9, 1, 0), 1, 1),
        (dt.datetime(2024, 1, 1, 9, 0, 0), dt.datetime(2024, 1, 1, 9, 0, 59), 0, 59),
        (dt.datetime(2024, 1, 1, 9, 0, 0, 999999), dt.datetime(2024, 1, 1, 9, 0, 1, 1), 0, 1),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, minutes int, seconds int")
    for r in df.select(
        "minutes", "seconds",
        dates.minutes_between(F.col("a"), F.col("b")).alias("m"),
        dates.seconds_between(F.col("a"), F.col("b")).alias("s"),
    ).collect():
        assert (r.m, r.s) == (r.minutes, r.seconds)
