"""Net hours: spells of work between breaks, and the week's overtime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.dates import seconds_between
from larder.operators.scan import scan_before

OVERTIME_PERCENT = 150


def work_spells(punches: DataFrame, longest_pause: str) -> DataFrame:
    """One row per spell of work of an employee: start, end, clock readings and the break before it.

    A pause longer than the interval ``longest_pause`` is a break and separates two
    spells, also where it or a spell crosses midnight. The spell of a reading follows
    from the first and last reading before it and the start of the spell they end in;
    these combine (``scan``), so the readings of one employee are cut into ranges.
    Readings without a time are left out; equal readings count each.
    """
    time = F.col("PunchTime")
    new = lambda last, t: t > last + F.expr(f"INTERVAL {longest_pause}")

    def combine(a: Column, b: Column) -> Column:
        start = F.coalesce(b["start"], F.when(new(a["last"], b["first"]), b["first"]), a["start"])
        ended = F.coalesce(F.when(b["start"].isNotNull(), b["ended"]), F.when(new(a["last"], b["first"]), a["last"]), a["ended"])
        return F.struct(a["first"].alias("first"), b["last"].alias("last"), start.alias("start"), ended.alias("ended"))

    # start is NULL while the spell reaches back to the first reading; ended is the last reading of the spell before
    unknown = F.lit(None).cast(punches.schema["PunchTime"].dataType)
    one = F.struct(time.alias("first"), time.alias("last"), unknown.alias("start"), unknown.alias("ended"))
    read = punches.where(time.isNotNull()).select("EmployeeID", "PunchTime")
    seen = scan_before(read, ["EmployeeID"], ["PunchTime"], one, combine, "_seen")
    was = F.col("_seen")
    begins = was.isNull() | new(was["last"], time)
    return (
        seen.select(
            "EmployeeID", "PunchTime",
            F.when(begins, time).otherwise(F.coalesce(was["start"], was["first"])).alias("SpellStart"),
            F.when(begins, was["last"]).otherwise(was["ended"]).alias("_ended"),
        )
        .groupBy("EmployeeID", "SpellStart")
        .agg(F.max("PunchTime").alias("SpellEnd"), F.count("*").alias("Readings"), F.max("_ended").alias("_ended"))
        .withColumn("BreakSeconds", seconds_between(F.col("_ended"), F.col("SpellStart")))
        .drop("_ended")
    )


def _pay(hourly_cents: int) -> Column:
    """Pay in cents rounded half up, in whole numbers; overtime counts ``OVERTIME_PERCENT``."""
    percent = F.col("RegularSeconds") * 100 + F.col("OvertimeSeconds") * OVERTIME_PERCENT
    return (F.floor((percent * hourly_cents + 180_000) / 360_000).cast("decimal(18,0)") / 100).cast("decimal(18,2)")


def net_hours(spells: DataFrame, hourly_cents: int, weekly_hours: int = 40) -> DataFrame:
    """Regular and overtime seconds and pay of each spell, by the running sum of its week.

    A week begins on Monday and a spell belongs to the week in which it starts. The
    window holds the spells of one employee and week, of which breaks allow few.
    """
    week = F.date_trunc("week", F.col("SpellStart")).cast("date")
    earlier = Window.partitionBy("EmployeeID", "Week").orderBy("SpellStart").rowsBetween(Window.unboundedPreceding, -1)
    limit = F.lit(weekly_hours * 3600)
    before = F.coalesce(F.sum("WorkedSeconds").over(earlier), F.lit(0))
    regular = F.greatest(F.least(F.col("WorkedSeconds"), limit - F.col("_before")), F.lit(0)).cast("bigint")
    return (
        spells.withColumn("Week", week)
        .withColumn("WorkedSeconds", seconds_between(F.col("SpellStart"), F.col("SpellEnd")))
        .withColumn("_before", before)
        .withColumn("RegularSeconds", regular)
        .withColumn("OvertimeSeconds", F.col("WorkedSeconds") - F.col("RegularSeconds"))
        .withColumn("GrossPay", _pay(hourly_cents))
        .drop("_before")
    )
