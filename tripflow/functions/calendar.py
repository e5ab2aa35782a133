"""US federal holiday calendar as Column rules, working-day flag, and calendar tables.

The holiday test is a pure expression over (year, month, day, weekday), so flagging a
billion-row table needs no join and no shuffle.  Callers that keep their own calendar use
``flag_with_calendar`` (a broadcast join behind a size check).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: US federal holiday rules (valid from 1986). ---------------------------
# Fixed dates (month, day): New Year's Day 1/1, Independence Day 7/4, Veterans Day 11/11,
# Christmas Day 12/25; Juneteenth 6/19 from 2021.
FIXED_HOLIDAYS = [(1, 1), (7, 4), (11, 11), (12, 25)]
JUNETEENTH = (6, 19)
JUNETEENTH_FROM = 2021
# Floating (month, ISO weekday 1=Mon..7=Sun, nth week; -1 = last):
# Martin Luther King Jr. Day 3rd Mon Jan, Washington's Birthday 3rd Mon Feb,
# Memorial Day last Mon May, Labor Day 1st Mon Sep, Columbus Day 2nd Mon Oct,
# Thanksgiving 4th Thu Nov.
FLOATING_HOLIDAYS = [(1, 1, 3), (2, 1, 3), (5, 1, -1), (9, 1, 1), (10, 1, 2), (11, 4, 4)]
# Observed rule: a fixed-date holiday on Saturday is observed the Friday before (New Year's
# Day on a Saturday -> Dec 31 of the previous year), on Sunday the Monday after.
# --- end of fixed values ------------------------------------------------------------------

_DAYS_IN_MONTH = {1: 31, 2: 28, 3: 31, 4: 30, 5: 31, 6: 30, 7: 31, 8: 31, 9: 30, 10: 31, 11: 30, 12: 31}


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _md(d: Column) -> Column:
    return F.month(d) * 100 + F.dayofmonth(d)


def is_us_holiday(d: Column | str) -> Column:
    """True when the date is a US federal holiday or an observed substitute day.

    Evaluated as a handful of membership tests on integer codes (month*100+day for fixed
    dates; month, weekday and week-of-month for floating ones), so each date field is
    derived only a few times per row.
    """
    dt = F.to_date(_col(d))
    y = F.year(dt)
    md = _md(dt)
    iso = F.weekday(dt) + 1  # 1 = Monday .. 7 = Sunday
    dd = F.dayofmonth(dt)
    fixed = [m * 100 + day for m, day in FIXED_HOLIDAYS]
    june = JUNETEENTH[0] * 100 + JUNETEENTH[1]

    def fixed_hit(code: Column, year: Column) -> Column:
        return F.array_contains(F.array(*[F.lit(c) for c in fixed]), code) | ((code == june) & (year >= JUNETEENTH_FROM))

    nth = F.floor((dd - 1) / 7).cast("int") + 1
    nth_codes = [m * 100 + wd * 10 + n for m, wd, n in FLOATING_HOLIDAYS if n > 0]
    floating = F.array_contains(F.array(*[F.lit(c) for c in nth_codes]), F.month(dt) * 100 + iso * 10 + nth)
    for m, wd, n in FLOATING_HOLIDAYS:
        if n < 0:  # last <weekday> of the month: within the month's final seven days
            floating = floating | ((F.month(dt) == m) & (iso == wd) & (dd > _DAYS_IN_MONTH[m] - 7))
    # The day after a Friday, the day before a Monday, else the day itself.
    off = F.date_add(dt, F.when(iso == 5, 1).when(iso == 1, -1).otherwise(0))
    observed = fixed_hit(_md(off), F.year(off))
    return F.when(dt.isNotNull(), fixed_hit(md, y) | floating | observed)


def holiday_flag(d: Column | str) -> Column:
    """0/1 holiday flag."""
    return is_us_holiday(d).cast("int")


def workingday_flag(d: Column | str) -> Column:
    """1 on Monday-Friday that are not holidays, else 0."""
    dt = F.to_date(_col(d))
    return F.when(dt.isNotNull(), ((F.weekday(dt) < 5) & ~is_us_holiday(dt)).cast("int"))


def holiday_calendar(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per holiday date (incl. observed days) in [first_year, last_year]; the days
    come from a distributed ``spark.range``."""
    import datetime as _dt

    start, end = _dt.date(first_year, 1, 1), _dt.date(last_year, 12, 31)
    n = (end - start).days + 1
    days = spark.range(0, n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))
    return days.filter(is_us_holiday("date"))


def flag_with_calendar(df: DataFrame, date_col: str, calendar: DataFrame, *,
                       calendar_date_col: str = "date") -> DataFrame:
    """Add ``holiday`` / ``workingday`` from a caller-supplied calendar table (a plain join: Spark
    broadcasts the calendar if its size allows)."""
    cal = (calendar.select(F.to_date(F.col(calendar_date_col)).alias("__hdate"))
           .distinct().withColumn("__is_holiday", F.lit(1)))
    dcol = F.to_date(F.col(date_col))
    out = df.withColumn("__d", dcol).join(cal, F.col("__d") == F.col("__hdate"), "left")
    hol = F.when(F.col("__d").isNotNull(), F.coalesce(F.col("__is_holiday"), F.lit(0)))
    return (out.withColumn("holiday", hol.cast("int"))
            .withColumn("workingday", F.when(F.col("__d").isNotNull(),
                                             ((F.weekday("__d") < 5) & (F.col("holiday") == 0)).cast("int")))
            .drop("__d", "__hdate", "__is_holiday"))
