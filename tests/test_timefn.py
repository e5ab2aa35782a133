import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripflow.functions import calendar, timefn


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_parse_trip_time(spark):
    rows = [("7/1/2021 7:14",), ("07/01/2021 07:14",), ("2021-07-01 07:14:05",), ("2021-7-1 7:14:05",),
            ("bad",), (None,), ("2/30/2021 7:14",), ("2021-07-01 07:14",)]
    got = one(spark, rows, "s string", timefn.parse_trip_time("s"))
    assert got == [(dt.datetime(2021, 7, 1, 7, 14),), (dt.datetime(2021, 7, 1, 7, 14),),
                   (dt.datetime(2021, 7, 1, 7, 14, 5),), (dt.datetime(2021, 7, 1, 7, 14, 5),),
                   (None,), (None,), (None,), (None,)]


def test_parse_strict_raises(spark):
    df = spark.createDataFrame([("bad",)], "s string").select(timefn.parse_trip_time("s", strict=True))
    with pytest.raises(Exception):
        df.collect()


def test_time_format_detection(spark):
    rows = [("2021-07-01 07:14:05.123",), ("2021-07-01 07:14:05",), ("2021-7-1 7:14",), ("x 2021-07-01",),
            ("7/1/2021 7:14",), ("",)]
    got = [r[0] for r in one(spark, rows, "s string", timefn.time_format("s"))]
    assert got == ["%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d", None, None]


def test_parse_any_time(spark):
    rows = [("2021-07-01 07:14:05.25",), ("2021-07-01",), ("7/1/2021 7:14",)]
    got = [r[0] for r in one(spark, rows, "s string", timefn.parse_any_time("s"))]
    assert got == [dt.datetime(2021, 7, 1, 7, 14, 5, 250000), dt.datetime(2021, 7, 1), dt.datetime(2021, 7, 1, 7, 14)]


def _season_truth(m, d):
    if m in (1, 2):
        return 1
    if m == 3:
        return 1 if d < 21 else 2
    if m in (4, 5):
        return 2
    if m == 6:
        return 2 if d < 21 else 3
    if m in (7, 8):
        return 3
    if m == 9:
        return 3 if d < 21 else 4
    if m in (10, 11):
        return 4
    return 4 if d < 21 else 1


def test_season_boundaries(spark):
    rows = [(dt.date(2021, m, d),) for m in range(1, 13) for d in (20, 21)]
    got = [r[0] for r in one(spark, rows, "d date", timefn.season("d"))]
    assert got == [_season_truth(r[0].month, r[0].day) for r in rows]


def test_hour_mode(spark):
    rows = [(h,) for h in range(24)]
    flags = timefn.hour_mode_flags("h")
    got = one(spark, rows, "h int", "h", timefn.hour_mode("h"), *flags.values())
    for h, mode, moe, noon, idle in got:
        exp = "MOE" if (6 <= h <= 9 or 16 <= h <= 19) else "NOON" if 11 <= h <= 13 else "IDLE"
        assert mode == exp and (moe, noon, idle) == (exp == "MOE", exp == "NOON", exp == "IDLE")


@pytest.mark.parametrize("day,hol,work", [
    ("2021-12-31", 1, 0),  # Friday: New Year's Day 2022 (a Saturday) observed
    ("2022-01-01", 1, 0),
    ("2021-07-04", 1, 0), ("2021-07-05", 1, 0), ("2021-07-06", 0, 1),  # Sunday holiday, Monday observed
    ("2020-06-19", 0, 1), ("2021-06-18", 1, 0), ("2021-06-19", 1, 0),  # Juneteenth from 2021
    ("2021-01-18", 1, 0), ("2021-01-11", 0, 1),  # 3rd Monday of January
    ("2021-02-15", 1, 0), ("2021-05-31", 1, 0), ("2021-05-24", 0, 1),  # Washington, Memorial Day
    ("2021-09-06", 1, 0), ("2021-10-11", 1, 0), ("2021-11-11", 1, 0), ("2021-11-25", 1, 0),
    ("2021-12-24", 1, 0),  # Christmas 2021 is a Saturday
    ("2021-07-10", 0, 0),  # plain Saturday
])
def test_holidays(spark, day, hol, work):
    got = one(spark, [(dt.date.fromisoformat(day),)], "d date", calendar.holiday_flag("d"), calendar.workingday_flag("d"))
    assert got == [(hol, work)]


def test_holiday_calendar_table(spark):
    days = [r["date"].isoformat() for r in calendar.holiday_calendar(spark, 2021, 2021).orderBy("date").collect()]
    assert "2021-12-31" in days and "2021-07-05" in days and "2021-06-18" in days
    assert len([d for d in days if d.startswith("2021")]) >= 11


def test_flag_with_calendar(spark):
    cal = spark.createDataFrame([(dt.date(2021, 3, 1),)], "date date")
    df = spark.createDataFrame([(dt.date(2021, 3, 1),), (dt.date(2021, 3, 2),), (None,)], "d date")
    got = sorted(tuple(r) for r in calendar.flag_with_calendar(df, "d", cal).select("holiday", "workingday").collect()
                 if r[0] is not None)
    assert got == [(0, 1), (1, 0)]


def test_month_shift(spark):
    rows = [(dt.date(2021, 1, 31),)]
    got = one(spark, rows, "d date", timefn.shift_months("d", 1), timefn.shift_months("d", 1, strict=True),
              timefn.shift_months("d", 0), timefn.shift_months("d", -1), timefn.shift_months("d", -13))
    assert got == [(dt.date(2021, 2, 28), None, dt.date(2021, 1, 31), dt.date(2020, 12, 31), dt.date(2019, 12, 31))]


def test_minutes_between(spark):
    rows = [(dt.datetime(2021, 1, 1, 23, 50), dt.datetime(2021, 1, 2, 0, 10)),
            (dt.datetime(2021, 1, 1, 8, 0), dt.datetime(2021, 1, 2, 8, 10)),
            (dt.datetime(2021, 1, 1, 8, 1), dt.datetime(2021, 1, 1, 8, 0))]
    got = one(spark, rows, "a timestamp_ntz, b timestamp_ntz", timefn.minutes_between("a", "b"),
              timefn.minutes_between("a", "b", wrap_days=True))
    assert got == [(20, 20), (1450, 10), (-1, 1439)]


def test_labels_and_epoch(spark):
    rows = [(dt.datetime(2021, 1, 6, 13, 53, 7),)]
    got = one(spark, rows, "t timestamp_ntz", timefn.hour_label("t"), timefn.date_label("t"), timefn.month_label("t"),
              timefn.epoch_seconds("t"), timefn.epoch_millis("t"), timefn.prev_day("t"), timefn.next_day_label("t"),
              timefn.last_month_label("t"), timefn.datetime_label(timefn.from_epoch_seconds(F.lit(1609941187))))
    assert got == [("2021-01-06 13:00:00", "2021-01-06", "2021-01", 1609941187, 1609941187000, "2021-01-05",
                    "2021-01-07", "2020-12", "2021-01-06 13:53:07")]


def test_tokens(spark):
    rows = [("7/1/2021 7:14",), ("2021-07-01 07:14:05",), ("nodate",)]
    got = one(spark, rows, "s string", timefn.date_token("s"), timefn.hour_token("s"), timefn.year_token("s"))
    assert got == [("7/1/2021", 7, "2021 7:14"), ("2021-07-01", 7, "UnknownYear"), ("nodate", None, "UnknownYear")]


def test_compare(spark):
    rows = [(dt.datetime(2021, 1, 1, 10), dt.datetime(2021, 1, 1, 9)), (dt.datetime(2021, 1, 1), dt.datetime(2021, 1, 3))]
    got = one(spark, rows, "a timestamp_ntz, b timestamp_ntz", timefn.compare_times("a", "b"),
              timefn.compare_dates("a", "b"), timefn.days_within("a", "b", 0, 1))
    assert got == [(1, 0, True), (-1, -1, False)]


def test_date_spine(spark):
    d = [r["ts"] for r in timefn.date_spine(spark, "2021-01-30", "2021-02-02").collect()]
    assert [x.day for x in d] == [30, 31, 1, 2]
    d = [r["ts"] for r in timefn.date_spine(spark, "2021-01-30", "2021-02-02", closed=False).collect()]
    assert [x.day for x in d] == [31, 1]
    assert timefn.date_spine(spark, "2021-02-02", "2021-01-30").count() == 0
    m = [r["ts"].date().isoformat() for r in timefn.date_spine(spark, "2021-01-31", "2021-04-30", "M").collect()]
    assert m == ["2021-01-31", "2021-02-28", "2021-03-31", "2021-04-30"]
    h = timefn.date_spine(spark, "2021-01-01 00:00:00", "2021-01-01 05:00:00", "H", 2).count()
    assert h == 3
