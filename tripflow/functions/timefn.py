"""Date and time Column functions.

All functions map Columns to Columns and stay inside whole-stage codegen: no Python runs per
row.  Wall-clock times are kept as ``TIMESTAMP_NTZ`` and every label is assembled from its
calendar fields, so results do not depend on ``spark.sql.session.timeZone`` (no daylight
saving shifts, no dependence on the worker's local zone).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: accepted trip time layouts and the four detectable formats. ---------
# Trip feed layouts: "M/d/yyyy H:mm" (e.g. 7/1/2021 7:14) and "yyyy-MM-dd HH:mm:ss".
MDY_HM_RE = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$"
YMD_HMS_RE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
# Format detection, tried in this order, each a search (not anchored):
DETECT_FORMATS = [
    ("%Y-%m-%d %H:%M:%S.%f", r"\d{4}-\d{1,2}-\d{1,2}\s\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}"),
    ("%Y-%m-%d %H:%M:%S", r"\d{4}-\d{1,2}-\d{1,2}\s\d{1,2}:\d{1,2}:\d{1,2}"),
    ("%Y-%m-%d %H:%M", r"\d{4}-\d{1,2}-\d{1,2}\s\d{1,2}:\d{1,2}"),
    ("%Y-%m-%d", r"\d{4}-\d{1,2}-\d{1,2}"),
]
# Hour modes: MOE = 6-9 and 16-19, NOON = 11-13, IDLE = every other hour.
HOUR_MODE_MOE = [(6, 9), (16, 19)]
HOUR_MODE_NOON = [(11, 13)]
# --- end of fixed values ------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _int_token(tokens: Column, i: int) -> Column:
    # get() gives NULL past the end instead of failing under ANSI mode.
    return F.get(tokens, F.lit(i)).try_cast("int")


def _num(c: Column) -> Column:
    return c.try_cast("int")


def parse_trip_time(c: Column | str, strict: bool = False) -> Column:
    """Parse ``M/d/yyyy H:mm`` or ``yyyy-M-d H:mm:ss`` (padded or not) to TIMESTAMP_NTZ.

    Anything else, impossible dates (Feb 30) included, gives NULL; with ``strict=True`` a
    non-NULL input that does not parse raises instead.  The layout is validated by an
    anchored pattern, then fields are cut with plain substring operations.
    """
    s = _col(c)
    date_part = F.substring_index(s, " ", 1)
    time_part = F.substring_index(s, " ", -1)
    mdy = F.try_make_timestamp_ntz(
        _num(F.substring_index(date_part, "/", -1)), _num(F.substring_index(date_part, "/", 1)),
        _num(F.substring_index(F.substring_index(date_part, "/", 2), "/", -1)),
        _num(F.substring_index(time_part, ":", 1)), _num(F.substring_index(time_part, ":", -1)), F.lit(0))
    ymd = F.try_make_timestamp_ntz(
        _num(F.substring_index(date_part, "-", 1)),
        _num(F.substring_index(F.substring_index(date_part, "-", 2), "-", -1)),
        _num(F.substring_index(date_part, "-", -1)),
        _num(F.substring_index(time_part, ":", 1)),
        _num(F.substring_index(F.substring_index(time_part, ":", 2), ":", -1)),
        _num(F.substring_index(time_part, ":", -1)))
    ts = F.when(s.rlike(MDY_HM_RE), mdy).when(s.rlike(YMD_HMS_RE), ymd)
    if strict:
        ts = F.when(s.isNotNull() & ts.isNull(),
                    F.raise_error(F.concat(F.lit("unparseable trip time: "), s))).otherwise(ts)
    return ts


def time_format(c: Column | str) -> Column:
    """Name of the first detectable format found in the string, else NULL."""
    s = _col(c)
    out = None
    for name, rx in DETECT_FORMATS:
        out = F.when(s.rlike(rx), F.lit(name)) if out is None else out.when(s.rlike(rx), F.lit(name))
    return F.when((s.isNull()) | (F.length(s) == 0), F.lit(None).cast("string")).otherwise(out)


def parse_any_time(c: Column | str) -> Column:
    """Parse any detectable format (fractional seconds, seconds, minutes, date) or the trip
    layout ``M/d/yyyy H:mm`` to TIMESTAMP_NTZ; NULL when none applies."""
    s = _col(c)
    m = F.regexp_extract(s, r"(\d{4})-(\d{1,2})-(\d{1,2})(?:\s(\d{1,2}):(\d{1,2})(?::(\d{1,2})(\.\d{1,6})?)?)?", 0)
    tok = F.split(F.regexp_replace(m, r"\.", ":"), r"[ :\-]")
    frac = F.coalesce(F.regexp_extract(m, r"(\.\d{1,6})$", 1), F.lit(""))
    secs = (F.coalesce(F.try_to_number(F.concat(F.coalesce(F.get(tok, F.lit(5)), F.lit("0")), frac),
                                       F.lit("99D999999")), F.lit(0)))
    ymd = F.try_make_timestamp_ntz(
        _int_token(tok, 0), _int_token(tok, 1), _int_token(tok, 2),
        F.coalesce(_int_token(tok, 3), F.lit(0)), F.coalesce(_int_token(tok, 4), F.lit(0)), secs)
    return F.when(F.length(m) > 0, ymd).otherwise(parse_trip_time(s))


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def date_label(ts: Column | str) -> Column:
    """``yyyy-MM-dd`` of a timestamp or date."""
    d = F.to_date(_col(ts))
    return F.concat(_pad(F.year(d), 4), F.lit("-"), _pad(F.month(d), 2), F.lit("-"), _pad(F.dayofmonth(d), 2))


def hour_label(ts: Column | str, day: Column | str | None = None) -> Column:
    """Hour bucket label ``yyyy-MM-dd HH:00:00`` (pure truncation, no zone conversion); ``day`` is the
    ``date_label`` of ``ts`` where there is one already."""
    t = _col(ts)
    return F.concat(date_label(t) if day is None else _col(day), F.lit(" "), _pad(F.hour(t), 2), F.lit(":00:00"))


def datetime_label(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a timestamp."""
    t = _col(ts)
    return F.concat(date_label(t), F.lit(" "), _pad(F.hour(t), 2), F.lit(":"),
                    _pad(F.minute(t), 2), F.lit(":"), _pad(F.second(t), 2))


def month_label(ts: Column | str) -> Column:
    """``yyyy-MM``."""
    d = F.to_date(_col(ts))
    return F.concat(_pad(F.year(d), 4), F.lit("-"), _pad(F.month(d), 2))


def date_token(c: Column | str) -> Column:
    """Raw date text: everything before the first space (source format kept)."""
    return F.split(_col(c), " ").getItem(0)


def hour_token(c: Column | str) -> Column:
    """Integer hour between the first space and the next colon; NULL when either is missing."""
    s = _col(c)
    h = F.get(F.split(F.get(F.split(s, " "), F.lit(1)), ":"), F.lit(0))
    return F.when(s.contains(" ") & s.contains(":"), F.try_to_number(h, F.lit("999999999")).cast("int"))


def year_token(c: Column | str) -> Column:
    """Third ``/`` field of a ``m/d/y`` text, else ``UnknownYear``."""
    s = _col(c)
    return F.when(s.contains("/"), F.get(F.split(s, "/"), F.lit(2))).otherwise(F.lit("UnknownYear"))


def date_parts(c: Column | str) -> Column:
    """struct(year, month, day) from a ``m/d/y`` or ``y-m-d`` date text (time part ignored)."""
    d = date_token(c)
    p = F.split(d, "[/-]")
    slash = d.contains("/")
    y = F.when(slash, F.get(p, F.lit(2))).otherwise(F.get(p, F.lit(0)))
    m = F.when(slash, F.get(p, F.lit(0))).otherwise(F.get(p, F.lit(1)))
    dd = F.when(slash, F.get(p, F.lit(1))).otherwise(F.get(p, F.lit(2)))
    num = lambda x: F.try_to_number(x, F.lit("9999")).cast("int")
    return F.struct(num(y).alias("year"), num(m).alias("month"), num(dd).alias("day"))


def season(d: Column | str) -> Column:
    """1 winter, 2 spring, 3 summer, 4 autumn: the quarter of the year, which a date from the 21st
    on takes from the month after its own."""
    dt = F.to_date(_col(d))
    return F.quarter(F.when(F.dayofmonth(dt) < 21, dt).otherwise(F.add_months(dt, 1))).cast("int")


def is_business_day(d: Column | str) -> Column:
    """Monday-Friday."""
    return F.weekday(F.to_date(_col(d))) < 5


def hour_mode(h: Column | str) -> Column:
    """'MOE' (6-9, 16-19), 'NOON' (11-13) or 'IDLE' for an hour 0-23."""
    hr = _col(h)
    moe = None
    for lo, hi in HOUR_MODE_MOE:
        cond = hr.between(lo, hi)
        moe = cond if moe is None else (moe | cond)
    noon = None
    for lo, hi in HOUR_MODE_NOON:
        cond = hr.between(lo, hi)
        noon = cond if noon is None else (noon | cond)
    return F.when(hr.isNull(), F.lit(None).cast("string")).when(moe, "MOE").when(noon, "NOON").otherwise("IDLE")


def hour_mode_flags(h: Column | str) -> dict[str, Column]:
    """The three 0/1 flag columns of an hour."""
    mode = hour_mode(h)
    return {
        "hour_is_morning_evening": (mode == "MOE").cast("int"),
        "hour_is_noon": (mode == "NOON").cast("int"),
        "hour_is_idle": (mode == "IDLE").cast("int"),
    }


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """b - a in whole seconds (TIMESTAMP or TIMESTAMP_NTZ)."""
    return F.timestamp_diff("SECOND", _col(a), _col(b))


def minutes_between(a: Column | str, b: Column | str, wrap_days: bool = False) -> Column:
    """Minutes from a to b, truncated toward zero.

    ``wrap_days=True`` keeps only the seconds-within-a-day part of the difference (whole
    days dropped, negative spans wrap into [0, 1440)), as a seconds-of-timedelta reading does.
    """
    sec = seconds_between(a, b)
    if wrap_days:
        return F.floor(F.pmod(sec, F.lit(86400)) / 60).cast("int")
    return (sec / 60).cast("int")


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(ts: Column | str) -> Column:
    """Seconds since 1970-01-01 00:00:00 of a wall-clock time read as UTC."""
    return F.timestamp_diff("SECOND", _epoch_ntz(), _col(ts).cast("timestamp_ntz"))


def epoch_millis(ts: Column | str) -> Column:
    """Milliseconds since the epoch, wall clock read as UTC."""
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), _col(ts).cast("timestamp_ntz"))


def from_epoch_seconds(s: Column | str) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (UTC wall clock)."""
    return F.timestamp_add("SECOND", _col(s).cast("long"), _epoch_ntz())


def shift_days(d: Column | str, n: int) -> Column:
    """``yyyy-MM-dd`` label n days from a date."""
    return date_label(F.date_add(F.to_date(_col(d)), n))


def prev_day(d: Column | str) -> Column:
    return shift_days(d, -1)


def next_day_label(d: Column | str) -> Column:
    return shift_days(d, 1)


def last_month_label(as_of: Column | str, deli: str = "-") -> Column:
    """``Y{deli}M`` of the month before ``as_of``; month not padded."""
    prev = F.add_months(F.to_date(_col(as_of)), -1)
    return F.concat(F.year(prev).cast("string"), F.lit(deli), F.month(prev).cast("string"))


def compare_times(a: Column | str, b: Column | str) -> Column:
    """1 / -1 / 0 as a is later / earlier / equal to b (NULL if either is NULL)."""
    return F.signum(seconds_between(b, a)).cast("int")


def compare_dates(a: Column | str, b: Column | str) -> Column:
    """1 / -1 / 0 on the calendar dates only."""
    return F.signum(F.datediff(F.to_date(_col(a)), F.to_date(_col(b)))).cast("int")


def days_within(d1: Column | str, d2: Column | str, lo: int, hi: int) -> Column:
    """lo <= (date(d2) - date(d1)).days <= hi."""
    return F.datediff(F.to_date(_col(d2)), F.to_date(_col(d1))).between(lo, hi)


def shift_months(d: Column | str, n: int | Column, strict: bool = False) -> Column:
    """Calendar month shift.  Default clamps to the month end (Jan 31 + 1 -> Feb 28/29);
    ``strict=True`` gives NULL when the day does not exist in the target month."""
    dt = F.to_date(_col(d))
    nn = n if isinstance(n, Column) else F.lit(n)
    shifted = F.add_months(dt, nn)
    if strict:
        return F.when(F.dayofmonth(shifted) == F.dayofmonth(dt), shifted)
    return shifted


_UNIT_INTERVAL = {"H": "HOUR", "D": "DAY", "W": "WEEK", "M": "MONTH", "Y": "YEAR"}


def _steps(unit: str, step: int, year_as_365: bool):
    """(Column -> Column) mapping a step index to an offset from the start."""
    u = unit.upper()
    if u not in _UNIT_INTERVAL:
        raise ValueError(f"unit must be one of {sorted(_UNIT_INTERVAL)}")
    if u == "H":
        return lambda b, i: F.timestamp_add("HOUR", i * step, b)
    if u == "D":
        return lambda b, i: F.timestamp_add("DAY", i * step, b)
    if u == "W":
        return lambda b, i: F.timestamp_add("DAY", i * 7 * step, b)
    if u == "Y" and year_as_365:
        return lambda b, i: F.timestamp_add("DAY", i * 365 * step, b)
    if u == "M":
        return lambda b, i: F.timestamp_add("MONTH", i * step, b)
    return lambda b, i: F.timestamp_add("YEAR", i * step, b)


def spine_frame(spark: SparkSession, begin, end, unit: str = "D", step: int = 1,
                year_as_365: bool = False, col: str = "ts") -> DataFrame:
    """Points from ``begin`` to ``end`` (inclusive, datetime values) every ``step`` units, as a
    ``spark.range`` split over tasks (the calendar span never sits in one row)."""
    import datetime as _dt

    def as_dt(v):
        if isinstance(v, str):
            return _dt.datetime.fromisoformat(v)
        if isinstance(v, _dt.datetime):
            return v
        return _dt.datetime(v.year, v.month, v.day)

    b, e = as_dt(begin), as_dt(end)
    if b >= e:
        return spark.range(0).select(F.lit(None).cast("timestamp_ntz").alias(col))
    secs = (e - b).total_seconds()
    per = {"H": 3600, "D": 86400, "W": 7 * 86400, "M": 28 * 86400, "Y": (365 if year_as_365 else 365) * 86400}
    upper = int(secs // (per[unit.upper()] * step)) + 2  # generous: over-generate, then clip
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), upper // 10000 + 1))
    off = _steps(unit, step, year_as_365)
    start = F.lit(b).cast("timestamp_ntz")
    pts = spark.range(0, upper, 1, parts).select(off(start, F.col("id")).alias(col))
    return pts.where(F.col(col) <= F.lit(e).cast("timestamp_ntz"))


def date_spine(spark: SparkSession, begin: str, end: str, unit: str = "D", step: int = 1,
               closed: bool = True, year_as_365: bool = False) -> DataFrame:
    """One row per point from begin to end; empty when begin >= end.  ``closed=False`` drops
    the end points when they are on the spine.  Months step by calendar month from the
    start day, clamped to the month end."""
    df = spine_frame(spark, begin, end, unit, step, year_as_365)
    if not closed:
        df = df.filter((F.col("ts") != F.lit(begin).cast("timestamp_ntz"))
                       & (F.col("ts") != F.lit(end).cast("timestamp_ntz")))
    return df
