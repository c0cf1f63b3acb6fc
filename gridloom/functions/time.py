"""Time functions on columns: month slices, interval conventions, resolutions, calendars, zones. ``today`` is always given."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import RequestError

#: Forms of a task's date and of a resolution.
DATE, RESOLUTION = r"^\d{4}(-\d{2}(-\d{2})?)?$", r"^\d+(h|min|d)$"


def month_start(year: int, month: int) -> Column:
    return F.lit(f"{year:04d}-{month:02d}-01 00:00:00").cast("timestamp_ntz")


def in_month(ts: Column, year: int, month: int) -> Column:
    """A half-open range, so that scans can prune by it."""
    return (ts >= month_start(year, month)) & (ts < month_start(year + month // 12, month % 12 + 1))


def in_month_by_end(ts: Column, year: int, month: int) -> Column:
    """For stamps that end an hour: the first instant of a month belongs to the month before."""
    hour = F.expr("INTERVAL 1 HOUR")
    return (ts >= month_start(year, month) + hour) & (ts < month_start(year + month // 12, month % 12 + 1) + hour)


def interval_start(ts: Column, minutes: int) -> Column:
    """The start of the interval that ends at ``ts``."""
    return ts - F.expr(f"INTERVAL {minutes} MINUTE")


def fiscal_year(ts: Column, first_month: int = 4) -> Column:
    return F.when(F.month(ts) >= first_month, F.year(ts)).otherwise(F.year(ts) - 1)


def year_start(*dates: Column, default: Column | None = None) -> Column:
    """January 1st of the first date that is not null."""
    c = F.coalesce(*dates, *([] if default is None else [default])).cast("timestamp_ntz")
    return F.make_date(F.year(c), F.lit(1), F.lit(1)).cast("timestamp_ntz")


def shift_hours(ts: Column, hours: int) -> Column:
    """Wall clock of a zone with a fixed offset from that of UTC."""
    return ts + F.make_dt_interval(hours=F.lit(hours))


def from_iso_duration(c: Column) -> Column:
    """PT60M gives 1h, PT15M 15min; anything else is an error when it is evaluated."""
    n = F.nullif(F.regexp_extract(c, r"^PT(\d+)M$", 1), F.lit(""))
    return F.when(n == "60", F.lit("1h")).when(n.isNotNull(), F.concat(n, F.lit("min"))).otherwise(F.when(c.isNotNull(), F.raise_error(F.concat(F.lit("no resolution: "), c))))


def from_minutes(c: Column) -> Column:
    """1h for 60, 5min for 5; null from other gaps than whole minutes up to an hour."""
    whole = c.cast("int")
    return F.when(c == 60, F.lit("1h")).when((c > 0) & (c < 60) & (c == whole), F.concat(whole.cast("string"), F.lit("min")))


def api_code(resolution: Column) -> Column:
    return F.regexp_replace(resolution, "min$", "m")


def valid_date(c: Column) -> Column:
    whole = F.concat(c, F.when(F.length(c) == 4, "-01-01").when(F.length(c) == 7, "-01").otherwise(""))
    return F.coalesce(c.rlike(DATE) & F.try_to_date(whole, "yyyy-MM-dd").isNotNull(), F.lit(False))


def valid_resolution(c: Column) -> Column:
    return F.coalesce(c.rlike(RESOLUTION), F.lit(False))


def epoch_in_zone(seconds: Column, zone: str) -> Column:
    """Wall clock in a zone of seconds since 1970."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)")))


def zone_to_utc(ts: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def period_starts(trading_date: Column, period: Column, zone: str, minutes: int = 30) -> Column:
    """UTC start of the n-th period of a local day, counted in real time, so days of 46 and 50 periods come out right."""
    return zone_to_utc(trading_date.cast("timestamp_ntz"), zone) + F.make_dt_interval(mins=(period - 1) * minutes)


def spine(spark: SparkSession, years: list[int], unit: str, today: dt.date) -> DataFrame:
    """``date`` strings of every day, month or year (``day``, ``month``, ``year``) of the years, up to yesterday."""
    yesterday = today - dt.timedelta(days=1)
    some = sorted({y for y in years if y <= yesterday.year})
    if not some:
        raise RequestError(f"no {unit} before {today} in {years}")
    form = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}[unit]
    ends = spark.createDataFrame([(dt.date(y, 1, 1), min(dt.date(y, 12, 31), yesterday)) for y in some], "a date, b date")
    return ends.select(F.explode(F.expr(f"sequence(a, b, INTERVAL 1 {unit.upper()})")).alias("d")).select(F.date_format("d", form).alias("date"))


def days_of_month(date: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.day(F.last_day(date))), lambda d: F.lpad(d.cast("string"), 2, "0"))


def hours_of_day() -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":00")))


def attach_zone(ts: Column, zone: str) -> Column:
    """A stamp without a zone, taken as wall clock there, as wall clock in UTC."""
    return zone_to_utc(ts.cast("timestamp_ntz"), zone)


def next_day(date: Column) -> Column:
    return F.date_add(date, 1)


def next_month(date: Column, n: int = 1) -> Column:
    """The first of the n-th month after the one that the date is in."""
    return F.add_months(F.trunc(date, "month"), n)


def next_period(month: Column) -> Column:
    """The month after ``YYYY-MM``, in the same form."""
    return F.date_format(next_month(F.to_date(F.concat(month, F.lit("-01")))), "yyyy-MM")
