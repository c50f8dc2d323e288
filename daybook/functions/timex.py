"""Dates, times and money as column expressions. Instants are UTC timestamps without zone."""

from __future__ import annotations

from functools import cache
from zoneinfo import available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions import text as T

ZONE = "America/Chicago"


@cache
def zone_names() -> tuple[str, ...]:
    """The named zones, as the driver's time zone data lists them."""
    return tuple(sorted(z for z in available_timezones() if z != "localtime" and not z.startswith(("posix", "right", "SystemV"))))


@cache
def zone_spellings() -> dict[str, str]:
    """The named zones by their names in lower case."""
    return {z.lower(): z for z in zone_names()}


def safe_timezone(zone: Column, default: str = ZONE) -> Column:
    """``zone`` if it is a named zone, in whatever case, as it is written; else the default: absent, blank, or an offset such as ``UTC+0``."""
    return F.when(zone.isNull() | zone.isin("", default), F.lit(default)).otherwise(F.coalesce(T.said_for(F.lower(zone), zone_spellings()), F.lit(default)))


def local(ts: Column, zone: str | Column = ZONE) -> Column:
    return F.from_utc_timestamp(ts, zone)


def offset_minutes(ts: Column, zone: str = ZONE) -> Column:
    return F.timestamp_diff("MINUTE", ts, local(ts, zone))


def iso_with_offset(ts: Column, zone: str = ZONE) -> Column:
    m = offset_minutes(ts, zone)
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return F.concat(F.date_format(local(ts, zone), "yyyy-MM-dd'T'HH:mm:ss"), F.when(m < 0, "-").otherwise("+"), two(F.floor(F.abs(m) / 60)), F.lit(":"), two(F.abs(m) % 60))


def wall_to_instant(wall: Column, zone: str | Column = ZONE) -> Column:
    """The instant of a wall clock, by the offset in force at that wall clock."""
    return F.to_utc_timestamp(wall, zone)


def clock_minutes(c: Column) -> Column:
    """Minutes after midnight of ``h[:mm[:ss]] [am|pm]``; null if it is no time of day."""
    said = F.lower(F.trim(c))
    half = F.when(F.endswith(said, F.lit("am")), "am").when(F.endswith(said, F.lit("pm")), "pm")
    parts = F.split(F.when(half.isNull(), said).otherwise(F.rtrim(F.left(said, F.length(said) - 2))), ":")
    digits = F.forall(parts, lambda x: x.rlike("^[0-9]{1,2}$")) & F.forall(F.slice(parts, 2, 3), lambda x: F.length(x) == 2) & (F.size(parts) <= 3)
    at = lambda i: F.when(digits, F.coalesce(F.get(parts, i), F.lit("0"))).cast("int")
    h, m, second = at(0), at(1), at(2)
    hour = F.when((half == "pm") & (h < 12), h + 12).when((half == "am") & (h == 12), 0).otherwise(h)
    return F.when((hour < 24) & (m < 60) & (second < 60), hour * 60 + m)


def time_of_day(ts: Column, all_day: Column, zone: str | Column = ZONE) -> Column:
    h = F.hour(local(ts, zone))
    return F.when(all_day, "all-day").when((h >= 21) | (h < 5), "late-night").when(h < 12, "morning").when(h < 17, "afternoon").otherwise("evening")


def is_weekend(ts: Column, zone: str | Column = ZONE) -> Column:
    return F.dayofweek(local(ts, zone)).isin(1, 7)


def is_multi_day(start_text: Column, end_text: Column) -> Column:
    return F.coalesce(F.substring(start_text, 1, 10) != F.substring(end_text, 1, 10), F.lit(False))


def instant_of(c: Column) -> Column:
    """``yyyymmddThhmmssZ`` or ``yyyymmdd``, else null."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyyMMdd'T'HHmmss'Z'")), F.try_to_timestamp(c, F.lit("yyyyMMdd")))


def iso_of_millis(c: Column) -> Column:
    return F.date_format(F.timestamp_millis(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def cost_of_values(values: Column) -> Column:
    """struct ``kind, price_min, price_max`` of price texts: a blank counts as 0, no number as unknown, all zeros as free."""
    numbers = F.filter(F.transform(values, lambda v: F.when(F.trim(F.coalesce(v, F.lit(""))) == "", F.lit(0.0)).otherwise(v.try_cast("double"))), lambda x: x.isNotNull())
    low, high = F.array_min(numbers), F.array_max(numbers)
    none, free = F.coalesce(F.size(numbers) <= 0, F.lit(True)), high == 0
    kind = F.when(none, "unknown").when(free & (low == 0), "free").otherwise("paid")
    return F.struct(kind.alias("kind"), F.when(kind == "paid", low).alias("price_min"), F.when((kind == "paid") & (high != low), high).alias("price_max"))


def confidence_rank(c: Column) -> Column:
    return F.when(c == "high", 3).when(c == "medium", 2).when(c == "low", 1)
