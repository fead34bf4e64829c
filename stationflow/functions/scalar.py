"""Column expressions. All are built-in JVM expressions, so they stay in generated code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

KPH_TO_MPH = 0.621371


def indicator(col: Column) -> Column:
    """1 where the value is positive, else 0. NULL counts as 0."""
    return F.when(col > 0, 1).otherwise(0)


def kph_to_mph(col: Column) -> Column:
    return col * F.lit(KPH_TO_MPH)


def to_day(col: Column) -> Column:
    return F.to_date(col)


def contains_flag(col: Column, needle: str = "rain") -> Column:
    """Whether the lower-cased text contains ``needle``; NULL text gives false."""
    return F.coalesce(F.lower(col).contains(needle.lower()), F.lit(False))


def as_date(value: dt.date | str | Column | None) -> Column:
    """A foldable date: a given day, or today's."""
    if value is None:
        return F.current_date()
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def within_lookback(day: Column, as_of: dt.date | str | None = None, days: int = 4) -> Column:
    """Keep the last ``days`` days before ``as_of`` and later.

    Both sides fold to a literal, so on a day derived from a scan column the comparison
    reaches the parquet reader.
    """
    return day >= F.date_sub(as_date(as_of), days)


def shift_day(day: Column, days: int | Column) -> Column:
    return F.date_add(day, days)


def iso_day(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def local_time(utc: Column, zone: str = "Asia/Bangkok") -> Column:
    """Wall-clock text in ``zone`` for a zone-less UTC timestamp."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc), "yyyy-MM-dd HH:mm:ss")


def event_time(ts: Column) -> Column:
    """A zone-less timestamp as the instant with that wall clock in UTC, which a watermark needs."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return F.timestamp_micros(micros)


def utc_day(instant: Column) -> Column:
    """The UTC calendar day of an instant, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def composite_key(*cols: Column, sep: str = "-") -> Column:
    """Join the parts with ``sep``; any NULL part makes the key NULL."""
    parts: list[Column] = []
    for i, col in enumerate(cols):
        parts += ([F.lit(sep)] if i else []) + [col.cast("string")]
    return F.concat(*parts)


def element(array: Column, index: int) -> Column:
    """0-based element, NULL beyond the end."""
    return F.get(array, F.lit(index))


def text_or(col: Column, default: str) -> Column:
    return F.trim(F.coalesce(col, F.lit(default)))


def json_field(body: Column, path: str) -> Column:
    return F.get_json_object(body, path)


def convert(col: Column, type_name: str, strict: bool = True) -> Column:
    """``strict`` raises on text that is not of the type, otherwise it becomes NULL."""
    return col.cast(type_name) if strict else col.try_cast(type_name)
