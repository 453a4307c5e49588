"""Business clock, batch ids and calendar columns.

Instants are stored zone-less in UTC; the business date is derived from them. The clock is
always an argument, so a batch can be repeated.
"""

from __future__ import annotations

import re
from datetime import UTC, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Business zone, batch id pattern and Spanish month names.
BUSINESS_ZONE = "America/Lima"
BATCH_ID_PATTERN = "[A-Z0-9-]+"
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)


def utc_now() -> datetime:
    return datetime.now(UTC)


def _aware(now: datetime) -> datetime:
    return now if now.tzinfo else now.replace(tzinfo=UTC)


def instant(now: datetime) -> Column:
    """A clock reading as a zone-less UTC literal."""
    reading = _aware(now).astimezone(UTC).replace(tzinfo=None)
    return F.lit(reading.isoformat(sep=" ")).cast("timestamp_ntz")


def default_batch_id(now: datetime | None = None) -> str:
    """Batch id of an instant, in business time."""
    local = _aware(now or utc_now()).astimezone(ZoneInfo(BUSINESS_ZONE))
    return f"BATCH-{local:%Y%m%d-%H%M%S}"


def checked_batch_id(batch_id: str | None = None, now: datetime | None = None) -> str:
    """The given batch id, or the default one; refuses ids that are unsafe in a path."""
    chosen = batch_id or default_batch_id(now)
    if not re.fullmatch(BATCH_ID_PATTERN, chosen):
        raise ValueError(f"batch_id has unsupported characters: {chosen!r}")
    return chosen


def date_folder(now: datetime) -> str:
    """Folder of the business day of an instant."""
    return f"{_aware(now).astimezone(ZoneInfo(BUSINESS_ZONE)):%Y/%m/%d}"


def is_batch_id(text: Column) -> Column:
    return text.rlike(rf"\A{BATCH_ID_PATTERN}\z")


def business_time(utc: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(BUSINESS_ZONE), utc)


def business_date(utc: Column) -> Column:
    return business_time(utc).cast("date")


def after_business_day(day: Column, utc: Column) -> Column:
    """Whether a date lies after the business day of an instant.

    The business day is at most one day before the UTC day, so earlier dates are decided
    without converting the instant.
    """
    return (day >= utc.cast("date")) & (day > business_date(utc))


def batch_id_of(utc: Column) -> Column:
    """Default batch id of each instant of a column."""
    digits = F.translate(F.substring(business_time(utc).cast("string"), 1, 19), " -:", "-")
    return F.concat(F.lit("BATCH-"), digits)


def batch_instant(batch_id: Column) -> Column:
    """UTC instant named by a default batch id, NULL for ids of another shape."""
    shape = "^BATCH-([0-9]{4})([0-9]{2})([0-9]{2})-([0-9]{2})([0-9]{2})([0-9]{2})$"
    year, month, day, hour, minute, second = (
        F.regexp_extract(batch_id, shape, group).try_cast("int") for group in range(1, 7)
    )
    local = F.try_make_timestamp_ntz(year, month, day, hour, minute, second)
    return F.convert_timezone(F.lit(BUSINESS_ZONE), F.lit("UTC"), local)


def date_key(day: Column) -> Column:
    """Integer yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_name(day: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTH_NAMES)), F.month(day))
