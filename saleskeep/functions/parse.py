"""Text to typed values, NULL where the text does not fit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


CONTROL = r"\x00-\x1F\x7F"


def whole_number(text: Column, kind: str) -> Column:
    """Whole number of a type; casts alone would skip control characters around it."""
    return F.when(~text.rlike(f"[{CONTROL}]"), text.try_cast(kind))


def plain_decimal(text: Column, precision: int, scale: int) -> Column:
    """Decimal written without an exponent, rounded half up to the scale."""
    return F.when(~text.rlike(f"[eE{CONTROL}]"), text.try_cast(f"decimal({precision},{scale})"))


# Sign, digits before and after the point, exponent.
NUMBER = r"^\s*([+-]?)(?=\.?[0-9])([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?\s*$"


# Numbers as they mostly are, told by one short pattern: without sign, exponent or blanks.
PLAIN, PLAIN_WHOLE = r"\A[0-9]+(?:\.[0-9]*)?\z", r"\A[0-9]+\z"


def number_sign(text: Column) -> Column:
    """-1, 0 or 1 for a number of any size and any number of decimals, exponents included."""
    digits = F.concat(F.regexp_extract(text, NUMBER, 2), F.regexp_extract(text, NUMBER, 3))
    sign = (
        F.when(~digits.rlike("[1-9]"), 0)
        .when(F.regexp_extract(text, NUMBER, 1) == "-", -1)
        .otherwise(1)
    )
    plain = F.when(text.rlike("[1-9]"), 1).otherwise(0)
    return F.when(text.rlike(PLAIN), plain).when(text.rlike(NUMBER), sign)


def is_whole(text: Column) -> Column:
    """Whether a number of any size is a whole one: its last digit that is not zero stands
    before the point, once the exponent has moved that."""
    before, after = F.regexp_extract(text, NUMBER, 2), F.regexp_extract(text, NUMBER, 3)
    exponent = F.regexp_extract(text, NUMBER, 4)
    digits = F.concat(before, after)
    zeros = F.length(digits) - F.length(F.rtrim(digits, F.lit("0")))
    # An exponent beyond bigint moves the point further than any text is long.
    far = F.when(exponent.startswith("-"), F.lit(-(1 << 40))).otherwise(F.lit(1 << 40))
    moved = F.when(exponent == "", F.lit(0)).otherwise(F.coalesce(exponent.try_cast("bigint"), far))
    decimals = (F.length(after) - zeros).cast("bigint")
    whole = ~digits.rlike("[1-9]") | (moved >= decimals)
    return F.when(text.rlike(PLAIN_WHOLE), True).when(text.rlike(NUMBER), whole)


def dashed_date(text: Column) -> Column:
    """Date written exactly as yyyy-mm-dd, from year 1."""
    return F.when(text.rlike(r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), text.try_cast("date"))


def iso_date(text: Column) -> Column:
    """Date in any ISO 8601 calendar or week form: 2026-08-01, 20260801, 2026-W31-6."""
    week = r"^((?!0000)[0-9]{4})(?:-W([0-9]{2})(?:-([1-7]))?|W([0-9]{2})([1-7])?)$"

    def part(group: int) -> Column:
        return F.regexp_extract(text, week, group).try_cast("int")

    year = part(1)
    number = F.coalesce(part(2), part(4))
    weekday = F.coalesce(part(3), part(5), F.lit(1))
    first_monday = F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4))).cast("date")
    monday = F.date_add(first_monday, (number - 1) * 7)
    # A week belongs to the year its Thursday falls in; week 53 exists only in some years.
    exists = F.year(F.date_add(monday, 3)) == year
    return F.coalesce(
        dashed_date(text),
        F.when(text.rlike("^(?!0000)[0-9]{8}$"), F.try_to_date(text, "yyyyMMdd")),
        F.when(text.rlike(week) & exists, F.date_add(monday, weekday - 1)),
    )
