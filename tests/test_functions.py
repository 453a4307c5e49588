from datetime import UTC, date, datetime
from decimal import Decimal
from fractions import Fraction
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from saleskeep.functions import clock, parse, text


def column(spark, expression, values, kind="string"):
    rows = spark.createDataFrame([(at, value) for at, value in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_default_batch_id_is_in_business_time():
    now = datetime(2024, 2, 29, 23, 59, 8, tzinfo=ZoneInfo("America/Lima"))
    assert clock.default_batch_id(now) == "BATCH-20240229-235908"
    assert clock.default_batch_id(now.astimezone(UTC)) == "BATCH-20240229-235908"
    assert clock.checked_batch_id(None, now) == "BATCH-20240229-235908"


@pytest.mark.parametrize("bad", ["BATCH 1", "batch-1", "A/B", "A\n", " A"])
def test_unsafe_batch_ids_are_refused(spark, bad):
    with pytest.raises(ValueError, match="unsupported"):
        clock.checked_batch_id(bad)
    assert column(spark, clock.is_batch_id, [bad, "BATCH-1"]) == [False, True]


def test_date_folder_follows_the_business_day():
    assert clock.date_folder(datetime(2026, 9, 1, 3, 0, tzinfo=UTC)) == "2026/08/31"


def test_batch_ids_of_a_column_and_back(spark):
    instants = [datetime(2024, 3, 1, 4, 59, 8, 999), datetime(2026, 1, 1, 4, 59, 59)]
    ids = column(spark, clock.batch_id_of, instants, "timestamp_ntz")
    assert ids == ["BATCH-20240229-235908", "BATCH-20251231-235959"]
    back = column(spark, clock.batch_instant, [*ids, "BATCH-TEST", "BATCH-20261301-000000", None])
    assert back == [datetime(2024, 3, 1, 4, 59, 8), datetime(2026, 1, 1, 4, 59, 59), None, None, None]


def test_calendar_columns(spark):
    days = [date(2026, 1, 31), date(2026, 9, 1), date(2026, 12, 31)]
    assert column(spark, clock.date_key, days, "date") == [20260131, 20260901, 20261231]
    assert column(spark, clock.month_name, days, "date") == ["Enero", "Septiembre", "Diciembre"]


def test_plain_decimals_round_half_up_and_refuse_exponents(spark):
    texts = ["12.345", "-12.345", ".5", "5.", "+7", "1e2", "x", "", "12345678901.00", "NaN", None]
    got = column(spark, lambda x: parse.plain_decimal(x, 12, 2), texts)
    assert got == [Decimal("12.35"), Decimal("-12.35"), Decimal("0.50"), Decimal("5.00"),
                   Decimal("7.00"), None, None, None, None, None, None]


def test_dashed_dates_take_one_form_only(spark):
    texts = ["2026-08-01", "2026-8-1", "2026", "20260801", "2026-02-30", "2026-08-01 x", " 2026-08-01"]
    assert column(spark, parse.dashed_date, texts) == [date(2026, 8, 1)] + [None] * 6


def test_iso_dates_agree_with_the_standard_library(spark):
    texts = ["2026-08-01", "20260801", "2026-W31-6", "2026W316", "2026-W31", "2026W31", "2026-W53-1",
             "2025-W53-1", "2026-W00-1", "2026-W01-1", "2020-W53-7", "2026-08", "2026-13-01",
             "2026-W31-8", "2026-W311", " 2026-08-01", "", "x"]

    def standard(value):
        try:
            return date.fromisoformat(value)
        except ValueError:
            return None

    assert column(spark, parse.iso_date, texts) == [standard(value) for value in texts]


def test_text_cleaning(spark):
    values = ["  a b ", "\ta ", "   ", "", None]
    assert column(spark, text.filled, values) == ["a b", "\ta", None, None, None]
    assert column(spark, text.stripped, ["\t a 　", " ", None]) == ["a", "", ""]
    assert column(spark, text.match_key, [" ÁB "]) == ["áb"]
    assert all(char.isspace() for char in text.WHITESPACE)
    spaces = [chr(code) for code in range(0x110000) if chr(code).isspace()]
    assert set(spaces) == set(text.WHITESPACE)


def test_dates_begin_with_year_one(spark):
    assert column(spark, parse.dashed_date, ["0000-01-01", "0001-01-01"]) == [None, date(1, 1, 1)]
    assert column(spark, parse.iso_date, ["0000-01-01", "00000101", "0000-W05", "00010101"]) == [None, None, None, date(1, 1, 1)]


def test_control_characters_are_no_part_of_a_number(spark):
    whole = lambda x: parse.whole_number(x, "int")
    assert column(spark, whole, ["5", "\t5", "5\n", "-3", "x"]) == [5, None, None, -3, None]
    assert column(spark, lambda x: parse.plain_decimal(x, 12, 2), ["1.5", "\x001.5", "1.5\r"]) == [Decimal("1.50"), None, None]


def test_numbers_of_any_size(spark):
    texts = ["0", "-0.0", "5", " 5 ", "+7.", ".5", "2.50", "1e23", "25e-1", "250e-1", "0e-5", "-3", "1E2",
             "0.0000000000000000001", "1" * 60, "10e-1", "1.5e1", "1.25e1", "-1e-40", "", ".", "x", "e5", "1e"]

    def exact(value):
        try:
            return Decimal(value)
        except ArithmeticError:
            return None

    numbers = [exact(value) for value in texts]
    signs = [None if n is None else (n > 0) - (n < 0) for n in numbers]
    assert column(spark, parse.number_sign, texts) == signs
    whole = [None if n is None else n == n.to_integral_value() for n in numbers]
    assert column(spark, parse.is_whole, texts) == whole
    far = ["1e" + "9" * 30, "1e-" + "9" * 30, "0e-" + "9" * 30]
    assert column(spark, parse.is_whole, far) == [True, False, True]


def test_plain_numbers_are_told_by_a_short_pattern(spark):
    """Whatever the form, the sign and wholeness are those of the number."""
    plain = ["0", "00", "7", "007", "10" * 40, "0.0", "0.10", "1.", "12.50", "3.000"]
    others = [" 7", "7 ", "7\n", "+7", "-0.5", "-0", ".5", ".", "", "1e2", "25e-1", "250e-1", "0e9", "1.5e1", "x", "1 2", "\u0663", "1.2.3", None]
    want = []
    for value in plain + others:
        try:
            number = Fraction(value.strip()) if value and value.isascii() else None
        except ValueError:
            number = None
        want.append((None, None) if number is None else ((number > 0) - (number < 0), number.denominator == 1))
    signs, whole = (column(spark, tell, plain + others) for tell in (parse.number_sign, parse.is_whole))
    assert list(zip(signs, whole)) == want
    for tell, short in ((parse.number_sign, parse.PLAIN), (parse.is_whole, parse.PLAIN_WHOLE)):
        told = tell(F.col("x"))._jc.toString().replace("\\\\", "\\")
        assert short in told and told.index(short) < told.index(parse.NUMBER)
