"""Cleaners, value by value: the source's unit tables plus the edge cases it missed."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewater.functions import clean


def one(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


NULLS = [None, "", "N/A", "NULL", "null", "none", "  n/a  "]


def test_dates_both_layouts_and_nulls(spark):
    got = one(spark, clean.parse_date, ["29/07/2026", "2026-07-29", " 29/07/2026 ", "1/7/2026", "2026-7-9"] + NULLS)
    assert got[:5] == [dt.date(2026, 7, 29)] * 3 + [dt.date(2026, 7, 1), dt.date(2026, 7, 9)]
    assert got[5:] == [None] * len(NULLS)


@pytest.mark.parametrize("bad", ["29-07-2026-invalido", "31/02/2026", "29/07/26", "ontem"])
def test_dates_bad_values_flagged_not_raised(spark, bad):
    assert one(spark, clean.parse_date, [bad]) == [None]
    assert one(spark, clean.parse_date_bad, [bad]) == [True]


def test_brazilian_numbers(spark):
    got = one(spark, clean.parse_number, ["1.250,50", "42,00", "-1.250", "1250,5", "7"] + NULLS)
    assert got[:5] == [Decimal("1250.50"), Decimal("42.00"), Decimal("-1250.00"), Decimal("1250.50"), Decimal("7.00")]
    assert got[5:] == [None] * len(NULLS)


def test_money_is_not_rounded(spark):
    texts = ["4000,014", "0,999", "1.250,5000", "4000,01", "-3,005"]
    assert one(spark, clean.parse_number, texts) == [None, None, Decimal("1250.50"), Decimal("4000.01"), None]
    assert one(spark, clean.parse_number_bad, texts) == [True, True, False, False, True]
    assert one(spark, clean.parse_measure, ["0,999"]) == [0.999]


@pytest.mark.parametrize("bad", ["abc", "1250.5", "1_000", "nan", "inf", "1d", "1.25,0"])
def test_numbers_guard_rejects(spark, bad):
    assert one(spark, clean.parse_number_bad, [bad]) == [True]


def test_integer_truncates_toward_zero(spark):
    assert one(spark, clean.parse_integer, ["1,9", "-1,9", "1.250,00"]) == [1, -1, 1250]


def test_text(spark):
    got = one(spark, clean.clean_text, ["APROVADO", "aprovado", "Aprovado", " aprovado ", "aprovado ",
                                        " aprovado "] + NULLS)
    assert got[:6] == ["aprovado"] * 6
    assert got[6:] == [None] * len(NULLS)


def test_nullable_fk_keeps_value_untouched(spark):
    assert one(spark, clean.null_if_variant, ["CLI-0001", " CLI-0002 "] + NULLS) == \
        ["CLI-0001", " CLI-0002 "] + [None] * len(NULLS)


def test_boolean(spark):
    got = one(spark, clean.parse_boolean, ["true", "True", "TRUE", "false", "yes", "1"] + NULLS)
    assert got == [True, True, True, False, False, False] + [None] * len(NULLS)


def test_timestamp(spark):
    got = one(spark, clean.parse_timestamp, ["2026-07-29T10:11:12", "N/A", "garbage"])
    assert got[0] == dt.datetime(2026, 7, 29, 10, 11, 12) and got[1] is None and got[2] is None
    assert one(spark, clean.parse_timestamp_bad, ["garbage", "N/A"]) == [True, False]


def test_accents(spark):
    assert one(spark, clean.strip_accents, ["Fabricação", "teste", "ÀÉÎÕÜ çñ"]) == ["Fabricacao", "teste", "AEIOU cn"]


def test_locale_format_round_trips(spark):
    df = spark.createDataFrame([(1250.5,), (42.0,), (-1234567.891,)], "x double")
    f = clean.format_number_locale("x")
    out = df.select(f.alias("s"), clean.parse_number(f).alias("back")).collect()
    assert [r.s for r in out] == ["1.250,50", "42,00", "-1.234.567,89"]
    assert [r.back for r in out] == [Decimal("1250.50"), Decimal("42.00"), Decimal("-1234567.89")]
    df0 = spark.createDataFrame([(1250.0,)], "x double")
    assert df0.select(clean.format_number_locale("x", 0)).first()[0] == "1.250"


def test_hours_to_days_is_a_ceiling(spark):
    df = spark.createDataFrame([(8,), (24,), (25,), (30,)], "h int")
    assert [r[0] for r in df.select(clean.hours_to_days("h")).collect()] == [1, 1, 2, 2]


@pytest.mark.parametrize("bad", ["01/02/99/2026", "1/2/3/2026", "/1/2026", "2026-07-01 x", "2026"])
def test_only_whole_date_shapes_parse(spark, bad):
    assert one(spark, clean.parse_date, [bad]) == [None]


def test_measures_keep_all_decimals_and_integers_are_cut(spark):
    assert one(spark, clean.parse_measure, ["8,004", "1,996", "-0,004", "1.234,5678"]) == [8.004, 1.996, -0.004, 1234.5678]
    assert one(spark, clean.parse_integer, ["1,999", "0,996", "-1,999", "9.007.199.254.740.993,5"]) == [1, 0, -1, 9007199254740993]


def test_a_time_of_day_is_not_a_timestamp(spark):
    assert one(spark, clean.parse_timestamp, ["10:30", "T10:30", "2026"]) == [None] * 3
    assert one(spark, clean.parse_timestamp, ["2026-07-01T10:30:05", "2026-07-01"]) == [dt.datetime(2026, 7, 1, 10, 30, 5), dt.datetime(2026, 7, 1)]


def test_separators_and_next_line_are_trimmed(spark):
    assert one(spark, clean.clean_text, ["\x1cA\x1f", "\x85b\x85"]) == ["a", "b"]
