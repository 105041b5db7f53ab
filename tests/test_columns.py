from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import functions as fn
from starloom.plans.calendar import calendar, dim_date, extend_calendar


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def text(v):
    return F.lit(v).cast("string")


def test_hash_keeps_the_position_of_null(spark):
    a = one(spark, fn.scd_hash(text("Smith"), text(None), text("London")))
    b = one(spark, fn.scd_hash(text("Smith"), text("London"), text(None)))
    assert a != b and a == one(spark, F.md5(F.lit("Smith|~NULL~|London")))


@pytest.mark.parametrize("given, want", [
    ("7/4/1996", "1996-07-04"), ("12/31/1999 10:20:30", "1999-12-31 10:20:30"),
    ("1996-07-04 00:00:00", "1996-07-04 00:00:00"), ("abc", "abc"), ("", ""), (" 1/2/2003 ", "2003-01-02"),
    ("1/2", "1/2"), ("a/b/c", "a/b/c"),
])
def test_us_dates(spark, given, want):
    assert one(spark, fn.normalise_us_date(text(given))) == want


@pytest.mark.parametrize("given, quoted, want", [
    (" null ", False, None), ("NULL", True, "NULL"), ("0xFF", False, None), ("0xFF", True, "0xFF"), (" a ", False, "a"),
])
def test_clean_literal(spark, given, quoted, want):
    assert one(spark, fn.clean_literal(text(given), quoted)) == want


@pytest.mark.parametrize("value, pattern, want", [
    ("Brazil", "[b,s,r]%", True), (",x", "[b,s,r]%", True), ("Peru", "[b,s,r]%", False),
    ("Peru", "[^b,s,r]%", True), ("Spain", "[^b,s,r]%", False), ("Germany", "g__M%", True),
    ("Hungary", "[g-s]%", True), ("UK", "[g-s]%", False), ("a.b", "a.b", True), ("axb", "a.b", False),
])
def test_like_class(spark, value, pattern, want):
    assert one(spark, fn.like_class(text(value), pattern)) is want


def test_date_key_and_month(spark):
    assert one(spark, fn.date_key(F.lit(date(1996, 7, 4)))) == 19960704
    assert one(spark, fn.date_key(F.lit(None).cast("date"))) == -1
    assert fn.month_keys(1997, 12) == (19971201, 19980101)


def test_rates_round_half_up_and_guard_zero(spark):
    d = lambda v: F.lit(v).cast("decimal(21,4)")
    assert one(spark, fn.percent(d("5.165"), d("100"))) == Decimal("5.17")
    assert one(spark, fn.percent(d("5"), d("0"))) is None
    assert one(spark, fn.mean_money(d("10.05"), F.lit(2))) == Decimal("5.03")
    assert one(spark, fn.mean_money(d("-0.25"), F.lit(1), 1)) == Decimal("-0.3")
    assert one(spark, fn.mean_money(d("1"), F.lit(0))) is None


def test_calendar_facts(spark):
    days = calendar(spark)
    assert days.count() == 3287 and len(days.columns) == 20
    row = days.filter("full_date = date'1996-12-30'").first()
    assert (row.iso_year, row.week_of_year, row.fiscal_year, row.fiscal_quarter) == (1997, 1, 1997, 3)
    assert (row.day_name, row.month_abbrev, row.quarter_name, row.is_weekend) == ("Monday", "Dec", "Q4", False)
    with pytest.raises(ValueError):
        calendar(spark, date(2000, 1, 2), date(2000, 1, 1))


def test_calendar_extension_keeps_what_is_there(spark):
    first = calendar(spark, date(2000, 1, 1), date(2000, 1, 10))
    both = extend_calendar(dim_date(first), date(2000, 1, 5), date(2000, 1, 12))
    assert both.count() == 13 and both.select("date_key").distinct().count() == 13
    assert both.filter("date_key = -1").first().month_name == "Unknown"
