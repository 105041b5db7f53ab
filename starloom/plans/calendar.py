"""Calendar dimension."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import UNKNOWN_KEY
from starloom.operators.keys import with_unknown

# Default range and the labels of the unknown day.
DEFAULT_FIRST = date(1994, 1, 1)
DEFAULT_LAST = date(2002, 12, 31)
UNKNOWN_DAY = {"day_name": "Unknown", "month_name": "Unknown", "quarter_name": "NA"}


# The calendar columns in order. The fiscal year starts in April and is named for the
# year it ends in.
CALENDAR_COLUMNS = {
    "date_key": "year(full_date) * 10000 + month(full_date) * 100 + day(full_date)",
    "full_date": "full_date",
    "day_of_month": "cast(day(full_date) as smallint)",
    "day_of_week": "cast(extract(dayofweek_iso from full_date) as smallint)",
    "day_name": "date_format(full_date, 'EEEE')",
    "day_of_year": "cast(dayofyear(full_date) as smallint)",
    "week_of_year": "cast(weekofyear(full_date) as smallint)",
    "iso_year": "cast(extract(yearofweek from full_date) as smallint)",
    "month_number": "cast(month(full_date) as smallint)",
    "month_name": "date_format(full_date, 'MMMM')",
    "month_abbrev": "date_format(full_date, 'MMM')",
    "month_end_date": "last_day(full_date)",
    "year_month": "year(full_date) * 100 + month(full_date)",
    "quarter_number": "cast(quarter(full_date) as smallint)",
    "quarter_name": "concat('Q', quarter(full_date))",
    "year_number": "cast(year(full_date) as smallint)",
    "fiscal_year": "cast(if(month(full_date) >= 4, year(full_date) + 1, year(full_date)) as smallint)",
    "fiscal_quarter": "cast(if(month(full_date) >= 4, quarter(full_date) - 1, 4) as smallint)",
    "is_weekend": "extract(dayofweek_iso from full_date) >= 6",
    "is_last_day_of_month": "full_date = last_day(full_date)",
}


def describe_days(days: DataFrame) -> DataFrame:
    """The calendar attributes of a frame with a `full_date` column."""
    return days.selectExpr(*[f"{e} as {name}" for name, e in CALENDAR_COLUMNS.items()])


def with_day_attributes(df: DataFrame, key: str, wanted: Mapping[str, str]) -> DataFrame:
    """Calendar columns of a date key, worked out from the key itself: no day can be missing.

    `wanted` maps new names to calendar columns. The unknown key gets the labels of the unknown day.
    """
    k = F.col(key)
    day = F.make_date((k / 10000).cast("int"), (k / 100 % 100).cast("int"), (k % 100).cast("int"))
    dated = df.withColumn("_day", F.when(k > 0, day))
    new = {
        out: F.when(k == UNKNOWN_KEY, F.lit(UNKNOWN_DAY.get(name))).otherwise(
            F.expr(CALENDAR_COLUMNS[name].replace("full_date", "_day")))
        for out, name in wanted.items()
    }
    return dated.withColumns(new).drop("_day")


def calendar(spark: SparkSession, first: date = DEFAULT_FIRST, last: date = DEFAULT_LAST) -> DataFrame:
    """One row per day from first to last, both included."""
    if last < first:
        raise ValueError(f"calendar: end date {last} precedes start date {first}")
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("full_date")
    )
    return describe_days(days)


def calendar_covering(df: DataFrame, moment: str) -> DataFrame:
    """Calendar of the whole years that the moments of `df` fall into."""
    span = df.agg(F.min(moment).alias("a"), F.max(moment).alias("b"))
    days = span.select(
        F.explode(
            F.sequence(
                F.trunc("a", "year"), F.last_day(F.add_months(F.trunc("b", "year"), 11))
            )
        ).alias("full_date")
    )
    return describe_days(days)


def new_days(existing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Days of `wanted` that the calendar does not have yet."""
    return wanted.join(existing.select("date_key"), "date_key", "left_anti").select(*wanted.columns)


def extend_calendar(existing: DataFrame, first: date, last: date) -> DataFrame:
    """The calendar with the range added; days already present are kept as they are."""
    added = new_days(existing, calendar(existing.sparkSession, first, last))
    return existing.unionByName(added)


def dim_date(days: DataFrame) -> DataFrame:
    return with_unknown(days, "date_key", UNKNOWN_DAY)
