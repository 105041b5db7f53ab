"""Training marts and routines: per-entity totals, ordered lists, path counts, stock rebuild."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import in_month, instant
from starloom.operators.rows import delete_where


def entity_totals(
    entities: DataFrame, attended: DataFrame, key: str, count: str, amount: str,
    count_name: str, amount_name: str,
) -> DataFrame:
    """Per entity the number and the sum of what it attended, 0 where it attended nothing.

    The set-based form of a table function called per id; `for_entity` narrows it to one id.
    """
    totals = attended.groupBy(key).agg(F.sum(count).alias("_n"), F.sum(amount).alias("_amount"))
    return entities.join(totals, key, "left").select(
        key, F.coalesce("_n", F.lit(0)).alias(count_name), F.coalesce("_amount", F.lit(0)).alias(amount_name))


def for_entity(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def ordered_list(df: DataFrame, key: str, value: str, name: str, separator: str = ", ") -> DataFrame:
    """The values of each key as one text, in binary order; NULLs are skipped, repeats are kept.

    Equal values are counted before the lists are built and written out once per repeat, so what a
    list is built from is its distinct values.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    repeated = F.array_join(F.array_repeat(F.col(value), F.col("_n")), separator)
    pieces = F.sort_array(F.collect_list(F.struct(F.col(value).alias("v"), repeated.alias("text"))))
    return counted.groupBy(key).agg(pieces.alias("_pieces")).select(
        key, F.array_join(F.col("_pieces.text"), separator).alias(name))


def delegate_days(runs: DataFrame, attendance: DataFrame, delegates: DataFrame) -> DataFrame:
    """Courses and days per delegate."""
    attended = attendance.join(runs.select("course_run_id", "duration_days"), "course_run_id").withColumn("one", F.lit(1))
    return entity_totals(
        delegates.select("delegate_id"), attended, "delegate_id", "one", "duration_days",
        "number_courses", "number_days")


def delegate_courses(runs: DataFrame, attendance: DataFrame, courses: DataFrame) -> DataFrame:
    """Course names per delegate as one ordered text."""
    named = attendance.join(runs.select("course_run_id", "course_id"), "course_run_id").join(
        courses.select("course_id", "course_name"), "course_id")
    return ordered_list(named, "delegate_id", "course_name", "courses")


def vendor_course_counts(
    vendors: DataFrame, courses: DataFrame, runs: DataFrame, attendance: DataFrame, by_date: bool = False
) -> DataFrame:
    """Delegates per vendor and course, optionally per start date; attendance is counted per run first."""
    per_run = attendance.groupBy("course_run_id").agg(F.count(F.lit(1)).alias("n"))
    label = ["vendor_name", "course_name", *(["start_date"] if by_date else [])]
    joined = per_run.join(runs, "course_run_id").join(courses, "course_id").join(
        vendors.select("vendor_id", "vendor_name"), "vendor_id")
    return joined.groupBy(*label).agg(F.sum("n").alias("number_delegates"))


def path_counts(orders: DataFrame, customers: DataFrame, by_day: bool = False) -> DataFrame:
    """Orders per region and country, optionally per day, along region - country - customer - order."""
    day = [F.col("order_date").cast("date").alias("order_day")] if by_day else []
    per_customer = orders.groupBy("customer_id", *day).agg(F.count(F.lit(1)).alias("n"))
    places = customers.select("customer_id", F.col("city").alias("region"), "country")
    return per_customer.join(places, "customer_id").groupBy(
        "region", "country", *(["order_day"] if by_day else [])).agg(F.sum("n").alias("orders"))


def rebuild_stock(transfers: DataFrame) -> DataFrame:
    """Balance per product: the sum of its signed transfers."""
    return transfers.groupBy("product_id").agg(F.sum("transfer_amount").alias("stock_amount"))


def reset_stock(transfers: DataFrame, purge_from: str = "2015-01-01 00:00:00") -> tuple[DataFrame, DataFrame]:
    """(new balance from all transfers, transfers left after purging the late ones)."""
    return rebuild_stock(transfers), delete_where(transfers, F.col("transfer_date") >= instant(purge_from))


def stock_after_reset(transfers: DataFrame, purge_from: str) -> DataFrame:
    """Both results of the reset in one pass: balance and number of transfers kept, per product."""
    return transfers.groupBy("product_id").agg(
        F.sum("transfer_amount").alias("stock_amount"),
        F.count_if(~F.coalesce(F.col("transfer_date") >= instant(purge_from), F.lit(False))).alias("kept_movements"))


def month_sum(scaled: DataFrame, year: int, month: int) -> DataFrame:
    return scaled.filter(in_month("order_date_key", year, month)).agg(
        F.sum("net_amount").cast("decimal(38,2)").alias("net_amount"))
