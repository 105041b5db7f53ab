"""A fact of any size for scan measurements, spread over the rows of a given table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import date_key
from starloom.sources.files import Files

# First day and number of days of the scaled fact.
FIRST_DAY = "1996-01-01"
DAYS = 1461
SCHEMA = "order_date_key int, order_date date, product_key bigint, customer_key int, net_amount decimal(10,2)"


def scaled_fact(lines: DataFrame, copies: int) -> DataFrame:
    """`copies` rows per line with day, keys and amount mixed from the line's keys.

    The mix is arithmetic on the keys rather than a random draw, so a lost task that runs again
    produces the same rows.
    """
    rows = lines.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
    o, p, n, k = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_linenumber", "copy"))
    day = F.date_add(
        F.lit(FIRST_DAY).cast("date"), ((o * 7919 + p * 31 + n * 389 + k * 104729) % DAYS).cast("int"))
    cents = (o * 104729 + p * 7 + n * 53 + k * 7919) % 100000
    return rows.select(
        date_key(day).alias("order_date_key"), day.alias("order_date"),
        (p + 1).alias("product_key"), (o % 91 + 1).cast("int").alias("customer_key"),
        (cents.cast("decimal(10,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)").alias("net_amount"))


def store_scaled(fact: DataFrame, path: str) -> None:
    """Write the fact in a folder per month, its rows sorted by day.

    Ranges go on to product and customer, so that a day with very many rows is cut as well. A range
    spans few months, so there are about as many files as tasks and months together.
    """
    order = ["order_date_key", "product_key", "customer_key"]
    month = F.expr("order_date_key div 100").cast("int")
    fact.withColumn("order_month", month).repartitionByRange(*order).sortWithinPartitions("order_month", *order).write.mode(
        "overwrite").partitionBy("order_month").parquet(path)


def scaled_between(spark: SparkSession, path: str, first: int, after: int) -> DataFrame:
    """The stored fact from day key `first` up to, not including, `after`.

    Only the folders of the months in question are listed and read. Inside them, row groups and pages
    whose days lie outside are skipped, as the range is put on the bare key that the rows are sorted
    by. A stored fact without rows gives none.
    """
    months = {f"order_month={m}" for m in range(first // 100, (after - 1) // 100 + 1)}
    folders = [f"{path}/{name}" for name in Files(spark, path).names(path) if name in months]
    rows = spark.read.schema(SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], SCHEMA)
    key = F.col("order_date_key")
    return rows.filter((key >= first) & (key < after))
