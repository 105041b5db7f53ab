"""The scaled fact as stored: which folders and how many bytes a day range reads."""

import pytest
from pyspark.sql import functions as F

from starloom.session import work_path
from starloom.sources.scaled import scaled_between, scaled_fact, store_scaled

FOLDER = "/root/testdata/sf0.01"
JANUARY = 19970101, 19970201


@pytest.fixture(scope="module")
def fact(spark):
    return scaled_fact(spark.read.parquet(f"{FOLDER}/lineitem.parquet"), 8)


@pytest.fixture(scope="module")
def path(spark, fact):
    path = work_path(spark)
    store_scaled(fact, path)
    return path


def bytes_read(spark, frame):
    """Bytes that the local file system handed out while `frame` was computed."""
    counters = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    before = counters.getLong("bytesRead")
    frame.collect()
    return counters.getLong("bytesRead") - before


def test_nothing_is_lost(spark, fact, path):
    whole = scaled_between(spark, path, 19960101, 20010101)
    assert whole.columns == fact.columns
    assert whole.exceptAll(fact).count() == 0 and whole.count() == fact.count()


@pytest.mark.parametrize("first, after", [JANUARY, (19961231, 19970102), (19970131, 19970201), (19970101, 19970101), (20300101, 20310101)])
def test_half_open_range(spark, fact, path, first, after):
    key = F.col("order_date_key")
    wanted = fact.filter((key >= first) & (key < after))
    assert sorted(scaled_between(spark, path, first, after).collect()) == sorted(wanted.collect())


def test_a_month_reads_little(spark, path):
    total = F.sum("net_amount")
    all_months = bytes_read(spark, scaled_between(spark, path, 19960101, 20010101).agg(total))
    one = bytes_read(spark, scaled_between(spark, path, *JANUARY).agg(total))
    assert 0 < one < 0.05 * all_months


def test_a_month_plans_its_folder_only(spark, path):
    files = scaled_between(spark, path, *JANUARY).select(F.input_file_name()).distinct().collect()
    assert files and all("order_month=199701/" in f[0] for f in files)


def test_a_day_with_a_third_of_all_rows_is_cut(spark, fact):
    hot = fact.withColumn("order_date_key", F.when(F.col("customer_key") <= 40, 19970115).otherwise(F.col("order_date_key")))
    path = work_path(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store_scaled(hot, path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    day = spark.read.parquet(path).filter("order_date_key = 19970115")
    per_file = [r["count"] for r in day.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == hot.filter("order_date_key = 19970115").count()
    assert max(per_file) < 0.5 * sum(per_file)


def test_no_rows(spark, fact):
    path = work_path(spark)
    store_scaled(fact.limit(0), path)
    got = scaled_between(spark, path, *JANUARY)
    assert got.columns == fact.columns and got.count() == 0
