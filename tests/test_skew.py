"""One order, one product and one customer hold a third of the rows; no join may be broadcast."""

import pytest
from compare import TABLES, connect, mismatch
from pyspark.sql import functions as F

from starloom.plans import facts
from starloom.plans.star import DeclaredStar
from starloom.queries import REGISTRY
from starloom.session import prepare

FOLDER = "/root/testdata/sf0.001"
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.shuffle.partitions": "8",
}
NAMES = [
    "sales_by_category_year", "customer_sales_summary", "fact_sales_order_line", "join_left", "join_full",
    "asof_dim_lookup", "customer_history", "scd2_overlaps", "scd2_gaps", "set_except", "referential_subset",
    "entity_days", "string_agg_ordered", "stock_rebuild", "late_key_resolution",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skew"))
    con = connect(FOLDER)
    changed = {
        "orders": "* replace (case when o_orderkey % 3 = 0 then 3 else o_custkey end as o_custkey)",
        "lineitem": "* replace (case when l_linenumber <= 2 then 7 else l_orderkey end as l_orderkey, "
                    "case when l_linenumber between 2 and 4 then 5 else l_partkey end as l_partkey)",
    }
    for t in TABLES:
        con.execute(f"copy (select {changed.get(t, '*')} from {t}) to '{folder}/{t}.parquet' (format parquet)")
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield folder, connect(folder)
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_change_no_result(spark, skewed, name):
    folder, con = skewed
    problem = mismatch(spark, con, folder, REGISTRY[name])
    assert problem is None, problem


def test_a_hot_customer_is_split(spark, skewed, capsys):
    """Key resolution of orders with one hot customer runs as a split join, also below an aggregate."""
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    hot = F.when(F.col("id") % 3 == 0, 3).otherwise(F.col("id") % 997)
    orders = spark.range(0, 60000, 1, 8).select(hot.alias("customer_id"), F.rand(1).alias("freight"))
    customers = spark.range(997).select(F.col("id").alias("customer_id"), (F.col("id") + 1).alias("customer_key"))
    resolved = facts.resolve(orders, {"dim_customer": customers}, facts.CUSTOMER_LOOKUP)
    summed = resolved.groupBy("customer_id").agg(F.count("customer_key").alias("n"), F.sum("freight").alias("f"))
    assert sum(r.n for r in summed.collect()) == 60000
    summed.explain()
    assert "skew=true" in capsys.readouterr().out


def test_price_and_discount_are_worked_out_above_the_joins(spark):
    """They follow from the sums of a line, so no shuffle carries them."""
    s = DeclaredStar(spark, "/root/testdata/sf0.001")
    for frame in (s.sales(), s.fact_lines):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("AS discount_pct") < plan.index("Join ") and plan.count("AS discount_pct") == 1


def test_shuffled_rows_are_dealt_out_in_small_portions(spark):
    """Unless the session says otherwise."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    try:
        spark.conf.set(name, "1k")
        prepare(spark)
        assert spark.conf.get(name) == "1k"
        spark.conf.unset(name)
        prepare(spark)
        assert spark.conf.get(name) == "16m"
    finally:
        if before is not None:
            spark.conf.set(name, before)
