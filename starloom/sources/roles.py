"""A directory of order-processing parquet tables, presented in the staging roles.

The loaders and marts are written against roles (customers, products, orders, order lines, ...).
This module maps the generated benchmark tables onto them; money arrives as double and is cast to
decimal per value, before anything is summed.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import AMOUNT, money, safe_ratio_4
from starloom.session import materialise


class OrderSystem:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    @cached_property
    def countries(self) -> DataFrame:
        return self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        ).select(F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("country"),
                 F.col("r_name").alias("city"))

    @cached_property
    def customers(self) -> DataFrame:
        """Customer role: `city` carries the world region, `contact_title` the market segment."""
        base = self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("contact_title"),
            money("c_acctbal").alias("balance"),
            F.col("c_nationkey").alias("nation_id"),
            F.concat(
                (F.col("c_nationkey") + 10).cast("string"), F.lit("-"),
                F.lpad(F.col("c_custkey").cast("string"), 7, "0"),
            ).alias("phone"),
        ).withColumn("fax", F.when(F.col("balance") >= 0, F.col("phone")))
        return base.join(self.countries, "nation_id", "left").drop("nation_id")

    @cached_property
    def products(self) -> DataFrame:
        """Product role. Stock figures come from the part size; the brand number is the supplier."""
        size = F.col("p_size")
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category_name"),
            F.col("p_brand").alias("supplier_name"),
            F.substring_index("p_brand", "#", -1).cast("bigint").alias("supplier_id"),
            money("p_retailprice").alias("unit_price"),
            size.alias("units_in_stock"),
            (50 - size).alias("units_on_order"),
            F.lit(10).alias("reorder_level"),
            (size > 45).alias("discontinued"),
        )

    @cached_property
    def categories(self) -> DataFrame:
        """Distinct part types. Written out, like the shippers, so that its real size is known."""
        kinds = self.products.groupBy("category_name").agg(F.count(F.lit(1)).alias("product_count"))
        return materialise(kinds.select(
            F.col("category_name").alias("category_id"), F.initcap("category_name").alias("category_name"),
            F.concat(F.col("product_count").cast("string"), F.lit(" products")).alias("description"),
        ))

    @cached_property
    def suppliers(self) -> DataFrame:
        return self.raw("supplier").join(
            self.countries, F.col("s_nationkey") == F.col("nation_id"), "left"
        ).select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("company_name"),
                 F.col("s_name").alias("contact_name"), "city", "country",
                 F.concat(F.lit("+"), F.col("s_suppkey").cast("string")).alias("phone"))

    @cached_property
    def employees(self) -> DataFrame:
        """Sales staff: the supplier rows, arranged in a ten-wide reporting tree rooted at 0."""
        person = self.raw("supplier").select(
            F.col("s_suppkey").alias("employee_id"),
            F.substring_index("s_name", "#", 1).alias("first_name"),
            F.substring_index("s_name", "#", -1).alias("last_name"),
            F.col("s_nationkey").alias("nation_id"),
            F.when(F.col("s_suppkey") != 0, F.expr("s_suppkey div 10")).alias("reports_to"),
            F.concat(F.lit("x"), F.col("s_suppkey").cast("string")).alias("extension"),
        )
        return person.join(self.countries, "nation_id", "left").drop("nation_id").withColumn(
            "title", F.when(F.col("reports_to").isNull(), "Head").otherwise("Representative")
        )

    @cached_property
    def shippers(self) -> DataFrame:
        """Distinct order priorities, written out: the planner then sees how few they are.

        Estimated from the orders they come from, they would look large, and the orders would be
        shuffled on a handful of values to meet them.
        """
        kinds = self.raw("orders").select("o_orderpriority").distinct()
        return materialise(kinds.select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("shipper_id"),
            F.expr("substring(o_orderpriority, 3)").alias("company_name"),
        ))

    @cached_property
    def orders(self) -> DataFrame:
        """Order headers without the ship date, which only the lines know."""
        staff = self.raw("supplier").agg(F.count(F.lit(1))).scalar()
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("o_orderkey") % staff).alias("employee_id"),
            F.col("o_orderdate").alias("order_date"),
            (F.col("o_orderdate") + F.expr("interval 60 days")).alias("required_date"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("ship_via"),
            money("o_totalprice").alias("freight"),
            F.col("o_orderstatus").alias("order_status"),
        )

    @cached_property
    def shipments(self) -> DataFrame:
        """Per order: last ship date and number of (order, product) lines."""
        return self.raw("lineitem").groupBy("l_orderkey").agg(
            F.max("l_shipdate").alias("shipped_date"),
        ).withColumnRenamed("l_orderkey", "order_id")

    @cached_property
    def orders_shipped(self) -> DataFrame:
        return self.orders.join(self.shipments, "order_id", "left")

    @cached_property
    def line_items(self) -> DataFrame:
        """Line rows as delivered: several may share (order, product). Measures are additive."""
        return _line_items(self.raw("lineitem"))

    @cached_property
    def line_sums(self) -> DataFrame:
        """Lines at the declared grain (order, product): the three sums that all other measures follow from."""
        return _line_sums(self.line_items)

    @cached_property
    def order_details(self) -> DataFrame:
        """Lines at the declared grain (order, product); price and discount are what the sums imply.

        The delivered numbers are dealt out by the grain before they are summed: few rows share it, and
        the sums of a part of the lines are twice as wide in a shuffle.
        """
        given = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
        return with_implied(_line_sums(_line_items(given.repartition("l_orderkey", "l_partkey"))))


def _line_items(lineitem: DataFrame) -> DataFrame:
    gross = money("l_extendedprice")
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        gross.alias("gross_amount"),
        (gross * F.col("l_discount").cast("decimal(5,4)")).cast(AMOUNT).alias("discount_amount"),
    )


def _line_sums(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id", "product_id").agg(
        F.sum("quantity").alias("quantity"),
        F.sum("gross_amount").cast(AMOUNT).alias("gross_amount"),
        F.sum("discount_amount").cast(AMOUNT).alias("discount_amount"),
    )


def with_implied(sums: DataFrame) -> DataFrame:
    """Net amount, price and discount from summed lines; after the joins, so that no shuffle carries them."""
    return sums.withColumns(
        {
            "net_amount": (F.col("gross_amount") - F.col("discount_amount")).cast(AMOUNT),
            "unit_price": safe_ratio_4(F.col("gross_amount"), F.col("quantity")).cast("decimal(19,4)"),
            "discount_pct": safe_ratio_4(F.col("discount_amount"), F.col("gross_amount")).cast("decimal(5,4)"),
        }
    )
