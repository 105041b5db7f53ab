"""The star over a directory of order-processing tables, declared but not stored.

Natural ids of these tables are integers from 0, so the surrogate key of a first load in natural
order is the id plus one. Stored warehouses get their keys from `operators.keys` instead.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans import dimensions, facts, marts
from starloom.plans.calendar import calendar, dim_date
from starloom.sources.roles import OrderSystem, with_implied


class _OnDemand(dict):
    """Tables declared when first asked for, so a query plans only what it reads."""

    def __init__(self, **makers: Callable[[], DataFrame]):
        super().__init__()
        self._makers = makers

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._makers[name]()
        return self[name]


class DeclaredStar:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.src = OrderSystem(spark, folder)

    def raw(self, name: str) -> DataFrame:
        return self.src.raw(name)

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar(self.spark)

    @cached_property
    def keys(self) -> dict[str, DataFrame]:
        """Natural and surrogate keys only: enough for key resolution, nothing joined in."""
        raw = self.src.raw

        def pair(table: str, column: str, name: str) -> DataFrame:
            return raw(table).select(
                F.col(column).alias(f"{name}_id"), (F.col(column) + 1).alias(f"{name}_key"))

        return _OnDemand(
            dim_customer=lambda: pair("customer", "c_custkey", "customer"),
            dim_product=lambda: pair("part", "p_partkey", "product"),
            dim_employee=lambda: pair("supplier", "s_suppkey", "employee"),
            dim_shipper=lambda: self.src.shippers.select("shipper_id", F.col("shipper_id").alias("shipper_key")),
        )

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        """Dimensions with their attributes, current versions only."""
        src = self.src
        return _OnDemand(
            dim_date=lambda: dim_date(self.calendar),
            dim_customer=lambda: src.customers.withColumn("customer_key", F.col("customer_id") + 1),
            dim_product=lambda: src.products.withColumns(
                {"product_key": F.col("product_id") + 1, "supplier_country": F.lit(None).cast("string")}),
            dim_employee=lambda: dimensions.employee_source(src.employees, fingerprint=False).withColumn(
                "employee_key", F.col("employee_id") + 1),
            dim_shipper=lambda: src.shippers.withColumn("shipper_key", F.col("shipper_id")),
        )

    def sales_lines(self, columns: list[str]) -> DataFrame:
        """Sales columns over line rows as delivered, for marts that only sum and count orders.

        Sums and distinct orders are the same with or without collapsing the rows to the declared
        grain, so the collapse and its shuffle are left out.
        """
        lines = self.src.line_items.withColumn(
            "net_amount", F.col("gross_amount") - F.col("discount_amount"))
        return marts.sales_from_staging(lines, self._orders(columns), self.dims, columns)

    def sales(self, columns: list[str] = marts.SALES_COLUMNS) -> DataFrame:
        """Sales at the declared grain."""
        return marts.sales_from_staging(self.src.line_sums, self._orders(columns), self.dims, columns, with_implied)

    def _orders(self, columns: list[str]) -> DataFrame:
        return self.src.orders_shipped if "shipped_date" in columns else self.src.orders

    @cached_property
    def fact_lines(self) -> DataFrame:
        return facts.fact_order_lines(self.src.line_sums, self.src.orders_shipped, self.keys, with_implied)

    @cached_property
    def order_line_keys(self) -> DataFrame:
        """Distinct (order, product) pairs: the grain of the line fact."""
        return self.src.line_items.select("order_id", "product_id").distinct()

    @cached_property
    def order_facts(self) -> DataFrame:
        """Per order from the lines in one pass: ship date and lines at the declared grain."""
        return self.src.raw("lineitem").groupBy(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")
        ).agg(F.max("l_shipdate").alias("shipped")).groupBy("order_id").agg(
            F.max("shipped").alias("shipped_date"), F.count(F.lit(1)).cast("int").alias("order_line_count")
        )

    @cached_property
    def fact_orders(self) -> DataFrame:
        orders = self.src.orders.join(self.order_facts, "order_id", "left")
        return facts.fact_orders(orders, None, self.keys)
