"""Fact builders: key resolution, measures, milestones.

Order-level dimensions are resolved on the order headers, which are several times fewer than the
lines; the resolved header then travels to the lines in the one join on the order number.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import AMOUNT, RATIO, UNKNOWN_KEY, date_key

# Columns whose change makes a stored fact row an update.
LINE_COMPARE = [
    "customer_key", "employee_key", "product_key", "shipper_key", "order_date_key",
    "required_date_key", "shipped_date_key", "quantity", "unit_price", "discount_pct",
]
ORDER_COMPARE = [
    "customer_key", "employee_key", "shipper_key", "order_date", "required_date", "shipped_date",
    "freight_amount", "order_line_count", "ship_name", "ship_city", "ship_country",
]
# Columns that follow from others of the row (`with_measures`, `with_lags`).
LINE_DERIVED = ["gross_amount", "discount_amount", "net_amount"]
ORDER_DERIVED = ["days_to_ship", "days_late", "is_shipped", "is_late"]
SHIP_TO = ["ship_name", "ship_address", "ship_city", "ship_region", "ship_postal_code", "ship_country"]


@dataclass(frozen=True)
class Lookup:
    """Resolve `foreign` against the current rows of a dimension, optionally carrying attributes.

    `carry` maps an output column to (dimension column, value for the unknown member).
    """

    foreign: str
    dimension: str
    natural: str
    surrogate: str
    carry: Mapping[str, tuple[str, str | int | None]] | None = None


CUSTOMER_LOOKUP = Lookup("customer_id", "dim_customer", "customer_id", "customer_key")
EMPLOYEE_LOOKUP = Lookup("employee_id", "dim_employee", "employee_id", "employee_key")
SHIPPER_LOOKUP = Lookup("ship_via", "dim_shipper", "shipper_id", "shipper_key")
PRODUCT_LOOKUP = Lookup("product_id", "dim_product", "product_id", "product_key")


def current(dimension: DataFrame, surrogate: str) -> DataFrame:
    """Rows a lookup may hit: current versions, never the unknown member."""
    rows = dimension.filter(F.col("is_current")) if "is_current" in dimension.columns else dimension
    return rows.filter(F.col(surrogate) != UNKNOWN_KEY)


def resolve(df: DataFrame, dims: Mapping[str, DataFrame], lookup: Lookup) -> DataFrame:
    """Left join on the natural key; no match gives the unknown key and the unknown labels."""
    carry = lookup.carry or {}
    side = current(dims[lookup.dimension], lookup.surrogate).select(
        F.col(lookup.natural).alias("_natural"),
        F.col(lookup.surrogate).alias("_surrogate"),
        *[F.col(source).alias(f"_carry_{out}") for out, (source, _) in carry.items()],
    )
    found = F.col("_surrogate").isNotNull()
    joined = df.join(side, F.col(lookup.foreign) == F.col("_natural"), "left").withColumns(
        {lookup.surrogate: F.coalesce("_surrogate", F.lit(UNKNOWN_KEY))}
        | {
            out: F.when(found, F.col(f"_carry_{out}")).otherwise(F.lit(label))
            for out, (_, label) in carry.items()
        }
    )
    return joined.drop("_natural", "_surrogate", *[f"_carry_{out}" for out in carry])


def with_date_keys(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {f"{role}_date_key": date_key(f"{role}_date") for role in ("order", "required", "shipped")}
    )


def with_measures(lines: DataFrame) -> DataFrame:
    """gross, discount and net from quantity, price and discount; each rounded to four places."""
    gross = F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")
    return lines.withColumns(
        {
            "gross_amount": gross.cast(AMOUNT),
            "discount_amount": (gross * F.col("discount_pct")).cast(AMOUNT),
            "net_amount": (gross * (F.lit(1).cast(RATIO) - F.col("discount_pct"))).cast(AMOUNT),
        }
    )


def with_lags(orders: DataFrame) -> DataFrame:
    """Cycle measures; NULL until the milestone is reached, an unshipped order is not late."""
    shipped = F.col("shipped_date").isNotNull()
    return orders.withColumns(
        {
            "days_to_ship": F.date_diff("shipped_date", "order_date"),
            "days_late": F.date_diff("shipped_date", "required_date"),
            "is_shipped": shipped,
            "is_late": F.when(shipped, F.col("shipped_date") > F.col("required_date")).otherwise(False),
        }
    )


ORDER_LOOKUPS = (CUSTOMER_LOOKUP, EMPLOYEE_LOOKUP, SHIPPER_LOOKUP)


def resolve_orders(
    orders: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup] = ORDER_LOOKUPS
) -> DataFrame:
    for lookup in lookups:
        orders = resolve(orders, dims, lookup)
    return orders


def line_measures(order_details: DataFrame) -> DataFrame:
    """Landed lines with the discount as an exact ratio and the derived amounts."""
    exact = order_details.withColumn("discount_pct", F.col("discount").cast(RATIO)).drop("discount")
    return with_measures(exact)


def fact_order_lines(
    lines: DataFrame, orders: DataFrame, dims: Mapping[str, DataFrame],
    derive: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Transaction fact: lines joined to their order, keys resolved, at grain (order, product).

    `derive` adds the measures that follow from others of a line; no shuffle carries them.
    """
    header = with_date_keys(resolve_orders(orders, dims)).select(
        "order_id", "customer_key", "employee_key", "shipper_key",
        "order_date_key", "required_date_key", "shipped_date_key",
    )
    resolved = resolve(lines.join(header, "order_id"), dims, PRODUCT_LOOKUP)
    return derive(resolved).select(
        "order_id", "product_id", "customer_key", "employee_key", "product_key", "shipper_key",
        "order_date_key", "required_date_key", "shipped_date_key", "quantity", "unit_price",
        "discount_pct", "gross_amount", "discount_amount", "net_amount",
    )


def line_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(F.count(F.lit(1)).cast("int").alias("order_line_count"))


def fact_orders(
    orders: DataFrame, lines: DataFrame | None, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """Accumulating snapshot: one row per order with milestones, freight and line count.

    `lines` may be None when the headers already carry `order_line_count`.
    """
    ship_to = [c for c in SHIP_TO if c in orders.columns]
    days: dict[str, Column] = {
        f"{role}_date": F.col(f"{role}_date").cast("date") for role in ("order", "required", "shipped")
    }
    counted = orders if lines is None else orders.join(line_counts(lines), "order_id", "left")
    built = resolve_orders(with_date_keys(counted.withColumns(days)), dims).withColumns(
        {
            "freight_amount": F.coalesce("freight", F.lit(0)).cast("decimal(19,4)"),
            "order_line_count": F.coalesce("order_line_count", F.lit(0)),
        }
    )
    return with_lags(built).select(
        "order_id", "customer_key", "employee_key", "shipper_key",
        "order_date_key", "required_date_key", "shipped_date_key",
        "order_date", "required_date", "shipped_date", "freight_amount", "order_line_count",
        "days_to_ship", "days_late", "is_shipped", "is_late", *ship_to,
    )
