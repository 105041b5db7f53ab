"""Presentation marts.

A mart is a function from tables to a DataFrame. `sales` takes the list of business columns that
are wanted and joins only the dimensions those columns need: every key resolves (the contracts
check it), so leaving a dimension out neither drops nor repeats a fact row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import AMOUNT, OPEN_END, UNKNOWN_KEY, instant, mean_money, percent
from starloom.operators.windows import by_month, version_numbers
from starloom.plans import dimensions, facts
from starloom.plans.calendar import with_day_attributes
from starloom.plans.facts import Lookup

# Business columns of `sales` by the dimension they come from.
CUSTOMER_COLUMNS = {
    "customer_id": ("customer_id", UNKNOWN_KEY), "customer": ("company_name", "Unknown"),
    "customer_city": ("city", None), "customer_country": ("country", "Unknown"),
}
EMPLOYEE_COLUMNS = {
    "employee": ("full_name", "Unknown"), "employee_title": ("title", None),
    "employee_manager": ("manager_name", None), "employee_country": ("country", None),
}
PRODUCT_COLUMNS = {
    "product_id": ("product_id", UNKNOWN_KEY), "product": ("product_name", "Unknown"),
    "category": ("category_name", "Unknown"), "supplier": ("supplier_name", "Unknown"),
    "supplier_country": ("supplier_country", None),
}
SHIPPER_COLUMNS = {"shipper": ("company_name", "Unknown")}
ORDER_DATE_COLUMNS = {
    "order_date": "full_date", "order_year": "year_number", "order_quarter": "quarter_name",
    "order_month": "month_name", "order_year_month": "year_month", "order_fiscal_year": "fiscal_year",
}
SHIPPED_DATE_COLUMNS = {"shipped_date": "full_date"}
MEASURE_COLUMNS = {
    "quantity": "quantity", "unit_price": "unit_price", "discount_pct": "discount_pct",
    "gross_revenue": "gross_amount", "discount_given": "discount_amount", "net_revenue": "net_amount",
}
SALES_COLUMNS = [
    "order_id", *ORDER_DATE_COLUMNS, *SHIPPED_DATE_COLUMNS, *CUSTOMER_COLUMNS, *EMPLOYEE_COLUMNS,
    *PRODUCT_COLUMNS, *SHIPPER_COLUMNS, *MEASURE_COLUMNS,
]
MARTS = [
    "dim_order_date", "dim_shipped_date", "sales", "sales_by_category_year",
    "customer_sales_summary", "employee_performance", "order_fulfilment_performance",
    "customer_history", "contact_directory", "new_contact_directory", "managers",
    "current_product_list", "order_subtotals", "products_above_average_price",
]


# --- role-playing calendar ----------------------------------------------------------------------

def dim_order_date(calendar: DataFrame) -> DataFrame:
    return calendar.select(
        F.col("date_key").alias("order_date_key"), F.col("full_date").alias("order_date"),
        F.col("year_number").alias("order_year"), F.col("quarter_name").alias("order_quarter"),
        F.col("month_number").alias("order_month_number"), F.col("month_name").alias("order_month"),
        F.col("year_month").alias("order_year_month"), F.col("fiscal_year").alias("order_fiscal_year"),
        F.col("is_weekend").alias("order_is_weekend"),
    )


def dim_shipped_date(calendar: DataFrame) -> DataFrame:
    return calendar.select(
        F.col("date_key").alias("shipped_date_key"), F.col("full_date").alias("shipped_date"),
        F.col("year_number").alias("shipped_year"), F.col("quarter_name").alias("shipped_quarter"),
        F.col("month_name").alias("shipped_month"),
    )


def dim_required_date(calendar: DataFrame) -> DataFrame:
    """The third role of the calendar; not one of the declared marts."""
    return calendar.select(
        F.col("date_key").alias("required_date_key"), F.col("full_date").alias("required_date"),
        F.col("year_number").alias("required_year"), F.col("quarter_name").alias("required_quarter"),
        F.col("month_name").alias("required_month"),
    )


def _date_role(df: DataFrame, calendar: DataFrame, key: str, wanted: Mapping[str, str]) -> DataFrame:
    day = calendar.select(F.col("date_key").alias("_day"), *[F.col(c).alias(out) for out, c in wanted.items()])
    return df.drop(*wanted).join(day, F.col(key) == F.col("_day"), "left").drop("_day")


def _wanted(spec: Mapping, columns: Sequence[str]) -> dict:
    return {out: source for out, source in spec.items() if out in columns}


# --- sales star ---------------------------------------------------------------------------------

_STAR = [
    ("customer_key", "dim_customer", CUSTOMER_COLUMNS),
    ("employee_key", "dim_employee", EMPLOYEE_COLUMNS),
    ("product_key", "dim_product", PRODUCT_COLUMNS),
    ("shipper_key", "dim_shipper", SHIPPER_COLUMNS),
]


def sales(fact: DataFrame, dims: Mapping[str, DataFrame], columns: Sequence[str] = SALES_COLUMNS) -> DataFrame:
    """Resolved star over a stored line fact: business columns only, one row per line."""
    df = fact.withColumnsRenamed({"product_id": "_line_product_id"})
    for key, dimension, spec in _STAR:
        wanted = _wanted(spec, columns)
        if wanted:
            side = dims[dimension].select(
                F.col(key).alias("_key"), *[F.col(source).alias(out) for out, (source, _) in wanted.items()]
            )
            df = df.join(side, F.col(key) == F.col("_key")).drop("_key")
    df = _with_dates(df, dims["dim_date"], columns)
    return df.select(*_projection(columns))


def sales_from_staging(
    lines: DataFrame, orders: DataFrame, dims: Mapping[str, DataFrame],
    columns: Sequence[str] = SALES_COLUMNS, derive: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """The same star straight from staged lines: each dimension is met once, on its natural key.

    `derive` adds the measures that follow from others of a line; no shuffle carries them.
    """
    order_lookups = [
        Lookup(base.foreign, base.dimension, base.natural, base.surrogate, _wanted(spec, columns))
        for base, spec in (
            (facts.CUSTOMER_LOOKUP, CUSTOMER_COLUMNS),
            (facts.EMPLOYEE_LOOKUP, EMPLOYEE_COLUMNS),
            (facts.SHIPPER_LOOKUP, SHIPPER_COLUMNS),
        )
        if _wanted(spec, columns)
    ]
    header = facts.resolve_orders(orders, dims, order_lookups)
    roles = [r for r in ("order", "shipped") if f"{r}_date" in header.columns]
    header = header.withColumns({f"{r}_date_key": facts.date_key(f"{r}_date") for r in roles})
    carried = [out for lookup in order_lookups for out in lookup.carry]
    header = header.select("order_id", *[f"{r}_date_key" for r in roles], *carried)
    # Products first: the order join comes last and leaves the lines partitioned by order, which is
    # the partitioning the per-order sums of the marts need.
    df = lines
    wanted = _wanted(PRODUCT_COLUMNS, columns)
    if wanted:
        base = facts.PRODUCT_LOOKUP
        df = df.withColumnRenamed("product_id", "_line_product_id")
        df = facts.resolve(
            df, dims, Lookup("_line_product_id", base.dimension, base.natural, base.surrogate, wanted)
        )
    df = _with_dates(df.join(header, "order_id"), None, columns)
    return derive(df).select(*_projection(columns))


def _with_dates(df: DataFrame, calendar: DataFrame | None, columns: Sequence[str]) -> DataFrame:
    """Attributes of both dates, from a stored calendar or, without one, worked out from the keys."""
    for key, spec in (("order_date_key", ORDER_DATE_COLUMNS), ("shipped_date_key", SHIPPED_DATE_COLUMNS)):
        wanted = _wanted(spec, columns)
        if wanted:
            df = with_day_attributes(df.drop(*wanted), key, wanted) if calendar is None else _date_role(df, calendar, key, wanted)
    return df


def _projection(columns: Sequence[str]) -> list[Column]:
    return [F.col(MEASURE_COLUMNS.get(c, c)).alias(c) for c in columns]


# --- revenue marts over `sales` ------------------------------------------------------------------

CATEGORY_YEAR_NEEDS = ["order_id", "order_year", "category", "quantity", "gross_revenue", "discount_given"]


def sales_by_category_year(lines: DataFrame) -> DataFrame:
    """Orders, units, gross, discount, net and discount rate by year and category.

    Lines are first summed to (year, category, order): that counts distinct orders with plain sums
    and leaves little to move for the second step.
    """
    per_order = lines.groupBy("order_year", "category", "order_id").agg(
        F.sum("quantity").alias("quantity"),
        F.sum("gross_revenue").alias("gross"),
        F.sum("discount_given").alias("discount"),
    )
    out = per_order.groupBy("order_year", "category").agg(
        F.count("order_id").alias("orders"),
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.sum("gross").cast(AMOUNT).alias("gross_revenue"),
        F.sum("discount").cast(AMOUNT).alias("discount_given"),
    )
    return out.withColumns(
        {
            "order_year": F.col("order_year").cast("int"),
            "net_revenue": (F.col("gross_revenue") - F.col("discount_given")).cast(AMOUNT),
            "discount_rate_pct": percent(F.col("discount_given"), F.col("gross_revenue")),
        }
    )


CUSTOMER_NEEDS = ["order_id", "order_date", "customer_id", "customer", "customer_country", "net_revenue"]


def customer_sales_summary(lines: DataFrame) -> DataFrame:
    """Lifetime figures per customer label set; a customer whose facts span versions has several rows."""
    label = ["customer_id", "customer", "customer_country"]
    per_order = lines.groupBy(*label, "order_id").agg(
        F.min("order_date").alias("first"), F.max("order_date").alias("last"),
        F.sum("net_revenue").alias("net"),
    )
    return per_order.groupBy(*label).agg(
        F.count("order_id").alias("orders"),
        F.min("first").alias("first_order"),
        F.max("last").alias("latest_order"),
        F.sum("net").cast(AMOUNT).alias("lifetime_revenue"),
    ).withColumn("avg_order_value", mean_money(F.col("lifetime_revenue"), F.col("orders")))


EMPLOYEE_NEEDS = [
    "order_id", "customer_id", "employee", "employee_title", "employee_manager", "employee_country",
    "net_revenue",
]


def employee_performance(lines: DataFrame) -> DataFrame:
    """Orders, customers served and revenue per employee label set.

    An order has one customer, so distinct orders and distinct customers both fall out of nested
    sums, without expanding each row once per distinct aggregate.
    """
    label = ["employee", "employee_title", "employee_manager", "employee_country"]
    per_order = lines.groupBy(*label, "customer_id", "order_id").agg(F.sum("net_revenue").alias("net"))
    per_customer = per_order.groupBy(*label, "customer_id").agg(
        F.count("order_id").alias("n"), F.sum("net").alias("net")
    )
    return per_customer.groupBy(*label).agg(
        F.sum("n").alias("orders"),
        F.count("customer_id").alias("customers_served"),
        F.sum("net").cast(AMOUNT).alias("net_revenue"),
    ).withColumn("avg_order_value", mean_money(F.col("net_revenue"), F.col("orders")))


def order_fulfilment_performance(
    fact: DataFrame, calendar: DataFrame | None, shippers: DataFrame, customers: DataFrame
) -> DataFrame:
    """Delivery performance and freight by year, quarter, shipper and customer country.

    No order is left out: one on a day that a stored calendar lacks counts without year and quarter;
    without a calendar both are worked out from the date key.
    """
    # Orders collapse to (day, shipper, customer) before they meet the customer dimension.
    measures = fact.groupBy("order_date_key", "shipper_key", "customer_key").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if("is_shipped").alias("shipped"),
        F.count_if("is_late").alias("late"),
        F.sum("days_to_ship").alias("days"),
        F.sum("freight_amount").alias("freight"),
    )
    named = (
        _with_dates(measures, calendar, ["order_year", "order_quarter"])
        .join(shippers.select("shipper_key", F.col("company_name").alias("shipper")), "shipper_key")
        .join(customers.select("customer_key", F.col("country").alias("customer_country")), "customer_key")
    )
    summed = named.groupBy("order_year", "order_quarter", "shipper", "customer_country").agg(
        F.sum("orders").alias("orders"),
        F.sum("shipped").alias("shipped_orders"),
        F.sum("late").alias("late_orders"),
        F.sum("days").alias("_days"),
        F.sum("freight").cast(AMOUNT).alias("total_freight"),
    )
    return summed.select(
        F.col("order_year").cast("int").alias("order_year"), "order_quarter", "shipper", "customer_country",
        "orders", "shipped_orders", "late_orders",
        percent(F.col("late_orders").cast("decimal(19,0)"), F.col("shipped_orders").cast("decimal(19,0)")).alias("late_pct"),
        mean_money(F.col("_days"), F.col("shipped_orders"), 1).alias("avg_days_to_ship"),
        "total_freight",
        mean_money(F.col("total_freight"), F.col("orders")).alias("avg_freight"),
    )


def customer_history(dim_customer: DataFrame) -> DataFrame:
    """Every version of every customer with its period and number; an open end shows as the far future."""
    real = dim_customer.filter(F.col("customer_key") != UNKNOWN_KEY).select(
        "customer_id", "company_name", "contact_name", "contact_title", "city", "country",
        "valid_from", "valid_to", "is_current",
    )
    numbered = version_numbers(real, "customer_id", "valid_from", by_month(F.col("valid_from")), "version_number")
    return numbered.withColumn("valid_to", F.coalesce("valid_to", instant(OPEN_END)))


# --- marts over staging ---------------------------------------------------------------------------

def contact_directory(
    customers: DataFrame, suppliers: DataFrame, employees: DataFrame, own_company: str,
    with_type: bool = True,
) -> DataFrame:
    """Telephone directory of customers, suppliers and own staff; duplicates are kept."""
    staff = employees.select(
        F.lit(own_company).alias("company_name"), dimensions.full_name().alias("contact_name"),
        F.col("extension").alias("phone"),
    )
    contact = ["company_name", "contact_name", "phone"]
    parts = {"Customer": customers.select(*contact), "Supplier": suppliers.select(*contact), "Employee": staff}
    typed = [
        df.withColumn("contact_type", F.lit(kind)) if with_type else df for kind, df in parts.items()
    ]
    return typed[0].unionByName(typed[1]).unionByName(typed[2])


def new_contact_directory(
    customers: DataFrame, suppliers: DataFrame, employees: DataFrame, own_company: str
) -> DataFrame:
    """The directory without the type column."""
    return contact_directory(customers, suppliers, employees, own_company, with_type=False)


def managers(employees: DataFrame) -> DataFrame:
    wanted = ["employee_id", "last_name", "first_name", "title", "title_of_courtesy", "home_phone",
              "extension", "reports_to"]
    return dimensions.managers(employees).select(*[c for c in wanted if c in employees.columns])


def current_product_list(products: DataFrame) -> DataFrame:
    return products.filter(~F.col("discontinued")).select("product_id", "product_name")


def order_subtotals(lines: DataFrame) -> DataFrame:
    """Net value per order at two places."""
    return lines.groupBy("order_id").agg(F.round(F.sum("net_amount"), 2).cast("decimal(19,2)").alias("subtotal"))


def products_above_average_price(products: DataFrame) -> DataFrame:
    average = products.agg(F.avg("unit_price")).scalar()
    return products.filter(F.col("unit_price") > average).select("product_name", "unit_price")


# --- tuning queries ---------------------------------------------------------------------------------

def category_revenue(fact: DataFrame, products: DataFrame, period: Column) -> DataFrame:
    """Net revenue by category for a period; lines are summed per product before the join."""
    per_product = fact.filter(period).groupBy("product_key").agg(F.sum("net_amount").alias("net"))
    return (
        per_product.join(products.select("product_key", F.col("category_name").alias("category")), "product_key")
        .groupBy("category").agg(F.sum("net").cast(AMOUNT).alias("net_revenue"))
    )


def period_total(fact: DataFrame, predicate: Column) -> DataFrame:
    return fact.filter(predicate).agg(F.sum("net_amount").cast(AMOUNT).alias("net_revenue"))


def current_by_country(dim_customer: DataFrame, country: str) -> DataFrame:
    return dim_customer.filter(F.col("is_current") & (F.col("country") == country)).select(
        "customer_id", "company_name"
    )


def lines_by_country(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Fact rows per customer country; rows are counted per customer before the join."""
    per_customer = fact.groupBy("customer_key").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_customer.join(customers.select("customer_key", "country"), "customer_key")
        .groupBy("country").agg(F.sum("n").alias("line_count"))
    )


def data_profile(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, current rows and distinct entities per table: {name: (table, entity column)}.

    Rows collapse to one per entity first, so the distinct count is a plain count of groups.
    """
    out = None
    for name, (df, entity) in tables.items():
        now = F.col("is_current") if "is_current" in df.columns else F.lit(True)
        per_entity = df.groupBy(F.col(entity).alias("_entity")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(now).alias("current")
        )
        part = per_entity.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum("current"), F.lit(0)).alias("current_rows"),
            F.count("_entity").alias("distinct_entities"),
        ).select(F.lit(name).alias("table_name"), "row_count", "current_rows", "distinct_entities")
        out = part if out is None else out.unionByName(part)
    return out


def drill_across(fact_lines: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Revenue and freight per order: each fact is summed to the shared grain, then joined."""
    revenue = fact_lines.groupBy("order_id").agg(F.sum("net_amount").cast(AMOUNT).alias("net_revenue"))
    return fact_orders.select("order_id", "freight_amount").join(revenue, "order_id", "left")


def freight_fanout(fact_lines: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Freight at its own grain beside the overstated total that a join to the lines would give."""
    per_order = facts.line_counts(fact_lines)
    joined = fact_orders.select("order_id", "freight_amount").join(per_order, "order_id", "left")
    at_lines = F.col("freight_amount") * F.coalesce("order_line_count", F.lit(0)).cast("decimal(10,0)")
    return joined.agg(
        F.sum("freight_amount").cast(AMOUNT).alias("freight_at_order_grain"),
        F.sum(at_lines).cast(AMOUNT).alias("freight_at_line_grain"),
    )


