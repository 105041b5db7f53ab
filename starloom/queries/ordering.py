"""Sorting and top-k shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import ranking
from starloom.queries.base import query, roles

PRICES = ["product_id", "product_name", "unit_price"]


@query("sort_multi", roles("prod") + """
select product_id, product_name, category_name, unit_price,
       cast((units_in_stock + units_on_order) * unit_price as decimal(21,4)) as future_stock_value
from prod where not discontinued order by category_name, unit_price desc, product_id""")
def sort_multi(s):
    value = ((F.col("units_in_stock") + F.col("units_on_order")) * F.col("unit_price")).cast("decimal(21,4)")
    return s.src.products.filter(~F.col("discontinued")).select(
        "product_id", "product_name", "category_name", "unit_price", value.alias("future_stock_value")
    ).orderBy("category_name", F.col("unit_price").desc(), "product_id")


@query("top_n", roles("prod") + """
select product_id, product_name, unit_price from prod order by unit_price desc, product_id limit 10""")
def top_n(s):
    return ranking.top_n(s.src.products.select(*PRICES), 10, F.col("unit_price").desc(), F.col("product_id"))


@query("limit_any")
def limit_any(s):
    # Any ten customers without a fax: which ones is not defined.
    return s.src.customers.filter(F.col("fax").isNull()).select("customer_id", "company_name", "phone", "fax").limit(10)


@query("limit_any_counts", roles("cust") + """
select least(10, count(*)) as row_count, least(10, count(*)) as without_fax from cust where fax is null""")
def limit_any_counts(s):
    """How many rows the free choice has, and that all of them fit: the part of it that is defined."""
    return limit_any(s).agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("fax").isNull()).alias("without_fax"))


@query("top_n_with_ties", roles("prod") + """
select product_id, product_name, unit_price from prod qualify rank() over (order by unit_price desc) <= 15""")
def top_n_with_ties(s):
    return ranking.top_n_with_ties(s.src.products.select(*PRICES), 15, "unit_price")


@query("top_percent", roles("prod") + """
select product_id, product_name, unit_price from prod
qualify row_number() over (order by unit_price desc, product_id) <= ceil((select count(*) from prod) * 10 / 100.0)""")
def top_percent(s):
    return ranking.top_percent(
        s.src.products.select(*PRICES), 10, [F.col("unit_price").desc(), F.col("product_id")])
