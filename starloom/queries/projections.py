"""Projections, filters and predicates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from starloom.functions import AMOUNT, differs, extended_price, in_days, like_class, money
from starloom.operators.rows import delete_where, update_where
from starloom.queries.base import query, roles

PRODUCT_LIST = ["product_id", "product_name", "category_name", "discontinued", "unit_price"]
PRODUCT_LIST_SQL = "product_id, product_name, category_name, discontinued, unit_price"


@query("project_columns", roles("cust") + "select customer_id, company_name, contact_title, phone from cust")
def project_columns(s):
    return s.src.customers.select("customer_id", "company_name", "contact_title", "phone")


@query("computed_columns", roles("prod") + """
select product_id, product_name, unit_price, units_in_stock, units_on_order,
       cast(unit_price * units_in_stock as decimal(21,4)) as current_stock_value,
       cast((units_in_stock + units_on_order) * unit_price as decimal(21,4)) as future_stock_value from prod""")
def computed_columns(s):
    price, stock, ordered = F.col("unit_price"), F.col("units_in_stock"), F.col("units_on_order")
    return s.src.products.select(
        "product_id", "product_name", "unit_price", "units_in_stock", "units_on_order",
        (price * stock).cast(AMOUNT).alias("current_stock_value"),
        ((stock + ordered) * price).cast(AMOUNT).alias("future_stock_value"),
    )


@query("extended_price", """
select l_orderkey as order_id, l_partkey as product_id, l_linenumber as line_number,
       cast(cast(l_extendedprice as decimal(19,4)) * (1 - cast(l_discount as decimal(5,4))) as decimal(21,4))
         as extended_price from lineitem""")
def extended_price_query(s):
    # The delivered price already contains the quantity, hence quantity 1 here.
    price = extended_price(
        money("l_extendedprice"), F.lit(1).cast("decimal(1,0)"), F.col("l_discount").cast("decimal(5,4)"))
    return s.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_number"), price.alias("extended_price"))


@query("distinct_values", roles("cust") + "select distinct country from cust")
def distinct_values(s):
    return s.src.customers.select("country").distinct()


@query("filter_compare", roles("prod") + """
select product_id, product_name, unit_price, units_in_stock, category_name from prod
where unit_price <= 950 and units_in_stock > 5 and units_in_stock < 40 and unit_price >= 905
  and category_name <> 'SMALL' and supplier_name != 'Brand#3' and units_in_stock + reorder_level < 45""")
def filter_compare(s):
    c = F.col
    return s.src.products.filter(
        (c("unit_price") <= 950) & (c("units_in_stock") > 5) & (c("units_in_stock") < 40)
        & (c("unit_price") >= 905) & (c("category_name") != "SMALL") & (c("supplier_name") != "Brand#3")
        & (c("units_in_stock") + c("reorder_level") < 45)
    ).select("product_id", "product_name", "unit_price", "units_in_stock", "category_name")


@query("filter_precedence", roles("prod") + """
select product_id, category_name, unit_price,
       (category_name = 'SMALL' or category_name = 'LARGE' and unit_price > 950) as without_parentheses,
       ((category_name = 'SMALL' or category_name = 'LARGE') and unit_price > 950) as with_parentheses
from prod where category_name = 'SMALL' or category_name = 'LARGE' and unit_price > 950""")
def filter_precedence(s):
    small, large = F.col("category_name") == "SMALL", F.col("category_name") == "LARGE"
    dear = F.col("unit_price") > 950
    loose, strict = small | (large & dear), (small | large) & dear
    # The strict form implies the loose one, so one scan serves both.
    return s.src.products.filter(loose).select(
        "product_id", "category_name", "unit_price",
        loose.alias("without_parentheses"), strict.alias("with_parentheses"))


@query("filter_between", roles("ord") + """
select order_id, customer_id, order_date, freight from ord
where order_date between timestamp '1997-08-01' and timestamp '1997-08-31' and freight between 100000 and 300000""")
def filter_between(s):
    first, last = (F.to_timestamp_ntz(F.lit(f"1997-08-{d} 00:00:00")) for d in ("01", "31"))
    return s.src.orders.filter(
        F.col("order_date").between(first, last) & F.col("freight").between(100000, 300000)
    ).select("order_id", "customer_id", "order_date", "freight")


@query("filter_half_open", roles("ord") + """
select order_id, customer_id, order_date from ord
where order_date >= timestamp '1997-01-01' and order_date < timestamp '1997-02-01'""")
def filter_half_open(s):
    return s.src.orders.filter(in_days("order_date", date(1997, 1, 1), date(1997, 2, 1))).select(
        "order_id", "customer_id", "order_date")


@query("filter_in", roles("cust") + """
select customer_id, contact_title, country from cust
where contact_title in ('BUILDING', 'MACHINERY') and country in ('NATION_1', 'NATION_3', 'NATION_5')""")
def filter_in(s):
    return s.src.customers.filter(
        F.col("contact_title").isin("BUILDING", "MACHINERY")
        & F.col("country").isin("NATION_1", "NATION_3", "NATION_5")
    ).select("customer_id", "contact_title", "country")


@query("filter_like", roles("prod") + """
select product_id, product_name, product_name ilike 'SMALL%' as starts_small,
       product_name ilike '%ring%' as has_ring, product_name ilike '_o%t' as o_second from prod
where product_name ilike 'SMALL%' or product_name ilike '%ring%' or product_name ilike '_o%t'""")
def filter_like(s):
    name = F.col("product_name")
    flags = {"starts_small": name.ilike("SMALL%"), "has_ring": name.ilike("%ring%"), "o_second": name.ilike("_o%t")}
    return s.src.products.select("product_id", "product_name", *[e.alias(n) for n, e in flags.items()]).filter(
        "starts_small or has_ring or o_second")


@query("filter_like_class", roles("prod") + """
select product_id, product_name, regexp_matches(lower(product_name), '^[b,s,r]') as one_of,
       regexp_matches(lower(product_name), '^[^b,s,r]') as none_of,
       regexp_matches(lower(product_name), '^[g-s]') as in_range from prod""")
def filter_like_class(s):
    name = F.col("product_name")
    return s.src.products.select(
        "product_id", "product_name",
        like_class(name, "[B,S,R]%").alias("one_of"),
        like_class(name, "[^b,s,r]%").alias("none_of"),
        like_class(name, "[g-s]%").alias("in_range"))


@query("filter_null", roles("cust") + """
select customer_id, 'is null' as test from cust where fax is null
union all select customer_id, 'is not null' from cust where fax is not null
union all select customer_id, 'equals null' from cust where fax = null""")
def filter_null(s):
    fax = F.col("fax")
    people = s.src.customers.select("customer_id", "fax")
    tests = {"is null": fax.isNull(), "is not null": fax.isNotNull(), "equals null": fax == F.lit(None).cast("string")}
    parts = [people.filter(p).select("customer_id", F.lit(n).alias("test")) for n, p in tests.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("case_banding", roles("prod") + """
select product_id, product_name, unit_price,
       case when unit_price > 980 then 'Price level 1' when unit_price <= 980 and unit_price > 960 then 'Price level 2'
            when unit_price <= 960 and unit_price > 940 then 'Price level 3'
            when unit_price <= 940 and unit_price > 920 then 'Price level 4' else 'Price level 5' end as price_level
from prod""")
def case_banding(s):
    price = F.col("unit_price")
    level = F.when(price > 980, 1).when(price > 960, 2).when(price > 940, 3).when(price > 920, 4).otherwise(5)
    return s.src.products.select(
        "product_id", "product_name", "unit_price",
        F.concat(F.lit("Price level "), level.cast("string")).alias("price_level"))


@query("null_safe_diff", roles("cust") + """
select customer_id, fax, phone from cust
where fax is distinct from phone or balance is distinct from abs(balance)""")
def null_safe_diff(s):
    c = F.col
    return s.src.customers.filter(
        differs([c("fax"), c("balance")], [c("phone"), F.abs(c("balance")).cast("decimal(19,4)")])
    ).select("customer_id", "fax", "phone")


@query("update_where", roles("cust") + """
select customer_id, case when balance > 9000 then 'KEY ACCOUNT' else contact_title end as contact_title,
       cast(case when balance > 9000 then balance + 100 else balance end as decimal(19,4)) as balance from cust""")
def update_where_query(s):
    return update_where(
        s.src.customers.select("customer_id", "contact_title", "balance"), F.col("balance") > 9000,
        {"contact_title": F.lit("KEY ACCOUNT"), "balance": F.col("balance") + 100})


@query("delete_where", roles("cust") + """
select customer_id, fax, balance from cust where not coalesce(fax > '2' and balance < 5000, false)""")
def delete_where_query(s):
    return delete_where(
        s.src.customers.select("customer_id", "fax", "balance"),
        (F.col("fax") > "2") & (F.col("balance") < 5000))
