"""Aggregation shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import AMOUNT, mean_money
from starloom.plans import training
from starloom.queries.base import query, roles, sql_mean
from starloom.session import work_path
from starloom.sources.scaled import scaled_between, scaled_fact, store_scaled


@query("agg_global", roles("ord") + """
select count(*) as orders, min(cast(order_date as date)) as earliest, max(cast(order_date as date)) as latest,
       count(*) filter (where order_status = 'F') as finished,
       min(cast(order_date as date)) filter (where order_status = 'F') as earliest_finished,
       max(cast(order_date as date)) filter (where order_status = 'F') as latest_finished from ord""")
def agg_global(s):
    day, done = F.col("order_date").cast("date"), F.col("order_status") == "F"
    return s.src.orders.agg(
        F.count(F.lit(1)).alias("orders"), F.min(day).alias("earliest"), F.max(day).alias("latest"),
        F.count_if(done).alias("finished"), F.min(F.when(done, day)).alias("earliest_finished"),
        F.max(F.when(done, day)).alias("latest_finished"))


@query("agg_grouped", roles("prod") + f"""
select category_name, count(*) as products, cast(sum(units_in_stock) as bigint) as in_stock,
       {sql_mean('sum(unit_price)', 'count(unit_price)')} as avg_price, max(unit_price) as max_price,
       round(stddev_samp(cast(unit_price as double)), 2) as stdev_price from prod group by 1""")
def agg_grouped(s):
    return s.src.products.groupBy("category_name").agg(
        F.count(F.lit(1)).alias("products"), F.sum("units_in_stock").alias("in_stock"),
        mean_money(F.sum("unit_price"), F.count("unit_price")).alias("avg_price"),
        F.max("unit_price").alias("max_price"),
        F.round(F.stddev_samp(F.col("unit_price").cast("double")), 2).alias("stdev_price"))


@query("agg_having", roles("item") + """
select product_id, cast(sum(gross) as decimal(21,4)) as total_value from item
group by 1 having sum(gross) <= 1000000 order by total_value desc""")
def agg_having(s):
    return s.src.line_items.groupBy("product_id").agg(
        F.sum("gross_amount").cast(AMOUNT).alias("total_value")
    ).filter(F.col("total_value") <= 1000000).orderBy(F.col("total_value").desc())


@query("customer_order_counts", roles("cust", "ord") + f"""
select c.customer_id, c.company_name, count(o.order_id) as orders,
       coalesce(strftime(min(o.order_date), '%Y-%m-%d %H:%M:%S'), 'No orders') as first_order
from cust c left join ord o on o.customer_id = c.customer_id
group by 1, 2""")
def customer_order_counts(s):
    # Orders are counted per customer first: the join then has one row per customer on each side.
    per_customer = s.src.orders.groupBy("customer_id").agg(
        F.count("order_id").alias("orders"), F.min("order_date").alias("first"))
    return s.src.customers.select("customer_id", "company_name").join(per_customer, "customer_id", "left").select(
        "customer_id", "company_name", F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce(F.date_format("first", "yyyy-MM-dd HH:mm:ss"), F.lit("No orders")).alias("first_order"))


_MOVES_SQL = """, moves as (select p.category_name as category, p.supplier_name as supplier,
  cast(year(i.shipped) as int) as ship_year, count(*) as line_count
  from item i join prod p on p.product_id = i.product_id group by 1, 2, 3) """


def moves(s):
    """Line counts by category, supplier and year: lines are counted per product and year first."""
    per_product = s.raw("lineitem").groupBy(
        F.col("l_partkey").alias("product_id"), F.year("l_shipdate").alias("ship_year")
    ).agg(F.count(F.lit(1)).alias("n"))
    labels = s.src.products.select(
        "product_id", F.col("category_name").alias("category"), F.col("supplier_name").alias("supplier"))
    return per_product.join(labels, "product_id").groupBy("category", "supplier", "ship_year").agg(
        F.sum("n").alias("line_count"))


@query("agg_rollup", roles("item", "prod") + _MOVES_SQL + """
select category, supplier, ship_year, cast(sum(line_count) as bigint) as total,
       cast(grouping(category) * 4 + grouping(supplier) * 2 + grouping(ship_year) as bigint) as level
from moves group by rollup (category, supplier, ship_year)""")
def agg_rollup(s):
    return moves(s).rollup("category", "supplier", "ship_year").agg(
        F.sum("line_count").alias("total"), F.grouping_id().alias("level"))


@query("agg_cube", roles("item", "prod") + _MOVES_SQL + """
select category, supplier, ship_year, cast(sum(line_count) as bigint) as total,
       cast(grouping(category) * 4 + grouping(supplier) * 2 + grouping(ship_year) as bigint) as level
from moves group by cube (category, supplier, ship_year)""")
def agg_cube(s):
    return moves(s).cube("category", "supplier", "ship_year").agg(
        F.sum("line_count").alias("total"), F.grouping_id().alias("level"))


@query("agg_cube_pairs", roles("item", "prod") + _MOVES_SQL + """
select category, supplier, cast(sum(line_count) as bigint) as total from moves group by cube (category, supplier)""")
def agg_cube_pairs(s):
    return moves(s).cube("category", "supplier").agg(F.sum("line_count").alias("total"))


@query("agg_grouping_sets", roles("item", "prod") + _MOVES_SQL + """
select category, supplier, ship_year, cast(sum(line_count) as bigint) as total
from moves group by grouping sets ((category), (category, supplier, ship_year))""")
def agg_grouping_sets(s):
    c = [F.col(n) for n in ("category", "supplier", "ship_year")]
    return moves(s).groupingSets([[c[0]], c], *c).agg(F.sum("line_count").alias("total"))


@query("string_agg_ordered", roles("ord", "ship") + """
select customer_id, string_agg(company_name, ', ' order by company_name) as shippers
from (select distinct o.customer_id, s.company_name from ord o join ship s on s.shipper_id = o.ship_via) group by 1""")
def string_agg_ordered(s):
    # One row per (customer, shipper) is left before a list is built, so a list is as long as the
    # shipper table at most.
    used = s.src.orders.select("customer_id", F.col("ship_via").alias("shipper_id")).distinct()
    named = used.join(s.src.shippers, "shipper_id")
    return training.ordered_list(named, "customer_id", "company_name", "shippers")


@query("entity_days", roles("item", "cust", "ord") + f"""
select c.customer_id, count(i.order_id) as number_lines, cast(coalesce(sum(i.quantity), 0) as bigint) as number_units
from cust c left join ord o on o.customer_id = c.customer_id
left join item i on i.order_id = o.order_id group by 1""")
def entity_days(s):
    # Lines are summed to their order before the join, so a long order arrives as one row.
    per_order = s.src.line_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("units"))
    attended = s.src.orders.select("order_id", "customer_id").join(per_order, "order_id")
    return training.entity_totals(
        s.src.customers.select("customer_id"), attended, "customer_id", "n", "units",
        "number_lines", "number_units")


@query("entity_path_counts", """
select r_name as region, n_name as country, count(*) as orders from region
join nation on n_regionkey = r_regionkey join customer on c_nationkey = n_nationkey
join orders on o_custkey = c_custkey group by 1, 2""")
def entity_path_counts(s):
    return training.path_counts(s.src.orders, s.src.customers)


@query("entity_path_date_counts", """
select r_name as region, n_name as country, cast(o_orderdate as date) as order_day, count(*) as orders from region
join nation on n_regionkey = r_regionkey join customer on c_nationkey = n_nationkey
join orders on o_custkey = c_custkey group by 1, 2, 3""")
def entity_path_date_counts(s):
    return training.path_counts(s.src.orders, s.src.customers, by_day=True)


@query("stock_rebuild", """
select l_partkey as product_id,
       cast(sum(case when l_returnflag = 'R' then 1 else -1 end * cast(l_quantity as bigint)) as bigint) as stock_amount,
       count(*) filter (where l_shipdate < timestamp '2000-01-01') as kept_movements
from lineitem group by 1""")
def stock_rebuild(s):
    quantity = F.col("l_quantity").cast("bigint")
    movements = s.raw("lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("transfer_date"),
        F.when(F.col("l_returnflag") == "R", quantity).otherwise(-quantity).alias("transfer_amount"))
    return training.stock_after_reset(movements, "2000-01-01 00:00:00")


@query("scaled_fact_month_sum", """
select cast(sum(net) as decimal(38,2)) as net_amount from (
  select date '1996-01-01' + cast((l_orderkey * 7919 + l_partkey * 31 + l_linenumber * 389 + k * 104729) % 1461 as int) as order_day,
         cast((l_orderkey * 104729 + l_partkey * 7 + l_linenumber * 53 + k * 7919) % 100000 as decimal(10,0)) * cast(0.01 as decimal(3,2)) as net
  from lineitem, (select unnest(generate_series(1, 4)) as k))
where order_day >= date '1997-01-01' and order_day < date '1997-02-01'""")
def scaled_fact_month_sum(s):
    return training.month_sum(scaled_fact(s.raw("lineitem"), 4), 1997, 1)


@query("scaled_fact_stored_days", """
select order_day as order_date, count(*) as line_count, cast(sum(net) as decimal(38,2)) as net_amount from (
  select date '1996-01-01' + cast((l_orderkey * 7919 + l_partkey * 31 + l_linenumber * 389 + k * 104729) % 1461 as int) as order_day,
         cast((l_orderkey * 104729 + l_partkey * 7 + l_linenumber * 53 + k * 7919) % 100000 as decimal(10,0)) * cast(0.01 as decimal(3,2)) as net
  from lineitem, (select unnest(generate_series(1, 4)) as k))
where order_day >= date '1996-12-20' and order_day < date '1997-02-03' group by 1""")
def scaled_fact_stored_days(s):
    """Days of a half-open key range over the fact as stored: other months are not read, other days skipped."""
    path = work_path(s.spark)
    store_scaled(scaled_fact(s.raw("lineitem"), 4), path)
    return scaled_between(s.spark, path, 19961220, 19970203).groupBy("order_date").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("net_amount").cast("decimal(38,2)").alias("net_amount"))
