"""Join shapes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.functions import AMOUNT
from starloom.operators.joins import anti, as_at, full_outer, left_outer, semi
from starloom.operators.windows import by_month, next_value, overlap_pairs
from starloom.plans import dimensions, marts
from starloom.queries.base import query, roles

ORDER_STATUSES = ["F", "O", "P"]


def lines(s):
    """Lines under another name of their order: some orders have none, which the outer joins need."""
    return s.src.line_items.select(F.col("order_id").alias("line_order"), "product_id", "quantity")


@query("join_inner", roles("cust", "ord") + """
select c.customer_id, c.company_name, c.country, o.order_id, o.order_date
from cust c join ord o on o.customer_id = c.customer_id""")
def join_inner(s):
    return s.src.orders.select("order_id", "order_date", "customer_id").join(
        s.src.customers.select("customer_id", "company_name", "country"), "customer_id")


@query("invoices", roles("item", "ord", "cust", "emp", "ship", "prod") + """
select o.order_id, o.order_date, o.required_date, c.customer_id, c.company_name as customer_name, c.city, c.country,
       e.first_name || ' ' || e.last_name as salesperson, s.company_name as shipper_name,
       p.product_id, p.product_name, i.quantity, i.gross as gross_amount, i.disc as discount_amount,
       cast(i.gross - i.disc as decimal(21,4)) as extended_price, o.freight
from ord o join cust c on c.customer_id = o.customer_id join emp e on e.employee_id = o.employee_id
join ship s on s.shipper_id = o.ship_via join item i on i.order_id = o.order_id
join prod p on p.product_id = i.product_id""")
def invoices(s):
    header = (
        s.src.orders.select("order_id", "customer_id", "employee_id", "ship_via", "order_date", "required_date", "freight")
        .join(s.src.customers.select("customer_id", F.col("company_name").alias("customer_name"), "city", "country"),
              "customer_id")
        .join(s.src.employees.select("employee_id", dimensions.full_name().alias("salesperson")), "employee_id")
        .join(s.src.shippers.select(F.col("shipper_id").alias("ship_via"), F.col("company_name").alias("shipper_name")),
              "ship_via")
        .drop("employee_id", "ship_via"))
    lines = s.src.line_items.withColumn(
        "extended_price", (F.col("gross_amount") - F.col("discount_amount")).cast(AMOUNT))
    return lines.join(header, "order_id").join(s.src.products.select("product_id", "product_name"), "product_id")


@query("uk_orders_by_category", roles("item", "ord", "cust", "prod") + """
select c.customer_id, c.company_name, o.order_id, o.order_date, i.product_id, i.quantity, p.product_name, p.category_name
from cust c join ord o on o.customer_id = c.customer_id join item i on i.order_id = o.order_id
join prod p on p.product_id = i.product_id
where c.country = 'NATION_7' and p.category_name = 'PROMO' order by c.company_name, o.order_date""")
def uk_orders_by_category(s):
    buyers = s.src.customers.filter(F.col("country") == "NATION_7").select("customer_id", "company_name")
    goods = s.src.products.filter(F.col("category_name") == "PROMO").select("product_id", "product_name", "category_name")
    header = s.src.orders.select("order_id", "order_date", "customer_id").join(buyers, "customer_id")
    lines = s.src.line_items.select("order_id", "product_id", "quantity")
    return lines.join(goods, "product_id").join(header, "order_id").orderBy("company_name", "order_date")


@query("join_left", roles("ord", "item") + """
select o.order_id, o.order_date, i.product_id, i.quantity from ord o left join item i on i.order_id = o.order_id""")
def join_left(s):
    return left_outer(s.src.orders.select("order_id", "order_date"), lines(s), "order_id", "line_order").drop("line_order")


@query("join_right", roles("ord", "item") + """
select i.product_id, i.quantity, o.order_id, o.customer_id from item i right join ord o on i.order_id = o.order_id""")
def join_right(s):
    return left_outer(s.src.orders.select("order_id", "customer_id"), lines(s), "order_id", "line_order").drop("line_order")


@query("join_full", roles("cust", "ord") + """
select c.customer_id, c.company_name, o.order_id, o.customer_id as buyer
from cust c full join ord o on o.customer_id = c.customer_id""")
def join_full(s):
    customers = s.src.customers.select("customer_id", "company_name")
    orders = s.src.orders.select("order_id", F.col("customer_id").alias("buyer"))
    return full_outer(customers, orders, "customer_id", "buyer")


@query("join_full_days", roles("ord", "item") + """
select ordered_on, order_count, shipped_on, line_count
from (select cast(order_date as date) as ordered_on, count(*) as order_count from ord group by 1) o
full join (select cast(shipped as date) as shipped_on, count(*) as line_count from item group by 1) i on shipped_on = ordered_on""")
def join_full_days(s):
    """Days with orders beside days with shipments; the first and last days have one of them only."""
    one = F.count(F.lit(1))
    ordered = s.src.orders.groupBy(F.col("order_date").cast("date").alias("ordered_on")).agg(one.alias("order_count"))
    shipped = s.raw("lineitem").groupBy(F.col("l_shipdate").cast("date").alias("shipped_on")).agg(one.alias("line_count"))
    return full_outer(ordered, shipped, "ordered_on", "shipped_on")


@query("join_cross", roles("cust", "ord") + """
select c.customer_id, k.order_status, coalesce(n.orders, 0) as orders
from cust c cross join (values ('F'), ('O'), ('P')) as k(order_status)
left join (select customer_id, order_status, count(*) as orders from ord group by 1, 2) n
on n.customer_id = c.customer_id and n.order_status = k.order_status""")
def join_cross(s):
    # Every customer beside every declared status. The second factor is a fixed list, so the
    # product is a constant number of rows per customer and needs no join.
    grid = s.src.customers.select(
        "customer_id", F.explode(F.array(*map(F.lit, ORDER_STATUSES))).alias("order_status"))
    counts = s.src.orders.groupBy("customer_id", "order_status").agg(F.count(F.lit(1)).alias("orders"))
    return grid.join(counts, ["customer_id", "order_status"], "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0)))


@query("self_join", roles("emp") + """
select e.employee_id, e.first_name || ' ' || e.last_name as employee,
       m.employee_id as manager_id, m.first_name || ' ' || m.last_name as manager
from emp e left join emp m on m.employee_id = e.reports_to""")
def self_join(s):
    staff = s.src.employees.select("employee_id", dimensions.full_name().alias("employee"), "reports_to")
    boss = s.src.employees.select(
        F.col("employee_id").alias("manager_id"), dimensions.full_name().alias("manager"))
    return staff.join(boss, F.col("reports_to") == F.col("manager_id"), "left").drop("reports_to")


@query("join_semi", roles("ord", "item") + """
select order_id, customer_id from ord o where exists (select 1 from item i where i.order_id = o.order_id)""")
def join_semi(s):
    return semi(s.src.orders.select("order_id", "customer_id"), "order_id", lines(s), "line_order")


@query("join_anti", roles("ord", "item") + """
select order_id, customer_id from ord o where not exists (select 1 from item i where i.order_id = o.order_id)""")
def join_anti(s):
    return anti(s.src.orders.select("order_id", "customer_id"), "order_id", lines(s), "line_order")


# --- versions -----------------------------------------------------------------------------------------

VERSIONS_SQL = """versions as (
  select customer_id, valid_from, lead(valid_from) over (partition by customer_id order by valid_from) as valid_to, title
  from (select customer_id, date_trunc('year', order_date)::timestamp as valid_from,
               max(order_status || cast(ship_via as varchar)) as title from ord group by 1, 2))"""


def customer_versions(s):
    """A version per customer and year with orders; it lasts until the next one opens."""
    yearly = s.src.orders.groupBy(
        "customer_id", F.date_trunc("YEAR", "order_date").cast("timestamp_ntz").alias("valid_from")
    ).agg(F.max(F.concat("order_status", F.col("ship_via").cast("string"))).alias("title"))
    # One row per customer and calendar year, so a customer's window stays within the calendar.
    chain = Window.partitionBy("customer_id").orderBy("valid_from")
    return yearly.withColumn("valid_to", F.lead("valid_from").over(chain))


@query("asof_dim_lookup", roles("ord") + ", " + VERSIONS_SQL + """
select o.order_id, o.customer_id, o.required_date, v.valid_from, v.title
from ord o left join versions v on v.customer_id = o.customer_id and v.valid_from <= o.required_date
 and (v.valid_to is null or o.required_date < v.valid_to)""")
def asof_dim_lookup(s):
    facts = s.src.orders.select("order_id", "customer_id", "required_date")
    versions = customer_versions(s).withColumnRenamed("customer_id", "version_of")
    # The year is part of the join key: it cuts a busy customer's orders into the calendar's years.
    last = facts.agg(F.max("required_date")).scalar()
    covered = F.sequence(F.year("valid_from"), F.year(F.coalesce("valid_to", last)))
    covered = F.when(F.year("valid_from") <= F.year(F.coalesce("valid_to", last)), covered)
    return as_at(
        facts, versions, "customer_id", "version_of", F.col("required_date"), F.year("required_date"), covered
    ).drop("version_of", "valid_to")


@query("customer_history", roles("ord", "cust") + ", " + VERSIONS_SQL + """
select v.customer_id, c.company_name, c.company_name as contact_name, v.title as contact_title, c.city, c.country,
       v.valid_from, coalesce(v.valid_to, timestamp '9999-12-31 00:00:00') as valid_to, v.valid_to is null as is_current,
       cast(row_number() over (partition by v.customer_id order by v.valid_from) as int) as version_number
from versions v join cust c on c.customer_id = v.customer_id""")
def customer_history(s):
    dim = customer_versions(s).join(
        s.src.customers.select("customer_id", "company_name", "city", "country"), "customer_id"
    ).select(
        (F.col("customer_id") + 1).alias("customer_key"), "customer_id", "company_name",
        F.col("company_name").alias("contact_name"), F.col("title").alias("contact_title"), "city", "country",
        "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))
    return marts.customer_history(dim)


OPEN_PERIODS_SQL = "periods as (select distinct customer_id, order_date as opens, required_date as closes from ord)"


def open_periods(s):
    """Days on which a customer ordered, each with its delivery window."""
    return s.src.orders.select(
        "customer_id", F.col("order_date").alias("opens"), F.col("required_date").alias("closes")).distinct()


@query("scd2_overlaps", roles("ord") + ", " + OPEN_PERIODS_SQL + """
select a.customer_id, count(*) as overlapping_pairs from periods a join periods b
on a.customer_id = b.customer_id and a.opens < b.opens and b.opens < a.closes group by 1""")
def scd2_overlaps(s):
    return overlap_pairs(open_periods(s), "customer_id", "opens", "closes", by_month)


@query("scd2_gaps", roles("ord") + ", " + OPEN_PERIODS_SQL + """
select * from (select customer_id, opens, closes,
  lead(opens) over (partition by customer_id order by opens) as next_opens from periods)
where next_opens is not null and next_opens > closes""")
def scd2_gaps(s):
    chain = next_value(open_periods(s), "customer_id", "opens", by_month(F.col("opens")), "next_opens")
    return chain.filter(F.col("next_opens") > F.col("closes"))
