"""Registered warehouse operators: merges, keys, loads, landing, subset."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starloom.functions import instant, scd_hash
from starloom.operators.keys import assign_keys
from starloom.operators.merge import INSERT, KEEP, UPDATE, scd2_versions, upsert
from starloom.plans import dimensions, facts
from starloom.plans.load import pin_keys
from starloom.queries.base import query, roles
from starloom.queries.warehouse_marts import with_facts
from starloom.session import work_path
from starloom.sources import landing, subset
from starloom.sources.landing import conform, row_count_report
from starloom.sources.schemas import GRAINS, struct
from starloom.sources.store import WarehouseStore, publish_snapshot

FIRST, SECOND = "2000-01-01 00:00:00", "2001-01-01 00:00:00"
_TIMES = f"timestamp '{FIRST}' as t1, timestamp '{SECOND}' as t2"


def as_current(df, key, natural):
    """Rows of a first load: one open version each, opened by batch 1."""
    return df.withColumns({
        key: F.col(natural) + 1, "valid_from": instant(FIRST), "valid_to": F.lit(None).cast("timestamp_ntz"),
        "is_current": F.lit(True), "dw_load_batch_id": F.lit(1).cast("bigint"),
        "dw_inserted_at": instant(FIRST), "dw_updated_at": instant(FIRST)})


# --- Type 2 -----------------------------------------------------------------------------------------

TRACKED = ["company_name", "contact_title", "phone", "country"]


@query("scd2_customer", roles("cust") + f""", cur as (select * from cust where contact_title <> 'MACHINERY'),
src as (select customer_id, company_name, contact_title, country,
        case when balance < 0 then phone || '*' else phone end as phone from cust where contact_title <> 'FURNITURE'),
t as (select {_TIMES})
select c.customer_id, c.phone, t1 as valid_from, cast(null as timestamp) as valid_to, true as is_current, 1 as dw_load_batch_id
from cur c left join src s on s.customer_id = c.customer_id, t where s.customer_id is null or s.phone = c.phone
union all select c.customer_id, c.phone, t1, t2, false, 1
from cur c join src s on s.customer_id = c.customer_id, t where s.phone <> c.phone
union all select s.customer_id, s.phone, t2, null, true, 2
from src s left join cur c on s.customer_id = c.customer_id, t where c.customer_id is null or s.phone <> c.phone""")
def scd2_customer(s):
    """Second load of the customers: some new, some missing, a new phone for those in debt."""
    people = s.src.customers.select("customer_id", *TRACKED, "balance")
    current = as_current(
        people.filter(F.col("contact_title") != "MACHINERY").withColumn("row_hash", scd_hash(*TRACKED)),
        "customer_key", "customer_id").drop("balance")
    changed = F.when(F.col("balance") < 0, F.concat("phone", F.lit("*"))).otherwise(F.col("phone"))
    source = (
        people.filter(F.col("contact_title") != "FURNITURE").withColumn("phone", changed)
        .withColumn("row_hash", scd_hash(*TRACKED)).drop("balance"))
    versions = scd2_versions(current, source, "customer_id", "customer_key", instant(SECOND), 2)
    return versions.select(
        "customer_id", "phone", "valid_from", "valid_to", "is_current", "dw_load_batch_id")


@query("scd2_type1_product", roles("prod") + f""", t as (select {_TIMES}), src as (select product_id, category_name,
  cast(case when category_name = 'PROMO' then unit_price + 1 else unit_price end as decimal(19,4)) as unit_price,
  case when units_in_stock > 25 then units_in_stock + 5 else units_in_stock end as units_in_stock from prod)
select p.product_id, p.unit_price, s.units_in_stock, t1 as valid_from, cast(null as timestamp) as valid_to, true as is_current,
  case when s.units_in_stock <> p.units_in_stock then t2 else t1 end as dw_updated_at
from prod p join src s using (product_id), t where p.unit_price = s.unit_price
union all select p.product_id, p.unit_price, p.units_in_stock, t1, t2, false, t2
from prod p join src s using (product_id), t where p.unit_price <> s.unit_price
union all select s.product_id, s.unit_price, s.units_in_stock, t2, null, true, t2
from prod p join src s using (product_id), t where p.unit_price <> s.unit_price""")
def scd2_type1_product(s):
    """Second load of the products: a price change opens a version, a stock change does not."""
    tracked, stock = ["product_name", "unit_price", "category_name"], ["units_in_stock"]
    goods = s.src.products.select("product_id", *tracked, *stock)
    current = as_current(goods.withColumn("row_hash", scd_hash(*tracked)), "product_key", "product_id")
    price = F.when(F.col("category_name") == "PROMO", F.col("unit_price") + 1).otherwise(F.col("unit_price"))
    source = goods.withColumns({
        "unit_price": price.cast("decimal(19,4)"),
        "units_in_stock": F.when(F.col("units_in_stock") > 25, F.col("units_in_stock") + 5).otherwise(
            F.col("units_in_stock")),
    }).withColumn("row_hash", scd_hash(*tracked))
    versions = scd2_versions(current, source, "product_id", "product_key", instant(SECOND), 2, refresh=stock)
    return versions.select(
        "product_id", "unit_price", "units_in_stock", "valid_from", "valid_to", "is_current", "dw_updated_at")


# --- Type 1 and snapshot ------------------------------------------------------------------------------

@query("scd1_upsert", roles("cust") + """, tgt as (select * from cust where contact_title <> 'MACHINERY'),
src as (select customer_id, company_name, case when balance < 0 then phone || '*' else phone end as phone
        from cust where contact_title <> 'FURNITURE')
select coalesce(t.customer_id, s.customer_id) as customer_id, coalesce(s.phone, t.phone) as phone,
  case when t.customer_id is null then 'insert' when s.customer_id is null then 'absent'
       when s.phone <> t.phone then 'update' else 'keep' end as action,
  case when t.customer_id is null or s.phone <> t.phone then 2 else 1 end as dw_load_batch_id
from tgt t full join src s on s.customer_id = t.customer_id""")
def scd1_upsert(s):
    people = s.src.customers.select("customer_id", "company_name", "phone", "contact_title", "balance")
    target = people.filter(F.col("contact_title") != "MACHINERY").select(
        "customer_id", "company_name", "phone", F.lit(1).cast("bigint").alias("dw_load_batch_id"))
    source = people.filter(F.col("contact_title") != "FURNITURE").select(
        "customer_id", "company_name",
        F.when(F.col("balance") < 0, F.concat("phone", F.lit("*"))).otherwise(F.col("phone")).alias("phone"))
    merged = upsert(target, source, ["customer_id"], ["company_name", "phone"],
                    stamp={"dw_load_batch_id": F.lit(2)})
    return merged.select("customer_id", "phone", F.col("_action").alias("action"), "dw_load_batch_id")


def stamped(fact, batch):
    return fact.withColumn("dw_load_batch_id", F.lit(batch).cast("bigint"))


@query("snapshot_advance", with_facts("fo", body="""
select fo.order_id, shipped_date, shipped_date_key, days_to_ship, days_late, is_shipped, is_late,
  case when order_status <> 'F' and shipped_date is not null then 'update' else 'keep' end as action,
  case when order_status <> 'F' and shipped_date is not null then 2 else 1 end as dw_load_batch_id
from fo join ord on ord.order_id = fo.order_id"""))
def snapshot_advance(s):
    """Orders that were open in batch 1 have shipped by batch 2: their row advances, once."""
    headers = s.src.orders.join(s.order_facts, "order_id", "left")
    before = headers.withColumn("shipped_date", F.when(F.col("order_status") == "F", F.col("shipped_date")))
    compare = [c for c in facts.ORDER_COMPARE if c not in facts.SHIP_TO]
    merged = upsert(
        stamped(facts.fact_orders(before, None, s.keys), 1), facts.fact_orders(headers, None, s.keys),
        ["order_id"], compare, stamp={"dw_load_batch_id": F.lit(2)})
    return merged.select(
        "order_id", "shipped_date", "shipped_date_key", "days_to_ship", "days_late", "is_shipped", "is_late",
        F.col("_action").alias("action"), "dw_load_batch_id")


@query("rerun_noop", roles("line") + """
select cast(0 as bigint) as inserted, cast(0 as bigint) as updated, count(*) as kept from line""")
def rerun_noop(s):
    """Loading the same lines again changes nothing."""
    merged = upsert(stamped(s.fact_lines, 1), s.fact_lines, ["order_id", "product_id"], facts.LINE_COMPARE)
    return merged.agg(*[
        F.count_if(F.col("_action") == action).alias(name)
        for name, action in (("inserted", INSERT), ("updated", UPDATE), ("kept", KEEP))])


@query("late_key_resolution", roles("ord", "cust") + """
select o.order_id, case when c.contact_title = 'MACHINERY' then -1 else o.customer_id + 1 end as first_key,
  o.customer_id + 1 as customer_key, case when c.contact_title = 'MACHINERY' then 'update' else 'keep' end as action
from ord o join cust c on c.customer_id = o.customer_id""")
def late_key_resolution(s):
    """Orders that arrived before their customer sit on the unknown member until a later load."""
    known = s.src.customers.filter(F.col("contact_title") != "MACHINERY").select(
        "customer_id", (F.col("customer_id") + 1).alias("customer_key"))
    orders = s.src.orders.select("order_id", "customer_id")

    def load(customers):
        return facts.resolve(orders, {"dim_customer": customers}, facts.CUSTOMER_LOOKUP).select(
            "order_id", "customer_key")

    merged = upsert(
        load(known), load(s.keys["dim_customer"]), ["order_id"], ["customer_key"],
        pinned=pin_keys(["customer_key"]), remember=["customer_key"])
    return merged.select(
        "order_id", F.col("_old_customer_key").alias("first_key"), "customer_key", F.col("_action").alias("action"))


@query("surrogate_keys", """
select c_custkey as customer_id, row_number() over (order by c_custkey) as customer_key from customer""")
def surrogate_keys(s):
    return assign_keys(s.src.customers.select("customer_id"), "customer_key", ["customer_id"])


# --- dimension sources ----------------------------------------------------------------------------------

@query("product_source", roles("prod", "supp") + """, cat as (select category_name as category_id,
  upper(substr(category_name, 1, 1)) || lower(substr(category_name, 2)) as category_name,
  cast(count(*) as varchar) || ' products' as description from prod group by category_name),
j as (select p.product_id, p.product_name, p.unit_price, p.discontinued, p.supplier_id,
  coalesce(c.category_name, 'Unknown') as category_name, c.description as category_description,
  coalesce(s.company_name, 'Unknown') as supplier_name, s.country as supplier_country, s.city as supplier_city,
  s.contact_name as supplier_contact_name, c.category_id
  from prod p left join cat c on c.category_id = p.category_name left join supp s on s.supplier_id = p.supplier_id)
select product_id, category_name, category_description, supplier_name, supplier_country,
  md5(concat_ws('|', product_name, cast(unit_price as varchar), cast(discontinued as varchar),
    coalesce(category_id, '~NULL~'), category_name, coalesce(category_description, '~NULL~'), cast(supplier_id as varchar),
    supplier_name, coalesce(supplier_contact_name, '~NULL~'), coalesce(supplier_city, '~NULL~'),
    coalesce(supplier_country, '~NULL~'))) as row_hash from j""")
def product_source(s):
    goods = s.src.products.withColumnRenamed("category_name", "category_id").drop("supplier_name")
    joined = dimensions.product_source(goods, s.src.categories, s.src.suppliers, fingerprint=False)
    attributes = [c for c in dimensions.PRODUCT.tracked if c in joined.columns]  # those the given tables have
    return joined.withColumn("row_hash", scd_hash(*attributes)).select(
        "product_id", "category_name", "category_description", "supplier_name", "supplier_country", "row_hash")


@query("hierarchy_flatten", roles("emp") + """, named as (select employee_id as id, concat(first_name, ' ', last_name) as full_name, reports_to as boss from emp),
leads as (select boss, count(*) as reports from named where boss is not null group by boss)
select id as employee_id, full_name, named.boss as manager_employee_id,
  (select any_value(n.full_name) from named n where n.id = named.boss) as manager_name,
  coalesce(reports, 0) > 0 as is_manager from named left join leads on leads.boss = id""")
def hierarchy_flatten(s):
    return dimensions.employee_source(s.src.employees, fingerprint=False).select(
        "employee_id", "full_name", "manager_employee_id", "manager_name", "is_manager")


# --- landing --------------------------------------------------------------------------------------------

@query("row_count_report", """
with t as (select 'customer' as table_name, (select count(*) from customer) as actual, (select count(distinct c_custkey) from customer) as expected
union all select 'lineitem', (select count(*) from lineitem), (select count(*) from (select distinct l_orderkey, l_partkey from lineitem))
union all select 'orders', (select count(*) from orders), (select count(distinct o_orderkey) from orders))
select table_name, actual, expected, case when actual = expected then 'ok' else 'MISMATCH' end as status from t""")
def row_count_report_query(s):
    """Rows against distinct keys: a table that repeats its key reports a mismatch."""
    keys = {"customer": ["c_custkey"], "lineitem": ["l_orderkey", "l_partkey"], "orders": ["o_orderkey"]}
    expected = {t: s.raw(t).select(*k).distinct().agg(F.count(F.lit(1))).scalar() for t, k in keys.items()}
    return row_count_report({t: s.raw(t) for t in keys}, expected)


@query("staging_snapshot", """
select c_custkey as customer_id, c_name as company_name, cast(null as varchar) as contact_name,
       c_mktsegment as contact_title from customer""")
def staging_snapshot(s):
    """Customers and orders replaced together in a stored landing layer, then read back."""
    schema = struct("customer_id bigint, company_name string, contact_name string, contact_title string")
    landed = conform(s.src.customers, schema)
    store = WarehouseStore(s.spark, work_path(s.spark))
    publish_snapshot(store, {"customers": landed, "orders": s.src.orders}, "truncate and reload")
    return store.read("customers", schema)


_BUSY = """, busy as (select customer_id from ord where order_date >= timestamp '1997-01-01' and order_date < timestamp '1998-01-01'
group by 1 order by count(*) desc, customer_id limit 12),
kept as (select * from ord where order_date >= timestamp '1997-01-01' and order_date < timestamp '1998-01-01'
  and customer_id in (select customer_id from busy)) """


def subset_tables(s):
    return {"orders": s.src.orders, "order_details": s.src.line_items, "customers": s.src.customers}


@query("referential_subset", roles("item", "ord") + _BUSY + """
select i.order_id, i.product_id, i.quantity, i.gross as gross_amount from item i where i.order_id in (select order_id from kept)""")
def referential_subset(s):
    return subset.orders_and_lines(subset_tables(s), 1997, 12)["order_details"].select(
        "order_id", "product_id", "quantity", "gross_amount")


@query("referential_subset_staff", roles("ord", "emp").replace("with ", "with recursive ", 1) + _BUSY + """,
staff as (select distinct employee_id from kept union
  select e.reports_to from emp e join staff on staff.employee_id = e.employee_id where e.reports_to is not null)
select employee_id from staff""")
def referential_subset_staff(s):
    orders = subset.orders_and_lines(subset_tables(s), 1997, 12)["orders"]
    return subset.with_managers(s.src.employees, orders.select("employee_id"))



def all_staged(s):
    return {
        **subset_tables(s), "employees": s.src.employees, "shippers": s.src.shippers, "suppliers": s.src.suppliers,
        "products": s.src.products.withColumn("category_id", F.col("category_name")), "categories": s.src.categories}


@query("referential_subset_closure", roles("item", "ord", "emp", "prod", "supp").replace("with ", "with recursive ", 1) + _BUSY + """,
staff as (select distinct employee_id from kept union
  select e.reports_to from emp e join staff on staff.employee_id = e.employee_id where e.reports_to is not null),
sold as (select order_id, product_id from item where order_id in (select order_id from kept)),
goods as (select * from prod where product_id in (select product_id from sold))
select 'customers' as table_name, cast(customer_id as varchar) as id, cast(1 as bigint) as rows from busy
union all select 'orders', cast(order_id as varchar), 1 from kept
union all select 'order_details', order_id || '/' || product_id, count(*) from sold group by order_id, product_id
union all select 'products', cast(product_id as varchar), 1 from goods
union all select distinct 'categories', category_name, 1 from goods
union all select 'suppliers', cast(supplier_id as varchar), 1 from supp where supplier_id in (select supplier_id from goods)
union all select 'employees', cast(employee_id as varchar), 1 from staff where employee_id in (select employee_id from emp)
union all select distinct 'shippers', cast(ship_via as varchar), 1 from kept""")
def referential_subset_closure(s):
    """Ids of all tables of the subset, found by walking the declared keys from its orders and lines."""
    tables = all_staged(s)
    found = subset.closure(tables, subset.orders_and_lines(tables, 1997, 12))
    out = None
    for name, rows in found.items():
        ids = F.concat_ws("/", *[F.col(k).cast("string") for k in GRAINS[name]])
        part = rows.groupBy(ids.alias("id")).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "id", "rows")
        out = part if out is None else out.unionByName(part)
    return out


@query("dangling_references", roles("item", "ord", "emp", "prod", "supp", "ship", "cust") + """
select 'order_details.order_id' as reference, count(*) as rows from item where order_id % 5 = 0
union all select 'order_details.product_id', count(*) from item where product_id in (select product_id from prod where discontinued)
union all select 'orders.customer_id', count(*) from ord where order_id % 5 <> 0 and customer_id in (select customer_id from cust where balance < 0)
union all select 'orders.employee_id', count(*) from ord where order_id % 5 <> 0 and employee_id % 4 = 3
union all select 'orders.ship_via', count(*) from ord where order_id % 5 <> 0 and ship_via = 2
union all select 'products.category_id', 0 from (select 1)
union all select 'products.supplier_id', count(*) from prod where not discontinued and supplier_id not in (select supplier_id from supp)
union all select 'employees.reports_to', count(*) from emp where employee_id % 4 <> 3 and reports_to % 4 = 3""")
def dangling_references(s):
    """Rows without a parent when every fifth order, every fourth employee, customers in debt, products off the list
    and one shipper are missing."""
    tables = all_staged(s)
    return subset.dangling({
        **tables, "orders": tables["orders"].filter("order_id % 5 <> 0"), "employees": tables["employees"].filter("employee_id % 4 <> 3"),
        "customers": tables["customers"].join(s.raw("customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("customer_id")), "customer_id", "left_semi"),
        "products": tables["products"].filter("not discontinued"), "shippers": tables["shippers"].filter("shipper_id <> 2")})


LANDED = "customer_id bigint, company_name string, balance decimal(12,2), in_credit boolean"


@query("csv_landing_apart", """
with sent as (select c_custkey as id, c_name || case when c_custkey % 7 = 1 then chr(10) || 'said "so", twice' else '' end as name,
  cast(c_acctbal as decimal(12,2)) as balance from customer)
select case when id % 7 < 4 then id end as customer_id, case when id % 7 < 4 then name end as company_name,
  case when id % 7 < 4 then balance end as balance, case when id % 7 < 4 then balance >= 0 end as in_credit,
  case id % 7 when 4 then id || ',' || name || ',n/a,' || (balance >= 0) when 5 then 'no. ' || id || ',' || name || ',' || balance || ',' || (balance >= 0)
    when 6 then id || ',' || name || ',' || balance || ',maybe' end as rejected_line from sent""")
def csv_landing_apart(s):
    """Customers sent as CSV, some over two lines and some with values of a wrong type, landed and kept apart."""
    part = F.col("c_custkey") % 7
    balance = F.col("c_acctbal").cast("decimal(12,2)")
    sent = s.raw("customer").select(
        F.when(part == 5, F.concat(F.lit("no. "), "c_custkey")).otherwise(F.col("c_custkey").cast("string")).alias("customer_id"),
        F.when(part == 1, F.concat("c_name", F.lit('\nsaid "so", twice'))).otherwise(F.col("c_name")).alias("company_name"),
        F.when(part == 4, "n/a").otherwise(balance.cast("string")).alias("balance"),
        F.when(part == 6, "maybe").otherwise((balance >= 0).cast("string")).alias("in_credit"))
    path = work_path(s.spark)
    sent.write.options(header=True, escape='"').csv(path)
    rows, rejected = landing.read_csv_apart(s.spark, path, struct(LANDED), line_breaks=True)
    return rows.unionByName(rejected.select(landing.REJECTED), allowMissingColumns=True)


SENT_ORDERS = "order_id bigint, client_id* bigint, freight decimal(19,4), ship_via int, ship_city string"


@query("csv_landing_subset", """
select o_orderkey as order_id, o_custkey as customer_id, if(o_orderkey % 3 = 0, 0, cast(o_totalprice as decimal(19,4))) as freight,
       cast(3 as int) as ship_via, cast(null as varchar) as ship_city, 'web' as channel from orders""")
def csv_landing_subset(s):
    """Orders sent with three of the declared columns, one under an awkward header: landed, renamed, gaps filled."""
    sent = s.raw("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("client_id*"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice").cast("decimal(19,4)")).alias("freight"))
    path = work_path(s.spark)
    sent.write.option("header", True).csv(path)
    rows = landing.rename_columns(
        landing.read_csv(s.spark, path, struct(SENT_ORDERS), sent.columns), {"client_id*": "customer_id"})
    return landing.apply_defaults(rows, {"freight": F.lit(0).cast("decimal(19,4)"), "ship_via": F.lit(3), "channel": F.lit("web")})
