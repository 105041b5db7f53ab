"""Registered data-quality queries."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from starloom.functions import instant
from starloom.operators.joins import anti
from starloom.operators.keys import with_unknown
from starloom.plans import quality
from starloom.plans.calendar import calendar_covering
from starloom.plans.contracts import duplicate_keys, violations
from starloom.plans.dimensions import UNKNOWN_FROM
from starloom.queries.base import query, roles
from starloom.queries.warehouse import as_current
from starloom.queries.warehouse_marts import with_facts
from starloom.session import materialise


@query("dup_grain", """
select l_orderkey as order_id, l_partkey as product_id, count(*) as row_count from lineitem group by 1, 2 having count(*) > 1""")
def dup_grain(s):
    return duplicate_keys(s.src.line_items, ["order_id", "product_id"])


@query("orphan_lines", roles("item", "prod") + """
select product_id, count(*) as line_count from item
where product_id not in (select product_id from prod where not discontinued) group by 1""")
def orphan_lines(s):
    """Lines per product that is not on the current product list."""
    per_product = s.src.line_items.groupBy("product_id").agg(F.count(F.lit(1)).alias("line_count"))
    return anti(per_product, "product_id", s.src.products.filter("not discontinued"), "product_id")


@query("orders_without_lines", """
select o_orderkey as order_id, o_orderdate as order_date from orders
where o_orderkey not in (select l_orderkey from lineitem)""")
def orders_without_lines(s):
    return anti(s.src.orders.select("order_id", "order_date"), "order_id", s.src.line_items, "order_id")


@query("calendar_gaps", roles("ord") + """, span as (
select date_trunc('year', min(order_date)) as a, date_trunc('year', max(order_date)) + interval 1 year - interval 1 day as b
from ord), d as (select cast(unnest(generate_series(a, b, interval 1 day)) as date) as d from span)
select d as full_date from d where d not in (select cast(order_date as date) from ord)""")
def calendar_gaps(s):
    """Days of the covered years on which nothing was ordered."""
    days = calendar_covering(s.src.orders, "order_date").select("full_date")
    ordered = s.src.orders.select(F.col("order_date").cast("date").alias("day"))
    return anti(days, "full_date", ordered, "day")


@query("contract_violations", with_facts("fl", "fo", body="""
select 'fact_sales_order_line' as table_name, 'quantity' as contract, (select count(*) from fl where quantity <= 0) as violations
union all select 'fact_sales_order_line', 'unit_price', (select count(*) from fl where unit_price < 0)
union all select 'fact_sales_order_line', 'discount', (select count(*) from fl where discount_pct < 0 or discount_pct > 1)
union all select 'fact_order_fulfilment', 'freight', (select count(*) from fo where freight_amount < 0)
union all select 'fact_order_fulfilment', 'line_count', (select count(*) from fo where order_line_count < 0)
union all select 'fact_order_fulfilment', 'ship_after_order', (select count(*) from fo where shipped_date < order_date)"""))
def contract_violations(s):
    return violations(s.fact_lines, "fact_sales_order_line").unionByName(
        violations(s.fact_orders, "fact_order_fulfilment"))


# --- suites -----------------------------------------------------------------------------------------

def measured(s) -> quality.Measured:
    """A first load over the given tables, with both facts written out, and its staging.

    The checks read the facts many times; they start from the written tables, as they would in a
    stored warehouse. Staged lines are the rows as delivered, which repeat some keys.
    """
    def dimension(df, key, natural, **unknown):
        opened = as_current(df, key, natural).withColumn("row_hash", F.md5(F.col(natural).cast("string")))
        return with_unknown(opened, key, {
            natural: -1, "valid_from": instant(UNKNOWN_FROM), "is_current": True, **unknown})

    staff = s.dims["dim_employee"].drop("employee_key").withColumn("birth_date", F.lit(None).cast("date"))
    built = [s.fact_lines.withColumn("dw_load_batch_id", F.lit(1).cast("bigint")), s.fact_orders]
    with ThreadPoolExecutor(len(built)) as pool:
        line, order = pool.map(materialise, built)
    lines = s.src.line_items.withColumn("net_amount", F.col("gross_amount") - F.col("discount_amount"))
    return quality.Measured(
        staging={
            "customers": s.src.customers, "employees": s.src.employees, "orders": s.src.orders,
            "order_details": lines, "categories": s.src.categories,
            "products": s.src.products.withColumn("category_id", F.col("category_name")),
        },
        warehouse={
            "dim_customer": dimension(s.src.customers, "customer_key", "customer_id", company_name="Unknown"),
            "dim_product": dimension(s.dims["dim_product"].drop("product_key"), "product_key", "product_id", product_name="Unknown"),
            "dim_employee": dimension(staff, "employee_key", "employee_id", full_name="Unknown"),
            "dim_shipper": with_unknown(s.dims["dim_shipper"], "shipper_key", {"shipper_id": -1, "company_name": "Unknown"}),
            "dim_date": s.dims["dim_date"],
            "fact_sales_order_line": line, "fact_order_fulfilment": order,
        },
    )


def _suite_sql(checks, actual: dict[str, str], expected: dict[str, str] | None = None) -> str:
    expected = expected or {}
    rows = [
        f"select '{k.check_id}' as check_id, '{k.category}' as category, '{k.severity}' as severity, "
        f"cast(({expected.get(k.check_id) or ('null' if k.expected is None else repr(k.expected))}) as varchar) as expected, "
        f"cast(({actual.get(k.check_id, 'null')}) as varchar) as actual"
        for k in checks
    ]
    return "checks as (" + " union all ".join(rows) + ")"


def _n(table: str, where: str) -> str:
    return f"select count(*) from {table} where {where}"


def _dup(table: str, keys: str) -> str:
    return f"select count(*) from (select {keys} from {table} group by {keys} having count(*) > 1)"


VALIDATION_SQL = {
    "DUP-001": _dup("fl", "order_id, product_id"), "DUP-002": _dup("fo", "order_id"),
    "DUP-003": _dup("cust", "customer_id"), "DUP-004": _dup("prod", "product_id"),
    "DUP-005": _dup("emp", "employee_id"), "DUP-006": _dup("ship", "shipper_id"),
    "DUP-007": _dup("item", "order_id, product_id"),
    "SCD-001": _dup("cust", "customer_id"), "SCD-002": _dup("prod", "product_id"), "SCD-003": _dup("emp", "employee_id"),
    "SCD-004": "select 0", "SCD-005": _dup("cust", "customer_id"), "SCD-006": "select 0",
    "RI-001": _n("fl", "order_date_key not in (select date_key from days)"),
    "RI-002": _n("fl", "customer_key = -1"), "RI-003": _n("fl", "product_key = -1"), "RI-004": _n("fl", "order_date_key = -1"),
    "RI-005": _n("item", "order_id not in (select order_id from ord)"),
    "RI-006": _n("item", "product_id not in (select product_id from prod)"),
    "RI-007": _n("ord", "customer_id not in (select customer_id from cust)"), "RI-008": "select 0",
    "RI-009": _n("ord", "order_id not in (select order_id from item)"),
    "NUL-001": _n("cust", "company_name is null"), "NUL-002": _n("prod", "product_name is null"),
    "NUL-003": _n("emp", "first_name || last_name is null"), "NUL-004": "select 0", "NUL-005": "select 0",
    "NUL-006": _n("ord", "customer_id is null"), "NUL-007": _n("ord", "order_date is null"),
    "BIZ-001": "select 0", "BIZ-002": _n("emp", "reports_to = employee_id"),
    "BIZ-003": _n("fl", "discount_pct < 0 or discount_pct > 1"), "BIZ-004": _n("fl", "quantity <= 0"),
    "BIZ-005": _n("fl", "net_amount > gross_amount"), "BIZ-006": _n("fo", "shipped_date < order_date"),
    "BIZ-007": _n("fo", "freight_amount < 0"),
    "BIZ-008": "select date_diff('day', min(full_date), max(full_date)) + 1 - count(*) from days",
    "BIZ-009": _n("days", "date_key <> cast(strftime(full_date, '%Y%m%d') as int)"),
}


def _total(table: str, e: str) -> str:
    return f"select cast(round(sum({e}), 2) as decimal(38,2)) from {table}"


QUALITY_SQL = {
    "REC-001": "select count(*) from fl", "REC-002": "select count(*) from fo",
    "REC-003": _total("fl", "net_amount"), "REC-004": _total("fl", "gross_amount"), "REC-005": _total("fo", "freight_amount"),
    "REC-006": "select count(*) from fo left join (select order_id, count(*) n from fl group by 1) l "
               "on l.order_id = fo.order_id where order_line_count <> coalesce(n, 0)",
    "REC-007": "select count(*) from cust", "REC-008": "select count(*) from prod", "REC-009": "select count(*) from emp",
    "REC-010": _total("fl", "net_amount"), "REC-011": "select count(*) from fl",
    "STR-001": "select 0", "STR-002": "select 3",
    "STR-003": "select (select cast(count(*) = 0 as int) from (select 1 from fl group by order_id, product_id having count(*) > 1))"
               " + (select cast(count(*) = 0 as int) from (select 1 from fo group by order_id having count(*) > 1))",
    "STR-005": "select 5", "STR-007": "select 14",
}
QUALITY_EXPECTED_SQL = {
    "REC-001": "select count(*) from item", "REC-002": "select count(*) from ord",
    "REC-003": _total("item", "gross - disc"), "REC-004": _total("item", "gross"), "REC-005": _total("ord", "freight"),
    "REC-007": "select count(*) from cust", "REC-008": "select count(*) from prod", "REC-009": "select count(*) from emp",
    "REC-010": _total("fl", "net_amount"), "REC-011": "select count(*) from fl",
}

_RESULT = """select c.*, s.status from checks c join (values ('NOT RUN', 0), ('PASS', 1), ('FAIL', 2)) as s(status, code)
on s.code = if(c.actual is null, 0, if(coalesce(c.expected, '') = c.actual, 1, 2))"""
_PER_CHECK = "select category, severity = 'ERROR' as stops, cast(status = 'PASS' as int) as good from (" + _RESULT + ")"
_SUMMED = """count(*) as n_checks, cast(sum(good) as bigint) as n_passed,
cast(sum(if(stops, 1 - good, 0)) as bigint) as n_open_errors, cast(sum(if(stops, 0, 1 - good)) as bigint) as n_open_warnings"""
_SUMMARY = f"""select category, {_SUMMED} from ({_PER_CHECK}) group by category
union all select null, {_SUMMED} from ({_PER_CHECK})"""


def _suite(checks, actual, expected, tail):
    return with_facts("fl", "fo", extra="days", body=", " + _suite_sql(checks, actual, expected) + " " + tail)


RESULT_COLUMNS = ["check_id", "category", "severity", "expected", "actual", "status"]


@query("validation_results", _suite(quality.VALIDATION, VALIDATION_SQL, None, _RESULT))
def validation_results(s):
    return quality.validation_results(measured(s)).select(*RESULT_COLUMNS)


@query("validation_summary", _suite(quality.VALIDATION, VALIDATION_SQL, None, _SUMMARY))
def validation_summary(s):
    return quality.summary(quality.validation_results(measured(s)))


@query("quality_results", _suite(quality.QUALITY, QUALITY_SQL, QUALITY_EXPECTED_SQL, _RESULT))
def quality_results(s):
    return quality.quality_results(measured(s)).select(*RESULT_COLUMNS)


@query("quality_summary", _suite(quality.QUALITY, QUALITY_SQL, QUALITY_EXPECTED_SQL, _SUMMARY))
def quality_summary(s):
    return quality.summary(quality.quality_results(measured(s)))

