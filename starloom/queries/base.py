"""Query registry, and the staging roles written as SQL for the comparison queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from starloom.plans.star import DeclaredStar
from starloom.session import prepare


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[DeclaredStar], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(DeclaredStar(prepare(spark), folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a builder under `name`, with the SQL that must give the same rows."""

    def register(build: Callable[[DeclaredStar], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return register


# --- roles as SQL -----------------------------------------------------------------------------------

ROLES = {
    "cust": """select c_custkey as customer_id, c_name as company_name, c_mktsegment as contact_title,
        n_name as country, r_name as city, cast(c_acctbal as decimal(19,4)) as balance,
        cast(c_nationkey + 10 as varchar) || '-' || lpad(cast(c_custkey as varchar), 7, '0') as phone,
        case when c_acctbal >= 0
             then cast(c_nationkey + 10 as varchar) || '-' || lpad(cast(c_custkey as varchar), 7, '0') end as fax
        from customer left join nation on c_nationkey = n_nationkey
        left join region on n_regionkey = r_regionkey""",
    "prod": """select p_partkey as product_id, p_name as product_name, p_type as category_name,
        p_brand as supplier_name, cast(split_part(p_brand, '#', 2) as bigint) as supplier_id,
        cast(p_retailprice as decimal(19,4)) as unit_price, p_size as units_in_stock,
        50 - p_size as units_on_order, 10 as reorder_level, p_size > 45 as discontinued from part""",
    "supp": """select s_suppkey as supplier_id, s_name as company_name, s_name as contact_name,
        r_name as city, n_name as country, '+' || cast(s_suppkey as varchar) as phone
        from supplier left join nation on s_nationkey = n_nationkey
        left join region on n_regionkey = r_regionkey""",
    "emp": """select s_suppkey as employee_id, split_part(s_name, '#', 1) as first_name,
        split_part(s_name, '#', 2) as last_name, n_name as country, r_name as city,
        case when s_suppkey <> 0 then s_suppkey // 10 end as reports_to,
        'x' || cast(s_suppkey as varchar) as extension,
        case when s_suppkey = 0 then 'Head' else 'Representative' end as title
        from supplier left join nation on s_nationkey = n_nationkey
        left join region on n_regionkey = r_regionkey""",
    "ship": """select distinct cast(substr(o_orderpriority, 1, 1) as int) as shipper_id,
        substr(o_orderpriority, 3) as company_name from orders""",
    "ord": """select o_orderkey as order_id, o_custkey as customer_id,
        o_orderkey % (select count(*) from supplier) as employee_id, o_orderdate as order_date,
        o_orderdate + interval 60 day as required_date,
        cast(substr(o_orderpriority, 1, 1) as int) as ship_via,
        cast(o_totalprice as decimal(19,4)) as freight, o_orderstatus as order_status from orders""",
    "item": """select l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as bigint) as quantity,
        cast(l_extendedprice as decimal(19,4)) as gross,
        cast(cast(l_extendedprice as decimal(19,4)) * cast(l_discount as decimal(5,4)) as decimal(21,4)) as disc,
        l_shipdate as shipped from lineitem""",
    "line": """select order_id, product_id, cast(sum(quantity) as bigint) as quantity,
        cast(sum(gross) as decimal(21,4)) as gross, cast(sum(disc) as decimal(21,4)) as disc,
        cast(sum(gross) - sum(disc) as decimal(21,4)) as net, max(shipped) as shipped
        from item group by order_id, product_id""",
    "shipment": """select order_id, max(shipped) as shipped_date, cast(count(*) as int) as line_count
        from line group by order_id""",
    "osh": """select ord.*, shipped_date, coalesce(line_count, 0) as line_count
        from ord left join shipment on shipment.order_id = ord.order_id""",
    "days": """select cast(d as date) as full_date,
        cast(year(d) * 10000 + month(d) * 100 + day(d) as int) as date_key
        from generate_series(timestamp '1994-01-01', timestamp '2002-12-31', interval 1 day) as g(d)""",
}
_NEEDS = {"line": ["item"], "shipment": ["line"], "osh": ["ord", "shipment"]}


def roles(*names: str) -> str:
    """WITH clause defining the roles and what they are built from."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "with " + ", ".join(f"{n} as ({ROLES[n]})" for n in ordered) + " "


def sql_percent(part: str, whole: str) -> str:
    """Exact half-up percentage at two places from two amounts with four places."""
    p, w = f"cast(({part}) * 10000 as hugeint)", f"cast(({whole}) * 10000 as hugeint)"
    return (
        f"cast(cast((2 * {p} * 10000 + {w}) // nullif(2 * {w}, 0) as decimal(18,0))"
        " * cast(0.01 as decimal(3,2)) as decimal(9,2))"
    )


def sql_mean(total: str, n: str, places: int = 2) -> str:
    """Exact mean, half away from zero, of a total with up to four places."""
    t = f"cast(({total}) * 10000 as hugeint)"
    k = f"cast({n} as hugeint)"
    unit = {1: "cast(0.1 as decimal(2,1))", 2: "cast(0.01 as decimal(3,2))", 4: "cast(0.0001 as decimal(5,4))"}[places]
    size = f"(2 * abs({t}) * {10 ** places} + 10000 * {k}) // nullif(20000 * {k}, 0)"
    return f"cast(cast(sign({t}) * ({size}) as decimal(18,0)) * {unit} as decimal(19,{places}))"


def sql_ratio4(top: str, bottom: str, kind: str) -> str:
    """Exact half-up quotient at four places of two positive amounts with four places."""
    t, b = f"cast(({top}) * 10000 as hugeint)", f"cast(({bottom}) * 10000 as hugeint)"
    return (
        f"cast(cast((2 * {t} * 10000 + {b}) // nullif(2 * {b}, 0) as decimal(18,0))"
        f" * cast(0.0001 as decimal(5,4)) as {kind})"
    )


def date_key_sql(day: str) -> str:
    return f"coalesce(cast(year({day}) * 10000 + month({day}) * 100 + day({day}) as int), -1)"
