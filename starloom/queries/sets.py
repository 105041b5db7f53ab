"""Set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.queries.base import query, roles
from starloom.queries.warehouse_marts import _DIRECTORY, directory

_SOLD_SQL = """, sold as (select distinct product_id from item),
off as (select product_id from prod where discontinued) """


def sold(s):
    """Products with a line, once each: duplicates go before the rows are shuffled."""
    return s.raw("lineitem").select(F.col("l_partkey").alias("product_id")).distinct()


def discontinued(s):
    return s.src.products.filter("discontinued").select("product_id")


@query("union_distinct", roles("cust", "supp", "emp") + f"""
select company_name, contact_name, phone from ({_DIRECTORY}) union
select company_name, contact_name, phone from ({_DIRECTORY}) where contact_type = 'Supplier'""")
def union_distinct(s):
    everybody = directory(s, with_type=False)
    suppliers = directory(s).filter(F.col("contact_type") == "Supplier").drop("contact_type")
    return everybody.union(suppliers).distinct()


@query("set_intersect", roles("item", "prod") + _SOLD_SQL + "select * from off intersect select * from sold")
def set_intersect(s):
    return discontinued(s).intersect(sold(s))


@query("set_except", roles("item", "prod") + _SOLD_SQL + """
select product_id, 'discontinued, never sold' as direction from (select * from off except select * from sold)
union all select product_id, 'sold, not discontinued' from (select * from sold except select * from off)""")
def set_except(s):
    off, had_lines = discontinued(s), sold(s)
    return off.subtract(had_lines).withColumn("direction", F.lit("discontinued, never sold")).unionByName(
        had_lines.subtract(off).withColumn("direction", F.lit("sold, not discontinued")))
