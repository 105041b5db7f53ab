"""Small, referentially complete extract of an order system."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import in_days
from starloom.operators.joins import key_set, semi
from starloom.plans.evidence import Evidence
from starloom.session import materialise
from starloom.sources.schemas import REFERENCES


class IncompleteSubset(ValueError):
    """The extract is empty or holds a reference that does not resolve inside it."""


def busiest_customers(orders: DataFrame, n: int) -> DataFrame:
    """The n customers with the most orders; equal counts are settled by id."""
    counts = orders.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "customer_id").limit(n).select("customer_id")


def with_managers(employees: DataFrame, ids: DataFrame) -> DataFrame:
    """Ids closed over the reporting line. One round per level of the hierarchy.

    Each round joins the managers of the last level. A level is written once; together they are the
    known ids.
    """
    lines = employees.select("employee_id", "reports_to")
    known = materialise(ids.select(F.col("employee_id")).distinct())
    level = known
    while True:
        above = key_set(
            lines.join(level, "employee_id", "left_semi"), "reports_to", "employee_id"
        ).join(known, "employee_id", "left_anti")
        level = materialise(above)
        if level.isEmpty():
            return known
        known = known.unionByName(level)


def orders_and_lines(tables: Mapping[str, DataFrame], year: int, n: int) -> dict[str, DataFrame]:
    """The year's orders of its n busiest customers, with their lines."""
    of_year = tables["orders"].filter(in_days("order_date", date(year, 1, 1), date(year + 1, 1, 1)))
    # At most n rows by construction, so this side is safe to send everywhere.
    chosen = F.broadcast(busiest_customers(of_year, n))
    orders = of_year.join(chosen, "customer_id", "left_semi")
    return {
        "customers": tables["customers"].join(chosen, "customer_id", "left_semi"),
        "orders": orders,
        "order_details": semi(tables["order_details"], "order_id", orders, "order_id", unique=True),
    }


def closure(
    tables: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame],
    references: Mapping[str, Mapping[str, tuple[str, str]]] = REFERENCES,
) -> dict[str, DataFrame]:
    """The seeds and every row of `tables` they refer to, directly or through other rows.

    A walk over the declared keys: each round takes the rows the last one added, asks for the parents
    they name that are not kept yet, and writes those. It ends when a round adds nothing, after as many
    rounds as the longest path of references has steps, so cycles and hierarchies need no case of their
    own. NULL keys and keys without a parent add nothing; `dangling` counts the latter.
    """
    kept = {t: [materialise(rows)] for t, rows in seeds.items()}
    fresh = {t: frames[0] for t, frames in kept.items()}
    while fresh:
        wanted: dict[str, DataFrame] = {}
        for child, rows in fresh.items():
            for column, (parent, key) in references.get(child, {}).items():
                if column in rows.columns and parent in tables:
                    keys = key_set(rows, column, key)
                    wanted[parent] = wanted[parent].unionByName(keys) if parent in wanted else keys
        fresh = {}
        for parent, keys in wanted.items():
            key = keys.columns[0]
            keys = keys.distinct()
            for known in kept.get(parent, []):
                keys = keys.join(known.select(key), key, "left_anti")
            rows = materialise(semi(tables[parent], key, keys, key, unique=True))
            if not rows.isEmpty():
                fresh[parent] = rows
                kept.setdefault(parent, []).append(rows)
    return {t: reduce(DataFrame.unionByName, frames) for t, frames in kept.items()}


def dangling(
    tables: Mapping[str, DataFrame], references: Mapping[str, Mapping[str, tuple[str, str]]] = REFERENCES,
) -> DataFrame:
    """(reference, rows): rows per declared reference whose key is in no row of the parent. One read per table."""
    questions = Evidence(tables)
    for child, columns in references.items():
        for column, (parent, key) in columns.items():
            if child in tables and parent in tables and column in tables[child].columns:
                questions.refers(child, column, parent, key, orphans=f"{child}.{column}")
    return questions.measures().select(F.col("check_id").alias("reference"), F.col("number").alias("rows"))


def referential_subset(tables: Mapping[str, DataFrame], year: int, n: int) -> dict[str, DataFrame]:
    """Busiest customers of a year, their orders and lines, and everything those refer to."""
    out = closure(tables, orders_and_lines(tables, year, n))
    verify(out)
    return out


def verify(subset: Mapping[str, DataFrame]) -> None:
    """Raise when a reference dangles or the extract is empty."""
    # At most one row per declared reference.
    lost = dangling(subset).filter(F.col("rows") > 0).orderBy("reference").collect()
    if lost:
        raise IncompleteSubset("; ".join(f"{r.reference}: {r.rows} rows without a parent" for r in lost))
    for table in ("customers", "orders", "order_details"):
        if subset[table].isEmpty():
            raise IncompleteSubset(f"{table} is empty: the selection matched nothing")
