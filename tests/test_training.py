"""Training routines over small tables with results worked out by hand."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starloom.plans import training
from starloom.plans.contracts import ContractViolation, assert_contracts
from starloom.sources import subset
from starloom.sources.schemas import TRAINING, struct
from starloom.sources.store import WarehouseStore, publish_snapshot


@pytest.fixture(scope="module")
def courses(spark):
    def table(name, rows):
        return spark.createDataFrame(rows, TRAINING[name])

    return {
        "vendor": table("vendor", [(1, "V1", "a", None), (2, "V2", "b", None)]),
        "course": table("course", [(10, "SQL basics", 1), (11, "SQL advanced", 1), (20, "lower case", 2)]),
        "run": table("course_run", [(1, 10, 1, date(2016, 1, 1), 2), (2, 11, 1, date(2016, 2, 1), 3),
                                    (3, 20, 1, date(2016, 3, 1), 5), (4, 10, 1, date(2016, 4, 1), 2)]),
        "attendance": table("delegate_attendance", [(1, 1, 7), (2, 2, 7), (3, 3, 7), (4, 4, 7), (5, 1, 8), (6, 2, 8)]),
        "delegate": table("delegate", [(7, "Seven", None), (8, "Eight", None), (9, "Nine", None)]),
    }


def test_days_and_names_per_delegate(courses):
    days = training.delegate_days(courses["run"], courses["attendance"], courses["delegate"])
    assert sorted(map(tuple, days.collect())) == [(7, 4, 12), (8, 2, 5), (9, 0, 0)]
    assert training.for_entity(days, "delegate_id", 8).first().number_days == 5
    names = training.delegate_courses(courses["run"], courses["attendance"], courses["course"])
    assert {r.delegate_id: r.courses for r in names.collect()} == {
        7: "SQL advanced, SQL basics, SQL basics, lower case", 8: "SQL advanced, SQL basics"}


def test_counts_rollup_cube_and_sets(courses):
    args = (courses["vendor"], courses["course"], courses["run"], courses["attendance"])
    assert {(r.vendor_name, r.course_name): r.number_delegates for r in training.vendor_course_counts(*args).collect()} == {
        ("V1", "SQL basics"): 3, ("V1", "SQL advanced"): 2, ("V2", "lower case"): 1}
    dated = training.vendor_course_counts(*args, by_date=True)
    assert dated.count() == 4
    keys = ["vendor_name", "course_name", "start_date"]
    total = F.sum("number_delegates").alias("n")
    assert dated.rollup(*keys).agg(total).count() == 4 + 3 + 2 + 1
    assert dated.cube(*keys).agg(total).filter("vendor_name is null and course_name is null and start_date is null").first().n == 6


def test_stock_counts_all_movements_then_purges(spark, tmp_path):
    moves = spark.createDataFrame(
        [(1, datetime(2011, 1, 1), "Start", 46), (1, datetime(2012, 1, 1), "Out", -15), (1, datetime(2015, 1, 1), "Out", -1),
         (2, datetime(2016, 1, 1), "Start", 5)], TRAINING["book_transfers"])
    stock, left = training.reset_stock(moves)
    assert sorted(map(tuple, stock.collect())) == [(1, 30), (2, 5)]
    assert left.count() == 2
    assert sorted(map(tuple, training.rebuild_stock(left).collect())) == [(1, 31)]
    store = WarehouseStore(spark, str(tmp_path))
    publish_snapshot(store, {"book_stock": stock, "book_transfers": left}, "reset")
    assert store.read("book_stock", stock.schema).count() == 2
    assert store.read("book_transfers", left.schema).count() == 2
    short = spark.createDataFrame([(1, datetime(2011, 1, 1), "Out", -4)], TRAINING["book_transfers"])
    with pytest.raises(ContractViolation):
        assert_contracts(training.rebuild_stock(short), "book_stock")


def test_composite_key_join(spark):
    contact = spark.createDataFrame([(1, "A", "Ann"), (1, "B", "Bob"), (2, "A", "Cy")], struct("company_no int, contact_code string, name string"))
    sale = spark.createDataFrame([(100, 1, "B"), (101, 2, "A"), (102, 2, "B")], struct("order_no int, company_no int, contact_code string"))
    assert {r.order_no: r.name for r in sale.join(contact, ["company_no", "contact_code"], "left").collect()} == {
        100: "Bob", 101: "Cy", 102: None}


def test_subset_is_closed(spark):
    import orders_fixture as fx

    tables = fx.staging(spark)
    known = tables["orders"].filter("customer_id <> 'ZZZZZ'")
    out = subset.referential_subset({**tables, "orders": known}, 1997, 1)
    ids = {t: sorted(r[0] for r in df.select(k).collect()) for t, df, k in (
        (t, out[t], k) for t, k in (("customers", "customer_id"), ("orders", "order_id"), ("employees", "employee_id"),
                                    ("products", "product_id"), ("categories", "category_id")))}
    assert ids == {"customers": ["AAAAA"], "orders": [10, 11], "employees": [1, 2, 3], "products": [1, 2, 3], "categories": [1, 2]}
    with pytest.raises(subset.IncompleteSubset, match="empty"):
        subset.referential_subset(tables, 1901, 3)
    with pytest.raises(subset.IncompleteSubset, match="customer_id"):
        subset.verify({**out, "customers": out["customers"].limit(0)})
