"""A small order system, invented for the tests."""

from datetime import datetime
from decimal import Decimal

from starloom.sources.landing import conform
from starloom.sources.schemas import STAGING, struct


def day(text):
    return datetime.fromisoformat(text) if text else None


CATEGORIES = [(1, "Tea", "leaves"), (2, "Tools", None)]
SUPPLIERS = [(1, "Leaf Ltd", "Ann Leaf", "Leeds", "UK"), (2, "Forge AG", "Max Eisen", "Essen", "Germany")]
# id, name, supplier, category, price, stock, on order, reorder level, discontinued
PRODUCTS = [
    (1, "Green tea", 1, 1, "10.0000", 5, 0, 1, False),
    (2, "Black tea", 1, 1, "18.0000", 8, 2, 1, False),
    (3, "Hammer", 2, 2, "40.0000", 3, 5, 2, True),
    (4, "Mystery", None, None, "7.5000", 1, 0, 0, False),
]
# id, company, contact, city, country, fax
CUSTOMERS = [
    ("AAAAA", "Alpha", "Al Pha", "Leeds", "UK", "111"),
    ("BBBBB", "Beta", "Bea Ta", "Essen", "Germany", None),
    ("CCCCC", "Gamma", "Gam Ma", "Lyon", "France", None),
]
# id, last, first, reports to, born, hired
EMPLOYEES = [
    (1, "Root", "Rita", None, "1960-01-01", "1990-01-01"),
    (2, "Stem", "Sam", 1, "1970-02-03", "1995-05-05"),
    (3, "Twig", "Tom", 2, "1980-03-04", "1999-09-09"),
]
SHIPPERS = [(1, "Fast", "1"), (2, "Slow", "2")]
# id, customer, employee, ordered, required, shipped, via, freight
ORDERS = [
    (10, "AAAAA", 2, "1997-01-05", "1997-01-20", "1997-01-10", 1, "5.0000"),
    (11, "AAAAA", 3, "1997-02-05", "1997-02-10", "1997-02-15", 2, "7.5000"),
    (12, "BBBBB", 3, "1998-03-01", "1998-03-10", None, 1, None),
    (13, "ZZZZZ", 2, "1998-03-02", "1998-03-20", "1998-03-05", 2, "1.0000"),
]
# order, product, price, quantity, discount
LINES = [
    (10, 2, "18.0000", 10, 0.25),
    (10, 1, "9.5000", 3, 0.0),
    (11, 3, "40.0000", 1, 0.15),
    (12, 1, "10.0000", 2, 0.05),
    (12, 4, "7.5000", 4, 0.0),
    (13, 2, "18.0000", 1, 0.0),
]


def staging(spark, customers=None, products=None, orders=None, lines=None, employees=None):
    """All landing tables as DataFrames; any of them may be replaced."""
    def table(name, columns, rows):
        return conform(spark.createDataFrame(rows, struct(columns)), STAGING[name])

    products = [(*p[:4], Decimal(p[4]), *p[5:]) for p in (products or PRODUCTS)]
    orders = [
        (*o[:3], day(o[3]), day(o[4]), day(o[5]), o[6], Decimal(o[7]) if o[7] else None)
        for o in (orders or ORDERS)
    ]
    lines = [(*line[:2], Decimal(line[2]), *line[3:]) for line in (lines or LINES)]
    staff = [(*e[:4], day(e[4]), day(e[5])) for e in (employees or EMPLOYEES)]
    return {
        "categories": table("categories", "category_id int, category_name string, description string", CATEGORIES),
        "suppliers": table(
            "suppliers", "supplier_id int, company_name string, contact_name string, city string, country string",
            SUPPLIERS),
        "products": table(
            "products",
            "product_id int, product_name string, supplier_id int, category_id int, unit_price decimal(19,4), "
            "units_in_stock smallint, units_on_order smallint, reorder_level smallint, discontinued boolean", products),
        "customers": table(
            "customers",
            "customer_id string, company_name string, contact_name string, city string, country string, fax string",
            customers or CUSTOMERS),
        "employees": table(
            "employees",
            "employee_id int, last_name string, first_name string, reports_to int, birth_date timestamp_ntz, "
            "hire_date timestamp_ntz", staff),
        "shippers": table("shippers", "shipper_id int, company_name string, phone string", SHIPPERS),
        "orders": table(
            "orders",
            "order_id int, customer_id string, employee_id int, order_date timestamp_ntz, required_date timestamp_ntz, "
            "shipped_date timestamp_ntz, ship_via int, freight decimal(19,4)", orders),
        "order_details": table(
            "order_details",
            "order_id int, product_id int, unit_price decimal(19,4), quantity smallint, discount float", lines),
    }
