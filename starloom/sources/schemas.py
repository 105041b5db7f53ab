"""Declared schemas and grains. Files are never read with an inferred schema."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(), "smallint": T.ShortType(), "bigint": T.LongType(), "float": T.FloatType(),
    "string": T.StringType(), "boolean": T.BooleanType(), "binary": T.BinaryType(), "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(19,4)": T.DecimalType(19, 4), "decimal(12,4)": T.DecimalType(12, 4),
    "decimal(21,4)": T.DecimalType(21, 4), "decimal(5,4)": T.DecimalType(5, 4),
    "decimal(12,2)": T.DecimalType(12, 2),
}


def struct(columns: str) -> T.StructType:
    """`name type, name type, ...` as a schema, usable before a session exists."""
    pairs = [c.split() for c in re.split(r",\s+", columns.strip())]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The landing tables, their column order and types.
_STAGING = {
    "categories": "category_id int, category_name string, description string, picture binary",
    "customers": "customer_id string, company_name string, contact_name string, contact_title string, "
    "address string, city string, region string, postal_code string, country string, phone string, fax string",
    "employees": "employee_id int, last_name string, first_name string, title string, "
    "title_of_courtesy string, birth_date timestamp_ntz, hire_date timestamp_ntz, address string, "
    "city string, region string, postal_code string, country string, home_phone string, "
    "extension string, photo binary, notes string, reports_to int, photo_path string",
    "shippers": "shipper_id int, company_name string, phone string",
    "suppliers": "supplier_id int, company_name string, contact_name string, contact_title string, "
    "address string, city string, region string, postal_code string, country string, phone string, "
    "fax string, home_page string",
    "products": "product_id int, product_name string, supplier_id int, category_id int, "
    "quantity_per_unit string, unit_price decimal(19,4), units_in_stock smallint, "
    "units_on_order smallint, reorder_level smallint, discontinued boolean",
    "orders": "order_id int, customer_id string, employee_id int, order_date timestamp_ntz, "
    "required_date timestamp_ntz, shipped_date timestamp_ntz, ship_via int, freight decimal(19,4), "
    "ship_name string, ship_address string, ship_city string, ship_region string, "
    "ship_postal_code string, ship_country string",
    "order_details": "order_id int, product_id int, unit_price decimal(19,4), quantity smallint, discount float",
    "region": "region_id int, region_description string",
    "territories": "territory_id string, territory_description string, region_id int",
    "employee_territories": "employee_id int, territory_id string",
    "customer_demographics": "customer_type_id string, customer_desc string",
    "customer_customer_demo": "customer_id string, customer_type_id string",
}

# The training tables used by the exercise queries.
_TRAINING = {
    "company": "company_no int, name string, tel string, county string, post_code string",
    "dept": "dept_no int, dept_name string, manager string, sales_target decimal(12,4)",
    "contact": "company_no int, contact_code string, name string, job_title string, tel string, notes string",
    "salesperson": "emp_no int, fname string, lname string, dept_no int, sales_target decimal(12,4), "
    "county string, post_code string, tel string, notes string",
    "sale": "order_no int, emp_no int, their_order_no string, company_no int, contact_code string, "
    "order_value int, order_date timestamp_ntz, description string",
    "vendor": "vendor_id int, vendor_name string, contact_name string, phone_number string",
    "course": "course_id int, course_name string, vendor_id int",
    "trainer": "trainer_id int, trainer_name string, phone_number string",
    "delegate": "delegate_id int, delegate_name string, company_name string",
    "course_run": "course_run_id int, course_id int, trainer_id int, start_date date, duration_days int",
    "delegate_attendance": "attendance_id int, course_run_id int, delegate_id int",
    "book_transfers": "product_id int, transfer_date timestamp_ntz, transfer_reason string, transfer_amount int",
    "book_stock": "product_id int, stock_amount int",
    "revenue": "department_id int, revenue int, revenue_year int",
}

STAGING: dict[str, T.StructType] = {name: struct(ddl) for name, ddl in _STAGING.items()}
TRAINING: dict[str, T.StructType] = {name: struct(ddl) for name, ddl in _TRAINING.items()}

# Fixed-width text of the source is blank padded; it is trimmed on landing.
PADDED = {
    "customers": ["customer_id"],
    "orders": ["customer_id"],
    "region": ["region_description"],
    "territories": ["territory_description"],
    "customer_demographics": ["customer_type_id"],
    "customer_customer_demo": ["customer_id", "customer_type_id"],
    "company": ["tel", "post_code"],
    "dept": ["dept_name", "manager"],
    "contact": ["contact_code", "tel"],
    "salesperson": ["post_code"],
    "sale": ["contact_code"],
}

# Tables with long remarks that may contain line breaks.
FREE_TEXT = {"employees"}

# Columns that identify one row of each table.
GRAINS: dict[str, list[str]] = {
    "categories": ["category_id"],
    "customers": ["customer_id"],
    "employees": ["employee_id"],
    "shippers": ["shipper_id"],
    "suppliers": ["supplier_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_details": ["order_id", "product_id"],
    "region": ["region_id"],
    "territories": ["territory_id"],
    "employee_territories": ["employee_id", "territory_id"],
    "customer_demographics": ["customer_type_id"],
    "customer_customer_demo": ["customer_id", "customer_type_id"],
    "dim_date": ["date_key"],
    "dim_customer": ["customer_key"],
    "dim_product": ["product_key"],
    "dim_employee": ["employee_key"],
    "dim_shipper": ["shipper_key"],
    "fact_sales_order_line": ["order_id", "product_id"],
    "fact_order_fulfilment": ["order_id"],
    "company": ["company_no"],
    "dept": ["dept_no"],
    "contact": ["company_no", "contact_code"],
    "salesperson": ["emp_no"],
    "sale": ["order_no"],
    "vendor": ["vendor_id"],
    "course": ["course_id"],
    "trainer": ["trainer_id"],
    "delegate": ["delegate_id"],
    "course_run": ["course_run_id"],
    "delegate_attendance": ["attendance_id"],
}

WAREHOUSE_TABLES = [
    "dim_date", "dim_customer", "dim_product", "dim_employee", "dim_shipper",
    "fact_sales_order_line", "fact_order_fulfilment",
]

# Foreign keys of the star: fact column -> (dimension, dimension key).
FOREIGN_KEYS: dict[str, dict[str, tuple[str, str]]] = {
    "fact_sales_order_line": {
        "customer_key": ("dim_customer", "customer_key"),
        "product_key": ("dim_product", "product_key"),
        "employee_key": ("dim_employee", "employee_key"),
        "shipper_key": ("dim_shipper", "shipper_key"),
        "order_date_key": ("dim_date", "date_key"),
        "required_date_key": ("dim_date", "date_key"),
        "shipped_date_key": ("dim_date", "date_key"),
    },
    "fact_order_fulfilment": {
        "customer_key": ("dim_customer", "customer_key"),
        "employee_key": ("dim_employee", "employee_key"),
        "shipper_key": ("dim_shipper", "shipper_key"),
        "order_date_key": ("dim_date", "date_key"),
        "required_date_key": ("dim_date", "date_key"),
        "shipped_date_key": ("dim_date", "date_key"),
    },
}

# Foreign keys of the landing tables: child -> column -> (parent, its key).
REFERENCES: dict[str, dict[str, tuple[str, str]]] = {
    "order_details": {"order_id": ("orders", "order_id"), "product_id": ("products", "product_id")},
    "orders": {
        "customer_id": ("customers", "customer_id"), "employee_id": ("employees", "employee_id"),
        "ship_via": ("shippers", "shipper_id"),
    },
    "products": {"category_id": ("categories", "category_id"), "supplier_id": ("suppliers", "supplier_id")},
    "employees": {"reports_to": ("employees", "employee_id")},
    "territories": {"region_id": ("region", "region_id")},
    "employee_territories": {"employee_id": ("employees", "employee_id"), "territory_id": ("territories", "territory_id")},
    "customer_customer_demo": {
        "customer_id": ("customers", "customer_id"), "customer_type_id": ("customer_demographics", "customer_type_id"),
    },
}
