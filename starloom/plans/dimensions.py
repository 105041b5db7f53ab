"""Dimension sources and layouts: what a dimension row is made of, and its unknown member."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.functions import UNKNOWN_KEY, instant, scd_hash
from starloom.operators.joins import key_set
from starloom.sources.schemas import struct

# Fixed value: start of the unknown member's validity.
UNKNOWN_FROM = "1900-01-01 00:00:00"

_VERSIONING = (
    "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean, row_hash string, "
    "dw_load_batch_id bigint, dw_inserted_at timestamp_ntz, dw_updated_at timestamp_ntz"
)


@dataclass(frozen=True)
class Dimension:
    name: str
    natural: str
    surrogate: str
    schema: StructType
    unknown: Mapping[str, Any]
    tracked: Sequence[str]
    refreshed: Sequence[str] = field(default_factory=tuple)

    @property
    def source_schema(self) -> StructType:
        """What a source row carries: everything but the key and the versioning columns."""
        own = {self.surrogate, *struct(_VERSIONING).names} - {"row_hash"}
        return StructType([f for f in self.schema.fields if f.name not in own])

    @property
    def unknown_values(self) -> dict[str, Any]:
        values: dict[str, Any] = dict(self.unknown)
        if "valid_from" in self.schema.names:
            values |= {"valid_from": instant(UNKNOWN_FROM), "is_current": True}
        return values


# Dimension columns, tracked attributes in fingerprint order, unknown-member labels.
CUSTOMER = Dimension(
    "dim_customer", "customer_id", "customer_key",
    struct(
        "customer_key bigint, customer_id string, company_name string, contact_name string, "
        "contact_title string, address string, city string, region string, postal_code string, "
        "country string, phone string, fax string, " + _VERSIONING
    ),
    {"customer_id": "?????", "company_name": "Unknown", "contact_name": "Unknown", "country": "Unknown"},
    ["company_name", "contact_name", "contact_title", "address", "city", "region", "postal_code",
     "country", "phone", "fax"],
)
PRODUCT = Dimension(
    "dim_product", "product_id", "product_key",
    struct(
        "product_key bigint, product_id int, product_name string, quantity_per_unit string, "
        "unit_price decimal(19,4), discontinued boolean, category_id int, category_name string, "
        "category_description string, supplier_id int, supplier_name string, "
        "supplier_contact_name string, supplier_city string, supplier_country string, "
        "units_in_stock smallint, units_on_order smallint, reorder_level smallint, " + _VERSIONING
    ),
    {"product_id": UNKNOWN_KEY, "product_name": "Unknown", "category_name": "Unknown",
     "supplier_name": "Unknown", "discontinued": False},
    ["product_name", "quantity_per_unit", "unit_price", "discontinued", "category_id",
     "category_name", "category_description", "supplier_id", "supplier_name",
     "supplier_contact_name", "supplier_city", "supplier_country"],
    ("units_in_stock", "units_on_order", "reorder_level"),
)
EMPLOYEE = Dimension(
    "dim_employee", "employee_id", "employee_key",
    struct(
        "employee_key bigint, employee_id int, first_name string, last_name string, "
        "full_name string, title string, title_of_courtesy string, birth_date date, hire_date date, "
        "address string, city string, region string, postal_code string, country string, "
        "home_phone string, extension string, photo_path string, manager_employee_id int, "
        "manager_name string, is_manager boolean, " + _VERSIONING
    ),
    {"employee_id": UNKNOWN_KEY, "first_name": "Unknown", "last_name": "Unknown",
     "full_name": "Unknown", "is_manager": False},
    ["first_name", "last_name", "title", "title_of_courtesy", "birth_date", "hire_date", "address",
     "city", "region", "postal_code", "country", "home_phone", "extension", "photo_path",
     "manager_employee_id", "manager_name"],
)
SHIPPER = Dimension(
    "dim_shipper", "shipper_id", "shipper_key",
    struct(
        "shipper_key bigint, shipper_id int, company_name string, phone string, "
        "dw_load_batch_id bigint, dw_inserted_at timestamp_ntz, dw_updated_at timestamp_ntz"
    ),
    {"shipper_id": UNKNOWN_KEY, "company_name": "Unknown"},
    ["company_name", "phone"],
)
VERSIONED = [CUSTOMER, PRODUCT, EMPLOYEE]


def with_hash(source: DataFrame, tracked: Sequence[str]) -> DataFrame:
    """The fingerprint over every tracked column. A missing one would change every fingerprint, so it is an error."""
    missing = [c for c in tracked if c not in source.columns]
    if missing:
        raise ValueError(f"tracked columns missing from the source: {', '.join(missing)}")
    return source.withColumn("row_hash", scd_hash(*tracked))


def customer_source(customers: DataFrame) -> DataFrame:
    return with_hash(customers, CUSTOMER.tracked)


def product_source(
    products: DataFrame, categories: DataFrame, suppliers: DataFrame, fingerprint: bool = True
) -> DataFrame:
    """Products with category and supplier collapsed in; a missing parent reads 'Unknown'.

    Both parents are joined on their declared key. How they are joined is left to the optimiser,
    which broadcasts a parent only when its size is known to be small.
    """
    c = categories.select(
        "category_id", F.col("category_name").alias("_category"),
        F.col("description").alias("category_description"),
    )
    s = suppliers.select(
        "supplier_id", F.col("company_name").alias("_supplier"),
        F.col("contact_name").alias("supplier_contact_name"),
        F.col("city").alias("supplier_city"), F.col("country").alias("supplier_country"),
    )
    joined = products.join(c, "category_id", "left").join(s, "supplier_id", "left").withColumns(
        {
            "category_name": F.coalesce("_category", F.lit("Unknown")),
            "supplier_name": F.coalesce("_supplier", F.lit("Unknown")),
        }
    ).drop("_category", "_supplier")
    return with_hash(joined, PRODUCT.tracked) if fingerprint else joined


def full_name(prefix: str = "") -> Column:
    return F.concat(F.col(f"{prefix}first_name"), F.lit(" "), F.col(f"{prefix}last_name"))


def employee_source(employees: DataFrame, fingerprint: bool = True) -> DataFrame:
    """Employees with the manager's name and an is-manager flag.

    The flag is not part of the fingerprint: gaining a report opens no new version.
    """
    manager = employees.select(
        F.col("employee_id").alias("_manager_id"), full_name().alias("manager_name")
    )
    leads = key_set(employees, "reports_to", "_leader_id")
    joined = (
        employees.withColumnRenamed("reports_to", "manager_employee_id")
        .join(leads, F.col("employee_id") == F.col("_leader_id"), "left")
        .join(manager, F.col("manager_employee_id") == F.col("_manager_id"), "left")
        .withColumns({"full_name": full_name(), "is_manager": F.col("_leader_id").isNotNull()})
        .drop("_manager_id", "_leader_id")
    )
    dates = {c: F.col(c).cast("date") for c in ("birth_date", "hire_date") if c in joined.columns}
    # The fingerprint takes the dates as landed (with time of day), like every other attribute.
    return (with_hash(joined, EMPLOYEE.tracked) if fingerprint else joined).withColumns(dates)


def managers(employees: DataFrame) -> DataFrame:
    """Employees with at least one direct report."""
    leads = key_set(employees, "reports_to", "_leader_id")
    return employees.join(leads, F.col("employee_id") == F.col("_leader_id"), "left_semi")
