"""Loads of the dimensions: each takes the dimension as it is and gives the dimension after the load."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.functions.dates import calendar_columns
from orderloom.functions.text import concat_blank_null
from orderloom.operators.keys import highest, offset_keys, rank_keys
from orderloom.operators.merge import insert_absent, merge_upsert
from orderloom.operators.scd2 import scd2_merge, scd2_step
from orderloom.operators.skew import lookup_join

# The calendar loaded when no range is given.
CALENDAR_START = date(2023, 1, 1)
CALENDAR_END = date(2026, 12, 31)


def calendar_days(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end``; just ``start`` when the range is empty."""
    last = max(start, end)
    day = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 DAY")))
    return spark.range(1).select(day.alias("FullDate"))


def load_dim_date(dim: DataFrame, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """The calendar with all missing days of the range added; days it has stay as they are."""
    days = calendar_days(dim.sparkSession, start, end).select(*calendar_columns(F.col("FullDate")))
    return dim.unionByName(days.join(dim.select("DateKey"), "DateKey", "left_anti"))


def load_dim_customer(dim: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    """Customers by version; a change of segment opens a new one."""
    return scd2_merge(dim, customer_source(customers), "CustomerID", "CustomerKey", ["CustomerSegment"], as_of)


def customer_versions(current: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    """The versions of customers that are current after a load, and those that the load closes."""
    return scd2_step(current, customer_source(customers), "CustomerID", "CustomerKey", ["CustomerSegment"], as_of)


def customer_source(customers: DataFrame) -> DataFrame:
    return customers.select(
        "CustomerID", concat_blank_null(F.col("FirstName"), " ", F.col("LastName")).alias("FullName"), "Email",
        "CustomerSegment", "SignupDate")


def product_source(products: DataFrame, categories: DataFrame, suppliers: DataFrame) -> DataFrame:
    named = lookup_join(products, categories.select("CategoryID", "CategoryName"), ["CategoryID"], ["ProductID"])
    supplied = lookup_join(named, suppliers.select("SupplierID", "SupplierName"), ["SupplierID"], ["ProductID"],
                           hot_in=products)
    return supplied.select("ProductID", "ProductName", "CategoryName", "SupplierName", "UnitPrice", "Discontinued")


def load_dim_product(dim: DataFrame, products: DataFrame, categories: DataFrame,
                     suppliers: DataFrame) -> DataFrame:
    """Products, overwritten as a whole when price, sale state or category changed, and only then."""
    source = product_source(products, categories, suppliers)
    fresh = offset_keys(source, "ProductKey", "ProductID", highest(dim, "ProductKey"), products)
    changed = ("t.UnitPrice <> s.UnitPrice OR t.Discontinued <> s.Discontinued "
               "OR t.CategoryName <> s.CategoryName")
    return merge_upsert(dim, fresh, ["ProductID"],
                        ["ProductName", "CategoryName", "SupplierName", "UnitPrice", "Discontinued"], changed)


def load_dim_employee(dim: DataFrame, employees: DataFrame) -> DataFrame:
    """Employees, overwritten at each load; those the source no longer has stay."""
    source = employees.select(
        "EmployeeID", concat_blank_null(F.col("FirstName"), " ", F.col("LastName")).alias("FullName"), "Title",
        "Region")
    fresh = offset_keys(source, "EmployeeKey", "EmployeeID", highest(dim, "EmployeeKey"))
    return merge_upsert(dim, fresh, ["EmployeeID"], ["FullName", "Title", "Region"])


def load_dim_geography(dim: DataFrame, addresses: DataFrame) -> DataFrame:
    """Places; new ones are added, none changes."""
    place = ["City", "State", "Country"]
    fresh = rank_keys(insert_absent(dim, addresses, place), "GeographyKey", place,
                      highest(dim, "GeographyKey"), label="geography")
    return dim.unionByName(fresh)
