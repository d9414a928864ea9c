"""Lookup rows every new set of tables starts with."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from orderloom.model import OLTP
from orderloom.sources.tables import literal_rows

# Lookup rows, as the sample data defines them.
CATEGORIES = [
    (1, "Electronics", "Consumer electronics and accessories"),
    (2, "Home & Kitchen", "Home goods and kitchen appliances"),
    (3, "Apparel", "Clothing and footwear"),
    (4, "Sports & Outdoors", "Fitness and outdoor equipment"),
    (5, "Books", "Print and digital books"),
    (6, "Beauty & Personal Care", "Cosmetics and grooming"),
    (7, "Toys & Games", "Toys, games and puzzles"),
    (8, "Office Supplies", "Stationery and office equipment"),
]
SUPPLIERS = [
    (1, "Northwind Traders", "contact@northwind.com", "555-0101", "USA"),
    (2, "Global Gadgets Ltd", "sales@globalgadgets.com", "555-0102", "India"),
    (3, "Prime Home Supplies", "info@primehome.com", "555-0103", "India"),
    (4, "Everest Sportswear", "hello@everestsport.com", "555-0104", "Nepal"),
    (5, "Bright Books Co", "orders@brightbooks.com", "555-0105", "UK"),
    (6, "Lumina Beauty", "support@luminabeauty.com", "555-0106", "India"),
    (7, "FunTime Toys", "sales@funtimetoys.com", "555-0107", "China"),
    (8, "OfficePro Distributors", "contact@officepro.com", "555-0108", "USA"),
]
EMPLOYEES = [
    (1, "Aditi", "Sharma", None, "Sales Director", date(2019, 1, 15), "North"),
    (2, "Rohan", "Verma", 1, "Sales Manager", date(2020, 3, 1), "North"),
    (3, "Kiran", "Nair", 1, "Sales Manager", date(2020, 6, 10), "South"),
    (4, "Neha", "Gupta", 2, "Sales Executive", date(2021, 2, 20), "North"),
    (5, "Arjun", "Iyer", 3, "Sales Executive", date(2021, 5, 15), "South"),
    (6, "Priya", "Das", 3, "Sales Executive", date(2022, 1, 10), "South"),
]
CITIES = [
    ("Delhi", "Delhi", "India"), ("Mumbai", "Maharashtra", "India"), ("Bengaluru", "Karnataka", "India"),
    ("Chennai", "Tamil Nadu", "India"), ("Pune", "Maharashtra", "India"), ("Hyderabad", "Telangana", "India"),
    ("Kolkata", "West Bengal", "India"), ("Ahmedabad", "Gujarat", "India"),
]


def categories(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, CATEGORIES, OLTP["Categories"].schema)


def suppliers(spark: SparkSession, created: datetime) -> DataFrame:
    return literal_rows(spark, [(*row, created) for row in SUPPLIERS], OLTP["Suppliers"].schema)


def employees(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, EMPLOYEES, OLTP["Employees"].schema)
