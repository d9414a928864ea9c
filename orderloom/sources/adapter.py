"""The retail tables as derived from the order tables at hand (region .. lineitem).

Only columns and keys are mapped here; what the orders add up to, how they were paid and what came back is
worked out by the jobs in ``orderloom.plans``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.functions.dates import moment
from orderloom.functions.money import PRICE
from orderloom.operators.columns import with_line_total
from orderloom.operators.keys import rank_keys
from orderloom.operators.skew import lookup_join

RAW = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def raw(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.schema(RAW[name]).parquet(f"{directory}/{name}.parquet")


def _places(spark: SparkSession, directory: str) -> DataFrame:
    """Nations with their region: one row per nation key."""
    return (raw(spark, directory, "nation")
            .join(raw(spark, directory, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
            .select("n_nationkey", "n_name", "r_name"))


def categories(spark: SparkSession, directory: str) -> DataFrame:
    names = raw(spark, directory, "part").select(F.col("p_type").alias("CategoryName")).distinct()
    return rank_keys(names, "CategoryID", ["CategoryName"], label="categories").select(
        "CategoryID", "CategoryName", F.lit(None).cast("string").alias("Description"))


def suppliers(spark: SparkSession, directory: str, created: datetime) -> DataFrame:
    return (raw(spark, directory, "supplier")
            .join(_places(spark, directory), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("SupplierID"), F.col("s_name").alias("SupplierName"),
                    F.lit(None).cast("string").alias("ContactEmail"),
                    F.lit(None).cast("string").alias("Phone"), F.col("n_name").alias("Country"),
                    moment(created).alias("CreatedAt")))


def employees(spark: SparkSession, directory: str) -> DataFrame:
    """A sales force with three reports per manager, one member per supplier."""
    key = F.col("s_suppkey")
    return (raw(spark, directory, "supplier")
            .join(_places(spark, directory), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(key.alias("EmployeeID"), F.lit("Emp").alias("FirstName"), F.col("s_name").alias("LastName"),
                    F.when(key != 0, F.floor((key - 1) / 3).cast("long")).alias("ManagerID"),
                    F.when(key == 0, "Sales Director").when(key <= 3, "Sales Manager")
                    .otherwise("Sales Executive").alias("Title"),
                    F.lit("1995-01-01").cast("date").alias("HireDate"), F.col("r_name").alias("Region")))


def customers(spark: SparkSession, directory: str) -> DataFrame:
    key = F.col("c_custkey")
    return raw(spark, directory, "customer").select(
        key.alias("CustomerID"), F.lit("Cust").alias("FirstName"), F.col("c_name").alias("LastName"),
        F.concat(F.lit("customer"), key.cast("string"), F.lit("@example.com")).alias("Email"),
        F.lit(None).cast("string").alias("Phone"), F.lit("1995-01-01").cast("date").alias("SignupDate"),
        F.when(key % 20 == 0, "VIP").when(key % 5 == 0, "Premium").otherwise("Standard")
        .alias("CustomerSegment"),
        (key % 37 != 0).alias("IsActive"))


def addresses(spark: SparkSession, directory: str) -> DataFrame:
    key = F.col("c_custkey")
    return (raw(spark, directory, "customer")
            .join(_places(spark, directory), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(key.alias("AddressID"), key.alias("CustomerID"),
                    F.concat((key % 999).cast("string"), F.lit(" Main Street")).alias("AddressLine1"),
                    F.concat(F.lit("CITY_"), (key % 10).cast("string")).alias("City"),
                    F.col("n_name").alias("State"), F.col("r_name").alias("Country"),
                    (100000 + key % 899999).cast("string").alias("PostalCode"), F.lit(True).alias("IsDefault")))


def products(spark: SparkSession, directory: str, known_categories: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    n_suppliers = raw(spark, directory, "supplier").agg(F.count("*").alias("n")).scalar()
    parts = raw(spark, directory, "part").withColumnRenamed("p_type", "CategoryName")
    return (lookup_join(parts, known_categories.select("CategoryID", "CategoryName"), ["CategoryName"], ["p_partkey"])
            .select(key.alias("ProductID"), F.col("p_name").alias("ProductName"), "CategoryID",
                    (key % n_suppliers).alias("SupplierID"),
                    F.col("p_retailprice").cast(PRICE).alias("UnitPrice"),
                    (10 + (F.col("p_size") % 5) * 5).cast("int").alias("ReorderLevel"),
                    (key % 17 == 0).alias("Discontinued")))


def inventory(spark: SparkSession, directory: str) -> DataFrame:
    key = F.col("p_partkey")
    return raw(spark, directory, "part").select(
        key.alias("ProductID"), ((key * 37 + 11) % 520).cast("int").alias("QuantityOnHand"),
        F.when(key % 2 == 0, "MAIN").otherwise("NORTH-DC").alias("WarehouseLocation"),
        F.when(key % 10 != 0, F.lit("2001-07-01").cast("date")).alias("LastRestockDate"))


def order_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Order lines with their return flag, numbered once in the order of all raw columns."""
    prices = raw(spark, directory, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").cast(PRICE).alias("UnitPrice"))
    lines = raw(spark, directory, "lineitem")
    priced = lookup_join(lines, prices, ["l_partkey"], LINE_ORDER)
    ranked = rank_keys(priced, "OrderDetailID", LINE_ORDER, label="order-lines", keep=[
        "l_orderkey", "l_partkey", "l_quantity", "UnitPrice", "l_discount", "l_returnflag"])
    return with_line_total(ranked.select(
        "OrderDetailID", F.col("l_orderkey").alias("OrderID"), F.col("l_partkey").alias("ProductID"),
        F.col("l_quantity").cast("int").alias("Quantity"), "UnitPrice",
        F.col("l_discount").cast("decimal(4,2)").alias("Discount"), F.col("l_returnflag").alias("ReturnFlag")))


def order_headers(spark: SparkSession, directory: str) -> DataFrame:
    """Orders whose TotalAmount is still 0."""
    key = F.col("o_orderkey")
    n_employees = raw(spark, directory, "supplier").agg(F.count("*").alias("n")).scalar()
    status = F.col("o_orderstatus")
    return raw(spark, directory, "orders").select(
        key.alias("OrderID"), F.col("o_custkey").alias("CustomerID"),
        F.when(key % 50 != 0, key % n_employees).alias("EmployeeID"),
        F.col("o_custkey").alias("AddressID"), F.col("o_orderdate").alias("OrderDate"),
        F.when(status == "F", "Delivered").when(status == "O", "Confirmed")
        .when(key % 3 == 0, "Cancelled").otherwise("Pending").alias("OrderStatus"),
        F.lit(0).cast("decimal(28,2)").alias("TotalAmount"))


# Fixed rules for payments: by order number instead of by chance.
def payment_method(order_id):
    turn = order_id % 5
    return (F.when(turn == 0, "CreditCard").when(turn == 1, "DebitCard").when(turn == 2, "UPI")
            .when(turn == 3, "NetBanking").otherwise("COD"))


def payment_status(order_id):
    return F.when(order_id % 25 == 0, "Failed").otherwise("Success")
