"""Sample tables of any size. Every value is picked by a hash of the row's key, so each run gives the same rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.functions.picks import pick
from orderloom.functions.text import concat_blank_null, left_pad_digits
from orderloom.operators.columns import with_line_total
from orderloom.operators.keys import rank_keys
from orderloom.operators.skew import lookup_join
from orderloom.sources.seed import CITIES
from orderloom.sources.tables import numbers

# Fixed value: how many orders there are per customer.
ORDERS_PER_CUSTOMER = 12


def _days_before(as_of: datetime, days: Column) -> Column:
    return F.date_sub(F.lit(as_of.date()).cast("date"), days.cast("int"))


def generate_products(spark: SparkSession, n: int, n_categories: int, n_suppliers: int) -> DataFrame:
    return products_for(numbers(spark, n), n_categories, n_suppliers)


def products_for(keys: DataFrame, n_categories: int, n_suppliers: int) -> DataFrame:
    """A product for each key ``n``."""
    i = F.col("n")
    return keys.select(
        i.alias("ProductID"), concat_blank_null("Product ", i).alias("ProductName"),
        (F.pmod(i - 1, F.lit(n_categories)) + 1).alias("CategoryID"),
        (F.pmod(i - 1, F.lit(n_suppliers)) + 1).alias("SupplierID"),
        (50 + pick(i, "price", 95000).cast("decimal(10,0)") / 100).cast("decimal(10,2)").alias("UnitPrice"),
        (10 + i % 5 * 5).cast("int").alias("ReorderLevel"), (i % 17 == 0).alias("Discontinued"))


def generate_inventory(products: DataFrame, as_of: datetime) -> DataFrame:
    key = F.col("ProductID")
    return products.select(
        key, (20 + pick(key, "stock", 500)).cast("int").alias("QuantityOnHand"),
        F.when(key % 2 == 0, "MAIN").otherwise("NORTH-DC").alias("WarehouseLocation"),
        _days_before(as_of, pick(key, "restock", 60)).alias("LastRestockDate"))


def generate_customers(spark: SparkSession, n: int, as_of: datetime) -> DataFrame:
    return customers_for(numbers(spark, n), as_of)


def customers_for(keys: DataFrame, as_of: datetime) -> DataFrame:
    """A customer for each key ``n``."""
    i = F.col("n")
    return keys.select(
        i.alias("CustomerID"), concat_blank_null("First", i).alias("FirstName"),
        concat_blank_null("Last", i).alias("LastName"),
        concat_blank_null("customer", i, "@example.com").alias("Email"),
        concat_blank_null("9", left_pad_digits(pick(i, "phone", 1000000000), 9)).alias("Phone"),
        _days_before(as_of, pick(i, "signup", 900)).alias("SignupDate"),
        F.when(i % 20 == 0, "VIP").when(i % 5 == 0, "Premium").otherwise("Standard").alias("CustomerSegment"),
        (i % 37 != 0).alias("IsActive"))


def generate_addresses(customers: DataFrame) -> DataFrame:
    """One default address per customer, in one of the seed cities."""
    key = F.col("CustomerID")
    cities = F.array(*[F.struct(F.lit(c).alias("City"), F.lit(s).alias("State"), F.lit(l).alias("Country"))
                       for c, s, l in CITIES])
    place = F.element_at(cities, (1 + pick(key, "city", len(CITIES))).cast("int"))
    return customers.select(
        key.alias("AddressID"), key,
        concat_blank_null(pick(key, "house", 999), " Main Street").alias("AddressLine1"),
        place["City"].alias("City"), place["State"].alias("State"), place["Country"].alias("Country"),
        left_pad_digits(100000 + pick(key, "postcode", 899999), 6).alias("PostalCode"),
        F.lit(True).alias("IsDefault"))


def _indexed(df: DataFrame, key: str, label: str) -> tuple[DataFrame, int]:
    """Rows numbered 0 .. n-1 in column ``_index``, and n."""
    ranked = rank_keys(df, "_index", [key], -1, label)
    return ranked, ranked.count()


def generate_orders(customers: DataFrame, addresses: DataFrame, employees: DataFrame,
                    as_of: datetime) -> DataFrame:
    """Orders of random customers to their lowest-numbered address, over the last 730 days.

    Customers without an address get no order. TotalAmount is 0 until the lines are known.
    """
    spark = customers.sparkSession
    buyers, n_buyers = _indexed(customers.select("CustomerID"), "CustomerID", "buyers")
    sellers, n_sellers = _indexed(employees.select("EmployeeID"), "EmployeeID", "sellers")
    home = addresses.groupBy("CustomerID").agg(F.min("AddressID").alias("AddressID"))
    n = F.col("n")
    bucket = pick(n, "status", 20)
    drawn = numbers(spark, ORDERS_PER_CUSTOMER * n_buyers).select(
        n.alias("OrderID"), pick(n, "customer", n_buyers).alias("_buyer"),
        pick(n, "employee", n_sellers).alias("_seller"),
        _days_before(as_of, pick(n, "day", 730)).cast("timestamp_ntz").alias("OrderDate"),
        F.when(bucket == 0, "Cancelled").when(bucket == 1, "Pending").otherwise("Delivered")
        .alias("OrderStatus"))
    known = buyers.join(home, "CustomerID").withColumnRenamed("_index", "_buyer")
    # There may be few sellers, with many orders each.
    sold = lookup_join(drawn, sellers.withColumnRenamed("_index", "_seller"), ["_seller"], ["OrderID"])
    return sold.join(known, "_buyer").select(
        "OrderID", "CustomerID", "EmployeeID", "AddressID", "OrderDate", "OrderStatus",
        F.lit(0).cast("decimal(28,2)").alias("TotalAmount"))


def generate_lines(orders: DataFrame, products: DataFrame) -> DataFrame:
    """One to four lines with different products for every order. OrderDetailID = 4 x OrderID + line number.

    The products of an order are drawn one by one from those it has not got yet: a draw is a place among the
    remaining ones, moved up by one for each product taken before that stands at or below it.
    """
    priced, n = _indexed(products.select("ProductID", "UnitPrice"), "ProductID", "assortment")
    key = F.col("OrderID")
    count = F.least(1 + pick(key, "lines", 4), F.lit(n))

    def drawn(taken: Column, line: Column) -> Column:
        place = pick(key * 4 + line, "product", F.lit(n) - line)
        free = F.aggregate(F.array_sort(taken), place, lambda at, t: F.when(at >= t, at + 1).otherwise(at))
        return F.concat(taken, F.array(free))
    draws = F.aggregate(F.sequence(F.lit(0).cast("long"), count - 1), F.array().cast("array<bigint>"), drawn)
    picked = (orders.select(key, F.posexplode(draws).alias("_line", "_index"))
              .withColumn("OrderDetailID", key * 4 + F.col("_line")))
    line = F.col("OrderDetailID")
    priced_lines = lookup_join(picked, priced, ["_index"], ["OrderDetailID"])
    return with_line_total(priced_lines.select(
        "OrderDetailID", "OrderID", "ProductID", (1 + pick(line, "quantity", 5)).cast("int").alias("Quantity"),
        "UnitPrice",
        F.when(pick(line, "discount", 10) == 0, 0.10).otherwise(0).cast("decimal(4,2)").alias("Discount")))


def random_method(order_id: Column) -> Column:
    turn = pick(order_id, "method", 5)
    return (F.when(turn == 0, "CreditCard").when(turn == 1, "DebitCard").when(turn == 2, "UPI")
            .when(turn == 3, "NetBanking").otherwise("COD"))


def random_status(order_id: Column) -> Column:
    return F.when(pick(order_id, "paid", 25) == 0, "Failed").otherwise("Success")
