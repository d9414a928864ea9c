"""Batches and table states the registered queries run on, derived from the whole retail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.text import concat_null
from orderloom.operators.columns import with_line_total
from orderloom.operators.skew import lookup_join
from orderloom.session import materialize
from orderloom.sources.adapter import payment_method

# Year of the pivot and the two categories whose buyers are compared.
PIVOT_YEAR = 1997
WANTED, OTHER = "ECONOMY", "PROMO"
SAMPLE_ROWS = 300


def first_customers(customers: DataFrame) -> DataFrame:
    """Customers as the first load finds them: only active ones are known yet."""
    return customers.where("IsActive")


def later_customers(customers: DataFrame) -> DataFrame:
    """All customers, some with another segment or address for mail."""
    key, segment = F.col("CustomerID"), F.col("CustomerSegment")
    moved = F.when(segment == "VIP", "Premium").otherwise("VIP")
    return (customers.withColumn("Email", F.when(key % 11 == 0, concat_null("new_", F.col("Email")))
                                 .otherwise(F.col("Email")))
            .withColumn("CustomerSegment", F.when(key % 7 == 0, moved).otherwise(segment)))


def first_products(products: DataFrame) -> DataFrame:
    """Products as the first load finds them: only those on sale."""
    return products.where(~F.col("Discontinued"))


def later_products(products: DataFrame) -> DataFrame:
    """All products, some renamed, some dearer, some taken off sale."""
    key, price = F.col("ProductID"), F.col("UnitPrice")
    return (products.withColumn("ProductName", F.when(key % 5 == 0, concat_null(F.col("ProductName"), " v2"))
                                .otherwise(F.col("ProductName")))
            .withColumn("UnitPrice", F.when(key % 11 == 0, price + 5).otherwise(price).cast("decimal(10,2)"))
            .withColumn("Discontinued", (key % 29 == 0) | F.col("Discontinued")))


def first_employees(employees: DataFrame) -> DataFrame:
    """Employees before the branch in Asia opened."""
    return employees.where(F.col("Region") != "ASIA")


def later_employees(employees: DataFrame) -> DataFrame:
    """All employees, with a new title in Europe."""
    return employees.withColumn("Title", F.when(F.col("Region") == "EUROPE", concat_null("Senior ", F.col("Title")))
                                .otherwise(F.col("Title")))


def first_addresses(addresses: DataFrame) -> DataFrame:
    """Addresses before the first delivery to Asia."""
    return addresses.where(F.col("Country") != "ASIA")


def later_lines(lines: DataFrame) -> DataFrame:
    """All order lines; those sold at a discount of 5 percent or more got one piece more."""
    more = F.when(F.col("Discount") >= 0.05, F.col("Quantity") + 1).otherwise(F.col("Quantity"))
    return with_line_total(lines.withColumn("Quantity", more))


def order_requests(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Every order line as a request of its own, in line order; some with a fault."""
    headers = orders.select("OrderID", "CustomerID", "EmployeeID", "AddressID")
    seq = F.col("OrderDetailID")
    joined = lookup_join(lines.select("OrderDetailID", "OrderID", "ProductID", "Quantity"), headers, ["OrderID"],
                         ["OrderDetailID"])
    method = payment_method(F.col("OrderID"))
    return materialize(joined.select(
        seq.alias("seq"), F.when(seq % 89 == 0, -F.col("CustomerID") - 1).otherwise(F.col("CustomerID"))
        .alias("CustomerID"), "EmployeeID", "AddressID",
        F.when(seq % 97 == 0, -F.col("ProductID") - 1).otherwise(F.col("ProductID")).alias("ProductID"),
        F.when(seq % 83 == 0, 0).otherwise(F.col("Quantity")).alias("Quantity"),
        F.when(seq % 79 == 0, "Barter").otherwise(method).alias("PaymentMethod")), "order-requests")


def return_requests(lines: DataFrame) -> DataFrame:
    """A request to take back each line with the return flag; some for unknown lines or for no piece."""
    seq = F.col("OrderDetailID")
    return lines.where(F.col("ReturnFlag") == "R").select(
        seq.alias("seq"), F.when(seq % 101 == 0, -seq).otherwise(seq).alias("OrderDetailID"),
        F.when(seq % 103 == 0, 0).otherwise(1 + seq % 3).cast("int").alias("QuantityReturned"),
        F.lit("Customer changed mind").alias("Reason"))


def refunds_paid(returns: DataFrame) -> DataFrame:
    """Refund days of the returns whose refund has been paid: those of up to 1,200.00, four days later."""
    return returns.where(F.col("RefundAmount") <= 1200).select(
        "ReturnID", F.timestamp_add("DAY", F.lit(4), F.col("ReturnDate")).alias("RefundDate"))


def stock_count(inventory: DataFrame) -> DataFrame:
    """Replacement rows for all products after a count: a tenth less in stock, moved to one site."""
    counted = F.col("QuantityOnHand") - F.floor(F.col("QuantityOnHand") / 10)
    return inventory.select("ProductID", counted.cast("int").alias("QuantityOnHand"),
                            F.lit("MAIN").alias("WarehouseLocation"), "LastRestockDate")


def wrong_stock_count(inventory: DataFrame) -> DataFrame:
    """The same with fifty pieces less everywhere, which makes some stocks negative."""
    return stock_count(inventory).withColumn("QuantityOnHand", F.col("QuantityOnHand") - 50)


def unchecked_lines(lines: DataFrame) -> DataFrame:
    """Order lines as a careless sender would give them: every rule of the table is broken somewhere, and some lines
    are sent twice."""
    seq = F.col("OrderDetailID")
    lines = lines.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(seq % 47 == 0, 2).otherwise(1))))
    return lines.select(
        "OrderDetailID", F.when(seq % 61 == 0, -F.col("OrderID") - 1).otherwise(F.col("OrderID")).alias("OrderID"),
        F.when(seq % 67 == 0, F.lit(None)).when(seq % 71 == 0, -F.col("ProductID") - 1)
        .otherwise(F.col("ProductID")).alias("ProductID"),
        F.when(seq % 73 == 0, 0).otherwise(F.col("Quantity")).alias("Quantity"),
        F.when(seq % 59 == 0, -F.col("UnitPrice")).otherwise(F.col("UnitPrice")).cast("decimal(10,2)")
        .alias("UnitPrice"),
        F.when(seq % 53 == 0, F.lit(1.5)).otherwise(F.col("Discount")).cast("decimal(4,2)").alias("Discount"))


def asked_customers(customers: DataFrame) -> DataFrame:
    """Every customer, and as many numbers that no customer has."""
    known = customers.select("CustomerID")
    return known.unionByName(known.select((-1 - F.col("CustomerID")).alias("CustomerID")))


def twice(rows: DataFrame, key: str, every: int) -> DataFrame:
    """The rows, those with a key divisible by ``every`` two times."""
    return rows.unionByName(rows.where(F.col(key) % every == 0))


def unchecked_star(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star schema as a careless load would leave it: unknown keys, missing values, overlong names, and both
    composite keys given twice under other surrogate keys."""
    def odd(table: DataFrame, key: str, faults: dict[str, tuple[int, object]]) -> DataFrame:
        for column, (every, value) in faults.items():
            table = table.withColumn(column, F.when(F.col(key) % every == 0, F.lit(value).cast(
                table.schema[column].dataType)).otherwise(F.col(column)))
        return table

    def again(table: DataFrame, key: str, by: str, every: int) -> DataFrame:
        copies = table.where(F.col(by) % every == 0).withColumn(key, F.col(key) + 1_000_000_000)
        return table.unionByName(copies)

    customers = star["DimCustomer"].withColumn("FullName", F.when(F.col("CustomerKey") % 43 == 0, F.repeat(
        F.col("FullName"), F.lit(20))).otherwise(F.col("FullName")))
    sales = odd(star["FactSales"], "SalesKey", {
        "DateKey": (61, 19000101), "CustomerKey": (67, -1), "ProductKey": (71, -1), "EmployeeKey": (73, -1),
        "GeographyKey": (79, -1), "Quantity": (83, None)})
    return {**star, "DimCustomer": odd(customers, "CustomerKey", {"EffectiveDate": (41, None)}),
            "DimGeography": again(star["DimGeography"], "GeographyKey", "GeographyKey", 3),
            "FactSales": twice(sales, "SalesKey", 89),
            "FactInventorySnapshot": again(star["FactInventorySnapshot"], "SnapshotKey", "ProductKey", 47),
            "FactReturns": odd(star["FactReturns"], "ReturnKey", {
                "OrderDateKey": (53, 19000101), "ReturnDateKey": (59, 19000101), "RefundDateKey": (61, 19000101)})}
