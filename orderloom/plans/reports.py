"""Parameterised reports over customers and their orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.functions.money import AMOUNT, amount, zero_if_null


def lifetime_values(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """What every customer has spent on orders that were not cancelled; 0 for those without any."""
    spent = (orders.where(F.col("OrderStatus") != "Cancelled").groupBy("CustomerID")
             .agg(F.sum("TotalAmount").alias("_spent")))
    return customers.select("CustomerID").join(spent, "CustomerID", "left").select(
        "CustomerID", amount(zero_if_null(F.col("_spent"))).alias("LifetimeValue"))


def lifetime_value(orders: DataFrame, customer_id: int) -> DataFrame:
    """The same for one customer: one row, 0 when there are no orders or no such customer."""
    chosen = orders.where((F.col("CustomerID") == customer_id) & (F.col("OrderStatus") != "Cancelled"))
    return chosen.agg(zero_if_null(F.sum("TotalAmount")).cast(AMOUNT).alias("LifetimeValue"))


def order_history(orders: DataFrame, lines: DataFrame, customer_id: int | None = None) -> DataFrame:
    """Orders with their number of lines, for one customer or all. Orders without lines are left out."""
    chosen = orders if customer_id is None else orders.where(F.col("CustomerID") == customer_id)
    counted = lines
    if customer_id is not None:
        counted = lines.join(chosen.select("OrderID"), "OrderID", "left_semi")
    per_order = counted.groupBy("OrderID").agg(F.count("OrderDetailID").alias("LineCount"))
    columns = ["OrderID", "OrderDate", "OrderStatus", "TotalAmount", "LineCount"]
    if customer_id is None:
        columns.insert(0, "CustomerID")
    return chosen.join(per_order, "OrderID").select(*columns)


def orders_by_status(orders: DataFrame, status: str) -> DataFrame:
    """Orders in one status, latest first. The status is bound, never pasted in, and cut to 20 characters."""
    return orders.sparkSession.sql(
        """SELECT OrderID, CustomerID, OrderDate, TotalAmount FROM {orders}
           WHERE OrderStatus = :status ORDER BY OrderDate DESC, OrderID""",
        args={"status": status[:20]}, orders=orders)


def define_customer_functions(spark: SparkSession, orders: DataFrame, lines: DataFrame, suffix: str = "") -> tuple[str, str]:
    """Two functions for SQL text, for this session: what a customer has spent, and the customer's orders.

    ``customer_lifetime_value(id)`` gives a number, ``customer_order_history(id)`` a table, to be called after
    LATERAL. The names, with ``suffix``, are returned; each suffix has its own tables. Called for many customers, they
    become joins on the customer.
    """
    value, history = f"customer_lifetime_value{suffix}", f"customer_order_history{suffix}"
    orders.createOrReplaceTempView(f"orders_of{suffix}")
    lines.createOrReplaceTempView(f"lines_of{suffix}")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {value}(id BIGINT) RETURNS {AMOUNT}
        RETURN SELECT CAST(coalesce(sum(o.TotalAmount), 0) AS {AMOUNT}) FROM orders_of{suffix} o
               WHERE o.CustomerID = id AND o.OrderStatus <> 'Cancelled'""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {history}(id BIGINT)
        RETURNS TABLE (OrderID BIGINT, OrderDate TIMESTAMP_NTZ, OrderStatus STRING, TotalAmount {AMOUNT}, LineCount BIGINT)
        RETURN SELECT o.OrderID, o.OrderDate, o.OrderStatus, o.TotalAmount, count(d.OrderDetailID)
               FROM orders_of{suffix} o JOIN lines_of{suffix} d ON d.OrderID = o.OrderID WHERE o.CustomerID = id
               GROUP BY o.OrderID, o.OrderDate, o.OrderStatus, o.TotalAmount""")
    return value, history


def customer_report(customers: DataFrame, orders: DataFrame, lines: DataFrame, suffix: str = "") -> DataFrame:
    """For a list of customers (CustomerID) what each has spent and each of the orders, by the functions above. Who has
    no orders, or does not exist, has one row without an order."""
    spark = customers.sparkSession
    value, history = define_customer_functions(spark, orders, lines, suffix)
    return spark.sql(f"""SELECT c.CustomerID, {value}(c.CustomerID) AS LifetimeValue, h.OrderID, h.OrderDate,
            h.OrderStatus, h.TotalAmount, h.LineCount
        FROM {{asked}} c LEFT JOIN LATERAL {history}(c.CustomerID) h""", asked=customers)
