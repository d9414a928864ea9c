"""Sources and loads of the fact tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions import errors
from orderloom.functions.dates import date_key, moment, month_key
from orderloom.operators.checks import check_foreign_key
from orderloom.operators.columns import with_days_to_refund
from orderloom.operators.keys import highest, offset_keys
from orderloom.operators.merge import merge_upsert
from orderloom.operators.skew import lookup_join

SALES_MONTH = "SalesMonth"


class DateOutsideCalendar(errors.LoadRefused):
    """A fact has a date that the date dimension lacks."""


def order_dimension_keys(orders: DataFrame, addresses: DataFrame, dim_customer: DataFrame,
                         dim_employee: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """The keys all lines of an order share, looked up once per order instead of once per line.

    Orders whose address, place or current customer is missing drop out; a missing employee gives NULL.
    """
    place = ["City", "State", "Country"]
    located = lookup_join(addresses.select("AddressID", *place),
                          dim_geography.select(*place, "GeographyKey"), place, ["AddressID"])
    keyed = orders.select("OrderID", "CustomerID", "EmployeeID", "AddressID",
                          date_key(F.col("OrderDate")).alias("DateKey"))
    for side, key, how in (
            (located.select("AddressID", "GeographyKey"), "AddressID", "inner"),
            (dim_customer.where("IsCurrent").select("CustomerID", "CustomerKey"), "CustomerID", "inner"),
            (dim_employee.select("EmployeeID", "EmployeeKey"), "EmployeeID", "left")):
        keyed = lookup_join(keyed, side, [key], ["OrderID"], how, hot_in=orders)
    return keyed.select("OrderID", "DateKey", "CustomerKey", "EmployeeKey", "GeographyKey")


def sales_source(lines: DataFrame, orders: DataFrame, addresses: DataFrame, dim_customer: DataFrame,
                 dim_product: DataFrame, dim_employee: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """One fact row per order line, cancelled orders included, amounts in cents."""
    keys = order_dimension_keys(orders, addresses, dim_customer, dim_employee, dim_geography)
    # The product first: lines still come in the order of their orders then, which packs better.
    with_product = lookup_join(lines, dim_product.select("ProductID", "ProductKey"), ["ProductID"],
                               ["OrderDetailID"]).drop("ProductID")
    with_order = lookup_join(with_product, keys, ["OrderID"], ["OrderDetailID"], hot_in=lines, bound=orders)
    return with_order.select(
        "OrderDetailID", "DateKey", "CustomerKey", "ProductKey", "EmployeeKey", "GeographyKey", "Quantity",
        "UnitPrice", "Discount", F.col("LineTotal").cast("decimal(12,2)").alias("LineTotal"))


def first_sales(source: DataFrame, lines: DataFrame, as_of: datetime, start: Column | int = 0) -> DataFrame:
    """The rows of a first load, or of lines that are all new. ``lines`` are the order lines in the source."""
    return offset_keys(source, "SalesKey", "OrderDetailID", start, lines).withColumn(
        "LoadedAt", moment(as_of))


def merge_sales(fact: DataFrame, source: DataFrame, lines: DataFrame, as_of: datetime,
                start: Column | None = None, within: Sequence[str] = ()) -> DataFrame:
    """The sales fact after an upsert by order line.

    Known lines take quantity, price, discount and total, and keep all their keys: a sale stays with the
    customer version it was first loaded for. ``fact`` may be cut to the months that hold or get lines of
    ``source``, ``start`` is then the highest key of the whole table. Both may be partitioned by columns ``within``,
    in which the rows of a line are alike.
    """
    first = highest(fact, "SalesKey") if start is None else start
    least = lines.agg(F.min("OrderDetailID").alias("least")).scalar()
    # As in ``first_sales``; only new lines need them, so they are worked out behind the join.
    new = {"SalesKey": first + 1 + F.col("s.OrderDetailID") - least, "LoadedAt": moment(as_of)}
    return merge_upsert(fact, source, [*within, "OrderDetailID"], ["Quantity", "UnitPrice", "Discount", "LineTotal"],
                        inserted=new)


def snapshot_source(inventory: DataFrame, products: DataFrame, dim_product: DataFrame, day: date) -> DataFrame:
    """Stock and reorder level per product on one day."""
    today = day.year * 10000 + day.month * 100 + day.day
    return (inventory.join(products.select("ProductID", "ReorderLevel"), "ProductID")
            .join(dim_product.select("ProductID", "ProductKey"), "ProductID")
            .select(F.lit(today).alias("DateKey"), "ProductKey", "QuantityOnHand", "ReorderLevel"))


def merge_snapshot(fact: DataFrame, source: DataFrame, dim_product: DataFrame, as_of: datetime,
                   start: Column) -> DataFrame:
    """Snapshot rows after an upsert by day and product. ``fact`` may be cut to the days of ``source``,
    ``start`` is the highest key of the whole table."""
    fresh = offset_keys(source, "SnapshotKey", "ProductKey", start, dim_product).withColumn(
        "LoadedAt", moment(as_of))
    return merge_upsert(fact, fresh, ["DateKey", "ProductKey"], ["QuantityOnHand", "ReorderLevel"])


def returns_source(returns: DataFrame, lines: DataFrame, orders: DataFrame, dim_customer: DataFrame,
                   dim_product: DataFrame, refunds: DataFrame | None = None) -> DataFrame:
    """One row per return with the days of order, return and refund.

    ``refunds`` gives (ReturnID, RefundDate) as far as refunds were paid; without it the refund day is open.
    """
    line_cols = lines.select("OrderDetailID", "OrderID", "ProductID")
    order_cols = orders.select("OrderID", "CustomerID", date_key(F.col("OrderDate")).alias("OrderDateKey"))
    spread = ["ReturnID"]
    out = returns.select("ReturnID", "OrderDetailID", date_key(F.col("ReturnDate")).alias("ReturnDateKey"),
                         "QuantityReturned", "RefundAmount")
    out = lookup_join(out, line_cols, ["OrderDetailID"], spread)
    out = lookup_join(out, order_cols, ["OrderID"], spread, hot_in=lines, bound=orders)
    out = lookup_join(out, dim_customer.where("IsCurrent").select("CustomerID", "CustomerKey"), ["CustomerID"],
                      spread, hot_in=orders)
    out = lookup_join(out, dim_product.select("ProductID", "ProductKey"), ["ProductID"], spread,
                      hot_in=lines)
    if refunds is None:
        out = out.withColumn("RefundDateKey", F.lit(None).cast("int"))
    else:
        paid = refunds.select("ReturnID", date_key(F.col("RefundDate")).alias("RefundDateKey"))
        out = out.join(paid, "ReturnID", "left")
    return with_days_to_refund(out.select(
        "ReturnID", "OrderDateKey", "ReturnDateKey", "RefundDateKey", "CustomerKey", "ProductKey",
        "QuantityReturned", "RefundAmount"))


def merge_returns(fact: DataFrame, source: DataFrame, returns: DataFrame) -> DataFrame:
    """Return facts after an upsert by return: the refund day and the amounts move on, the keys stay."""
    fresh = offset_keys(source, "ReturnKey", "ReturnID", highest(fact, "ReturnKey"), returns)
    return merge_upsert(fact, fresh, ["ReturnID"],
                        ["RefundDateKey", "QuantityReturned", "RefundAmount", "DaysToRefund"])


def require_dates(fact: DataFrame, dim_date: DataFrame, column: str = "DateKey") -> None:
    """Fail unless every date of ``fact`` is in the calendar. Reads one column, reduced to distinct days."""
    bad = check_foreign_key(fact, [column], dim_date, ["DateKey"], f"{column} in calendar").orderBy(
        "key").limit(5).collect()
    if bad:
        raise DateOutsideCalendar(", ".join(f"{r['key']} ({r['detail']})" for r in bad), errors.CONSTRAINT)


def with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(SALES_MONTH, month_key(F.col("DateKey")))
