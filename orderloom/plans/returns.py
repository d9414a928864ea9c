"""Return jobs: processing a batch of return requests, and drawing sample returns."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions import errors
from orderloom.functions.dates import moment
from orderloom.functions.money import amount
from orderloom.functions.picks import pick
from orderloom.operators.keys import highest, last_key, offset_keys
from orderloom.operators.sampling import sample_rows
from orderloom.operators.skew import lookup_join
from orderloom.session import materialize
from orderloom.sources.tables import TableStore


@dataclass(frozen=True)
class ProcessedReturns:
    """What a batch of return requests leads to. ``decided`` has one row per request."""

    decided: DataFrame
    returns: DataFrame
    payments: DataFrame
    errors: DataFrame


def process_returns(requests: DataFrame, lines: DataFrame, payments: DataFrame, returns: DataFrame,
                    as_of: datetime, error_log: DataFrame | None = None) -> ProcessedReturns:
    """Record a batch of returns and mark the payments of their orders as refunded.

    ``requests`` has (seq, OrderDetailID, QuantityReturned, Reason). The refund is list price times quantity.
    An unknown line, or a quantity that is not positive, leaves nothing but an error. A known line whose order
    has no payment keeps its return and logs the failed refund. A reason is cut to its 200 characters. All payments of
    a refunded order are marked, whatever their status. ReturnIDs follow those in ``returns``, ErrorLogIDs those in
    ``error_log``, or start at 1.
    """
    known = lookup_join(requests, lines.select("OrderDetailID", "OrderID", "UnitPrice"), ["OrderDetailID"],
                        ["seq"], "left")
    priced = materialize(known, "return-lines")
    sound = (F.col("UnitPrice").isNotNull() & F.coalesce(F.col("QuantityReturned") > 0, F.lit(False)))
    # One row per order on both sides, so neither a much-returned nor a much-paid order weighs more.
    returned_orders = materialize(priced.where(sound).select("OrderID").distinct(), "returned-orders")
    paid = materialize(payments.select("OrderID").distinct().join(returned_orders, "OrderID", "left_semi")
                       .withColumn("_paid", F.lit(True)), "paid-orders")
    fault = (F.when(F.col("UnitPrice").isNull(), F.lit(errors.UNKNOWN_LINE))
             .when(F.col("QuantityReturned").isNull(), F.lit(errors.NULL_VALUE))
             .when(F.col("QuantityReturned") <= 0, F.lit(errors.CONSTRAINT))
             .when(F.col("_paid").isNull(), F.lit(errors.NO_PAYMENT)))
    decided = materialize(
        lookup_join(priced, paid, ["OrderID"], ["seq"], "left", hot_in=priced)
        .select("seq", "OrderDetailID", "OrderID", "QuantityReturned", F.substring("Reason", 1, 200).alias("Reason"),
                sound.alias("Accepted"),
                F.when(sound, amount(F.col("UnitPrice") * F.col("QuantityReturned"))).alias("RefundAmount"),
                fault.cast("int").alias("ErrorNumber")), "returns")
    least = decided.agg(F.min("seq").alias("least")).scalar()
    new_returns = decided.where("Accepted").select(
        (highest(returns, "ReturnID") + 1 + F.col("seq") - least).alias("ReturnID"), "OrderDetailID",
        moment(as_of).alias("ReturnDate"), "QuantityReturned", "Reason", "RefundAmount")
    step = F.when(F.col("ErrorNumber") == errors.NO_PAYMENT, "usp_ProcessReturn (refund step)").otherwise(
        "usp_ProcessReturn")
    failed = decided.where("ErrorNumber IS NOT NULL").select(
        "seq", (last_key(error_log, "ErrorLogID") + 1 + F.col("seq") - least).alias("ErrorLogID"),
        *errors.error_columns(step, F.col("ErrorNumber"), as_of))
    return ProcessedReturns(decided, new_returns, refund_payments(payments, returned_orders), failed)


def store_processed(store: TableStore, batch: str, processed: ProcessedReturns, as_of: datetime) -> bool:
    """Add what a batch of returns led to to the stored tables, all of it at once; nothing if ``batch`` is stored."""
    return store.store_batch(batch, as_of, added={"Returns": processed.returns, "ErrorLog": processed.errors},
                             replaced={"Payments": processed.payments})


def refund_payments(payments: DataFrame, refunded_orders: DataFrame) -> DataFrame:
    """``payments`` with every payment of the given orders (one row per OrderID) marked as refunded."""
    hit = refunded_orders.select("OrderID", F.lit(True).alias("_hit"))
    marked = lookup_join(payments, hit, ["OrderID"], ["PaymentID"], "left")
    status = F.when(F.col("_hit"), F.lit("Refunded")).otherwise(F.col("PaymentStatus"))
    return marked.withColumn("PaymentStatus", status).select(*payments.columns)


def sample_returns(lines: DataFrame, orders: DataFrame, n: int, salt: str = "returns",
                   start: Column | int = 0) -> DataFrame:
    """``n`` delivered lines drawn at random, each returned as one piece 5 to 24 days after its order. ReturnIDs follow
    ``start`` in the order of the lines, with their gaps."""
    delivered = orders.where(F.col("OrderStatus") == "Delivered").select("OrderID", "OrderDate")
    candidates = lookup_join(lines.select("OrderDetailID", "OrderID", "UnitPrice"), delivered, ["OrderID"],
                             ["OrderDetailID"])
    days = 5 + pick(F.col("OrderDetailID"), salt + "-day", 20)
    drawn = sample_rows(candidates, n, "OrderDetailID", salt)
    return offset_keys(drawn, "ReturnID", "OrderDetailID", start, lines).select(
        "ReturnID", "OrderDetailID", F.timestamp_add("DAY", days.cast("int"), F.col("OrderDate")).alias("ReturnDate"),
        F.lit(1).alias("QuantityReturned"), F.lit("Customer changed mind").alias("Reason"),
        amount(F.col("UnitPrice")).alias("RefundAmount"))


def delivered_returns(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """A return, ReturnID = OrderDetailID, for every delivered line that carries the return flag 'R'."""
    delivered = orders.where(F.col("OrderStatus") == "Delivered").select("OrderID", "OrderDate")
    flagged = lines.where(F.col("ReturnFlag") == "R").select("OrderDetailID", "OrderID", "UnitPrice")
    days = (5 + F.col("OrderDetailID") % 20).cast("int")
    return lookup_join(flagged, delivered, ["OrderID"], ["OrderDetailID"]).select(
        F.col("OrderDetailID").alias("ReturnID"), "OrderDetailID",
        F.timestamp_add("DAY", days, F.col("OrderDate")).alias("ReturnDate"),
        F.lit(1).alias("QuantityReturned"), F.lit("Customer changed mind").alias("Reason"),
        amount(F.col("UnitPrice")).alias("RefundAmount"))
