"""Order jobs: totals, payments, and placing a batch of orders against stock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions import errors
from orderloom.functions.dates import add_minutes, moment
from orderloom.functions.money import amount, line_total
from orderloom.functions.text import concat_blank_null
from orderloom.model import PAYMENT_METHODS
from orderloom.operators.keys import highest, last_key
from orderloom.operators.merge import update_from
from orderloom.operators.prefix import crossings
from orderloom.operators.skew import lookup_join, with_known
from orderloom.plans.audit import line_entries
from orderloom.session import materialize
from orderloom.sources.tables import TableStore

# Stock of a product, once it runs short, that is shared out in turn by one task.
TURNS = 100_000


def recompute_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders with TotalAmount set to the sum of their lines; orders without lines keep what they had."""
    totals = lines.groupBy("OrderID").agg(F.sum("LineTotal").alias("OrderTotal"))
    return update_from(orders, totals, ["OrderID"], {"TotalAmount": amount(F.col("v.OrderTotal"))})


def derive_payments(orders: DataFrame, method: Column, status: Column) -> DataFrame:
    """One payment, five minutes later, for every order that was not cancelled. PaymentID = OrderID."""
    return orders.where(F.col("OrderStatus") != "Cancelled").select(
        F.col("OrderID").alias("PaymentID"), "OrderID",
        add_minutes(F.col("OrderDate"), 5).alias("PaymentDate"),
        F.col("TotalAmount").alias("Amount"), method.alias("PaymentMethod"), status.alias("PaymentStatus"))


@dataclass(frozen=True)
class PlacedOrders:
    """What a batch of order requests leads to. ``decided`` has one row per request."""

    decided: DataFrame
    orders: DataFrame
    lines: DataFrame
    payments: DataFrame
    audit: DataFrame
    errors: DataFrame
    inventory: DataFrame


def _served_at_once(sound: DataFrame, stock: DataFrame) -> DataFrame:
    """For products whose requests exceed their stock, what their stock looks like from which turn on: (ProductID,
    _phases), an array of (since, left) in the order of turns.

    Up to the first request that the stock left cannot serve, all are served. That one is refused, and as stock only
    falls, so are all later ones for more than what is left; among the others the same holds again. One such step
    leaves less stock than the largest quantity asked for, so a second one is needed only where single requests ask
    for more than ``TURNS``; each further step rules out at least one more quantity. What is left then is shared out
    in turn.
    """
    asked = sound.select("ProductID", "seq", "Quantity")
    bounds = stock.select("ProductID", F.greatest("OnHand", F.lit(0)).alias("bound"))
    phases, rest = None, asked
    while True:
        found = crossings(rest, ["ProductID"], "seq", F.col("Quantity"), bounds)
        phase = materialize(found.select("ProductID", F.col("at").alias("since"),
                                         (F.col("bound") - F.col("before")).alias("left")), "stock-phase")
        phases = phase if phases is None else phases.unionByName(phase)
        plenty = phase.where(F.col("left") > TURNS)
        if plenty.isEmpty():
            break
        rest = lookup_join(asked, plenty, ["ProductID"], ["seq"], bound=stock).where(
            "seq > since AND Quantity <= left").select("ProductID", "seq", "Quantity")
        bounds = plenty.select("ProductID", F.col("left").alias("bound"))
    return phases.groupBy("ProductID").agg(F.array_sort(F.collect_list(F.struct("since", "left"))).alias("_phases"))


def _state() -> Column:
    """What becomes of a sound request, by its product's phases: free, short, or turn where it has to be decided in
    turn. ``_phase`` is the last phase that began before the request or with it."""
    phase = F.col("_phase")
    return (F.when(phase.isNull(), F.lit("free"))
            .when((phase["since"] == F.col("seq")) | (F.col("Quantity") > phase["left"]), F.lit("short"))
            .when(phase["left"] > TURNS, F.lit("free")).otherwise(F.lit("turn")))


def _in_turn(contested: DataFrame) -> DataFrame:
    """Which of the requests that compete for ``_left`` are served: (seq, ProductID, Quantity, StockAfter).

    A request is served if the stock left at its turn is enough; one that is not takes nothing. That has to
    be decided in turn, product by product, but not for every request: stock only falls, so when a request
    is served, every earlier one for the same product and quantity was served too. Hence only the first
    left / quantity requests of each quantity can be served, and a product has at most
    left x (1 + ln left) of them, however many requests it gets; ``left`` is ``TURNS`` at most.
    """
    def take_in_turn(batches):
        """Rows come sorted by product and turn; the stock of the product at hand is kept between batches."""
        product, stock = None, 0
        for batch in batches:
            left = []
            rows = zip(batch["ProductID"].tolist(), batch["_left"].tolist(), batch["Quantity"].tolist())
            for key, in_stock, quantity in rows:
                if key != product:
                    product, stock = key, in_stock
                if quantity <= stock:
                    stock -= quantity
                    left.append(stock)
                else:
                    left.append(None)
            yield pd.DataFrame({"seq": batch["seq"], "ProductID": batch["ProductID"],
                                "Quantity": batch["Quantity"], "StockAfter": pd.array(left, dtype="Int64")})

    pair = ["ProductID", "Quantity"]
    enough = contested.groupBy(*pair).agg(F.max("_left").alias("_left")).select(
        *pair, F.expr("_left DIV Quantity").alias("bound"))
    too_late = materialize(crossings(contested, pair, "seq", F.lit(1), enough).select(
        *pair, F.col("at").alias("_from")), "too-late")
    chances = lookup_join(contested, too_late, pair, ["seq"], "left").where("_from IS NULL OR seq < _from")
    return (chances.select("seq", "ProductID", "Quantity", "_left").repartition("ProductID")
            .sortWithinPartitions("ProductID", "seq")
            .mapInPandas(take_in_turn, "seq BIGINT, ProductID BIGINT, Quantity INT, StockAfter BIGINT"))


def decide(requests: DataFrame, inventory: DataFrame, products: DataFrame, customers: DataFrame,
           employees: DataFrame, addresses: DataFrame) -> DataFrame:
    """Each request with its price, its error number (NULL when served) and whether it was served.

    Checks come in this order: the product exists, the stock at the request's turn is enough, the values and
    references are valid. A request that fails takes no stock.
    """
    spread = ["seq"]
    stocked = (inventory.select("ProductID", F.col("QuantityOnHand").cast("long").alias("OnHand"))
               .join(products.select("ProductID", "UnitPrice"), "ProductID"))
    known = requests.withColumn("PaymentMethod", F.substring("PaymentMethod", 1, 20))
    for flag, table, column in (("_customer", customers, "CustomerID"), ("_employee", employees, "EmployeeID"),
                                ("_address", addresses, "AddressID")):
        known = with_known(known, table, column, spread, flag)
    # The order header is written first, then the line, then the payment.
    fault = (F.when(F.col("CustomerID").isNull() | F.col("AddressID").isNull() | F.col("Quantity").isNull(),
                    F.lit(errors.NULL_VALUE))
             .when(F.col("_customer").isNull() | F.col("_address").isNull()
                   | (F.col("EmployeeID").isNotNull() & F.col("_employee").isNull())
                   | (F.col("Quantity") <= 0), F.lit(errors.CONSTRAINT))
             .when(F.col("PaymentMethod").isNull(), F.lit(errors.NULL_VALUE))
             .when(~F.col("PaymentMethod").isin(*PAYMENT_METHODS), F.lit(errors.CONSTRAINT)))
    checked = known.withColumn("_fault", fault).drop("_customer", "_employee", "_address")

    # Where all requests up to a point together fit the stock, none of them has to wait for its turn. Requests for
    # products without stock meet no bound there.
    faultless = checked.where("_fault IS NULL").select("ProductID", "seq", "Quantity")
    repeated = materialize(stocked.groupBy("ProductID").agg(F.count("*").cast("int").alias("_copies"))
                           .where("_copies > 1"), "repeated-stock")
    if not repeated.isEmpty():  # a request then comes once for each row of its product
        copies = F.sequence(F.lit(1), F.coalesce("_copies", F.lit(1)))
        faultless = (lookup_join(faultless, repeated, ["ProductID"], spread, "left")
                     .withColumn("_copy", F.explode(copies)).drop("_copies", "_copy"))
    served = _served_at_once(faultless, stocked.select("ProductID", "OnHand"))
    stocked = materialize(stocked.join(served, "ProductID", "left"), "phases")
    begun = F.filter("_phases", lambda p: p["since"] <= F.col("seq"))
    sound = F.col("OnHand").isNotNull() & F.col("_fault").isNull()
    marked = (lookup_join(checked, stocked, ["ProductID"], spread, "left", hot_in=requests)
              .withColumn("_sound", sound).withColumn("_phase", F.try_element_at(begun, F.lit(-1)))
              .withColumn("_state", F.when(F.col("_sound"), _state())).withColumn("_left", F.col("_phase.left"))
              .drop("_phases", "_phase"))
    marked = materialize(marked, "contested")
    turns = materialize(_in_turn(marked.where("_state = 'turn'").select("seq", "ProductID", "Quantity", "_left")),
                        "turns")

    # Sound requests: served at once, refused at once, or as their turn says.
    settled = marked.where("_state IN ('free', 'short')").withColumn("_served", F.col("_state") == "free")
    turned = (marked.where("_state = 'turn'").join(turns.select("seq", "StockAfter"), "seq", "left")
              .withColumn("_served", F.col("StockAfter").isNotNull()).drop("StockAfter"))
    short = F.when(~F.col("_served"), F.lit(errors.INSUFFICIENT_STOCK))
    decided = settled.unionByName(turned).withColumn("ErrorNumber", short)

    # Faulty requests take nothing, but short stock at their turn is reported before the fault. As stock
    # only falls, it is short for a quantity from one certain turn on.
    faulty = marked.where("NOT _sound")
    taken = marked.where("_state = 'free'").select("ProductID", "seq", "Quantity").unionByName(
        turns.where("StockAfter IS NOT NULL").select("ProductID", "seq", "Quantity"))
    short_from = materialize(_short_from(faulty, taken), "short-stock")
    number = (F.when(F.col("OnHand").isNull(), F.lit(errors.UNKNOWN_PRODUCT))
              .when(F.col("_short_from") < F.col("seq"), F.lit(errors.INSUFFICIENT_STOCK))
              .otherwise(F.col("_fault")))
    refused = (lookup_join(faulty, short_from, ["ProductID", "Quantity"], spread, "left")
               .withColumn("_served", F.lit(False)).withColumn("ErrorNumber", number).drop("_short_from"))
    return decided.unionByName(refused).select(
        "seq", "CustomerID", "EmployeeID", "AddressID", "ProductID", "Quantity", "PaymentMethod", "UnitPrice",
        F.col("_served").alias("Accepted"), F.col("ErrorNumber").cast("int").alias("ErrorNumber"))


def _short_from(faulty: DataFrame, taken: DataFrame) -> DataFrame:
    """(ProductID, Quantity, _short_from): the turn after which the stock was below a faulty request's quantity, -1 if
    it was so from the start. That is the turn at which more than the rest of the stock had been taken."""
    asked = (faulty.where("OnHand IS NOT NULL AND Quantity > 0")
             .groupBy("ProductID", "Quantity").agg(F.max("OnHand").alias("OnHand")))
    spare = asked.where("OnHand >= Quantity").select("ProductID", (F.col("OnHand") - F.col("Quantity")).alias("bound"),
                                                    "Quantity")
    passed = crossings(taken, ["ProductID"], "seq", F.col("Quantity"), spare.select("ProductID", "bound"))
    later = spare.join(passed, ["ProductID", "bound"]).select("ProductID", "Quantity", F.col("at").alias("_short_from"))
    return later.unionByName(asked.where("OnHand < Quantity").select(
        "ProductID", "Quantity", F.lit(-1).cast("long").alias("_short_from")))


def place_orders(requests: DataFrame, orders: DataFrame, inventory: DataFrame, products: DataFrame,
                 customers: DataFrame, employees: DataFrame, addresses: DataFrame, lines: DataFrame,
                 as_of: datetime, payments: DataFrame | None = None, audit_log: DataFrame | None = None,
                 error_log: DataFrame | None = None) -> PlacedOrders:
    """Place a batch of one-line order requests, each one wholly or not at all.

    ``requests`` has (seq, CustomerID, EmployeeID, AddressID, ProductID, Quantity, PaymentMethod); ``seq`` is
    the order in which they came and tells them apart. All new keys follow the existing ones of their table; where
    ``payments``, ``audit_log`` or ``error_log`` is left out, they start at 1. A request that is served has two audit
    rows, first that of its line.
    """
    decided = materialize(
        decide(requests, inventory, products, customers, employees, addresses), "decided")
    taken = decided.where("Accepted")
    least = decided.agg(F.min("seq").alias("least")).scalar()
    place = F.col("seq") - least  # from 0
    now = moment(as_of)
    order_id = (highest(orders, "OrderID") + 1 + place).alias("OrderID")
    price = amount(F.col("UnitPrice") * F.col("Quantity"))
    new_orders = taken.select(
        order_id, "CustomerID", "EmployeeID", "AddressID", now.alias("OrderDate"),
        F.lit("Confirmed").alias("OrderStatus"), price.alias("TotalAmount"))
    no_discount = F.lit(0).cast("decimal(4,2)")
    first_audit = (last_key(audit_log, "AuditID") + 1 + 2 * place).alias("_audit")
    with_audit = taken.select(
        (highest(lines, "OrderDetailID") + 1 + place).alias("OrderDetailID"), order_id, "ProductID", "Quantity",
        "UnitPrice", no_discount.alias("Discount"),
        line_total(F.col("Quantity"), F.col("UnitPrice"), no_discount).alias("LineTotal"), first_audit)
    new_payments = taken.select(
        (last_key(payments, "PaymentID") + 1 + place).alias("PaymentID"), order_id, now.alias("PaymentDate"),
        price.alias("Amount"), "PaymentMethod", F.lit("Success").alias("PaymentStatus"))
    placed = taken.select(
        (first_audit + 1).alias("AuditID"), order_id, F.lit("PLACED").alias("Action"),
        concat_blank_null("Qty=", F.col("Quantity"), ", Product=", F.col("ProductID")).alias("ActionDetail"),
        now.alias("ActionAt"))
    failed = decided.where("NOT Accepted").select(
        "seq", (last_key(error_log, "ErrorLogID") + 1 + place).alias("ErrorLogID"),
        *errors.error_columns("usp_PlaceOrder", F.col("ErrorNumber"), as_of))
    sold = taken.groupBy("ProductID").agg(F.sum("Quantity").alias("_sold"))
    stock = update_from(inventory, sold, ["ProductID"],
                        {"QuantityOnHand": F.col("t.QuantityOnHand") - F.col("v._sold")})
    return PlacedOrders(decided, new_orders, with_audit.drop("_audit"), new_payments,
                        placed.unionByName(line_entries(with_audit, F.col("_audit"), as_of)), failed, stock)


def store_placed(store: TableStore, batch: str, placed: PlacedOrders, as_of: datetime) -> bool:
    """Add what a batch of requests led to to the stored tables, all of it at once; nothing if ``batch`` is stored."""
    return store.store_batch(
        batch, as_of, added={"Orders": placed.orders, "OrderDetails": placed.lines, "Payments": placed.payments,
                             "OrderAuditLog": placed.audit, "ErrorLog": placed.errors},
        replaced={"Inventory": placed.inventory})
