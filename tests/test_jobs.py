import io
import random
import re
from contextlib import redirect_stdout
from datetime import date, datetime
from decimal import Decimal

import pytest
from shop import make, rows
from pyspark.errors import PySparkException
from pyspark.sql import Observation, functions as F

from orderloom.model import TABLES
from orderloom.operators import checks, prefix, skew
from orderloom.plans import orders as order_jobs
from orderloom.plans import reports, returns, stock
from orderloom.plans.audit import audit_new_lines
from orderloom.session import materialize, scratch_path
from orderloom.sources.tables import TableStore

NOW = datetime(2024, 6, 1)
REQUEST = ("seq BIGINT, CustomerID BIGINT, EmployeeID BIGINT, AddressID BIGINT, ProductID BIGINT, Quantity INT, "
           "PaymentMethod STRING")


def place(spark, shop, requests):
    return order_jobs.place_orders(
        spark.createDataFrame(requests, REQUEST), shop["Orders"], shop["Inventory"], shop["Products"],
        shop["Customers"], shop["Employees"], shop["ShippingAddresses"], shop["OrderDetails"], NOW)


def verdicts(placed):
    return {r["seq"]: r["ErrorNumber"] for r in placed.decided.collect()}


def test_a_refused_request_takes_no_stock(spark, shop):
    placed = place(spark, shop, [(1, 1, 1, 1, 10, 6, "UPI"), (2, 1, 1, 1, 10, 5, "UPI"), (3, 1, None, 1, 10, 4, "COD")])
    assert verdicts(placed) == {1: None, 2: 51001, 3: None}
    assert {r["ProductID"]: r["QuantityOnHand"] for r in placed.inventory.collect()} == {10: 0, 20: 9, 30: 1}
    assert rows(placed.orders) == [
        (6, 1, 1, 1, NOW, "Confirmed", Decimal("600.00")), (8, 1, None, 1, NOW, "Confirmed", Decimal("400.00"))]
    assert [(r["OrderDetailID"], r["OrderID"], r["LineTotal"]) for r in placed.lines.orderBy("OrderID").collect()] == [
        (6, 6, Decimal("600.0000")), (8, 8, Decimal("400.0000"))]
    assert [(r["OrderID"], r["Amount"], r["PaymentMethod"], r["PaymentStatus"])
            for r in placed.payments.orderBy("OrderID").collect()] == [
        (6, Decimal("600.00"), "UPI", "Success"), (8, Decimal("400.00"), "COD", "Success")]
    assert sorted(r["ActionDetail"] for r in placed.audit.collect()) == [
        "ProductID=10, Qty=4, LineTotal=400.0000", "ProductID=10, Qty=6, LineTotal=600.0000",
        "Qty=4, Product=10", "Qty=6, Product=10"]
    assert [(r["seq"], r["ErrorProcedure"], r["ErrorNumber"]) for r in placed.errors.collect()] == [
        (2, "usp_PlaceOrder", 51001)]


def test_reasons_for_refusal_and_their_order(spark, shop):
    placed = place(spark, shop, [
        (1, 1, 1, 1, 99, 1, "UPI"),       # no such product
        (2, 77, 1, 1, 10, 1, "UPI"),      # no such customer, stock is enough
        (3, 1, 77, 1, 10, 1, "UPI"),      # no such employee
        (4, 1, 1, 77, 10, 1, "UPI"),      # no such address
        (5, 1, 1, 1, 10, 0, "UPI"),       # no piece
        (6, 1, 1, 1, 10, 1, "Barter"),    # no such method
        (7, None, 1, 1, 10, 1, "UPI"),    # no customer
        (8, 77, 1, 1, 10, 11, "UPI"),     # short stock counts before the customer
        (9, 1, 1, 1, 10, 8, "UPI"),       # served: 2 left
        (10, 77, 1, 1, 10, 3, "UPI"),     # now short
        (11, 77, 1, 1, 10, 2, "UPI"),     # not short
        (12, 1, 1, 1, 10, None, "UPI")])
    assert verdicts(placed) == {1: 51000, 2: 547, 3: 547, 4: 547, 5: 547, 6: 547, 7: 515, 8: 51001, 9: None,
                                10: 51001, 11: 547, 12: 515}


def brute_force(requests, stock_of, bad):
    left, out = dict(stock_of), {}
    for seq, _, _, _, product, quantity, _ in sorted(requests):
        if product not in left:
            out[seq] = 51000
        elif left[product] < quantity:
            out[seq] = 51001
        elif seq in bad:
            out[seq] = 547
        else:
            left[product] -= quantity
            out[seq] = None
    return out, left


@pytest.mark.parametrize("salted, span, turns", [
    (False, 100_000, 100_000), (True, 100_000, 3), (False, 7, 100_000), (True, 40, 10)])
def test_turns_equal_brute_force_with_one_hot_product(spark, shop, monkeypatch, salted, span, turns):
    if salted:
        monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(prefix, "SPAN", span)
    monkeypatch.setattr(order_jobs, "TURNS", turns)
    draw = random.Random(span)
    stock_of = {p: draw.choice([0, 1, 3, 40, 300, 2000]) for p in range(100, 160)}
    stock_of[100] = 12000  # for some 2400 requests of 15 pieces on average
    requests, bad = [], set()
    for seq in range(6000):
        product = 100 if draw.random() < 0.4 else draw.randrange(100, 162)
        faulty = draw.random() < 0.1
        if faulty:
            bad.add(seq)
        requests.append((seq, 77 if faulty else 1, 1, 1, product, draw.randrange(1, 30), "UPI"))
    tables = dict(shop)
    tables["Inventory"] = make(spark, "Inventory", *[(p, n, "MAIN", None) for p, n in stock_of.items()])
    tables["Products"] = make(spark, "Products", *[(p, "P", 1, 1, Decimal("1.00"), 1, False) for p in stock_of])
    placed = place(spark, tables, requests)
    expected, left = brute_force(requests, stock_of, bad)
    assert verdicts(placed) == expected
    assert {r["ProductID"]: r["QuantityOnHand"] for r in placed.inventory.collect()} == left


def test_all_requests_for_one_product_over_several_spans(spark, shop, monkeypatch):
    monkeypatch.setattr(prefix, "SPAN", 50)
    draw = random.Random(2)
    bad = {seq for seq in range(4000) if draw.random() < 0.2}
    requests = [(seq, 77 if seq in bad else 1, 1, 1, 10, draw.choice([1, 1, 2, 7, 30]), "UPI") for seq in range(4000)]
    tables = {**shop, "Inventory": make(spark, "Inventory", (10, 9000, "MAIN", None))}
    placed = place(spark, tables, requests)
    assert verdicts(placed) == brute_force(requests, {10: 9000}, bad)[0]


def test_no_window_holds_all_requests_of_a_product(spark, shop, monkeypatch):
    """Windows of the decision are over one span of a key, whatever tables are written on the way."""
    plans = []

    def seen(df, label):
        text = io.StringIO()
        with redirect_stdout(text):
            df.explain("extended")
        plans.append(text.getvalue())
        return materialize(df, label)
    for module in (order_jobs, prefix):
        monkeypatch.setattr(module, "materialize", seen)
    monkeypatch.setattr(prefix, "SPAN", 2)
    place(spark, shop, [(i, 1, 1, 1, 10, 1 + i % 3, "UPI") for i in range(20)])
    logical = [line for text in plans for line in text.split("== Physical Plan ==")[0].split("\n") if "+- Window [" in line]
    parts = [re.findall(r"\], \[([^\]]*)\], \[", line)[-1].split(", ") for line in logical]
    assert parts and all(re.match(r"(_unit|_parent)#", names[-1]) and len(names) > 1 for names in parts)


def test_served_batches_are_stored_once_with_all_their_keys(spark, shop):
    """Orders and then returns of them, each batch stored twice; every row fits its table's contract."""
    store = TableStore(spark, scratch_path(spark, "shop"))
    paid = order_jobs.derive_payments(shop["Orders"], F.lit("UPI"), F.lit("Success")).withColumn(
        "Amount", F.col("Amount").cast("decimal(28,2)"))
    for name, table in (*shop.items(), ("Payments", paid)):
        store.write(name, table, NOW)
    requests = [(7, 1, 1, 1, 10, 6, "UPI"), (8, 1, 1, 1, 10, 5, "UPI"), (9, 1, None, 1, 10, 4, "COD")]

    def read(*names):
        return [store.read(name) for name in names]
    placed = order_jobs.place_orders(
        spark.createDataFrame(requests, REQUEST), *read("Orders", "Inventory", "Products", "Customers", "Employees",
                                                        "ShippingAddresses", "OrderDetails"), NOW,
        *read("Payments", "OrderAuditLog", "ErrorLog"))
    assert [order_jobs.store_placed(store, "orders-1", placed, NOW) for _ in range(2)] == [True, False]
    assert {r["OrderID"] for r in store.read("Orders").collect()} == {1, 2, 3, 4, 5, 6, 8}
    assert {r["PaymentID"] for r in store.read("Payments").collect()} == {1, 2, 4, 5, 6, 8}
    assert rows(store.read("OrderAuditLog").select("AuditID", "OrderID", "Action")) == [
        (1, 6, "LINE_ADDED"), (2, 6, "PLACED"), (5, 8, "LINE_ADDED"), (6, 8, "PLACED")]
    assert rows(store.read("ErrorLog").select("ErrorLogID", "ErrorNumber")) == [(2, 51001)]
    assert rows(store.read("Inventory").select("ProductID", "QuantityOnHand")) == [(10, 0), (20, 9), (30, 1)]
    asked = spark.createDataFrame([(1, 6, 1, "late"), (2, 99, 1, None), (3, 3, 1, None)],
                                  "seq BIGINT, OrderDetailID BIGINT, QuantityReturned INT, Reason STRING")
    done = returns.process_returns(asked, *read("OrderDetails", "Payments", "Returns"), NOW, store.read("ErrorLog"))
    assert [returns.store_processed(store, "returns-1", done, NOW) for _ in range(2)] == [True, False]
    assert rows(store.read("Returns").select("ReturnID", "OrderDetailID", "RefundAmount")) == [
        (1, 6, Decimal("100.00")), (3, 3, Decimal("100.00"))]
    assert {r["OrderID"] for r in store.read("Payments").where("PaymentStatus = 'Refunded'").collect()} == {2, 6}
    assert rows(store.read("ErrorLog").select("ErrorLogID", "ErrorNumber")) == [(2, 51001), (4, 51002)]
    again = TableStore(spark, store.root)
    for name in ("Orders", "OrderDetails", "Payments", "Returns", "OrderAuditLog", "ErrorLog"):
        assert checks.table_violations(name, TABLES[name], again.read(name), {}).isEmpty()


def test_totals_round_and_keep_orders_without_lines(spark, shop):
    got = {r["OrderID"]: r["TotalAmount"]
           for r in order_jobs.recompute_totals(shop["Orders"].withColumn("TotalAmount", F.lit(7).cast(
               "decimal(28,2)")), shop["OrderDetails"]).collect()}
    assert got == {1: Decimal("230.00"), 2: Decimal("100.00"), 3: Decimal("49.95"), 4: Decimal("150.00"),
                   5: Decimal("7.00")}


def payments(shop):
    orders = order_jobs.recompute_totals(shop["Orders"], shop["OrderDetails"])
    return order_jobs.derive_payments(orders, F.lit("UPI"), F.lit("Failed"))


def test_payments_leave_out_cancelled_orders(spark, shop):
    got = payments(shop).orderBy("OrderID").collect()
    assert [(r["OrderID"], r["PaymentDate"], r["Amount"]) for r in got][0] == (
        1, datetime(2024, 1, 5, 0, 5), Decimal("230.00"))
    assert [r["OrderID"] for r in got] == [1, 2, 4, 5]


def test_returns(spark, shop):
    requests = spark.createDataFrame(
        [(1, 1, 2, "broken"), (2, 4, 1, None), (3, 99, 1, None), (4, 3, 0, None)],
        "seq BIGINT, OrderDetailID BIGINT, QuantityReturned INT, Reason STRING")
    made = make(spark, "Returns", (30, 5, NOW, 1, None, Decimal("50.00")))
    done = returns.process_returns(requests, shop["OrderDetails"], payments(shop), made, NOW)
    # List price counts, not the discounted one; the cancelled order's return is kept.
    assert rows(done.returns) == [(31, 1, NOW, 2, "broken", Decimal("200.00")), (32, 4, NOW, 1, None, Decimal("9.99"))]
    assert {r["OrderID"]: r["PaymentStatus"] for r in done.payments.collect()} == {
        1: "Refunded", 2: "Failed", 4: "Failed", 5: "Failed"}
    assert [(r["seq"], r["ErrorProcedure"], r["ErrorNumber"]) for r in done.errors.orderBy("seq").collect()] == [
        (2, "usp_ProcessReturn (refund step)", 51003), (3, "usp_ProcessReturn", 51002),
        (4, "usp_ProcessReturn", 547)]


def test_restock_is_strict_and_skips_products_off_sale(spark, shop):
    seen = Observation()
    got = stock.replenish(shop["Inventory"], shop["Products"], date(2024, 6, 1), restocked=seen)
    assert rows(got) == [(10, 10, "MAIN", None), (20, 109, "MAIN", date(2024, 6, 1)), (30, 1, "MAIN", None)]
    assert seen.get["rows"] == 1 and stock.restock_notice(seen) is None


def test_restock_notice_when_nothing_is_short(spark, shop):
    seen = Observation()
    stock.replenish(shop["Inventory"].where("ProductID = 10"), shop["Products"], date(2024, 6, 1),
                    restocked=seen).collect()
    assert stock.restock_notice(seen) == "No products currently below reorder level."


def test_inventory_update_is_all_or_nothing(spark, shop):
    schema = shop["Inventory"].schema
    good = spark.createDataFrame([(10, 3, "B", date(2024, 1, 1)), (99, 3, "B", None)], schema)
    assert rows(stock.apply_inventory_update(shop["Inventory"], good)) == [
        (10, 3, "B", date(2024, 1, 1)), (20, 9, "MAIN", None), (30, 1, "MAIN", None)]
    bad = spark.createDataFrame([(10, 3, "B", None), (20, -1, "B", None)], schema)
    assert rows(stock.apply_inventory_update(shop["Inventory"], bad)) == rows(shop["Inventory"])
    assert rows(stock.update_verdict(bad)) == [(2, 1, "Update rejected: inventory cannot go negative.")]
    twice = spark.createDataFrame([(10, 3, "B", None), (10, 4, "B", None)], schema)
    with pytest.raises(PySparkException, match="more than one row"):
        stock.apply_inventory_update(shop["Inventory"], twice).collect()


def test_audit_text(spark, shop):
    got = audit_new_lines(shop["OrderDetails"].where("OrderDetailID = 1"), NOW).collect()[0]
    assert tuple(got) == (1, 1, "LINE_ADDED", "ProductID=10, Qty=2, LineTotal=180.0000", NOW)


def test_lifetime_value(spark, shop):
    orders = order_jobs.recompute_totals(shop["Orders"], shop["OrderDetails"])
    assert rows(reports.lifetime_values(shop["Customers"], orders)) == [
        (1, Decimal("330.00")), (2, Decimal("0.00")), (3, Decimal("150.00"))]
    assert rows(reports.lifetime_value(orders, 1)) == [(Decimal("330.00"),)]
    assert rows(reports.lifetime_value(orders, 2)) == [(Decimal("0.00"),)]
    assert rows(reports.lifetime_value(orders, 99)) == [(Decimal("0.00"),)]


def test_order_history_leaves_out_orders_without_lines(spark, shop):
    got = reports.order_history(shop["Orders"], shop["OrderDetails"], 1)
    assert got.columns == ["OrderID", "OrderDate", "OrderStatus", "TotalAmount", "LineCount"]
    assert [(r["OrderID"], r["LineCount"]) for r in got.orderBy("OrderID").collect()] == [(1, 2), (2, 1)]
    everyone = reports.order_history(shop["Orders"], shop["OrderDetails"])
    assert [r["OrderID"] for r in everyone.orderBy("OrderID").collect()] == [1, 2, 3, 4]


def test_orders_by_status_binds_its_argument(spark, shop):
    got = reports.orders_by_status(shop["Orders"], "Delivered").collect()
    assert [r["OrderID"] for r in got] == [4, 1]
    assert reports.orders_by_status(shop["Orders"], "x' OR '1'='1").count() == 0
    assert reports.orders_by_status(shop["Orders"], "Delivered" + " " * 40).count() == 0
