"""All queries by name. Each takes a session and a data directory and returns its result."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from orderloom import scenario
from orderloom.functions.errors import LoadRefused
from orderloom.model import OLTP, STAR
from orderloom.operators import checks
from orderloom.operators.columns import with_defaults
from orderloom.operators.keys import highest, offset_keys, rank_keys
from orderloom.plans import analytics, audit, dimensions, facts, reports, returns, stock
from orderloom.plans import full_load, orders as order_jobs
from orderloom.session import materialize, scratch_path
from orderloom.sources import adapter, generator, seed
from orderloom.sources.tables import TableStore
from orderloom.sources.workspace import FIRST_LOAD, SECOND_LOAD, Workspace, workspace

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def query(run: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    """Register a function from workspace to result under its own name."""
    _queries[run.__name__] = lambda spark, directory: run(workspace(spark, directory))
    return run


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def _empty(w: Workspace, name: str) -> DataFrame:
    return w.spark.createDataFrame([], STAR[name].schema)


# Analytics over the loaded star schema.

@query
def monthly_sales(w: Workspace) -> DataFrame:
    return analytics.monthly_sales(w.star("FactSales"), w.star("DimDate"))


@query
def top_customers_by_region(w: Workspace) -> DataFrame:
    return analytics.top_customers_by_region(w.star("FactSales"), w.star("DimCustomer"), w.star("DimEmployee"))


@query
def org_hierarchy(w: Workspace) -> DataFrame:
    return analytics.org_hierarchy(w.table("Employees"))


@query
def category_quarter_pivot(w: Workspace) -> DataFrame:
    return analytics.category_by_quarter(w.star("FactSales"), w.star("DimProduct"), w.star("DimDate"),
                                         scenario.PIVOT_YEAR)


@query
def order_islands(w: Workspace) -> DataFrame:
    return analytics.order_islands(w.table("Orders"))


@query
def churn_gaps_all_pairs(w: Workspace) -> DataFrame:
    return analytics.gaps_all_pairs(w.table("Orders"))


@query
def churn_gap_counts(w: Workspace) -> DataFrame:
    """The same, counted: one row per island."""
    return analytics.gaps_counted(w.table("Orders"))


@query
def churn_gaps_adjacent(w: Workspace) -> DataFrame:
    return analytics.gaps_adjacent(w.table("Orders"))


@query
def segment_set_ops(w: Workspace) -> DataFrame:
    return analytics.buyer_segments(w.star("FactSales"), w.star("DimProduct"), scenario.WANTED, scenario.OTHER)


@query
def segment_one_pass(w: Workspace) -> DataFrame:
    return analytics.buyer_segments_one_pass(w.star("FactSales"), w.star("DimProduct"), scenario.WANTED,
                                             scenario.OTHER)


# Dimensions.

@query
def dim_date(w: Workspace) -> DataFrame:
    """The calendar of the orders' first half year, then completed to whole years."""
    start, end = w.calendar()
    part = dimensions.load_dim_date(_empty(w, "DimDate"), start, start.replace(month=6, day=30))
    return dimensions.load_dim_date(part, start, end)


def _customers_twice(w: Workspace) -> tuple[DataFrame, DataFrame]:
    customers = w.table("Customers")
    first = materialize(dimensions.load_dim_customer(
        _empty(w, "DimCustomer"), scenario.first_customers(customers), FIRST_LOAD.date()), "first-customers")
    return first, dimensions.load_dim_customer(first, scenario.later_customers(customers), SECOND_LOAD.date())


@query
def dim_customer_scd2(w: Workspace) -> DataFrame:
    return _customers_twice(w)[1]


@query
def dim_customer_scd2_rerun(w: Workspace) -> DataFrame:
    """A third load of the same source changes nothing."""
    again = dimensions.load_dim_customer(_customers_twice(w)[1],
                                         scenario.later_customers(w.table("Customers")), SECOND_LOAD.date())
    return again.groupBy("CustomerSegment", "IsCurrent", "EffectiveDate", "ExpiryDate").agg(
        F.count("*").alias("versions"), F.max("CustomerKey").alias("last_key"))


def _products_twice(w: Workspace) -> tuple[DataFrame, DataFrame]:
    products, categories, suppliers = w.table("Products"), w.table("Categories"), w.table("Suppliers")
    first = materialize(dimensions.load_dim_product(
        _empty(w, "DimProduct"), scenario.first_products(products), categories, suppliers), "first-products")
    return first, dimensions.load_dim_product(first, scenario.later_products(products), categories, suppliers)


@query
def dim_product_scd1(w: Workspace) -> DataFrame:
    return _products_twice(w)[1]


@query
def dim_employee_upsert(w: Workspace) -> DataFrame:
    employees = w.table("Employees")
    first = dimensions.load_dim_employee(_empty(w, "DimEmployee"), scenario.first_employees(employees))
    return dimensions.load_dim_employee(first, scenario.later_employees(employees))


@query
def dim_geography_insert(w: Workspace) -> DataFrame:
    addresses = w.table("ShippingAddresses")
    first = dimensions.load_dim_geography(_empty(w, "DimGeography"), scenario.first_addresses(addresses))
    return dimensions.load_dim_geography(first, addresses)


# Facts.

@query
def fact_sales_initial(w: Workspace) -> DataFrame:
    return w.star("FactSales").drop(facts.SALES_MONTH)


@query
def fact_sales_merge(w: Workspace) -> DataFrame:
    """A first load without inactive customers and products off sale, then a second with everything changed."""
    customers, products = _customers_twice(w), _products_twice(w)

    def source(turn: int, lines: DataFrame) -> DataFrame:
        return facts.sales_source(lines, w.table("Orders"), w.table("ShippingAddresses"), customers[turn],
                                  products[turn], w.star("DimEmployee"), w.star("DimGeography"))

    lines = w.table("OrderDetails")
    first = materialize(facts.first_sales(source(0, lines), lines, FIRST_LOAD), "first-sales")
    return facts.merge_sales(first, source(1, scenario.later_lines(lines)), lines, SECOND_LOAD)


@query
def fact_sales_outside_calendar(w: Workspace) -> DataFrame:
    """Sales days a calendar without the last year of orders would refuse."""
    start, _ = w.calendar()
    calendar = dimensions.load_dim_date(_empty(w, "DimDate"), start, start.replace(year=start.year + 5))
    return checks.check_foreign_key(w.star("FactSales"), ["DateKey"], calendar, ["DateKey"], "sales day known")


@query
def inventory_snapshot_merge(w: Workspace) -> DataFrame:
    """A snapshot, the same day again after restocking, and the next day."""
    inventory, products, dim = w.table("Inventory"), w.table("Products"), w.star("DimProduct")
    restocked = stock.replenish(inventory, products, FIRST_LOAD.date())
    fact = _empty(w, "FactInventorySnapshot")
    for rows, as_of in ((inventory, FIRST_LOAD), (restocked, FIRST_LOAD), (restocked, SECOND_LOAD)):
        source = facts.snapshot_source(rows, products, dim, as_of.date())
        fact = facts.merge_snapshot(fact, source, dim, as_of, highest(fact, "SnapshotKey"))
    return fact


@query
def fact_returns(w: Workspace) -> DataFrame:
    return w.star("FactReturns")


@query
def fact_returns_refunded(w: Workspace) -> DataFrame:
    """The return facts after some of the refunds have been paid."""
    made = w.table("Returns")
    source = facts.returns_source(made, w.table("OrderDetails"), w.table("Orders"), w.star("DimCustomer"),
                                  w.star("DimProduct"), scenario.refunds_paid(made))
    return facts.merge_returns(w.star("FactReturns"), source, made)


@query
def second_load_counts(w: Workspace) -> DataFrame:
    """Rows per table after two full loads of changing sources into tables of their own."""
    store = TableStore(w.spark, scratch_path(w.spark, "two-loads"))
    oltp = w.oltp()
    first = {**oltp, "Customers": scenario.first_customers(oltp["Customers"]),
             "Products": scenario.first_products(oltp["Products"]),
             "Employees": scenario.first_employees(oltp["Employees"]),
             "ShippingAddresses": scenario.first_addresses(oltp["ShippingAddresses"])}
    later = {**oltp, "Customers": scenario.later_customers(oltp["Customers"]),
             "Products": scenario.later_products(oltp["Products"]),
             "Employees": scenario.later_employees(oltp["Employees"]),
             "OrderDetails": scenario.later_lines(oltp["OrderDetails"])}
    full_load.run_full_load(store, first, FIRST_LOAD, w.calendar())
    full_load.run_full_load(store, later, SECOND_LOAD, w.calendar())
    return full_load.table_counts(store, ["DimDate", "DimCustomer", "DimProduct", "DimEmployee", "DimGeography",
                                          "FactSales", "FactInventorySnapshot"])


# Table contracts and keys.

@query
def constraint_violations(w: Workspace) -> DataFrame:
    """How often each rule of the retail tables is broken, 0 included; the order lines are unchecked ones."""
    tables = {**w.oltp(), "Payments": w.table("Payments"), "Returns": w.table("Returns")}
    tables["OrderDetails"] = scenario.unchecked_lines(tables["OrderDetails"])
    parents = {**tables, "OrderDetails": w.table("OrderDetails")}
    found, rules = [], []
    for name, df in tables.items():
        found.append(checks.table_violations(name, OLTP[name], df, parents))
        rules += checks.rule_names(name, OLTP[name], df.columns, list(parents))
    counted = reduce(DataFrame.unionByName, found).groupBy("rule").agg(F.count("*").alias("violations"))
    known = w.spark.createDataFrame([(rule,) for rule in rules], "rule STRING")
    return known.join(counted, "rule", "left").select(
        "rule", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))


_STAR_TABLES = ["DimDate", "DimCustomer", "DimProduct", "DimEmployee", "DimGeography", "FactSales",
                "FactInventorySnapshot", "FactReturns"]


@query
def star_constraint_violations(w: Workspace) -> DataFrame:
    """How often each rule of the star schema is broken by tables with planted faults, 0 included."""
    parents = {name: w.star(name).select(*[f.name for f in STAR[name].schema.fields]) for name in _STAR_TABLES}
    tables = scenario.unchecked_star(parents)
    found = [checks.table_violations(name, STAR[name], df, parents) for name, df in tables.items()]
    rules = [rule for name, df in tables.items() for rule in checks.rule_names(name, STAR[name], df.columns, _STAR_TABLES)]
    counted = reduce(DataFrame.unionByName, found).groupBy("rule").agg(F.count("*").alias("violations"))
    known = w.spark.createDataFrame([(rule,) for rule in rules], "rule STRING")
    return known.join(counted, "rule", "left").select(
        "rule", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))


@query
def load_failures(w: Workspace) -> DataFrame:
    """The error log after three loads that fail: customers given twice, products without a name, orders beyond the
    calendar. Which customer is met first is left to chance, so the message about it is cut."""
    store = TableStore(w.spark, scratch_path(w.spark, "failing-loads"))
    oltp = w.oltp()
    named = F.when(F.col("ProductID") % 7 != 0, F.col("ProductName"))
    later = F.col("OrderDate") + F.expr("INTERVAL 20 YEAR")
    for changed in ({"Customers": scenario.twice(oltp["Customers"], "CustomerID", 10)},
                    {"Products": oltp["Products"].withColumn("ProductName", named)},
                    {"Orders": oltp["Orders"].withColumn("OrderDate", later)}):
        try:
            full_load.run_full_load(store, {**oltp, **changed}, FIRST_LOAD, w.calendar())
        except (PySparkException, LoadRefused):
            continue  # the load has logged it
        raise AssertionError("a load that has to fail did not")
    return store.read("ErrorLog").select("ErrorLogID", "ErrorProcedure", "ErrorNumber", F.regexp_replace(
        "ErrorMessage", "more than one row.*", "more than one row").alias("ErrorMessage"), "ErrorAt")


@query
def merge_refusals(w: Workspace) -> DataFrame:
    """The keys for which an upsert of unchecked order lines is refused, and how many rows each has."""
    return checks.check_unique(scenario.unchecked_lines(w.table("OrderDetails")), ["OrderDetailID"],
                               "merge source").select(F.col("key").cast("long").alias("OrderDetailID"), "detail")


@query
def seeded_categories(w: Workspace) -> DataFrame:
    """The categories every new shop starts with, beside those of the products at hand that share their first letter."""
    letter = F.substring("CategoryName", 1, 1)
    at_hand = (w.table("Products").join(w.table("Categories"), "CategoryID").groupBy(letter.alias("Letter"))
               .agg(F.count("*").alias("ProductsAtHand")))
    return seed.categories(w.spark).withColumn("Letter", letter).join(
        F.broadcast(at_hand), "Letter", "left").select(  # one row per letter
        "CategoryID", "CategoryName", F.coalesce("ProductsAtHand", F.lit(0)).cast("long").alias("ProductsAtHand"))


@query
def rejected_lines(w: Workspace) -> DataFrame:
    """Unchecked order lines that must not be stored, with the rules they break."""
    parents = {"Orders": w.table("Orders"), "Products": w.table("Products")}
    _, bad = checks.split_valid("OrderDetails", OLTP["OrderDetails"],
                                scenario.unchecked_lines(w.table("OrderDetails")), parents)
    return bad.select("OrderDetailID", F.concat_ws("; ", F.array_sort("broken_rules")).alias("broken_rules"))


@query
def accepted_lines(w: Workspace) -> DataFrame:
    parents = {"Orders": w.table("Orders"), "Products": w.table("Products")}
    good, _ = checks.split_valid("OrderDetails", OLTP["OrderDetails"],
                                 scenario.unchecked_lines(w.table("OrderDetails")), parents)
    return good.select("OrderDetailID", "OrderID", "ProductID", "Quantity")


@query
def surrogate_keys(w: Workspace) -> DataFrame:
    """Customers numbered after 1000 by segment and id, without gaps."""
    rows = w.table("Customers").select("CustomerSegment", "CustomerID")
    return rank_keys(rows, "CustomerKey", ["CustomerSegment", "CustomerID"], 1000, "customer-keys")


@query
def surrogate_keys_with_gaps(w: Workspace) -> DataFrame:
    return offset_keys(w.table("Returns").select("ReturnID"), "ReturnKey", "ReturnID", 1000)


@query
def default_values(w: Workspace) -> DataFrame:
    """Orders sent with nothing but their references, completed by the table's defaults."""
    sent = w.table("Orders").select("OrderID", "CustomerID", "EmployeeID", "AddressID")
    return with_defaults(sent, OLTP["Orders"], FIRST_LOAD)


# Order, return and stock jobs.

@query
def order_totals(w: Workspace) -> DataFrame:
    headers = adapter.order_headers(w.spark, w.directory)
    return order_jobs.recompute_totals(headers, w.table("OrderDetails")).select("OrderID", "TotalAmount")


@query
def payments_derived(w: Workspace) -> DataFrame:
    key = F.col("OrderID")
    return order_jobs.derive_payments(w.table("Orders"), adapter.payment_method(key), adapter.payment_status(key))


@query
def returns_sampled(w: Workspace) -> DataFrame:
    return returns.sample_returns(w.table("OrderDetails"), w.table("Orders"), scenario.SAMPLE_ROWS)


def _place(w: Workspace) -> order_jobs.PlacedOrders:
    """The batch is decided once; the queries below read its results."""
    return w.once("placed orders", lambda: order_jobs.place_orders(
        scenario.order_requests(w.table("OrderDetails"), w.table("Orders")), w.table("Orders"),
        w.table("Inventory"), w.table("Products"), w.table("Customers"), w.table("Employees"),
        w.table("ShippingAddresses"), w.table("OrderDetails"), FIRST_LOAD, w.table("Payments")))


@query
def place_orders(w: Workspace) -> DataFrame:
    return _place(w).decided.select("seq", "ProductID", "Quantity", "Accepted", "ErrorNumber")


@query
def place_orders_headers(w: Workspace) -> DataFrame:
    return _place(w).orders


@query
def place_orders_lines(w: Workspace) -> DataFrame:
    return _place(w).lines


@query
def place_orders_payments(w: Workspace) -> DataFrame:
    return _place(w).payments


@query
def place_orders_audit(w: Workspace) -> DataFrame:
    return _place(w).audit


@query
def place_orders_errors(w: Workspace) -> DataFrame:
    return _place(w).errors


@query
def place_orders_inventory(w: Workspace) -> DataFrame:
    return _place(w).inventory


@query
def place_orders_stored(w: Workspace) -> DataFrame:
    """The stored tables after the batch was stored, and stored once more: all rows, in one shape."""
    store = TableStore(w.spark, scratch_path(w.spark, "shop"))
    for name in ("Orders", "OrderDetails", "Payments", "Inventory"):
        store.write(name, w.table(name), FIRST_LOAD)
    placed = _place(w)
    for _ in range(2):
        order_jobs.store_placed(store, "requests-1", placed, FIRST_LOAD)
    none = F.lit(None)
    shapes = {
        "Orders": ("OrderID", "OrderID", none, "TotalAmount", "OrderStatus"),
        "OrderDetails": ("OrderDetailID", "OrderID", "ProductID", "LineTotal", F.col("Quantity").cast("string")),
        "Payments": ("PaymentID", "OrderID", none, "Amount", F.concat_ws(" ", "PaymentMethod", "PaymentStatus")),
        "OrderAuditLog": ("AuditID", "OrderID", none, none, F.concat_ws(": ", "Action", "ActionDetail")),
        "ErrorLog": ("ErrorLogID", none, none, "ErrorNumber", F.col("ErrorMessage")),
        "Inventory": ("ProductID", none, "ProductID", "QuantityOnHand", F.col("WarehouseLocation"))}
    types = ("bigint", "bigint", "bigint", "decimal(28,4)", "string")
    names = ("RowID", "OrderID", "ProductID", "Amount", "Detail")
    read = TableStore(w.spark, store.root)  # as another reader sees them
    return reduce(DataFrame.unionByName, [read.read(table).select(F.lit(table).alias("TableName"), *[
        (F.col(c) if isinstance(c, str) else c).cast(t).alias(n) for c, t, n in zip(shape, types, names)])
        for table, shape in shapes.items()])


def _process(w: Workspace) -> returns.ProcessedReturns:
    return w.once("processed returns", lambda: returns.process_returns(
        scenario.return_requests(w.order_lines()), w.table("OrderDetails"), w.table("Payments"),
        w.table("Returns"), FIRST_LOAD))


@query
def process_returns(w: Workspace) -> DataFrame:
    return _process(w).returns


@query
def process_returns_payments(w: Workspace) -> DataFrame:
    return _process(w).payments


@query
def process_returns_errors(w: Workspace) -> DataFrame:
    return _process(w).errors


@query
def replenish_inventory(w: Workspace) -> DataFrame:
    return stock.replenish(w.table("Inventory"), w.table("Products"), FIRST_LOAD.date())


@query
def restock_notice(w: Workspace) -> DataFrame:
    """How many products a restocking changes, the notice it gives, and both for a second one, which finds none short.

    The first run sets every short product to its reorder level at least; both are written."""
    runs, inventory = [], w.table("Inventory")
    for turn in (1, 2):
        watched = Observation()
        inventory = materialize(stock.replenish(inventory, w.table("Products"), FIRST_LOAD.date(), restocked=watched),
                                "restocked")
        runs.append((turn, watched.get["rows"], stock.restock_notice(watched)))
    return w.spark.createDataFrame(runs, "Run INT, RowsChanged BIGINT, Notice STRING")


@query
def line_audit(w: Workspace) -> DataFrame:
    return audit.audit_new_lines(w.table("OrderDetails"), FIRST_LOAD)


@query
def inventory_update_accepted(w: Workspace) -> DataFrame:
    return stock.apply_inventory_update(w.table("Inventory"), scenario.stock_count(w.table("Inventory")))


@query
def inventory_update_rejected(w: Workspace) -> DataFrame:
    return stock.apply_inventory_update(w.table("Inventory"), scenario.wrong_stock_count(w.table("Inventory")))


@query
def inventory_update_verdicts(w: Workspace) -> DataFrame:
    inventory = w.table("Inventory")
    return stock.update_verdict(scenario.stock_count(inventory)).unionByName(
        stock.update_verdict(scenario.wrong_stock_count(inventory)))


# Reports.

@query
def customer_ltv(w: Workspace) -> DataFrame:
    return reports.lifetime_values(w.table("Customers"), w.table("Orders"))


@query
def order_history(w: Workspace) -> DataFrame:
    return reports.order_history(w.table("Orders"), w.table("OrderDetails"))


@query
def customer_functions(w: Workspace) -> DataFrame:
    """Both customer functions called from SQL, for every customer and as many unknown ones."""
    suffix = f"_{zlib.crc32(w.directory.encode()):08x}"
    return reports.customer_report(scenario.asked_customers(w.table("Customers")), w.table("Orders"),
                                   w.table("OrderDetails"), suffix)


@query
def orders_by_status(w: Workspace) -> DataFrame:
    return reports.orders_by_status(w.table("Orders"), "Delivered")


@query
def load_summary(w: Workspace) -> DataFrame:
    """Row counts of customers, orders and order lines in one row."""
    counts = [w.table(name).agg(F.count("*").alias("n")).scalar().alias(label) for name, label in
              (("Customers", "customers"), ("Orders", "orders"), ("OrderDetails", "order_lines"))]
    return w.spark.range(1).select(*counts)


# Sample rows for the keys of the tables at hand.

def _made_customers(w: Workspace) -> DataFrame:
    return generator.customers_for(w.table("Customers").select(F.col("CustomerID").alias("n")), FIRST_LOAD)


@query
def generated_customers(w: Workspace) -> DataFrame:
    return _made_customers(w)


@query
def generated_addresses(w: Workspace) -> DataFrame:
    return generator.generate_addresses(_made_customers(w))


@query
def generated_products(w: Workspace) -> DataFrame:
    return generator.products_for(w.table("Products").select(F.col("ProductID").alias("n")),
                                  w.table("Categories").count(), w.table("Suppliers").count())


@query
def generated_inventory(w: Workspace) -> DataFrame:
    return generator.generate_inventory(w.table("Products"), FIRST_LOAD)


@query
def generated_orders(w: Workspace) -> DataFrame:
    return generator.generate_orders(w.table("Customers"), w.table("ShippingAddresses"), w.table("Employees"),
                                     FIRST_LOAD)


@query
def generated_lines(w: Workspace) -> DataFrame:
    return generator.generate_lines(w.table("Orders"), w.table("Products"))


@query
def generated_payments(w: Workspace) -> DataFrame:
    key = F.col("OrderID")
    return order_jobs.derive_payments(w.table("Orders"), generator.random_method(key),
                                      generator.random_status(key))
