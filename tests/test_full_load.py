import time
from datetime import date, datetime
from decimal import Decimal as D
from pathlib import Path

import pytest
from shop import rows
from pyspark.sql import functions as F

from orderloom.model import STAR
from orderloom.operators import checks
from orderloom.operators.columns import with_line_total
from orderloom.operators.merge import merge_upsert
from orderloom.plans import dimensions, facts, full_load
from orderloom.plans.full_load import load_returns, run_full_load, table_counts
from orderloom.session import scratch_path, shared_dir, shuffles_removed
from orderloom.sources.tables import TableStore

DAY1, DAY2 = datetime(2024, 8, 1), datetime(2024, 8, 2)
YEAR = (date(2024, 1, 1), date(2024, 12, 31))


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_path(spark, "test"))


def test_calendar_defaults_and_empty_range(spark):
    empty = spark.createDataFrame([], STAR["DimDate"].schema)
    assert dimensions.load_dim_date(empty).count() == 1461
    single = dimensions.load_dim_date(empty, date(2024, 1, 3), date(2024, 1, 1)).collect()
    assert [tuple(r) for r in single] == [
        (20240103, date(2024, 1, 3), 4, "Wednesday", 3, 1, "January", 1, 2024, False)]


def test_calendar_keeps_days_it_has(spark):
    empty = spark.createDataFrame([], STAR["DimDate"].schema)
    odd = dimensions.load_dim_date(empty, date(2024, 1, 1), date(2024, 1, 1)).withColumn("DayName", F.lit("?"))
    got = dimensions.load_dim_date(odd, date(2024, 1, 1), date(2024, 1, 2))
    assert [(r["DateKey"], r["DayName"]) for r in got.orderBy("DateKey").collect()] == [
        (20240101, "?"), (20240102, "Tuesday")]


def test_first_load(spark, shop, store):
    run_full_load(store, shop, DAY1, YEAR)
    assert {r["TableName"]: r["RowCount"] for r in table_counts(store, [
        "DimDate", "DimCustomer", "DimProduct", "DimEmployee", "DimGeography", "FactSales",
        "FactInventorySnapshot"]).collect()} == {
        "DimDate": 366, "DimCustomer": 3, "DimProduct": 3, "DimEmployee": 2, "DimGeography": 2, "FactSales": 5,
        "FactInventorySnapshot": 3}
    got = store.read("FactSales").orderBy("OrderDetailID").select(
        "OrderDetailID", "DateKey", "CustomerKey", "ProductKey", "EmployeeKey", "LineTotal", "SalesMonth").collect()
    # The cancelled order is in; the order without an employee has no employee key.
    assert [tuple(r) for r in got] == [
        (1, 20240105, 1, 1, 1, D("180.00"), 202401), (2, 20240105, 1, 11, 1, D("50.00"), 202401),
        (3, 20240206, 1, 1, None, D("100.00"), 202402), (4, 20240307, 2, 21, 2, D("49.95"), 202403),
        (5, 20240708, 3, 11, 2, D("150.00"), 202407)]


def test_second_load_of_the_same_changes_nothing(spark, shop, store):
    run_full_load(store, shop, DAY1, YEAR)
    before = {name: rows(store.read(name)) for name in STAR if store.exists(name)}
    run_full_load(store, shop, DAY1, YEAR)
    assert {name: rows(store.read(name)) for name in before} == before


def test_later_load_changes_measures_but_not_keys(spark, shop, store):
    run_full_load(store, shop, DAY1, YEAR)
    later = dict(shop)
    later["Customers"] = shop["Customers"].withColumn(
        "CustomerSegment", F.when(F.col("CustomerID") == 1, "VIP").otherwise(F.col("CustomerSegment")))
    # Line 1 grows, line 6 is new in a month of its own, line 7 comes late into a known month.
    more = spark.createDataFrame([(6, 5, 30, 1), (7, 2, 20, 2)],
                                 "OrderDetailID BIGINT, OrderID BIGINT, ProductID BIGINT, Quantity INT").select(
        "*", F.lit(D("20.00")).cast("decimal(10,2)").alias("UnitPrice"),
        F.lit(0).cast("decimal(4,2)").alias("Discount"))
    grown = shop["OrderDetails"].drop("LineTotal").withColumn(
        "Quantity", F.when(F.col("OrderDetailID") == 1, 3).otherwise(F.col("Quantity")))
    later["OrderDetails"] = with_line_total(grown.unionByName(more))
    run_full_load(store, later, DAY2, YEAR)
    got = {r["OrderDetailID"]: r for r in store.read("FactSales").collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7]
    assert (got[1]["Quantity"], got[1]["LineTotal"], got[1]["CustomerKey"], got[1]["LoadedAt"]) == (
        3, D("270.00"), 1, DAY1)
    current = {r["CustomerID"]: r["CustomerKey"] for r in store.read("DimCustomer").where("IsCurrent").collect()}
    assert current[1] > 3 and got[7]["CustomerKey"] == current[1] and got[7]["LoadedAt"] == DAY2
    keys = [r["SalesKey"] for r in got.values()]
    assert len(set(keys)) == 7 and min(got[6]["SalesKey"], got[7]["SalesKey"]) > 5
    days = {(r["DateKey"], r["ProductKey"]) for r in store.read("FactInventorySnapshot").collect()}
    assert len(days) == 6 and {d for d, _ in days} == {20240801, 20240802}


def test_change_of_order_date_keeps_the_line_in_its_month(spark, shop, store):
    run_full_load(store, shop, DAY1, YEAR)
    moved = {**shop, "Orders": shop["Orders"].withColumn("OrderDate", F.expr("OrderDate + INTERVAL 2 MONTH"))}
    run_full_load(store, moved, DAY2, YEAR)
    got = store.read("FactSales")
    assert got.count() == 5 and rows(got.select("OrderDetailID", "SalesMonth")) == [
        (1, 202401), (2, 202401), (3, 202402), (4, 202403), (5, 202407)]


def test_failed_step_is_logged_and_earlier_steps_stay(spark, shop, store):
    with pytest.raises(facts.DateOutsideCalendar):
        run_full_load(store, shop, DAY1, (date(2024, 2, 1), date(2024, 12, 31)))
    assert store.exists("DimGeography") and not store.exists("FactSales")
    log = store.read("ErrorLog").collect()
    assert [(r["ErrorLogID"], r["ErrorProcedure"], r["ErrorNumber"]) for r in log] == [
        (1, "usp_ETL_RunFullLoad - failed at step: FactSales", 547)]
    assert "20240105" in log[0]["ErrorMessage"]
    with pytest.raises(facts.DateOutsideCalendar):
        run_full_load(store, shop, DAY1, (date(2024, 2, 1), date(2024, 12, 31)))
    assert [r["ErrorLogID"] for r in store.read("ErrorLog").orderBy("ErrorLogID").collect()] == [1, 2]
    run_full_load(store, shop, DAY1, YEAR)
    assert store.read("FactSales").count() == 5


def test_published_versions_are_seen_by_other_readers(spark, shop, store):
    store.write("Categories", shop["Categories"], DAY1)
    other = TableStore(spark, store.root)
    assert rows(other.read("Categories")) == rows(shop["Categories"])
    version = store.stage("Categories", shop["Categories"].where("CategoryID = 1"))
    assert TableStore(spark, store.root).read("Categories").count() == 2
    store.publish({"Categories": version}, DAY2)
    assert TableStore(spark, store.root).read("Categories").count() == 1


def test_product_load_ignores_name_changes_alone(spark, shop):
    empty = spark.createDataFrame([], STAR["DimProduct"].schema)
    load = lambda dim, p: dimensions.load_dim_product(dim, p, shop["Categories"], shop["Suppliers"])
    first = load(empty, shop["Products"])
    renamed = shop["Products"].withColumn("ProductName", F.lit("New"))
    assert rows(load(first, renamed)) == rows(first)
    dearer = renamed.withColumn("UnitPrice", F.when(F.col("ProductID") == 10, D("101.00"))
                                .otherwise(F.col("UnitPrice")).cast("decimal(10,2)"))
    names = {r["ProductID"]: r["ProductName"] for r in load(first, dearer).collect()}
    assert names == {10: "New", 20: "Shirt", 30: "Cable"}


def test_return_facts_accumulate(spark, shop, store):
    run_full_load(store, shop, DAY1, YEAR)
    made = spark.createDataFrame([(1, 1, datetime(2024, 1, 12), 1, None, D("100.00"))],
                                 "ReturnID BIGINT, OrderDetailID BIGINT, ReturnDate TIMESTAMP_NTZ, "
                                 "QuantityReturned INT, Reason STRING, RefundAmount DECIMAL(28,2)")
    load_returns(store, {**shop, "Returns": made}, None, DAY1)
    assert [tuple(r) for r in store.read("FactReturns").collect()] == [
        (1, 1, 20240105, 20240112, None, 1, 1, 1, D("100.00"), None)]
    paid = spark.createDataFrame([(1, datetime(2024, 1, 15))], "ReturnID BIGINT, RefundDate TIMESTAMP_NTZ")
    load_returns(store, {**shop, "Returns": made}, paid, DAY2)
    assert [tuple(r) for r in store.read("FactReturns").collect()] == [
        (1, 1, 20240105, 20240112, 20240115, 1, 1, 1, D("100.00"), 3)]


def test_rows_that_break_a_contract_are_not_published(spark, shop, store):
    """Each kind of rule has its number; what was published before stays as it was."""
    run_full_load(store, shop, DAY1, YEAR)
    before = {name: rows(store.read(name)) for name in STAR if store.exists(name)}
    extra = spark.createDataFrame([(40, "x" * 151, 1, 1, D("1.00"), 1, False)], shop["Products"].schema)
    nameless = spark.createDataFrame([(4, None, "Four", "d@x", None, date(2023, 1, 1), "VIP", True)],
                                     "CustomerID BIGINT, FirstName STRING, LastName STRING, Email STRING, Phone STRING, "
                                     "SignupDate DATE, CustomerSegment STRING, IsActive BOOLEAN")
    unsigned = nameless.withColumn("SignupDate", F.lit(None).cast("date"))
    for changed, step, number, text in (
            ({"Products": shop["Products"].unionByName(extra)}, "DimProduct", 2628, "DimProduct.ProductName length: 1"),
            ({"Customers": shop["Customers"].unionByName(unsigned)}, "DimCustomer", 515,
             "DimCustomer.SignupDate not null: 1"),
            ({"Customers": shop["Customers"].unionByName(shop["Customers"])}, "DimCustomer", 8672, "more than one row")):
        with pytest.raises(Exception):
            run_full_load(store, {**shop, **changed}, DAY2, YEAR)
        last = store.read("ErrorLog").orderBy(F.desc("ErrorLogID")).first()
        assert last["ErrorProcedure"].endswith(step) and last["ErrorNumber"] == number and text in last["ErrorMessage"]
        assert {name: rows(store.read(name)) for name in before if name != "FactInventorySnapshot"} == {
            name: held for name, held in before.items() if name != "FactInventorySnapshot"}


def test_gate_counts_keys_and_references(spark, shop, store):
    run_full_load(store, shop, DAY1, YEAR)
    places, sales = store.read("DimGeography"), store.read("FactSales").drop("SalesMonth")
    parents = {name: store.read(name) for name in STAR}
    twice = places.unionByName(places.withColumn("GeographyKey", F.col("GeographyKey") + 10))
    with pytest.raises(checks.ContractBroken) as found:
        checks.require_contract("DimGeography", STAR["DimGeography"], twice, parents)
    assert found.value.counts == {"DimGeography.City,State,Country unique": 2} and found.value.number == 2627
    with pytest.raises(checks.ContractBroken) as found:
        checks.require_contract("FactSales", STAR["FactSales"], sales.withColumn("CustomerKey", F.lit(99).cast("long")),
                                parents)
    assert found.value.counts == {"FactSales.CustomerKey references DimCustomer": 1} and found.value.number == 547
    checks.require_contract("FactSales", STAR["FactSales"], sales, parents)
    empty, broken = checks.watched("FactSales", STAR["FactSales"], sales.where("false"))
    empty.write.format("noop").mode("overwrite").save()
    assert broken() == {}


def test_closed_versions_are_never_written_again(spark, shop, store):
    def load(segment, day):
        rows_of = shop["Customers"].withColumn("CustomerSegment", F.when(F.col("CustomerID") == 1, segment).otherwise(
            F.col("CustomerSegment")))
        run_full_load(store, {**shop, "Customers": rows_of}, day, YEAR)

    def closed_files():
        return set(store.read("DimCustomer").where("NOT IsCurrent").select(F.col("_metadata.file_path")).distinct()
                   .toPandas()["file_path"])
    load("Standard", DAY1)
    assert closed_files() == set()
    load("VIP", DAY2)
    first = closed_files()
    load("Premium", datetime(2024, 8, 3))
    assert len(first) == 1 and first < closed_files()
    load("Premium", datetime(2024, 8, 4))
    assert len(closed_files()) == 2
    history = store.read("DimCustomer").where("CustomerID = 1").orderBy("CustomerKey").collect()
    assert [(r["CustomerSegment"], r["EffectiveDate"], r["ExpiryDate"], r["IsCurrent"]) for r in history] == [
        ("Standard", date(2024, 8, 1), date(2024, 8, 2), False), ("VIP", date(2024, 8, 2), date(2024, 8, 3), False),
        ("Premium", date(2024, 8, 3), None, True)]
    assert store.read("DimCustomer", "current").count() == 3


def test_a_batch_is_stored_once_and_as_a_whole(spark, shop, store):
    """A batch that dies before its entry is not seen; stored again, it is there once; a rewrite ends its parts."""
    store.write("Orders", shop["Orders"], DAY1)
    more = shop["Orders"].withColumn("OrderID", F.col("OrderID") + 10)
    store.stage("Orders", more)
    assert store.read("Orders").count() == 5
    for turn in (True, False):
        assert store.store_batch("b1", DAY1, {"Orders": more}, {"Inventory": shop["Inventory"]}) is turn
    other = TableStore(spark, store.root)
    assert other.read("Orders").count() == 10 and other.read("Inventory").count() == 3
    assert not other.store_batch("b1", DAY2, {"Orders": more})
    assert other.store_batch("b2", DAY2, {"Orders": more.withColumn("OrderID", F.col("OrderID") + 10)})
    assert {r["OrderID"] for r in other.read("Orders").collect()} == {
        *range(1, 6), *range(11, 16), *range(21, 26)}
    other.write("Orders", other.read("Orders"), DAY2)
    assert other.read("Orders").count() == 15 and other.content("Orders").parts == {}
    assert not other.store_batch("b2", DAY2, {"Orders": more})


def later_shop(spark, shop):
    """Every order a month later, line 1 with more pieces, line 3 gone, two lines more."""
    lines = shop["OrderDetails"].where("OrderDetailID <> 3")
    more = lines.where("OrderDetailID IN (2, 5)").withColumn("OrderDetailID", F.col("OrderDetailID") + 10)
    grown = lines.withColumn("Quantity", F.when(F.col("OrderDetailID") == 1, 7).otherwise(F.col("Quantity")))
    return {**shop, "OrderDetails": with_line_total(grown.unionByName(more).drop("LineTotal")),
            "Orders": shop["Orders"].withColumn("OrderDate", F.expr("OrderDate + INTERVAL 1 MONTH"))}


def test_full_loads_leave_no_temporary_files(spark, shop, store, monkeypatch):
    """Neither shuffle files nor the rows that were kept apart; what is swapped in is not shuffled again."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = Path(shared_dir(spark), "orderloom", spark.sparkContext.applicationId)

    def shuffle_files():
        return {path for folder in disk.localDirsString() for path in Path(folder).rglob("shuffle_*.data")}

    def kept_rows():
        return {path for name in ("sales-source", "FactSales", "moved-lines", "DimCustomer", "FactInventorySnapshot")
                for path in held.glob(f"{name}-*")}
    plans, swap = [], TableStore.replace_partitions

    def seen(store, name, df, partition_by):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        swap(store, name, df, partition_by)
    monkeypatch.setattr(TableStore, "replace_partitions", seen)
    before, kept = shuffle_files(), kept_rows()
    run_full_load(store, shop, DAY1, YEAR)
    run_full_load(store, later_shop(spark, shop), DAY2, YEAR)
    for _ in range(50):  # they are deleted in the background
        if shuffle_files() <= before:
            break
        time.sleep(0.2)
    assert shuffle_files() <= before and kept_rows() <= kept
    assert plans and not any("Repartition" in text for text in plans)


def test_sales_loaded_in_shares_are_the_same(spark, shop, store, monkeypatch):
    whole = TableStore(spark, scratch_path(spark, "test"))
    for tables, day in ((shop, DAY1), (later_shop(spark, shop), DAY2)):
        run_full_load(whole, tables, day, YEAR)
    got = {r["OrderDetailID"]: (r["SalesMonth"], r["Quantity"]) for r in whole.read("FactSales").collect()}
    assert got == {1: (202401, 7), 2: (202401, 1), 3: (202402, 1), 4: (202403, 5), 5: (202407, 3), 12: (202402, 1),
                   15: (202408, 3)}
    monkeypatch.setattr(full_load, "SHARED_LINES", 0)
    monkeypatch.setattr(full_load, "MERGED_ROWS", 2)
    counted, place = {}, full_load._placed
    monkeypatch.setattr(full_load, "_placed", lambda df, months: counted.update(months) or place(df, months))
    for tables, day in ((shop, DAY1), (later_shop(spark, shop), DAY2)):
        run_full_load(store, tables, day, YEAR)
    assert rows(store.read("FactSales")) == rows(whole.read("FactSales"))
    # Rows of a month that are read are counted, whether the batch has them or not.
    assert counted == {202401: 2, 202402: 4, 202403: 1, 202404: 1, 202407: 1, 202408: 2}


def test_a_large_month_has_several_tasks_and_small_ones_share_one(spark, monkeypatch):
    monkeypatch.setattr(full_load, "MERGED_ROWS", 100)
    months = {202401: 40, 202402: 50, 202403: 950, 202404: 30}
    lines = spark.createDataFrame([(m,) for m, n in months.items() for _ in range(n)], "_at INT").select(
        "_at", F.monotonically_increasing_id().alias("OrderDetailID"), F.col("_at").alias("month"))
    placed = full_load._placed(lines, months).withColumn("at", F.spark_partition_id())
    assert placed.where("at <> _task").isEmpty() and placed.count() == 1070
    tasks = {r["month"]: set(r["tasks"]) for r in placed.groupBy("month").agg(
        F.collect_set("_task").alias("tasks")).collect()}
    assert tasks == {202401: {0}, 202402: {0}, 202403: set(range(1, 11)), 202404: {11}}
    both = merge_upsert(full_load._placed(lines, months), full_load._placed(lines, months),
                        ["_task", "OrderDetailID"], ["month"])
    both.collect()
    assert both._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange") == 4
    assert full_load._dealt(months, 2) == [[202403], [202401, 202402, 202404]]


def test_threads_share_the_removal_of_shuffle_files(spark):
    """The setting comes back when the last one is done, in whatever order they end."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    first, second = shuffles_removed(spark), shuffles_removed(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(name) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(name, None) == before
