from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from shop import rows

from orderloom.model import STAR
from orderloom.operators import skew
from orderloom.plans import analytics, dimensions
from orderloom.sources import seed

FACT = ("SalesKey BIGINT, DateKey INT, CustomerKey BIGINT, ProductKey BIGINT, EmployeeKey BIGINT, "
        "LineTotal DECIMAL(12,2)")


@pytest.fixture
def calendar(spark):
    empty = spark.createDataFrame([], STAR["DimDate"].schema)
    return dimensions.load_dim_date(empty, date(2023, 1, 1), date(2024, 12, 31))


def fact(spark, *sales):
    return spark.createDataFrame([(n, *sale) for n, sale in enumerate(sales)], FACT)


def products(spark):
    return spark.createDataFrame([(1, "Electronics"), (2, "Apparel"), (3, "Books")],
                                 "ProductKey BIGINT, CategoryName STRING")


def test_months_skip_gaps_and_run_over_years(spark, calendar):
    f = fact(spark, (20231215, 1, 1, 1, D("10.00")), (20240110, 1, 1, 1, D("5.50")), (20240111, 1, 1, 1, D("1.50")),
             (20240301, 1, 1, 1, D("2.00")))
    got = [tuple(r) for r in analytics.monthly_sales(f, calendar).collect()]
    assert got == [
        (2023, 12, "December", D("10.00"), D("10.00"), None, None),
        (2024, 1, "January", D("7.00"), D("17.00"), D("10.00"), D("-3.00")),
        (2024, 3, "March", D("2.00"), D("19.00"), D("7.00"), D("-5.00"))]


@pytest.mark.parametrize("salted", [False, True])
def test_rank_ties_and_versions_of_a_customer(spark, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    customers = spark.createDataFrame([(n, f"C{n}") for n in range(1, 8)] + [(8, "C1")],
                                      "CustomerKey BIGINT, FullName STRING")
    staff = spark.createDataFrame([(1, "North"), (2, "South")], "EmployeeKey BIGINT, Region STRING")
    sales = [(20240101, n, 1, 1, D(100 - 10 * n)) for n in range(1, 6)]
    sales += [(20240101, 6, 1, 1, D(50)), (20240101, 7, 1, 1, D(1)),   # 6 ties with 5; 7 is seventh
              (20240101, 8, 1, 1, D(5)),                               # another version of customer 1
              (20240101, 7, 1, None, D(999)), (20240101, 7, 1, 2, D(3))]
    got = [tuple(r) for r in analytics.top_customers_by_region(fact(spark, *sales), customers, staff).collect()]
    assert got == [("North", "C1", D("95.00"), 1), ("North", "C2", D("80.00"), 2), ("North", "C3", D("70.00"), 3),
                   ("North", "C4", D("60.00"), 4), ("North", "C5", D("50.00"), 5), ("North", "C6", D("50.00"), 5),
                   ("South", "C7", D("3.00"), 1)]


def test_org_chart_of_the_seed(spark):
    got = [tuple(r) for r in analytics.org_hierarchy(seed.employees(spark)).collect()]
    assert got == [
        ("Aditi Sharma", "Sales Director", 0), ("    Kiran Nair", "Sales Manager", 1),
        ("    Rohan Verma", "Sales Manager", 1), ("        Priya Das", "Sales Executive", 2),
        ("        Neha Gupta", "Sales Executive", 2), ("        Arjun Iyer", "Sales Executive", 2)
    ]


STAFF = "EmployeeID BIGINT, FirstName STRING, LastName STRING, ManagerID BIGINT, Title STRING"


def chain(n):
    return [(i, "F", f"L{i:04d}", i - 1 if i else None, "T") for i in range(n)]


def test_cycles_and_orphans_are_absent(spark):
    staff = spark.createDataFrame(
        chain(3) + [(10, "F", "X", 11, "T"), (11, "F", "Y", 10, "T"), (12, "F", "Z", 11, "T"), (20, "F", "O", 99, "T"),
                    (30, "F", "S", 30, "T")], STAFF)
    assert [(r["OrgChart"].strip(), r["HierarchyLevel"]) for r in analytics.org_hierarchy(staff).collect()] == [
        ("F L0000", 0), ("F L0001", 1), ("F L0002", 2)]


def test_depth_limit(spark):
    deepest = analytics.org_hierarchy(spark.createDataFrame(chain(101), STAFF))
    assert max(r["HierarchyLevel"] for r in deepest.collect()) == 100
    with pytest.raises(RecursionError):
        analytics.org_hierarchy(spark.createDataFrame(chain(102), STAFF))
    assert analytics.org_hierarchy(spark.createDataFrame(chain(130), STAFF), max_levels=200).count() == 130


def test_hierarchy_below_one_hot_manager(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    wide = [(i, "F", f"L{i}", None if i == 0 else 0 if i <= 400 else i - 400, "T") for i in range(900)]
    got = analytics.org_hierarchy(spark.createDataFrame(wide, STAFF)).groupBy("HierarchyLevel").count()
    assert rows(got) == [(0, 1), (1, 400), (2, 400), (3, 99)]


def test_pivot_leaves_holes_null(spark, calendar):
    f = fact(spark, (20240101, 1, 1, 1, D("5.00")), (20241231, 1, 1, 1, D("7.00")), (20240401, 1, 2, 1, D("1.00")),
             (20230101, 1, 3, 1, D("9.00")))
    got = [tuple(r) for r in analytics.category_by_quarter(f, products(spark), calendar, 2024).collect()]
    assert got == [("Apparel", None, D("1.00"), None, None), ("Electronics", D("5.00"), None, None, D("7.00"))]


def orders(spark, *days):
    start = datetime(2024, 1, 1, 9)
    return spark.createDataFrame([(c, start + timedelta(days=d)) for c, d in days],
                                 "CustomerID BIGINT, OrderDate TIMESTAMP_NTZ")


def test_islands_and_gaps(spark):
    o = orders(spark, (1, 1), (1, 2), (1, 2), (1, 3), (1, 70), (1, 200), (2, 5))
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    assert rows(analytics.order_islands(o)) == sorted([
        (1, day(1), day(3)), (1, day(70), day(70)), (1, day(200), day(200)), (2, day(5), day(5))], key=repr)
    pairs = [tuple(r) for r in analytics.gaps_all_pairs(o).collect()]
    assert pairs == [(1, day(3), day(200), 197), (1, day(70), day(200), 130), (1, day(3), day(70), 67)]
    assert rows(analytics.gaps_counted(o)) == sorted([
        (1, day(3), 2, day(70), 197), (1, day(70), 1, day(200), 130), (1, day(200), 0, None, None),
        (2, day(5), 0, None, None)], key=repr)
    assert [r["GapDays"] for r in analytics.gaps_adjacent(o).collect()] == [130, 67]
    assert [r["GapDays"] for r in analytics.gaps_adjacent(o, 68).collect()] == [130]


def test_buyer_segments(spark):
    f = fact(spark, (20240101, 1, 1, 1, D(1)), (20240101, 1, 1, 1, D(1)), (20240101, 2, 1, 1, D(1)),
             (20240101, 2, 2, 1, D(1)), (20240101, 3, 2, 1, D(1)), (20240101, 4, 3, 1, D(1)))
    expected = [(1, "Electronics only"), (2, "Bought both")]
    assert rows(analytics.buyer_segments(f, products(spark), "Electronics", "Apparel")) == expected
    assert rows(analytics.buyer_segments_one_pass(f, products(spark), "Electronics", "Apparel")) == expected
