import sys
from datetime import date, datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from orderloom.operators.columns import with_line_total  # noqa: E402
from orderloom.session import build_session  # noqa: E402
from shop import make  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8, **{"spark.ui.showConsoleProgress": "false",
                                                       "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def shop(spark):
    """Hand-made retail tables: three customers, three products, five orders."""
    moment = datetime(2024, 3, 1, 10)
    lines = spark.createDataFrame([
        (1, 1, 10, 2, "100.00", "0.10"), (2, 1, 20, 1, "50.00", "0.00"), (3, 2, 10, 1, "100.00", "0.00"),
        (4, 3, 30, 5, "9.99", "0.00"), (5, 4, 20, 3, "50.00", "0.00")],
        "OrderDetailID BIGINT, OrderID BIGINT, ProductID BIGINT, Quantity INT, UnitPrice STRING, Discount STRING"
    ).selectExpr("OrderDetailID", "OrderID", "ProductID", "Quantity", "CAST(UnitPrice AS DECIMAL(10,2)) AS UnitPrice",
                 "CAST(Discount AS DECIMAL(4,2)) AS Discount")
    from decimal import Decimal as D
    return {
        "Categories": make(spark, "Categories", (1, "Electronics", None), (2, "Apparel", None)),
        "Suppliers": make(spark, "Suppliers", (1, "Acme", None, None, "India", moment)),
        "Employees": make(spark, "Employees",
                          (1, "Ann", "Lee", None, "Director", date(2020, 1, 1), "North"),
                          (2, "Bob", "Ray", 1, "Manager", date(2020, 1, 1), "South")),
        "Customers": make(spark, "Customers",
                          (1, "A", "One", "a@x", None, date(2023, 1, 1), "Standard", True),
                          (2, "B", "Two", "b@x", None, date(2023, 1, 1), "Premium", True),
                          (3, "C", "Three", "c@x", None, date(2023, 1, 1), "VIP", True)),
        "ShippingAddresses": make(spark, "ShippingAddresses",
                                  (1, 1, "1 St", "Pune", "MH", "India", "1", True),
                                  (2, 2, "2 St", "Delhi", "DL", "India", "2", True),
                                  (3, 3, "3 St", "Pune", "MH", "India", "3", True)),
        "Products": make(spark, "Products",
                         (10, "Phone", 1, 1, D("100.00"), 10, False), (20, "Shirt", 2, 1, D("50.00"), 10, False),
                         (30, "Cable", 1, 1, D("9.99"), 10, True)),
        "Inventory": make(spark, "Inventory",
                          (10, 10, "MAIN", None), (20, 9, "MAIN", None), (30, 1, "MAIN", None)),
        "Orders": make(spark, "Orders",
                       (1, 1, 1, 1, datetime(2024, 1, 5), "Delivered", D(0)),
                       (2, 1, None, 1, datetime(2024, 2, 6), "Confirmed", D(0)),
                       (3, 2, 2, 2, datetime(2024, 3, 7), "Cancelled", D(0)),
                       (4, 3, 2, 3, datetime(2024, 7, 8), "Delivered", D(0)),
                       (5, 3, 2, 3, datetime(2024, 7, 9), "Pending", D(0))),
        "OrderDetails": with_line_total(lines),
    }
