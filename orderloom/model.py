"""The tables: typed columns and the constraints that hold on them.

Row identifiers and surrogate keys are BIGINT, and amounts that add up many lines are DECIMAL(28,2), so that
neither overflows on very large tables. Everything else has the width of the retail model.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    """One table: ``columns`` is DDL text, ``NOT NULL`` included."""

    layer: str
    columns: str
    key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[ForeignKey, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: dict[str, str] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    # SQL text of the value a column takes when a batch leaves it out; :as_of is the load moment.
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    @property
    def required(self) -> list[str]:
        """Columns that must not be NULL, read from the text so that no session is needed."""
        return re.findall(r"(\w+) \w+(?:\([\d,]+\))? NOT NULL", self.columns)


def _fk(column: str, parent: str, parent_column: str | None = None) -> ForeignKey:
    return ForeignKey((column,), parent, (parent_column or column,))


# The lists the constraints allow.
SEGMENTS = ("Standard", "Premium", "VIP")
ORDER_STATUSES = ("Pending", "Confirmed", "Shipped", "Delivered", "Cancelled")
PAYMENT_METHODS = ("CreditCard", "DebitCard", "UPI", "NetBanking", "COD")
PAYMENT_STATUSES = ("Success", "Failed", "Refunded")

OLTP: dict[str, Table] = {
    "Categories": Table(
        "oltp", "CategoryID BIGINT NOT NULL, CategoryName STRING NOT NULL, Description STRING",
        ("CategoryID",), unique=(("CategoryName",),), lengths={"CategoryName": 100, "Description": 400}),
    "Suppliers": Table(
        "oltp", "SupplierID BIGINT NOT NULL, SupplierName STRING NOT NULL, ContactEmail STRING, Phone STRING, "
        "Country STRING NOT NULL, CreatedAt TIMESTAMP_NTZ NOT NULL",
        ("SupplierID",), lengths={"SupplierName": 150, "ContactEmail": 150, "Phone": 20, "Country": 80},
        defaults={"CreatedAt": ":as_of"}),
    "Employees": Table(
        "oltp", "EmployeeID BIGINT NOT NULL, FirstName STRING NOT NULL, LastName STRING NOT NULL, "
        "ManagerID BIGINT, Title STRING NOT NULL, HireDate DATE NOT NULL, Region STRING NOT NULL",
        ("EmployeeID",), foreign=(_fk("ManagerID", "Employees", "EmployeeID"),),
        lengths={"FirstName": 60, "LastName": 60, "Title": 80, "Region": 60}),
    "Customers": Table(
        "oltp", "CustomerID BIGINT NOT NULL, FirstName STRING NOT NULL, LastName STRING NOT NULL, "
        "Email STRING NOT NULL, Phone STRING, SignupDate DATE NOT NULL, CustomerSegment STRING NOT NULL, "
        "IsActive BOOLEAN NOT NULL",
        ("CustomerID",), unique=(("Email",),), domains={"CustomerSegment": SEGMENTS},
        lengths={"FirstName": 60, "LastName": 60, "Email": 150, "Phone": 20, "CustomerSegment": 20},
        defaults={"SignupDate": "CAST(:as_of AS DATE)", "CustomerSegment": "'Standard'", "IsActive": "TRUE"}),
    "ShippingAddresses": Table(
        "oltp", "AddressID BIGINT NOT NULL, CustomerID BIGINT NOT NULL, AddressLine1 STRING NOT NULL, "
        "City STRING NOT NULL, State STRING NOT NULL, Country STRING NOT NULL, PostalCode STRING NOT NULL, "
        "IsDefault BOOLEAN NOT NULL",
        ("AddressID",), foreign=(_fk("CustomerID", "Customers"),),
        lengths={"AddressLine1": 150, "City": 80, "State": 80, "Country": 80, "PostalCode": 15},
        defaults={"IsDefault": "FALSE"}),
    "Products": Table(
        "oltp", "ProductID BIGINT NOT NULL, ProductName STRING NOT NULL, CategoryID BIGINT NOT NULL, "
        "SupplierID BIGINT NOT NULL, UnitPrice DECIMAL(10,2) NOT NULL, ReorderLevel INT NOT NULL, "
        "Discontinued BOOLEAN NOT NULL",
        ("ProductID",), foreign=(_fk("CategoryID", "Categories"), _fk("SupplierID", "Suppliers")),
        ranges={"UnitPrice": "UnitPrice >= 0"}, lengths={"ProductName": 150},
        defaults={"ReorderLevel": "20", "Discontinued": "FALSE"}),
    "Inventory": Table(
        "oltp", "ProductID BIGINT NOT NULL, QuantityOnHand INT NOT NULL, WarehouseLocation STRING NOT NULL, "
        "LastRestockDate DATE",
        ("ProductID",), foreign=(_fk("ProductID", "Products"),),
        ranges={"QuantityOnHand": "QuantityOnHand >= 0"}, lengths={"WarehouseLocation": 60},
        defaults={"WarehouseLocation": "'MAIN'"}),
    "Orders": Table(
        "oltp", "OrderID BIGINT NOT NULL, CustomerID BIGINT NOT NULL, EmployeeID BIGINT, "
        "AddressID BIGINT NOT NULL, OrderDate TIMESTAMP_NTZ NOT NULL, OrderStatus STRING NOT NULL, "
        "TotalAmount DECIMAL(28,2) NOT NULL",
        ("OrderID",), foreign=(_fk("CustomerID", "Customers"), _fk("EmployeeID", "Employees"),
                               _fk("AddressID", "ShippingAddresses")),
        domains={"OrderStatus": ORDER_STATUSES}, ranges={"TotalAmount": "TotalAmount >= 0"},
        lengths={"OrderStatus": 20},
        defaults={"OrderDate": ":as_of", "OrderStatus": "'Pending'", "TotalAmount": "0"}),
    "OrderDetails": Table(
        "oltp", "OrderDetailID BIGINT NOT NULL, OrderID BIGINT NOT NULL, ProductID BIGINT NOT NULL, "
        "Quantity INT NOT NULL, UnitPrice DECIMAL(10,2) NOT NULL, Discount DECIMAL(4,2) NOT NULL, "
        "LineTotal DECIMAL(18,4)",
        ("OrderDetailID",), foreign=(_fk("OrderID", "Orders"), _fk("ProductID", "Products")),
        ranges={"Quantity": "Quantity > 0", "UnitPrice": "UnitPrice >= 0",
                "Discount": "Discount BETWEEN 0 AND 1"},
        defaults={"Discount": "0"}),
    "Payments": Table(
        "oltp", "PaymentID BIGINT NOT NULL, OrderID BIGINT NOT NULL, PaymentDate TIMESTAMP_NTZ NOT NULL, "
        "Amount DECIMAL(28,2) NOT NULL, PaymentMethod STRING NOT NULL, PaymentStatus STRING NOT NULL",
        ("PaymentID",), foreign=(_fk("OrderID", "Orders"),),
        domains={"PaymentMethod": PAYMENT_METHODS, "PaymentStatus": PAYMENT_STATUSES},
        ranges={"Amount": "Amount >= 0"}, lengths={"PaymentMethod": 20, "PaymentStatus": 20},
        defaults={"PaymentDate": ":as_of", "PaymentStatus": "'Success'"}),
    "Returns": Table(
        "oltp", "ReturnID BIGINT NOT NULL, OrderDetailID BIGINT NOT NULL, ReturnDate TIMESTAMP_NTZ NOT NULL, "
        "QuantityReturned INT NOT NULL, Reason STRING, RefundAmount DECIMAL(28,2) NOT NULL",
        ("ReturnID",), foreign=(_fk("OrderDetailID", "OrderDetails"),),
        ranges={"QuantityReturned": "QuantityReturned > 0", "RefundAmount": "RefundAmount >= 0"},
        lengths={"Reason": 200}, defaults={"ReturnDate": ":as_of"}),
}

AUDIT: dict[str, Table] = {
    "OrderAuditLog": Table(
        "audit", "AuditID BIGINT NOT NULL, OrderID BIGINT NOT NULL, Action STRING NOT NULL, "
        "ActionDetail STRING, ActionAt TIMESTAMP_NTZ NOT NULL",
        ("AuditID",), lengths={"Action": 20, "ActionDetail": 400}, defaults={"ActionAt": ":as_of"}),
    "ErrorLog": Table(
        "audit", "ErrorLogID BIGINT NOT NULL, ErrorProcedure STRING, ErrorNumber INT, ErrorMessage STRING, "
        "ErrorAt TIMESTAMP_NTZ NOT NULL",
        ("ErrorLogID",), lengths={"ErrorProcedure": 200, "ErrorMessage": 2000}, defaults={"ErrorAt": ":as_of"}),
}

STAR: dict[str, Table] = {
    "DimDate": Table(
        "star", "DateKey INT NOT NULL, FullDate DATE NOT NULL, DayOfWeek SMALLINT NOT NULL, "
        "DayName STRING NOT NULL, DayOfMonth SMALLINT NOT NULL, MonthNumber SMALLINT NOT NULL, "
        "MonthName STRING NOT NULL, Quarter SMALLINT NOT NULL, Year SMALLINT NOT NULL, "
        "IsWeekend BOOLEAN NOT NULL",
        ("DateKey",), lengths={"DayName": 10, "MonthName": 10}),
    "DimCustomer": Table(
        "star", "CustomerKey BIGINT NOT NULL, CustomerID BIGINT NOT NULL, FullName STRING NOT NULL, "
        "Email STRING NOT NULL, CustomerSegment STRING NOT NULL, SignupDate DATE NOT NULL, "
        "EffectiveDate DATE NOT NULL, ExpiryDate DATE, IsCurrent BOOLEAN NOT NULL",
        ("CustomerKey",), lengths={"FullName": 120, "Email": 150, "CustomerSegment": 20},
        defaults={"IsCurrent": "TRUE"}),
    "DimProduct": Table(
        "star", "ProductKey BIGINT NOT NULL, ProductID BIGINT NOT NULL, ProductName STRING NOT NULL, "
        "CategoryName STRING NOT NULL, SupplierName STRING NOT NULL, UnitPrice DECIMAL(10,2) NOT NULL, "
        "Discontinued BOOLEAN NOT NULL",
        ("ProductKey",), lengths={"ProductName": 150, "CategoryName": 100, "SupplierName": 150}),
    "DimEmployee": Table(
        "star", "EmployeeKey BIGINT NOT NULL, EmployeeID BIGINT NOT NULL, FullName STRING NOT NULL, "
        "Title STRING NOT NULL, Region STRING NOT NULL",
        ("EmployeeKey",), lengths={"FullName": 120, "Title": 80, "Region": 60}),
    "DimGeography": Table(
        "star", "GeographyKey BIGINT NOT NULL, City STRING NOT NULL, State STRING NOT NULL, "
        "Country STRING NOT NULL",
        ("GeographyKey",), unique=(("City", "State", "Country"),),
        lengths={"City": 80, "State": 80, "Country": 80}),
    "FactSales": Table(
        "star", "SalesKey BIGINT NOT NULL, OrderDetailID BIGINT NOT NULL, DateKey INT NOT NULL, "
        "CustomerKey BIGINT NOT NULL, ProductKey BIGINT NOT NULL, EmployeeKey BIGINT, "
        "GeographyKey BIGINT NOT NULL, Quantity INT NOT NULL, UnitPrice DECIMAL(10,2) NOT NULL, "
        "Discount DECIMAL(4,2) NOT NULL, LineTotal DECIMAL(12,2) NOT NULL, LoadedAt TIMESTAMP_NTZ NOT NULL",
        ("SalesKey",),
        foreign=(_fk("DateKey", "DimDate"), _fk("CustomerKey", "DimCustomer"), _fk("ProductKey", "DimProduct"),
                 _fk("EmployeeKey", "DimEmployee"), _fk("GeographyKey", "DimGeography")),
        defaults={"LoadedAt": ":as_of"}),
    "FactInventorySnapshot": Table(
        "star", "SnapshotKey BIGINT NOT NULL, DateKey INT NOT NULL, ProductKey BIGINT NOT NULL, "
        "QuantityOnHand INT NOT NULL, ReorderLevel INT NOT NULL, LoadedAt TIMESTAMP_NTZ NOT NULL",
        ("SnapshotKey",), unique=(("DateKey", "ProductKey"),),
        foreign=(_fk("DateKey", "DimDate"), _fk("ProductKey", "DimProduct")), defaults={"LoadedAt": ":as_of"}),
    "FactReturns": Table(
        "star", "ReturnKey BIGINT NOT NULL, ReturnID BIGINT NOT NULL, OrderDateKey INT NOT NULL, "
        "ReturnDateKey INT NOT NULL, RefundDateKey INT, CustomerKey BIGINT NOT NULL, "
        "ProductKey BIGINT NOT NULL, QuantityReturned INT NOT NULL, RefundAmount DECIMAL(28,2) NOT NULL, "
        "DaysToRefund INT",
        ("ReturnKey",),
        foreign=(_fk("OrderDateKey", "DimDate", "DateKey"), _fk("ReturnDateKey", "DimDate", "DateKey"),
                 _fk("RefundDateKey", "DimDate", "DateKey"), _fk("CustomerKey", "DimCustomer"),
                 _fk("ProductKey", "DimProduct"))),
}

TABLES: dict[str, Table] = {**OLTP, **AUDIT, **STAR}
