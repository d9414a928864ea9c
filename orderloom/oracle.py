"""For each registered query, the SQL that gives the same rows on the plain tables.

The SQL is written on its own terms: global numbering, recursion turn by turn, joins line by line. Names start
with ``m_`` because the plain tables already use the bare ones.
"""

from __future__ import annotations

import re

from orderloom.model import OLTP, STAR, Table

FIRST = "TIMESTAMP '2001-12-01 00:00:00'"
FIRST_DAY = "DATE '2001-12-01'"
SECOND = "TIMESTAMP '2001-12-02 00:00:00'"
SECOND_DAY = "DATE '2001-12-02'"

_tables: dict[str, str] = {
    "m_Categories": """SELECT row_number() OVER (ORDER BY p_type) AS CategoryID, p_type AS CategoryName,
            CAST(NULL AS VARCHAR) AS Description FROM (SELECT DISTINCT p_type FROM part) t""",
    "m_Suppliers": """SELECT s_suppkey AS SupplierID, s_name AS SupplierName, n_name AS Country,
            CAST(NULL AS VARCHAR) AS ContactEmail, CAST(NULL AS VARCHAR) AS Phone,
            TIMESTAMP '2001-12-01 00:00:00' AS CreatedAt FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "m_Employees": """SELECT s_suppkey AS EmployeeID, 'Emp' AS FirstName, s_name AS LastName,
            CASE WHEN s_suppkey = 0 THEN NULL ELSE CAST(floor((s_suppkey - 1) / 3) AS BIGINT) END AS ManagerID,
            CASE WHEN s_suppkey = 0 THEN 'Sales Director' WHEN s_suppkey <= 3 THEN 'Sales Manager'
                 ELSE 'Sales Executive' END AS Title, DATE '1995-01-01' AS HireDate, r_name AS Region
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "m_Customers": """SELECT c_custkey AS CustomerID, 'Cust' AS FirstName, c_name AS LastName,
            concat('customer', CAST(c_custkey AS VARCHAR), '@example.com') AS Email,
            CAST(NULL AS VARCHAR) AS Phone, DATE '1995-01-01' AS SignupDate,
            CASE WHEN c_custkey % 20 = 0 THEN 'VIP' WHEN c_custkey % 5 = 0 THEN 'Premium'
                 ELSE 'Standard' END AS CustomerSegment, c_custkey % 37 <> 0 AS IsActive FROM customer""",
    "m_Addresses": """SELECT c_custkey AS AddressID, c_custkey AS CustomerID,
            concat('CITY_', CAST(c_custkey % 10 AS VARCHAR)) AS City, n_name AS State, r_name AS Country,
            concat(CAST(c_custkey % 999 AS VARCHAR), ' Main Street') AS AddressLine1,
            CAST(100000 + c_custkey % 899999 AS VARCHAR) AS PostalCode, TRUE AS IsDefault
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "m_Products": """SELECT p_partkey AS ProductID, p_name AS ProductName, CategoryID,
            p_partkey % (SELECT count(*) FROM supplier) AS SupplierID,
            CAST(p_retailprice AS DECIMAL(10,2)) AS UnitPrice,
            CAST(10 + (p_size % 5) * 5 AS INT) AS ReorderLevel, p_partkey % 17 = 0 AS Discontinued
        FROM part JOIN m_Categories ON CategoryName = p_type""",
    "m_Inventory": """SELECT p_partkey AS ProductID, CAST((p_partkey * 37 + 11) % 520 AS INT) AS QuantityOnHand,
            CASE WHEN p_partkey % 2 = 0 THEN 'MAIN' ELSE 'NORTH-DC' END AS WarehouseLocation,
            CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE DATE '2001-07-01' END AS LastRestockDate FROM part""",
    "m_Lines": """SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS OrderDetailID,
            l_orderkey AS OrderID, l_partkey AS ProductID, CAST(l_quantity AS INT) AS Quantity,
            CAST(p_retailprice AS DECIMAL(10,2)) AS UnitPrice, CAST(l_discount AS DECIMAL(4,2)) AS Discount,
            CAST(CAST(l_quantity AS INT) * CAST(p_retailprice AS DECIMAL(10,2))
                 * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS LineTotal,
            l_returnflag AS ReturnFlag
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "m_Headers": """SELECT o_orderkey AS OrderID, o_custkey AS CustomerID,
            CASE WHEN o_orderkey % 50 = 0 THEN NULL
                 ELSE o_orderkey % (SELECT count(*) FROM supplier) END AS EmployeeID,
            o_custkey AS AddressID, o_orderdate AS OrderDate,
            CASE WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Confirmed'
                 WHEN o_orderkey % 3 = 0 THEN 'Cancelled' ELSE 'Pending' END AS OrderStatus FROM orders""",
    "m_Orders": """SELECT h.*, CAST(coalesce(s.Total, 0) AS DECIMAL(28,2)) AS TotalAmount
        FROM m_Headers h LEFT JOIN (SELECT OrderID, sum(LineTotal) AS Total FROM m_Lines GROUP BY OrderID) s
          ON s.OrderID = h.OrderID""",
    "m_Payments": """SELECT OrderID AS PaymentID, OrderID, OrderDate + INTERVAL '5' MINUTE AS PaymentDate,
            TotalAmount AS Amount,
            CASE OrderID % 5 WHEN 0 THEN 'CreditCard' WHEN 1 THEN 'DebitCard' WHEN 2 THEN 'UPI'
                 WHEN 3 THEN 'NetBanking' ELSE 'COD' END AS PaymentMethod,
            CASE WHEN OrderID % 25 = 0 THEN 'Failed' ELSE 'Success' END AS PaymentStatus
        FROM m_Orders WHERE OrderStatus <> 'Cancelled'""",
    "m_Returns": """SELECT l.OrderDetailID AS ReturnID, l.OrderDetailID,
            o.OrderDate + to_days(CAST(5 + l.OrderDetailID % 20 AS INT)) AS ReturnDate, 1 AS QuantityReturned,
            'Customer changed mind' AS Reason, CAST(l.UnitPrice AS DECIMAL(28,2)) AS RefundAmount
        FROM m_Lines l JOIN m_Orders o ON o.OrderID = l.OrderID
        WHERE o.OrderStatus = 'Delivered' AND l.ReturnFlag = 'R'""",

    # The star schema after the first load.
    "m_Calendar": """SELECT CAST(d AS DATE) AS FullDate FROM (
            SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)),
                greatest(date_trunc('year', max(o_orderdate)), TIMESTAMP '2001-01-01') + INTERVAL 1 YEAR
                    - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders) t""",
    "m_DimDate": """SELECT CAST(strftime(FullDate, '%Y%m%d') AS INT) AS DateKey, FullDate,
            CAST(dayofweek(FullDate) + 1 AS SMALLINT) AS DayOfWeek, dayname(FullDate) AS DayName,
            CAST(day(FullDate) AS SMALLINT) AS DayOfMonth, CAST(month(FullDate) AS SMALLINT) AS MonthNumber,
            monthname(FullDate) AS MonthName, CAST(quarter(FullDate) AS SMALLINT) AS Quarter,
            CAST(year(FullDate) AS SMALLINT) AS Year, dayofweek(FullDate) IN (0, 6) AS IsWeekend
        FROM m_Calendar""",
    "m_DimCustomer": """SELECT 1 + CustomerID - (SELECT min(CustomerID) FROM m_Customers) AS CustomerKey, CustomerID,
            concat(FirstName, ' ', LastName) AS FullName, Email, CustomerSegment, SignupDate FROM m_Customers""",
    "m_ProductSource": """SELECT ProductID, ProductName, CategoryName, SupplierName, UnitPrice, Discontinued
        FROM m_Products p JOIN m_Categories c ON c.CategoryID = p.CategoryID
        JOIN m_Suppliers s ON s.SupplierID = p.SupplierID""",
    "m_DimProduct": """SELECT 1 + ProductID - (SELECT min(ProductID) FROM m_Products) AS ProductKey, *
        FROM m_ProductSource""",
    "m_DimEmployee": """SELECT 1 + EmployeeID - (SELECT min(EmployeeID) FROM m_Employees) AS EmployeeKey, EmployeeID,
            concat(FirstName, ' ', LastName) AS FullName, Title, Region FROM m_Employees""",
    "m_DimGeography": """SELECT row_number() OVER (ORDER BY City, State, Country) AS GeographyKey, City, State, Country
        FROM (SELECT DISTINCT City, State, Country FROM m_Addresses) t""",
    # What an order has in common for all its lines, worked out once per order.
    "m_Places": """SELECT AddressID, GeographyKey FROM m_Addresses JOIN m_DimGeography USING (City, State, Country)""",
    "m_OrderKeys": """SELECT OrderID, CustomerID, GeographyKey, EmployeeKey,
            CAST(year(OrderDate) * 10000 + month(OrderDate) * 100 + day(OrderDate) AS INT) AS DateKey
        FROM m_Headers JOIN m_Places USING (AddressID) LEFT JOIN m_DimEmployee USING (EmployeeID)""",
    "m_FactSales": f"""SELECT 1 + OrderDetailID - (SELECT min(OrderDetailID) FROM m_Lines) AS SalesKey, OrderDetailID,
            DateKey, CustomerKey, ProductKey, EmployeeKey, GeographyKey, Quantity, m_Lines.UnitPrice, Discount,
            CAST(LineTotal AS DECIMAL(12,2)) AS LineTotal, {FIRST} AS LoadedAt
        FROM m_OrderKeys JOIN (SELECT CustomerID, CustomerKey FROM m_DimCustomer) USING (CustomerID)
        JOIN m_Lines USING (OrderID) JOIN (SELECT ProductID, ProductKey FROM m_DimProduct) USING (ProductID)""",

    "m_FactReturns": """SELECT 1 + r.ReturnID - (SELECT min(ReturnID) FROM m_Returns) AS ReturnKey, r.ReturnID,
            CAST(strftime(o.OrderDate, '%Y%m%d') AS INT) AS OrderDateKey,
            CAST(strftime(r.ReturnDate, '%Y%m%d') AS INT) AS ReturnDateKey, CAST(NULL AS INT) AS RefundDateKey,
            c.CustomerKey, p.ProductKey, r.QuantityReturned, r.RefundAmount, CAST(NULL AS INT) AS DaysToRefund
        FROM m_Returns r JOIN m_Lines l ON l.OrderDetailID = r.OrderDetailID JOIN m_Orders o ON o.OrderID = l.OrderID
        JOIN m_DimCustomer c ON c.CustomerID = o.CustomerID JOIN m_DimProduct p ON p.ProductID = l.ProductID""",
    "m_FactSnapshot": f"""SELECT 1 + ProductKey - min(ProductKey) OVER () AS SnapshotKey, 20011201 AS DateKey, ProductKey,
            QuantityOnHand, ReorderLevel, {FIRST} AS LoadedAt
        FROM m_Inventory JOIN (SELECT ProductID, ReorderLevel FROM m_Products) USING (ProductID)
        JOIN (SELECT ProductID, ProductKey FROM m_DimProduct) USING (ProductID)""",

    # The star schema with planted faults.
    "m_BadCustomers": f"""SELECT CustomerKey, CustomerID, Email, CustomerSegment, SignupDate, NULL AS ExpiryDate, TRUE AS IsCurrent,
            CASE WHEN CustomerKey % 43 = 0 THEN repeat(FullName, 20) ELSE FullName END AS FullName,
            CASE WHEN CustomerKey % 41 <> 0 THEN {FIRST_DAY} END AS EffectiveDate FROM m_DimCustomer""",
    "m_BadGeography": """SELECT * FROM m_DimGeography UNION ALL
        SELECT GeographyKey + 1000000000, City, State, Country FROM m_DimGeography WHERE GeographyKey % 3 = 0""",
    "m_BadSalesOnce": """SELECT SalesKey, OrderDetailID, UnitPrice, Discount, LineTotal, LoadedAt,
            CASE WHEN SalesKey % 61 = 0 THEN 19000101 ELSE DateKey END AS DateKey,
            CASE WHEN SalesKey % 67 = 0 THEN -1 ELSE CustomerKey END AS CustomerKey,
            CASE WHEN SalesKey % 71 = 0 THEN -1 ELSE ProductKey END AS ProductKey,
            CASE WHEN SalesKey % 73 = 0 THEN -1 ELSE EmployeeKey END AS EmployeeKey,
            CASE WHEN SalesKey % 79 = 0 THEN -1 ELSE GeographyKey END AS GeographyKey,
            CASE WHEN SalesKey % 83 <> 0 THEN Quantity END AS Quantity FROM m_FactSales""",
    "m_BadSales": "SELECT * FROM m_BadSalesOnce UNION ALL SELECT * FROM m_BadSalesOnce WHERE SalesKey % 89 = 0",
    "m_BadSnapshot": """SELECT * FROM m_FactSnapshot UNION ALL SELECT SnapshotKey + 1000000000, DateKey, ProductKey,
            QuantityOnHand, ReorderLevel, LoadedAt FROM m_FactSnapshot WHERE ProductKey % 47 = 0""",
    "m_BadReturns": """SELECT ReturnKey, ReturnID, CustomerKey, ProductKey, QuantityReturned, RefundAmount, DaysToRefund,
            CASE WHEN ReturnKey % 53 = 0 THEN 19000101 ELSE OrderDateKey END AS OrderDateKey,
            CASE WHEN ReturnKey % 59 = 0 THEN 19000101 ELSE ReturnDateKey END AS ReturnDateKey,
            CASE WHEN ReturnKey % 61 = 0 THEN 19000101 ELSE RefundDateKey END AS RefundDateKey FROM m_FactReturns""",

    # Customers and products over two loads.
    "m_Customers2": """SELECT CustomerID, concat(FirstName, ' ', LastName) AS FullName,
            CASE WHEN CustomerID % 11 = 0 THEN concat('new_', Email) ELSE Email END AS Email,
            CASE WHEN CustomerID % 7 = 0 THEN CASE CustomerSegment WHEN 'VIP' THEN 'Premium' ELSE 'VIP' END
                 ELSE CustomerSegment END AS CustomerSegment, SignupDate FROM m_Customers""",
    "m_DimCustomer1": f"""SELECT 1 + CustomerID - (SELECT min(CustomerID) FROM m_Customers WHERE IsActive) AS CustomerKey,
            CustomerID, concat(FirstName, ' ', LastName) AS FullName, Email, CustomerSegment, SignupDate,
            {FIRST_DAY} AS EffectiveDate FROM m_Customers WHERE IsActive""",
    "m_DimCustomer2": f"""SELECT d.CustomerKey, d.CustomerID, d.FullName, d.Email, d.CustomerSegment, d.SignupDate,
            d.EffectiveDate, CASE WHEN c.CustomerSegment <> d.CustomerSegment THEN {SECOND_DAY} END AS ExpiryDate,
            c.CustomerSegment = d.CustomerSegment AS IsCurrent
        FROM m_DimCustomer1 d JOIN m_Customers2 c ON c.CustomerID = d.CustomerID
        UNION ALL
        SELECT (SELECT max(CustomerKey) FROM m_DimCustomer1) + 1 + c.CustomerID
                - (SELECT min(CustomerID) FROM m_Customers2), c.CustomerID, c.FullName, c.Email, c.CustomerSegment,
            c.SignupDate, {SECOND_DAY}, NULL, TRUE
        FROM m_Customers2 c LEFT JOIN m_DimCustomer1 d ON d.CustomerID = c.CustomerID
        WHERE d.CustomerID IS NULL OR d.CustomerSegment <> c.CustomerSegment""",
    "m_Products2": """SELECT p.ProductID,
            CASE WHEN p.ProductID % 5 = 0 THEN concat(p.ProductName, ' v2') ELSE p.ProductName END AS ProductName,
            s.CategoryName, s.SupplierName,
            CAST(CASE WHEN p.ProductID % 11 = 0 THEN p.UnitPrice + 5 ELSE p.UnitPrice END AS DECIMAL(10,2)) AS UnitPrice,
            p.ProductID % 29 = 0 OR p.Discontinued AS Discontinued
        FROM m_Products p JOIN m_ProductSource s ON s.ProductID = p.ProductID""",
    "m_DimProduct1": """SELECT 1 + ProductID - (SELECT min(ProductID) FROM m_Products WHERE NOT Discontinued)
            AS ProductKey, * FROM m_ProductSource WHERE NOT Discontinued""",
    "m_DimProduct2": """SELECT d.ProductKey, d.ProductID,
            CASE WHEN x THEN s.ProductName ELSE d.ProductName END AS ProductName,
            CASE WHEN x THEN s.CategoryName ELSE d.CategoryName END AS CategoryName,
            CASE WHEN x THEN s.SupplierName ELSE d.SupplierName END AS SupplierName,
            CASE WHEN x THEN s.UnitPrice ELSE d.UnitPrice END AS UnitPrice,
            CASE WHEN x THEN s.Discontinued ELSE d.Discontinued END AS Discontinued
        FROM m_DimProduct1 d JOIN m_Products2 s ON s.ProductID = d.ProductID,
             LATERAL (SELECT s.UnitPrice <> d.UnitPrice OR s.Discontinued <> d.Discontinued
                             OR s.CategoryName <> d.CategoryName AS x) c
        UNION ALL
        SELECT (SELECT max(ProductKey) FROM m_DimProduct1) + 1 + s.ProductID - (SELECT min(ProductID) FROM m_Products2),
            s.* FROM m_Products2 s WHERE s.ProductID NOT IN (SELECT ProductID FROM m_DimProduct1)""",
    "m_Lines2": """SELECT OrderDetailID, OrderID, ProductID, UnitPrice, Discount, Pieces AS Quantity,
            CAST(Pieces * UnitPrice * (1 - Discount) AS DECIMAL(18,4)) AS LineTotal
        FROM (SELECT *, CAST(CASE WHEN Discount >= 0.05 THEN Quantity + 1 ELSE Quantity END AS INT) AS Pieces
              FROM m_Lines) t""",
    "m_Orders1": """SELECT * FROM m_OrderKeys JOIN (SELECT CustomerID, CustomerKey FROM m_DimCustomer1)
        USING (CustomerID)""",
    "m_Orders2": """SELECT * FROM m_OrderKeys JOIN (SELECT CustomerID, CustomerKey FROM m_DimCustomer2 WHERE IsCurrent)
        USING (CustomerID)""",
    "m_Sales1": """SELECT OrderDetailID, DateKey, CustomerKey, ProductKey, EmployeeKey, GeographyKey,
            1 + OrderDetailID - (SELECT min(OrderDetailID) FROM m_Lines) AS SalesKey
        FROM m_Orders1 JOIN m_Lines USING (OrderID)
        JOIN (SELECT ProductID, ProductKey FROM m_DimProduct1) USING (ProductID)""",
    "m_Sales2": """SELECT OrderDetailID, DateKey, CustomerKey, ProductKey, EmployeeKey, GeographyKey, Quantity,
            m_Lines2.UnitPrice, Discount, CAST(LineTotal AS DECIMAL(12,2)) AS LineTotal
        FROM m_Orders2 JOIN m_Lines2 USING (OrderID)
        JOIN (SELECT ProductID, ProductKey FROM m_DimProduct2) USING (ProductID)""",

    # Analytics.
    "m_OrderDays": "SELECT CustomerID, list_sort(list(DISTINCT CAST(OrderDate AS DATE))) AS days FROM m_Headers GROUP BY ALL",
    # A day starts an island if the day before has no order, and ends one if the day after has none.
    "m_Islands": """SELECT CustomerID, unnest(list_filter(days, lambda d: NOT list_contains(days, d - 1))) AS IslandStart,
            unnest(list_filter(days, lambda d: NOT list_contains(days, d + 1))) AS IslandEnd FROM m_OrderDays""",
    "m_Bought": """SELECT CustomerKey, bool_or(CategoryName = 'ECONOMY') AS wanted, bool_or(CategoryName = 'PROMO') AS other
        FROM (SELECT DISTINCT CustomerKey, ProductKey FROM m_FactSales) JOIN m_DimProduct USING (ProductKey)
        GROUP BY CustomerKey""",

    # Placing orders: each request of a product in its turn.
    "m_Requests": """SELECT l.OrderDetailID AS seq,
            CASE WHEN l.OrderDetailID % 89 = 0 THEN -o.CustomerID - 1 ELSE o.CustomerID END AS CustomerID,
            o.EmployeeID, o.AddressID,
            CASE WHEN l.OrderDetailID % 97 = 0 THEN -l.ProductID - 1 ELSE l.ProductID END AS ProductID,
            CAST(CASE WHEN l.OrderDetailID % 83 = 0 THEN 0 ELSE l.Quantity END AS INT) AS Quantity,
            CASE WHEN l.OrderDetailID % 79 = 0 THEN 'Barter' ELSE CASE l.OrderID % 5 WHEN 0 THEN 'CreditCard'
                 WHEN 1 THEN 'DebitCard' WHEN 2 THEN 'UPI' WHEN 3 THEN 'NetBanking' ELSE 'COD' END END AS PaymentMethod
        FROM m_Lines l JOIN m_Headers o ON o.OrderID = l.OrderID""",
    "m_Checked": """SELECT r.*, i.QuantityOnHand AS OnHand, p.UnitPrice,
            c.CustomerID IS NULL OR a.AddressID IS NULL OR (r.EmployeeID IS NOT NULL AND e.EmployeeID IS NULL)
              OR r.Quantity <= 0
              OR r.PaymentMethod NOT IN ('CreditCard', 'DebitCard', 'UPI', 'NetBanking', 'COD') AS Faulty
        FROM m_Requests r LEFT JOIN m_Inventory i ON i.ProductID = r.ProductID
        LEFT JOIN m_Products p ON p.ProductID = r.ProductID
        LEFT JOIN m_Customers c ON c.CustomerID = r.CustomerID
        LEFT JOIN m_Addresses a ON a.AddressID = r.AddressID
        LEFT JOIN m_Employees e ON e.EmployeeID = r.EmployeeID""",
    "m_Queue": """SELECT ProductID, seq, Quantity, OnHand,
            row_number() OVER (PARTITION BY ProductID ORDER BY seq) AS turn
        FROM m_Checked WHERE NOT Faulty AND OnHand IS NOT NULL""",
    "m_Turns": """SELECT ProductID, CAST(0 AS BIGINT) AS turn, CAST(max(OnHand) AS BIGINT) AS stock,
            CAST(NULL AS BIGINT) AS seq, FALSE AS taken FROM m_Queue GROUP BY ProductID
        UNION ALL
        SELECT q.ProductID, q.turn, CASE WHEN q.Quantity <= t.stock THEN t.stock - q.Quantity ELSE t.stock END,
            q.seq, q.Quantity <= t.stock
        FROM m_Turns t JOIN m_Queue q ON q.ProductID = t.ProductID AND q.turn = t.turn + 1""",
    "m_Stocked": """SELECT c.*, coalesce(t.taken, FALSE) AS Accepted,
            c.OnHand - coalesce(sum(CASE WHEN t.taken THEN c.Quantity END) OVER (PARTITION BY c.ProductID
                ORDER BY c.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS Available
        FROM m_Checked c LEFT JOIN m_Turns t ON t.seq = c.seq""",
    "m_Decided": """SELECT *, CAST(CASE WHEN Accepted THEN NULL WHEN OnHand IS NULL THEN 51000
                WHEN Available < Quantity THEN 51001 ELSE 547 END AS INT) AS ErrorNumber FROM m_Stocked""",
    "m_Taken": """SELECT *, (SELECT max(OrderID) FROM m_Headers) + 1 + seq - (SELECT min(seq) FROM m_Requests) AS NewOrderID,
            (SELECT max(OrderDetailID) FROM m_Lines) + 1 + seq - (SELECT min(seq) FROM m_Requests) AS NewLineID,
            seq - (SELECT min(seq) FROM m_Requests) AS place,
            (SELECT max(PaymentID) FROM m_Payments) + 1 + seq - (SELECT min(seq) FROM m_Requests) AS NewPaymentID,
            CAST(UnitPrice * Quantity AS DECIMAL(28,2)) AS Price
        FROM m_Decided WHERE Accepted""",
    "m_PlacedAudit": f"""SELECT 2 + 2 * place AS AuditID, NewOrderID AS OrderID, 'PLACED' AS Action,
            concat('Qty=', Quantity, ', Product=', ProductID) AS ActionDetail, {FIRST} AS ActionAt FROM m_Taken
        UNION ALL
        SELECT 1 + 2 * place, NewOrderID, 'LINE_ADDED', concat('ProductID=', ProductID, ', Qty=', Quantity,
            ', LineTotal=', CAST(CAST(Price AS DECIMAL(18,4)) AS VARCHAR)), {FIRST} FROM m_Taken""",
    "m_PlacedErrors": f"""SELECT seq, 1 + seq - (SELECT min(seq) FROM m_Requests) AS ErrorLogID,
            'usp_PlaceOrder' AS ErrorProcedure, ErrorNumber,
            CASE ErrorNumber WHEN 51000 THEN 'Product does not exist.'
                WHEN 51001 THEN 'Insufficient stock to fulfil this order.'
                ELSE 'The statement conflicted with a table constraint.' END AS ErrorMessage, {FIRST} AS ErrorAt
        FROM m_Decided WHERE NOT Accepted""",
    "m_StockAfter": """SELECT i.ProductID,
            CAST(i.QuantityOnHand - coalesce(t.Sold, 0) AS INT) AS QuantityOnHand, i.WarehouseLocation,
            i.LastRestockDate
        FROM m_Inventory i LEFT JOIN (SELECT ProductID, sum(Quantity) AS Sold FROM m_Taken GROUP BY ProductID) t
          ON t.ProductID = i.ProductID""",

    # Taking returns.
    "m_ReturnRequests": """SELECT OrderDetailID AS seq,
            CASE WHEN OrderDetailID % 101 = 0 THEN -OrderDetailID ELSE OrderDetailID END AS OrderDetailID,
            CAST(CASE WHEN OrderDetailID % 103 = 0 THEN 0 ELSE 1 + OrderDetailID % 3 END AS INT) AS QuantityReturned
        FROM m_Lines WHERE ReturnFlag = 'R'""",
    "m_ReturnsDecided": """SELECT r.*, l.OrderID, l.UnitPrice, CAST(CASE WHEN l.OrderID IS NULL THEN 51002
                WHEN r.QuantityReturned <= 0 THEN 547 WHEN p.OrderID IS NULL THEN 51003 END AS INT) AS ErrorNumber
        FROM m_ReturnRequests r LEFT JOIN m_Lines l ON l.OrderDetailID = r.OrderDetailID
        LEFT JOIN m_Payments p ON p.OrderID = l.OrderID""",

    # Order lines of a careless sender.
    "m_Unchecked": """SELECT OrderDetailID, CASE WHEN OrderDetailID % 61 = 0 THEN -OrderID - 1 ELSE OrderID END AS OrderID,
            CASE WHEN OrderDetailID % 67 = 0 THEN NULL WHEN OrderDetailID % 71 = 0 THEN -ProductID - 1
                 ELSE ProductID END AS ProductID,
            CAST(CASE WHEN OrderDetailID % 73 = 0 THEN 0 ELSE Quantity END AS INT) AS Quantity,
            CASE WHEN OrderDetailID % 59 = 0 THEN -UnitPrice ELSE UnitPrice END AS UnitPrice,
            CASE WHEN OrderDetailID % 53 = 0 THEN 1.5 ELSE Discount END AS Discount
        FROM (SELECT * FROM m_Lines UNION ALL SELECT * FROM m_Lines WHERE OrderDetailID % 47 = 0)""",
    "m_UncheckedRules": """SELECT u.*, concat_ws('; ',
            CASE WHEN NOT (Discount BETWEEN 0 AND 1) THEN 'OrderDetails.Discount range' END,
            CASE WHEN count(*) OVER (PARTITION BY u.OrderDetailID) > 1 THEN 'OrderDetails.OrderDetailID unique' END,
            CASE WHEN o.OrderID IS NULL THEN 'OrderDetails.OrderID references Orders' END,
            CASE WHEN u.ProductID IS NULL THEN 'OrderDetails.ProductID not null' END,
            CASE WHEN u.ProductID IS NOT NULL AND p.ProductID IS NULL
                 THEN 'OrderDetails.ProductID references Products' END,
            CASE WHEN NOT (u.Quantity > 0) THEN 'OrderDetails.Quantity range' END,
            CASE WHEN NOT (u.UnitPrice >= 0) THEN 'OrderDetails.UnitPrice range' END) AS broken_rules
        FROM m_Unchecked u LEFT JOIN m_Headers o ON o.OrderID = u.OrderID
        LEFT JOIN m_Products p ON p.ProductID = u.ProductID""",
}


def _pick(key: str, salt: str, n: str | int) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{salt}'), 1, 15))::BIGINT % {n})"


_tables["m_DimEmployee1"] = """SELECT 1 + EmployeeID - min(EmployeeID) OVER () AS EmployeeKey, EmployeeID
        FROM m_Employees WHERE Region <> 'ASIA'"""
_tables["m_Restocked"] = """SELECT d.ProductKey, CAST(CASE WHEN i.QuantityOnHand < p.ReorderLevel AND NOT p.Discontinued
            THEN i.QuantityOnHand + 100 ELSE i.QuantityOnHand END AS INT) AS QuantityOnHand, p.ReorderLevel
        FROM m_Inventory i JOIN m_Products p ON p.ProductID = i.ProductID
        JOIN m_DimProduct d ON d.ProductID = i.ProductID"""
_tables["m_ManagedBelow"] = """SELECT EmployeeID, FirstName, LastName, Title, 0 AS Level FROM m_Employees
        WHERE ManagerID IS NULL
        UNION ALL
        SELECT e.EmployeeID, e.FirstName, e.LastName, e.Title, b.Level + 1
        FROM m_Employees e JOIN m_ManagedBelow b ON e.ManagerID = b.EmployeeID"""
_tables["m_NumberedCustomers"] = """SELECT n, CustomerID FROM (SELECT row_number() OVER (ORDER BY CustomerID) - 1 AS n,
        CustomerID FROM m_Customers) t"""
_tables["m_NumberedEmployees"] = """SELECT row_number() OVER (ORDER BY EmployeeID) - 1 AS n, EmployeeID FROM m_Employees"""
_tables["m_NumberedProducts"] = """SELECT row_number() OVER (ORDER BY ProductID) - 1 AS n, ProductID, UnitPrice
        FROM m_Products"""
# Four products drawn one after the other: the place among those still there, counted up past those taken.
_tables["m_Drawn"] = f"""SELECT OrderID, d0, d1, d2,
            r3 + (r3 >= l[1])::INT + (r3 + 1 >= l[2])::INT + (r3 + 2 >= l[3])::INT AS d3
        FROM (SELECT *, list_sort([d0, d1, d2]) AS l
        FROM (SELECT *, r2 + (r2 >= least(d0, d1))::INT + (r2 + 1 >= greatest(d0, d1))::INT AS d2
        FROM (SELECT *, r1 + (r1 >= d0)::INT AS d1
        FROM (SELECT OrderID, {_pick('OrderID * 4', 'product', 'n')} AS d0,
                {_pick('OrderID * 4 + 1', 'product', '(n - 1)')} AS r1,
                {_pick('OrderID * 4 + 2', 'product', '(n - 2)')} AS r2,
                {_pick('OrderID * 4 + 3', 'product', '(n - 3)')} AS r3
              FROM m_Headers, (SELECT count(*) AS n FROM part)))))"""
_tables["m_Made"] = """SELECT CustomerID AS i FROM m_Customers"""

_RECURSIVE = {"m_Turns", "m_ManagedBelow"}
_NAME = re.compile(r"\bm_\w+")


def with_tables(select: str) -> str:
    """``select`` behind the definitions of all the ``m_`` tables it needs."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name in needed:
            return
        for used in dict.fromkeys(_NAME.findall(_tables[name])):
            if used != name:
                add(used)
        needed.append(name)

    for name in dict.fromkeys(_NAME.findall(select)):
        add(name)
    if not needed:
        return select
    if select.startswith("WITH"):
        select = f"SELECT * FROM ({select}) q"
    word = "WITH RECURSIVE" if _RECURSIVE & set(needed) else "WITH"
    # Each definition is computed once; a reader gets its rows, not its text.
    plain = "{} AS ({})"
    once = "{} AS MATERIALIZED ({})"
    parts = [(plain if name in _RECURSIVE else once).format(name, _tables[name]) for name in needed]
    return f"{word} " + ",\n".join(parts) + f"\n{select}"


_AMOUNT = "DECIMAL(28,2)"

_selects: dict[str, str] = {
    "monthly_sales": f"""WITH days AS (SELECT DateKey, sum(LineTotal) AS sold FROM m_FactSales GROUP BY DateKey),
        months AS (SELECT Year, MonthNumber, min(MonthName) AS MonthName, CAST(sum(sold) AS {_AMOUNT}) AS MonthlySales,
                Year * 12 + MonthNumber AS place FROM days JOIN m_DimDate USING (DateKey) GROUP BY Year, MonthNumber)
        SELECT m.Year, m.MonthNumber, m.MonthName, m.MonthlySales,
            (SELECT CAST(sum(u.MonthlySales) AS {_AMOUNT}) FROM months u WHERE u.place <= m.place) AS RunningTotal,
            p.MonthlySales AS PrevMonthSales, CAST(m.MonthlySales - p.MonthlySales AS {_AMOUNT}) AS MoMChange
        FROM months m LEFT JOIN months p
          ON p.place = (SELECT max(b.place) FROM months b WHERE b.place < m.place)""",
    "top_customers_by_region": f"""WITH sold AS (SELECT CustomerKey, EmployeeKey, sum(LineTotal) AS part FROM m_FactSales
            GROUP BY ALL),
        named AS (SELECT Region, FullName, CAST(sum(part) AS {_AMOUNT}) AS Revenue
            FROM sold JOIN (SELECT CustomerKey, FullName FROM m_DimCustomer) USING (CustomerKey)
            JOIN (SELECT EmployeeKey, Region FROM m_DimEmployee) USING (EmployeeKey) GROUP BY Region, FullName),
        amounts AS (SELECT Region, list(Revenue) AS amounts FROM named GROUP BY Region)
        SELECT Region, FullName, Revenue, place AS RegionRank
        FROM (SELECT *, CAST(1 + len(list_filter(amounts, lambda a: a > Revenue)) AS INT) AS place
              FROM named JOIN amounts USING (Region)) WHERE place <= 5""",
    "org_hierarchy": """SELECT repeat('    ', Level) || FirstName || ' ' || LastName AS OrgChart, Title,
            CAST(Level AS INT) AS HierarchyLevel FROM m_ManagedBelow""",
    "category_quarter_pivot": "SELECT CategoryName, " + ", ".join(
        f"CAST(sum(CASE WHEN Quarter = {q} THEN LineTotal END) AS {_AMOUNT}) AS Q{q}" for q in (1, 2, 3, 4))
        + """ FROM m_FactSales f JOIN m_DimProduct p ON p.ProductKey = f.ProductKey
        JOIN m_DimDate d ON d.DateKey = f.DateKey WHERE d.Year = 1997 GROUP BY CategoryName""",
    "order_islands": "SELECT CustomerID, IslandStart, IslandEnd FROM m_Islands",
    "churn_gaps_all_pairs": """WITH starts AS (SELECT CustomerID, list(IslandStart) AS starts FROM m_Islands GROUP BY CustomerID),
        later AS (SELECT CustomerID, IslandEnd AS LastOrderInIsland,
                unnest(list_filter(starts, lambda s: s >= IslandEnd + 60)) AS NextOrderAfterGap
            FROM m_Islands JOIN starts USING (CustomerID))
        SELECT *, CAST(NextOrderAfterGap - LastOrderInIsland AS INT) AS GapDays FROM later""",
    "churn_gap_counts": """WITH starts AS (SELECT CustomerID, list(IslandStart) AS starts FROM m_Islands GROUP BY CustomerID),
        later AS (SELECT CustomerID, IslandEnd, list_filter(starts, lambda s: s >= IslandEnd + 60) AS later
            FROM m_Islands JOIN starts USING (CustomerID))
        SELECT CustomerID, IslandEnd AS LastOrderInIsland, CAST(len(later) AS BIGINT) AS LaterIslands,
            list_min(later) AS NextOrderAfterGap, CAST(list_max(later) - IslandEnd AS INT) AS LongestGapDays FROM later""",
    "churn_gaps_adjacent": """WITH pairs AS (SELECT CustomerID,
                unnest(list_zip(days[1:len(days) - 1], days[2:])) AS pair FROM m_OrderDays)
        SELECT CustomerID, pair[1] AS LastOrderInIsland, pair[2] AS NextOrderAfterGap,
            CAST(pair[2] - pair[1] AS INT) AS GapDays FROM pairs WHERE pair[2] - pair[1] >= 60""",
    "segment_set_ops": """SELECT CustomerKey, CASE WHEN other THEN 'Bought both' ELSE 'ECONOMY only' END AS Segment
        FROM m_Bought WHERE wanted""",

    "dim_date": "SELECT * FROM m_DimDate",
    "dim_customer_scd2": "SELECT * FROM m_DimCustomer2",
    "dim_customer_scd2_rerun": """SELECT CustomerSegment, IsCurrent, EffectiveDate, ExpiryDate, count(*) AS versions,
            max(CustomerKey) AS last_key
        FROM m_DimCustomer2 GROUP BY CustomerSegment, IsCurrent, EffectiveDate, ExpiryDate""",
    "dim_product_scd1": "SELECT * FROM m_DimProduct2",
    "dim_employee_upsert": """SELECT coalesce(f.EmployeeKey, (SELECT max(EmployeeKey) FROM m_DimEmployee1) + 1 + e.EmployeeID
                - (SELECT min(EmployeeID) FROM m_Employees)) AS EmployeeKey, e.EmployeeID,
            concat(e.FirstName, ' ', e.LastName) AS FullName,
            CASE WHEN e.Region = 'EUROPE' THEN concat('Senior ', e.Title) ELSE e.Title END AS Title, e.Region
        FROM m_Employees e LEFT JOIN m_DimEmployee1 f ON f.EmployeeID = e.EmployeeID""",
    "dim_geography_insert": """SELECT row_number() OVER (ORDER BY Country = 'ASIA', City, State, Country) AS GeographyKey,
            City, State, Country FROM (SELECT DISTINCT City, State, Country FROM m_Addresses) t""",

    "fact_sales_initial": "SELECT * FROM m_FactSales",
    "fact_sales_merge": f"""WITH known AS (SELECT max(SalesKey) AS top FROM m_Sales1)
        SELECT coalesce(f.SalesKey, top + 1 + s.OrderDetailID - (SELECT min(OrderDetailID) FROM m_Lines)) AS SalesKey,
            s.OrderDetailID, coalesce(f.DateKey, s.DateKey) AS DateKey,
            coalesce(f.CustomerKey, s.CustomerKey) AS CustomerKey, coalesce(f.ProductKey, s.ProductKey) AS ProductKey,
            CASE WHEN f.SalesKey IS NULL THEN s.EmployeeKey ELSE f.EmployeeKey END AS EmployeeKey,
            coalesce(f.GeographyKey, s.GeographyKey) AS GeographyKey, s.Quantity, s.UnitPrice, s.Discount, s.LineTotal,
            CASE WHEN f.SalesKey IS NULL THEN {SECOND} ELSE {FIRST} END AS LoadedAt
        FROM m_Sales2 s LEFT JOIN m_Sales1 f ON f.OrderDetailID = s.OrderDetailID, known""",
    "fact_sales_outside_calendar": """SELECT 'sales day known' AS rule, CAST(DateKey AS VARCHAR) AS key,
            concat(CAST(count(*) AS VARCHAR), ' rows') AS detail
        FROM m_FactSales WHERE DateKey > (SELECT (year(min(o_orderdate)) + 5) * 10000 + 101 FROM orders)
        GROUP BY DateKey""",
    "inventory_snapshot_merge": f"""SELECT 1 + ProductKey - min(ProductKey) OVER () AS SnapshotKey,
            20011201 AS DateKey, ProductKey, QuantityOnHand, ReorderLevel, {FIRST} AS LoadedAt FROM m_Restocked
        UNION ALL
        SELECT (1 + max(ProductKey) OVER () - min(ProductKey) OVER ()) + 1 + ProductKey - min(ProductKey) OVER (),
            20011202, ProductKey, QuantityOnHand, ReorderLevel, {SECOND} FROM m_Restocked""",
    "fact_returns": "SELECT * FROM m_FactReturns",
    "fact_returns_refunded": """SELECT 1 + r.ReturnID - (SELECT min(ReturnID) FROM m_Returns) AS ReturnKey, r.ReturnID,
            CAST(strftime(o.OrderDate, '%Y%m%d') AS INT) AS OrderDateKey,
            CAST(strftime(r.ReturnDate, '%Y%m%d') AS INT) AS ReturnDateKey,
            CASE WHEN r.RefundAmount <= 1200 THEN CAST(strftime(r.ReturnDate + INTERVAL 4 DAY, '%Y%m%d') AS INT) END
                AS RefundDateKey,
            c.CustomerKey, p.ProductKey, r.QuantityReturned, r.RefundAmount,
            CAST(CASE WHEN r.RefundAmount <= 1200 THEN 4 END AS INT) AS DaysToRefund
        FROM m_Returns r JOIN m_Lines l ON l.OrderDetailID = r.OrderDetailID JOIN m_Orders o ON o.OrderID = l.OrderID
        JOIN m_DimCustomer c ON c.CustomerID = o.CustomerID JOIN m_DimProduct p ON p.ProductID = l.ProductID""",
    "second_load_counts": """SELECT 'DimDate' AS TableName, count(*) AS RowCount FROM m_DimDate
        UNION ALL SELECT 'DimCustomer', count(*) FROM m_DimCustomer2
        UNION ALL SELECT 'DimProduct', count(*) FROM m_DimProduct2
        UNION ALL SELECT 'DimEmployee', count(*) FROM m_Employees
        UNION ALL SELECT 'DimGeography', count(*) FROM m_DimGeography
        UNION ALL SELECT 'FactSales', count(*) FROM m_Sales2
        UNION ALL SELECT 'FactInventorySnapshot', (SELECT count(*) FROM m_DimProduct1)
            + (SELECT count(*) FROM m_DimProduct2)""",

    "load_failures": f"""SELECT CAST(1 AS BIGINT) AS ErrorLogID,
            'usp_ETL_RunFullLoad - failed at step: DimCustomer' AS ErrorProcedure, 8672 AS ErrorNumber,
            'SparkRuntimeException: [USER_RAISED_EXCEPTION] dimension source: more than one row' AS ErrorMessage,
            {FIRST} AS ErrorAt
        FROM (SELECT count(*) AS n FROM m_Customers WHERE CustomerID % 10 = 0) t WHERE n > 0
        UNION ALL
        SELECT 2, 'usp_ETL_RunFullLoad - failed at step: DimProduct', 515,
            'ContractBroken: DimProduct.ProductName not null: ' || count(*), {FIRST}
        FROM m_Products WHERE ProductID % 7 = 0
        UNION ALL
        SELECT 3, 'usp_ETL_RunFullLoad - failed at step: FactSales', 547,
            'DateOutsideCalendar: ' || string_agg(day || ' (' || n || ' rows)', ', ' ORDER BY day), {FIRST}
        FROM (SELECT CAST(DateKey + 200000 AS VARCHAR) AS day, count(*) AS n FROM m_FactSales GROUP BY DateKey
              ORDER BY DateKey LIMIT 5) t""",
    "merge_refusals": """SELECT OrderDetailID, concat(count(*), ' rows') AS detail FROM m_Unchecked
        GROUP BY OrderDetailID HAVING count(*) > 1""",
    "seeded_categories": """SELECT CAST(i AS BIGINT) AS CategoryID, CategoryName,
            (SELECT count(*) FROM m_Products p JOIN m_Categories c ON c.CategoryID = p.CategoryID
             WHERE left(c.CategoryName, 1) = left(s.CategoryName, 1)) AS ProductsAtHand
        FROM (VALUES (1, 'Electronics'), (2, 'Home & Kitchen'), (3, 'Apparel'), (4, 'Sports & Outdoors'), (5, 'Books'),
            (6, 'Beauty & Personal Care'), (7, 'Toys & Games'), (8, 'Office Supplies')) s(i, CategoryName)""",
    "restock_notice": """SELECT 1 AS Run, count(*) AS RowsChanged,
            CASE WHEN count(*) = 0 THEN 'No products currently below reorder level.' END AS Notice
        FROM m_Inventory i JOIN m_Products p ON p.ProductID = i.ProductID
        WHERE i.QuantityOnHand < p.ReorderLevel AND NOT p.Discontinued
        UNION ALL SELECT 2, 0, 'No products currently below reorder level.'""",
    "rejected_lines": "SELECT OrderDetailID, broken_rules FROM m_UncheckedRules WHERE broken_rules <> ''",
    "accepted_lines": """SELECT OrderDetailID, OrderID, ProductID, Quantity FROM m_UncheckedRules
        WHERE broken_rules = ''""",
    "surrogate_keys": """SELECT CustomerSegment, CustomerID,
            1000 + row_number() OVER (ORDER BY CustomerSegment, CustomerID) AS CustomerKey FROM m_Customers""",
    "surrogate_keys_with_gaps": """SELECT ReturnID, 1001 + ReturnID - min(ReturnID) OVER () AS ReturnKey
        FROM m_Returns""",
    "default_values": f"""SELECT OrderID, CustomerID, EmployeeID, AddressID, {FIRST} AS OrderDate,
            'Pending' AS OrderStatus, CAST(0 AS {_AMOUNT}) AS TotalAmount FROM m_Headers""",

    "order_totals": "SELECT OrderID, TotalAmount FROM m_Orders",
    "payments_derived": "SELECT * FROM m_Payments",
    "returns_sampled": f"""SELECT 1 + OrderDetailID - (SELECT min(OrderDetailID) FROM m_Lines) AS ReturnID, OrderDetailID,
            OrderDate + to_days(CAST(5 + {_pick('OrderDetailID', 'returns-day', 20)} AS INT))
            AS ReturnDate, 1 AS QuantityReturned, 'Customer changed mind' AS Reason,
            CAST(UnitPrice AS {_AMOUNT}) AS RefundAmount
        FROM m_Lines l JOIN m_Headers o ON o.OrderID = l.OrderID WHERE o.OrderStatus = 'Delivered'
        ORDER BY md5(CAST(OrderDetailID AS VARCHAR) || '|returns'), OrderDetailID LIMIT 300""",
    "place_orders": "SELECT seq, ProductID, Quantity, Accepted, ErrorNumber FROM m_Decided",
    "place_orders_headers": f"""SELECT NewOrderID AS OrderID, CustomerID, EmployeeID, AddressID, {FIRST} AS OrderDate,
            'Confirmed' AS OrderStatus, Price AS TotalAmount FROM m_Taken""",
    "place_orders_lines": """SELECT NewLineID AS OrderDetailID, NewOrderID AS OrderID, ProductID, Quantity, UnitPrice,
            CAST(0 AS DECIMAL(4,2)) AS Discount, CAST(Price AS DECIMAL(18,4)) AS LineTotal FROM m_Taken""",
    "place_orders_payments": f"""SELECT NewPaymentID AS PaymentID, NewOrderID AS OrderID, {FIRST} AS PaymentDate, Price AS Amount, PaymentMethod,
            'Success' AS PaymentStatus FROM m_Taken""",
    "place_orders_audit": "SELECT * FROM m_PlacedAudit",
    "place_orders_errors": "SELECT * FROM m_PlacedErrors",
    "place_orders_inventory": "SELECT * FROM m_StockAfter",
    "place_orders_stored": """SELECT TableName, CAST(RowID AS BIGINT) AS RowID, CAST(OrderID AS BIGINT) AS OrderID,
            CAST(ProductID AS BIGINT) AS ProductID, CAST(Amount AS DECIMAL(28,4)) AS Amount, Detail FROM (
        SELECT 'Orders' AS TableName, OrderID AS RowID, OrderID, NULL AS ProductID, CAST(TotalAmount AS DECIMAL(28,4))
            AS Amount, OrderStatus AS Detail FROM m_Orders
        UNION ALL SELECT 'Orders', NewOrderID, NewOrderID, NULL, Price, 'Confirmed' FROM m_Taken
        UNION ALL SELECT 'OrderDetails', OrderDetailID, OrderID, ProductID, LineTotal, CAST(Quantity AS VARCHAR)
            FROM m_Lines
        UNION ALL SELECT 'OrderDetails', NewLineID, NewOrderID, ProductID, Price, CAST(Quantity AS VARCHAR) FROM m_Taken
        UNION ALL SELECT 'Payments', PaymentID, OrderID, NULL, Amount, PaymentMethod || ' ' || PaymentStatus
            FROM m_Payments
        UNION ALL SELECT 'Payments', NewPaymentID, NewOrderID, NULL, Price, PaymentMethod || ' Success' FROM m_Taken
        UNION ALL SELECT 'OrderAuditLog', AuditID, OrderID, NULL, NULL, Action || ': ' || ActionDetail
            FROM m_PlacedAudit
        UNION ALL SELECT 'ErrorLog', ErrorLogID, NULL, NULL, ErrorNumber, ErrorMessage FROM m_PlacedErrors
        UNION ALL SELECT 'Inventory', ProductID, NULL, ProductID, QuantityOnHand, WarehouseLocation
            FROM m_StockAfter) t""",
    "process_returns": f"""SELECT (SELECT max(ReturnID) FROM m_Returns) + 1 + seq - (SELECT min(seq) FROM m_ReturnRequests)
                AS ReturnID, OrderDetailID, {FIRST} AS ReturnDate, QuantityReturned,
            'Customer changed mind' AS Reason, CAST(UnitPrice * QuantityReturned AS {_AMOUNT}) AS RefundAmount
        FROM m_ReturnsDecided WHERE UnitPrice IS NOT NULL AND QuantityReturned > 0""",
    "process_returns_payments": """SELECT PaymentID, OrderID, PaymentDate, Amount, PaymentMethod,
            CASE WHEN OrderID IN (SELECT OrderID FROM m_ReturnsDecided WHERE UnitPrice IS NOT NULL
                                  AND QuantityReturned > 0) THEN 'Refunded' ELSE PaymentStatus END AS PaymentStatus
        FROM m_Payments""",
    "process_returns_errors": f"""SELECT seq, 1 + seq - (SELECT min(seq) FROM m_ReturnRequests) AS ErrorLogID, CASE ErrorNumber WHEN 51003 THEN 'usp_ProcessReturn (refund step)'
                ELSE 'usp_ProcessReturn' END AS ErrorProcedure, ErrorNumber,
            CASE ErrorNumber WHEN 51002 THEN 'Order line not found.'
                WHEN 51003 THEN 'No matching payment found to refund.'
                ELSE 'The statement conflicted with a table constraint.' END AS ErrorMessage, {FIRST} AS ErrorAt
        FROM m_ReturnsDecided WHERE ErrorNumber IS NOT NULL""",
    "replenish_inventory": f"""SELECT i.ProductID, CAST(CASE WHEN low THEN QuantityOnHand + 100 ELSE QuantityOnHand END AS INT)
                AS QuantityOnHand, WarehouseLocation,
            CASE WHEN low THEN {FIRST_DAY} ELSE LastRestockDate END AS LastRestockDate
        FROM m_Inventory i JOIN (SELECT x.ProductID, x.QuantityOnHand < p.ReorderLevel AND NOT p.Discontinued AS low
            FROM m_Inventory x JOIN m_Products p ON p.ProductID = x.ProductID) l ON l.ProductID = i.ProductID""",
    "line_audit": f"""SELECT 1 + OrderDetailID - min(OrderDetailID) OVER () AS AuditID, OrderID, 'LINE_ADDED' AS Action, concat('ProductID=', ProductID, ', Qty=', Quantity,
            ', LineTotal=', CAST(LineTotal AS VARCHAR)) AS ActionDetail, {FIRST} AS ActionAt FROM m_Lines""",
    "inventory_update_accepted": """SELECT ProductID, CAST(QuantityOnHand - QuantityOnHand // 10 AS INT) AS QuantityOnHand,
            'MAIN' AS WarehouseLocation, LastRestockDate FROM m_Inventory""",
    "inventory_update_rejected": "SELECT * FROM m_Inventory",
    "inventory_update_verdicts": """SELECT count(*) AS BatchRows, CAST(0 AS BIGINT) AS NegativeRows,
            CAST(NULL AS VARCHAR) AS ErrorMessage FROM m_Inventory
        UNION ALL
        SELECT count(*), count(*) FILTER (WHERE QuantityOnHand - QuantityOnHand // 10 < 50),
            'Update rejected: inventory cannot go negative.' FROM m_Inventory""",

    "customer_ltv": f"""SELECT c.CustomerID, CAST(coalesce(sum(o.TotalAmount), 0) AS {_AMOUNT}) AS LifetimeValue
        FROM m_Customers c LEFT JOIN m_Orders o ON o.CustomerID = c.CustomerID AND o.OrderStatus <> 'Cancelled'
        GROUP BY c.CustomerID""",
    "order_history": """WITH counted AS (SELECT OrderID, count(*) AS LineCount FROM m_Lines GROUP BY OrderID)
        SELECT CustomerID, OrderID, OrderDate, OrderStatus, TotalAmount, LineCount
        FROM counted JOIN m_Orders USING (OrderID)""",
    "customer_functions": f"""WITH asked AS (SELECT CustomerID FROM m_Customers UNION ALL SELECT -1 - CustomerID FROM m_Customers),
        counted AS (SELECT OrderID, count(*) AS LineCount FROM m_Lines GROUP BY OrderID),
        history AS (SELECT CustomerID, OrderID, OrderDate, OrderStatus, TotalAmount, LineCount
            FROM m_Orders JOIN counted USING (OrderID))
        SELECT CustomerID, (SELECT CAST(coalesce(sum(o.TotalAmount), 0) AS {_AMOUNT}) FROM m_Orders o
                WHERE o.CustomerID = a.CustomerID AND o.OrderStatus <> 'Cancelled') AS LifetimeValue,
            OrderID, OrderDate, OrderStatus, TotalAmount, LineCount
        FROM asked a LEFT JOIN history USING (CustomerID)""",
    "orders_by_status": """SELECT OrderID, CustomerID, OrderDate, TotalAmount FROM m_Orders
        WHERE OrderStatus = 'Delivered' ORDER BY OrderDate DESC""",
    "load_summary": """SELECT (SELECT count(*) FROM m_Customers) AS customers, (SELECT count(*) FROM m_Orders) AS orders,
            (SELECT count(*) FROM m_Lines) AS order_lines""",

    "generated_customers": f"""SELECT i AS CustomerID, concat('First', i) AS FirstName, concat('Last', i) AS LastName,
            concat('customer', i, '@example.com') AS Email,
            concat('9', lpad(CAST({_pick('i', 'phone', 1000000000)} AS VARCHAR), 9, '0')) AS Phone,
            {FIRST_DAY} - CAST({_pick('i', 'signup', 900)} AS INT) AS SignupDate,
            CASE WHEN i % 20 = 0 THEN 'VIP' WHEN i % 5 = 0 THEN 'Premium' ELSE 'Standard' END AS CustomerSegment,
            i % 37 <> 0 AS IsActive FROM m_Made""",
    "generated_addresses": f"""SELECT i AS AddressID, i AS CustomerID,
            concat({_pick('i', 'house', 999)}, ' Main Street') AS AddressLine1, c.City, c.State, 'India' AS Country,
            CAST(100000 + {_pick('i', 'postcode', 899999)} AS VARCHAR) AS PostalCode, TRUE AS IsDefault
        FROM m_Made JOIN (VALUES (0, 'Delhi', 'Delhi'), (1, 'Mumbai', 'Maharashtra'), (2, 'Bengaluru', 'Karnataka'),
            (3, 'Chennai', 'Tamil Nadu'), (4, 'Pune', 'Maharashtra'), (5, 'Hyderabad', 'Telangana'),
            (6, 'Kolkata', 'West Bengal'), (7, 'Ahmedabad', 'Gujarat')) c(n, City, State)
          ON c.n = {_pick('i', 'city', 8)}""",
    "generated_products": f"""SELECT i AS ProductID, concat('Product ', i) AS ProductName,
            (i - 1 + c) % c + 1 AS CategoryID, (i - 1 + s) % s + 1 AS SupplierID,
            CAST(50 + CAST({_pick('i', 'price', 95000)} AS DECIMAL(18,2)) / 100 AS DECIMAL(10,2)) AS UnitPrice,
            CAST(10 + i % 5 * 5 AS INT) AS ReorderLevel, i % 17 = 0 AS Discontinued
        FROM (SELECT ProductID AS i, (SELECT count(*) FROM m_Categories) AS c, (SELECT count(*) FROM supplier) AS s
              FROM m_Products) t""",
    "generated_inventory": f"""SELECT ProductID, CAST(20 + {_pick('ProductID', 'stock', 500)} AS INT) AS QuantityOnHand,
            CASE WHEN ProductID % 2 = 0 THEN 'MAIN' ELSE 'NORTH-DC' END AS WarehouseLocation,
            {FIRST_DAY} - CAST({_pick('ProductID', 'restock', 60)} AS INT) AS LastRestockDate FROM m_Products""",
    "generated_orders": f"""SELECT d.i AS OrderID, c.CustomerID, e.EmployeeID, c.CustomerID AS AddressID,
            CAST({FIRST_DAY} - CAST({_pick('d.i', 'day', 730)} AS INT) AS TIMESTAMP) AS OrderDate,
            CASE {_pick('d.i', 'status', 20)} WHEN 0 THEN 'Cancelled' WHEN 1 THEN 'Pending' ELSE 'Delivered' END
                AS OrderStatus, CAST(0 AS {_AMOUNT}) AS TotalAmount
        FROM (SELECT i, {_pick('i', 'customer', 'customers')} AS buyer, {_pick('i', 'employee', 'employees')} AS seller
              FROM (SELECT count(*) AS customers, (SELECT count(*) FROM supplier) AS employees,
                        unnest(generate_series(1, 12 * count(*))) AS i FROM customer) k) d
        JOIN m_NumberedCustomers c ON c.n = d.buyer JOIN m_NumberedEmployees e ON e.n = d.seller""",
    "generated_lines": f"""SELECT t.OrderDetailID, t.OrderID, p.ProductID,
            CAST(1 + {_pick('t.OrderDetailID', 'quantity', 5)} AS INT) AS Quantity, p.UnitPrice, Discount,
            CAST((1 + {_pick('t.OrderDetailID', 'quantity', 5)}) * p.UnitPrice * (1 - Discount) AS DECIMAL(18,4))
                AS LineTotal
        FROM (SELECT OrderID, OrderID * 4 + k AS OrderDetailID,
                CAST(CASE WHEN {_pick('OrderID * 4 + k', 'discount', 10)} = 0 THEN 0.10 ELSE 0 END AS DECIMAL(4,2))
                    AS Discount,
                CASE k WHEN 0 THEN d0 WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END AS n
              FROM m_Drawn, LATERAL (SELECT unnest(generate_series(0, {_pick('OrderID', 'lines', 4)})) AS k) s) t
        JOIN m_NumberedProducts p ON p.n = t.n""",
    "generated_payments": f"""SELECT OrderID AS PaymentID, OrderID, OrderDate + INTERVAL '5' MINUTE AS PaymentDate,
            TotalAmount AS Amount,
            CASE {_pick('OrderID', 'method', 5)} WHEN 0 THEN 'CreditCard' WHEN 1 THEN 'DebitCard' WHEN 2 THEN 'UPI'
                 WHEN 3 THEN 'NetBanking' ELSE 'COD' END AS PaymentMethod,
            CASE WHEN {_pick('OrderID', 'paid', 25)} = 0 THEN 'Failed' ELSE 'Success' END AS PaymentStatus
        FROM m_Orders WHERE OrderStatus <> 'Cancelled'""",
}
_selects["segment_one_pass"] = _selects["segment_set_ops"]


# The rules of the contracts, counted one by one, and the tables they are counted in: with planted faults, where there
# are such; references are looked up in the tables without.
_CHECKED = {"Categories": "m_Categories", "Suppliers": "m_Suppliers", "Employees": "m_Employees",
            "Customers": "m_Customers", "ShippingAddresses": "m_Addresses", "Products": "m_Products",
            "Inventory": "m_Inventory", "OrderDetails": "m_Unchecked", "Orders": "m_Orders",
            "Payments": "m_Payments", "Returns": "m_Returns"}
_CHECKED_STAR = {"DimDate": "m_DimDate", "DimCustomer": "m_BadCustomers", "DimProduct": "m_DimProduct",
                 "DimEmployee": "m_DimEmployee", "DimGeography": "m_BadGeography", "FactSales": "m_BadSales",
                 "FactInventorySnapshot": "m_BadSnapshot", "FactReturns": "m_BadReturns"}
_SOUND = {"OrderDetails": "m_Lines", "DimCustomer": "m_DimCustomer", "DimGeography": "m_DimGeography"}


def _rule_counts(tables: dict[str, Table], views: dict[str, str]) -> str:
    counts = []

    def count(rule: str, source: str, broken: str = "TRUE") -> None:
        counts.append(f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS violations FROM {source}")

    for name, view in views.items():
        table = tables[name]
        for column in table.required:
            count(f"{name}.{column} not null", view, f"{column} IS NULL")
        for column, allowed in table.domains.items():
            count(f"{name}.{column} domain", view, f"{column} NOT IN {allowed}")
        for column, condition in table.ranges.items():
            count(f"{name}.{column} range", view, f"NOT ({condition})")
        for column, limit in table.lengths.items():
            count(f"{name}.{column} length", view, f"length({column}) > {limit}")
        for columns in (table.key, *table.unique):
            text = ",".join(columns)
            count(f"{name}.{text} unique", f"(SELECT {text} FROM {view} GROUP BY {text} HAVING count(*) > 1) t")
        for fk in table.foreign:
            parent = _SOUND.get(fk.parent) or views[fk.parent]
            child = fk.columns[0]
            count(f"{name}.{child} references {fk.parent}",
                  f"(SELECT DISTINCT {child} AS k FROM {view}) c "
                  f"LEFT JOIN (SELECT {fk.parent_columns[0]} AS p FROM {parent}) q ON q.p = c.k",
                  "k IS NOT NULL AND p IS NULL")
    return "\nUNION ALL ".join(counts)


_selects["constraint_violations"] = _rule_counts(OLTP, _CHECKED)
_selects["star_constraint_violations"] = _rule_counts(STAR, _CHECKED_STAR)


def all_oracles() -> dict[str, str]:
    return {name: with_tables(select) for name, select in _selects.items()}
