"""Analytic queries over the star schema and the order tables.

The fact is reduced before it meets a dimension wherever the question allows it: sums are partial per task,
so a day, customer or product that holds a large part of the sales costs no more than another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.functions.dates import days_between
from orderloom.functions.money import AMOUNT
from orderloom.functions.text import concat_null, indent
from orderloom.operators.skew import fits_broadcast, lookup_join
from orderloom.session import materialize

# Levels below a root that a hierarchy may have before the query fails.
MAX_LEVELS = 100


def monthly_sales(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Sales per month with running total, previous present month and change against it.

    The windows run over one row per calendar month.
    """
    daily = fact.groupBy("DateKey").agg(F.sum("LineTotal").alias("_sales"))
    monthly = (daily.join(dim_date, "DateKey").groupBy("Year", "MonthNumber", "MonthName")
               .agg(F.sum("_sales").cast(AMOUNT).alias("MonthlySales")))
    by_month = Window.orderBy("Year", "MonthNumber")
    running = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous = F.lag("MonthlySales", 1).over(by_month)
    return (monthly.withColumn("RunningTotal", F.sum("MonthlySales").over(running).cast(AMOUNT))
            .withColumn("PrevMonthSales", previous)
            .withColumn("MoMChange", (F.col("MonthlySales") - F.col("PrevMonthSales")).cast(AMOUNT))
            .orderBy("Year", "MonthNumber"))


def top_customers_by_region(fact: DataFrame, dim_customer: DataFrame, dim_employee: DataFrame,
                            top: int = 5) -> DataFrame:
    """The customers ranked 1 to ``top`` by revenue in each region of the selling employee.

    Customers go by name, over all their versions; ties share a rank. Sales without an employee do not count.
    """
    sold = (fact.where(F.col("EmployeeKey").isNotNull()).groupBy("CustomerKey", "EmployeeKey")
            .agg(F.sum("LineTotal").alias("_sales")))
    staff = dim_employee.select("EmployeeKey", "Region")
    regional = (lookup_join(sold, staff, ["EmployeeKey"], ["CustomerKey"], hot_in=fact)
                .groupBy("CustomerKey", "Region").agg(F.sum("_sales").alias("_sales")))
    revenue = (regional.join(dim_customer.select("CustomerKey", "FullName"), "CustomerKey")
               .groupBy("Region", "FullName").agg(F.sum("_sales").cast(AMOUNT).alias("Revenue")))
    by_revenue = Window.partitionBy("Region").orderBy(F.desc("Revenue"))
    return (revenue.withColumn("RegionRank", F.rank().over(by_revenue)).where(F.col("RegionRank") <= top)
            .orderBy("Region", "RegionRank", "FullName"))


def org_hierarchy(employees: DataFrame, max_levels: int = MAX_LEVELS) -> DataFrame:
    """Every employee below a root (no manager), with the number of levels in between.

    Each round doubles the distance an employee looks up the tree, so a tree of depth d takes log2(d) joins
    instead of d. Who never reaches a root - in a cycle, or below a manager that does not exist - is left
    out. A tree deeper than ``max_levels`` is an error.
    """
    people = employees.select("EmployeeID", "FirstName", "LastName", "ManagerID", "Title")
    # (EmployeeID, up, steps): ``up`` is the ancestor ``steps`` levels higher; NULL once a root was passed.
    looking = materialize(people.select(
        "EmployeeID", F.col("ManagerID").alias("up"),
        F.when(F.col("ManagerID").isNull(), 0).otherwise(1).alias("steps")), "hierarchy")
    reach = 1
    while reach <= max_levels and looking.where(F.col("up").isNotNull()).limit(1).count():
        done = looking.where(F.col("up").isNull())
        open_ends = looking.where(F.col("up").isNotNull())
        further = looking.select(F.col("EmployeeID").alias("up"), F.col("up").alias("_up"),
                                 F.col("steps").alias("_steps"))
        moved = (lookup_join(open_ends, further, ["up"], ["EmployeeID"])
                 .select("EmployeeID", F.col("_up").alias("up"), (F.col("steps") + F.col("_steps")).alias("steps")))
        looking = materialize(done.unionByName(moved), "hierarchy")
        reach *= 2
    levels = looking.where(F.col("up").isNull()).select("EmployeeID", F.col("steps").alias("HierarchyLevel"))
    if levels.where(F.col("HierarchyLevel") > max_levels).limit(1).count():
        raise RecursionError(f"the hierarchy has more than {max_levels} levels")
    name = indent(F.col("HierarchyLevel"), concat_null(F.col("FirstName"), " ", F.col("LastName")))
    return (people.join(levels, "EmployeeID").orderBy("HierarchyLevel", "LastName", "EmployeeID")
            .select(name.alias("OrgChart"), "Title", F.col("HierarchyLevel").cast("int").alias("HierarchyLevel")))


def category_by_quarter(fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame, year: int) -> DataFrame:
    """Revenue of one year per category (rows) and quarter (columns); NULL where nothing was sold."""
    days = dim_date.where(F.col("Year") == year).select("DateKey", "Quarter")
    in_year = F.col("DateKey").between(year * 10000 + 101, year * 10000 + 1231)
    if "SalesMonth" in fact.columns:
        # The calendar's year is not visible to the partition filter of the fact, so it is said twice.
        in_year = in_year & F.col("SalesMonth").between(year * 100 + 1, year * 100 + 12)
    sold = (fact.where(in_year).join(F.broadcast(days), "DateKey")  # at most 366 rows
            .groupBy("ProductKey", "Quarter").agg(F.sum("LineTotal").alias("_sales")))
    named = sold.join(dim_product.select("ProductKey", "CategoryName"), "ProductKey")
    wide = named.groupBy("CategoryName").pivot("Quarter", [1, 2, 3, 4]).agg(F.sum("_sales").cast(AMOUNT))
    return wide.select("CategoryName", *[F.col(str(q)).alias(f"Q{q}") for q in (1, 2, 3, 4)]).orderBy(
        "CategoryName")


def order_islands(orders: DataFrame) -> DataFrame:
    """Runs of consecutive days with an order, per customer.

    Orders shrink to one row per customer and day before a customer's rows meet, so a group is never longer
    than the calendar.
    """
    days = orders.select("CustomerID", F.col("OrderDate").cast("date").alias("OrderDay")).distinct()
    turn = F.row_number().over(Window.partitionBy("CustomerID").orderBy("OrderDay"))
    return (days.withColumn("_island", F.date_sub("OrderDay", turn)).groupBy("CustomerID", "_island")
            .agg(F.min("OrderDay").alias("IslandStart"), F.max("OrderDay").alias("IslandEnd"))
            .select("CustomerID", "IslandStart", "IslandEnd"))


def _gap_columns() -> list[Column]:
    return ["CustomerID", F.col("IslandEnd").alias("LastOrderInIsland"),
            F.col("_next").alias("NextOrderAfterGap"),
            days_between(F.col("IslandEnd"), F.col("_next")).alias("GapDays")]


def gaps_all_pairs(orders: DataFrame, min_days: int = 60) -> DataFrame:
    """Every island with every later island of the customer that starts ``min_days`` or more after its end.

    The pairs are the answer as asked. Only pairs that belong to it leave the join, and a customer has at most
    one island for every two days of the calendar, whatever the number of orders.
    """
    islands = order_islands(orders)
    later = islands.select(F.col("CustomerID").alias("_id"), F.col("IslandStart").alias("_next"))
    far = F.col("_next") >= F.date_add("IslandEnd", max(min_days, 1))
    return (islands.join(later, (F.col("CustomerID") == F.col("_id")) & far).select(*_gap_columns())
            .orderBy(F.desc("GapDays"), "CustomerID", "LastOrderInIsland"))


def gaps_counted(orders: DataFrame, min_days: int = 60) -> DataFrame:
    """For every island, how many later islands of the customer start ``min_days`` or more after its end, the first of
    them and the longest such gap.

    What ``gaps_all_pairs`` lists, counted: islands and questions are ordered by day, the latest first, and each
    question looks at the islands up to its day. So there is one row per island, and no island meets another.
    """
    start, none = F.unix_date("IslandStart"), F.lit(None)
    question = F.struct(F.col("IslandEnd"), none.cast("int").alias("_start"),
                        (F.unix_date("IslandEnd") + max(min_days, 1)).alias("_day"))
    island = F.struct(none.cast("date").alias("IslandEnd"), start.alias("_start"), start.alias("_day"))
    events = order_islands(orders).select("CustomerID", F.inline(F.array(question, island)))
    later = Window.partitionBy("CustomerID").orderBy("_falling").rangeBetween(Window.unboundedPreceding, 0)
    end = F.unix_date("IslandEnd")
    return (events.withColumn("_falling", -F.col("_day")).select(
        "CustomerID", F.col("IslandEnd").alias("LastOrderInIsland"), F.count("_start").over(later).alias("LaterIslands"),
        F.date_from_unix_date(F.min("_start").over(later)).alias("NextOrderAfterGap"),
        (F.max("_start").over(later) - end).alias("LongestGapDays")).where(F.col("LastOrderInIsland").isNotNull()))


def gaps_adjacent(orders: DataFrame, min_days: int = 60) -> DataFrame:
    """Real pauses: from each island to the next one, if ``min_days`` or more apart."""
    following = F.lead("IslandStart").over(Window.partitionBy("CustomerID").orderBy("IslandStart"))
    return (order_islands(orders).withColumn("_next", following)
            .where(F.datediff("_next", "IslandEnd") >= min_days).select(*_gap_columns())
            .orderBy(F.desc("GapDays"), "CustomerID", "LastOrderInIsland"))


def _category_buyers(fact: DataFrame, dim_product: DataFrame, categories: list[str]) -> DataFrame:
    """(CustomerKey, CategoryName), distinct, for sales in the given categories."""
    chosen = dim_product.where(F.col("CategoryName").isin(categories)).select("ProductKey", "CategoryName")
    bought = fact.select("CustomerKey", "ProductKey")
    if not fits_broadcast(chosen):
        # The products are joined by a shuffle; what a task has seen a customer buy before does not take part in it.
        bought = bought.distinct()
    return (lookup_join(bought, chosen, ["ProductKey"], ["CustomerKey"], hot_in=fact)
            .select("CustomerKey", "CategoryName").distinct())


def buyer_segments(fact: DataFrame, dim_product: DataFrame, wanted: str, other: str) -> DataFrame:
    """Buyers of ``wanted`` but never ``other``, and buyers of both, by set operators."""
    # Written, as each of the four sets would join all sales again.
    buyers = materialize(_category_buyers(fact, dim_product, [wanted, other]), "buyers")
    has_wanted = buyers.where(F.col("CategoryName") == wanted).select("CustomerKey")
    has_other = buyers.where(F.col("CategoryName") == other).select("CustomerKey")
    only, both = F.lit(f"{wanted} only").alias("Segment"), F.lit("Bought both").alias("Segment")
    return (has_wanted.select("CustomerKey", only).subtract(has_other.select("CustomerKey", only))
            .unionAll(has_wanted.select("CustomerKey", both).intersect(has_other.select("CustomerKey", both))))


def buyer_segments_one_pass(fact: DataFrame, dim_product: DataFrame, wanted: str, other: str) -> DataFrame:
    """The same answer from one look at each buyer."""
    buyers = _category_buyers(fact, dim_product, [wanted, other])
    flags = buyers.groupBy("CustomerKey").agg(
        F.bool_or(F.col("CategoryName") == wanted).alias("_wanted"),
        F.bool_or(F.col("CategoryName") == other).alias("_other"))
    return flags.where("_wanted").select(
        "CustomerKey", F.when(F.col("_other"), "Bought both").otherwise(f"{wanted} only").alias("Segment"))
