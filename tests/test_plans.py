"""What the planner makes of the queries that have to hold up on large tables."""

import io
import re
from contextlib import redirect_stdout

import pytest
from shop import DATA, rows

from orderloom.operators import skew
from orderloom.plans import analytics, facts, full_load
from orderloom.registry import all_queries
from orderloom.session import bound_tasks
from orderloom.sources.tables import TableStore
from orderloom.sources.workspace import FIRST_LOAD, SECOND_LOAD, Workspace, workspace

QUERIES = all_queries()


def plan(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def shop_star(spark):
    return workspace(spark, DATA)


def test_top_customers_limit_groups_before_the_shuffle(shop_star):
    text = plan(analytics.top_customers_by_region(
        shop_star.star("FactSales"), shop_star.star("DimCustomer"), shop_star.star("DimEmployee")))
    assert text.count("WindowGroupLimit") >= 2


def test_pivot_prunes_months_and_columns(shop_star):
    text = plan(analytics.category_by_quarter(
        shop_star.star("FactSales"), shop_star.star("DimProduct"), shop_star.star("DimDate"), 1997))
    assert "PartitionFilters: [isnotnull(SalesMonth" in text
    assert "ReadSchema: struct<DateKey:int,ProductKey:bigint,LineTotal:decimal(12,2)>" in text
    assert "GreaterThanOrEqual(DateKey,19970101)" in text


def test_monthly_sales_sums_days_before_the_join(shop_star):
    text = plan(analytics.monthly_sales(shop_star.star("FactSales"), shop_star.star("DimDate")))
    assert "ReadSchema: struct<DateKey:int,LineTotal:decimal(12,2)>" in text
    assert "Keys [1]: [DateKey" in text


def test_segments_drop_repeated_buys_before_the_first_exchange(shop_star, monkeypatch):
    """Where the products are too many to be sent around, a task hands on each product of a customer once."""
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    frame = analytics.buyer_segments_one_pass(shop_star.star("FactSales"), shop_star.star("DimProduct"), "ECONOMY",
                                              "PROMO")
    lines = [line for line in frame._jdf.queryExecution().executedPlan().toString().split("\n") if line.strip()]
    sales = next(i for i, line in enumerate(lines) if "FileScan" in line and "CustomerKey" in line)
    above = [re.sub(r"^[^A-Za-z(]*(\(\d+\) )?", "", line).split("(")[0].split(" ")[0] for line in lines[:sales]]
    last_exchange = max(i for i, name in enumerate(above) if name == "Exchange")
    assert "HashAggregate" in above[last_exchange + 1:]


def test_customer_functions_become_joins(spark):
    text = plan(QUERIES["customer_functions"](spark, DATA))
    assert "Join" in text and "CartesianProduct" not in text and "PythonUDF" not in text


def test_sample_takes_first_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["returns_sampled"](spark, DATA))


@pytest.mark.parametrize("name", [
    "monthly_sales", "top_customers_by_region", "category_quarter_pivot", "segment_set_ops", "churn_gaps_all_pairs",
    "churn_gap_counts", "customer_functions",
    "fact_returns_refunded", "rejected_lines", "order_history", "line_audit", "dim_customer_scd2"])
def test_no_python_and_no_pairs_of_everything(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert word not in text


def test_a_dimension_does_not_load_the_facts(spark):
    """inventory_snapshot_merge and fact_sales_merge ask for dimensions only."""
    shop = Workspace(spark, DATA)
    assert shop.star("DimProduct").count() and shop.star("DimGeography").count()
    assert not shop.store.exists("FactSales") and "order lines" not in shop._made
    assert shop.star("FactInventorySnapshot").count() and not shop.store.exists("FactSales")


def test_sales_get_their_keys_behind_the_shuffle_by_month(spark, shop_star, monkeypatch):
    """What follows from other columns is not shuffled with the first load of the sales."""
    plans = {}

    def seen(store, name, df, *args, **kwargs):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        raise InterruptedError
    monkeypatch.setattr(TableStore, "stage", seen)
    monkeypatch.setattr(TableStore, "exists", lambda store, name: name != "FactSales")
    with pytest.raises(InterruptedError):
        full_load._load_sales(shop_star.store, shop_star.oltp(), FIRST_LOAD)
    gathered = plans["FactSales"].split("RebalancePartitions")[1]
    assert "SalesMonth" in gathered and "SalesKey" not in gathered


def test_merged_sales_shuffle_no_key_they_do_not_use(shop_star):
    fact = shop_star.star("FactSales").drop(facts.SALES_MONTH)
    source = fact.drop("SalesKey", "LoadedAt")
    merged = facts.merge_sales(fact, source, shop_star.table("OrderDetails"), SECOND_LOAD)
    joined = merged._jdf.queryExecution().optimizedPlan().toString().split("Join FullOuter")[1]
    assert joined.count("AS SalesKey#") == 0
    assert rows(merged) == rows(fact)


def test_set_operators_join_the_sales_once(shop_star):
    frame = analytics.buyer_segments(shop_star.star("FactSales"), shop_star.star("DimProduct"), "ECONOMY", "PROMO")
    assert "ProductKey" not in plan(frame)


def test_counted_gaps_find_the_islands_once(shop_star):
    assert plan(analytics.gaps_counted(shop_star.table("Orders"))).count("Scan parquet") == 2  # tree and details


def test_tasks_of_a_workspace_are_bounded_unless_the_session_says_otherwise(spark):
    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    other = spark.newSession()
    other.conf.set(sizes[1], "32m")
    bound_tasks(other)
    assert [other.conf.get(name) for name in sizes] == ["16m", "32m"]
    plain = spark.newSession()
    bound_tasks(plain)
    assert [plain.conf.get(name) for name in sizes] == ["16m", "8m"]
