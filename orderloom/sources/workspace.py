"""The retail tables and the star schema of one data directory, made once per session and kept as tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from threading import RLock
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.model import OLTP
from orderloom.plans import orders as order_jobs
from orderloom.plans import returns as return_jobs
from orderloom.plans.full_load import NEEDS, load_returns, run_step
from orderloom.session import bound_tasks, materialize, scratch_path, shuffles_removed
from orderloom.sources import adapter
from orderloom.sources.tables import TableStore

# The moments of the first and the second load; both lie after every order and inside the calendar.
FIRST_LOAD = datetime(2001, 12, 1)
SECOND_LOAD = datetime(2001, 12, 2)
SOURCES = ("OrderDetails", "Categories", "Customers", "ShippingAddresses", "Employees", "Suppliers", "Inventory",
           "Products", "Orders")
T = TypeVar("T")
_opened: dict[tuple[str, str], "Workspace"] = {}
_lock = RLock()


class Workspace:
    """Retail tables are made when first asked for; later readers get a scan of the stored table."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self.store = TableStore(spark, scratch_path(spark, "star"))
        self._made: dict[str, object] = {}
        self._turns: dict[str, RLock] = {}
        self._loading = RLock()

    def once(self, name: str, make: Callable[[], T]) -> T:
        """The result of ``make``, which runs on the first call for ``name`` only."""
        with _lock:
            turn = self._turns.setdefault(name, RLock())
        with turn:
            if name not in self._made:
                self._made[name] = make()
            return self._made[name]

    def forget(self, name: str) -> None:
        """Let the next call of ``once`` for ``name`` run again."""
        with _lock:
            self._made.pop(name, None)

    def order_lines(self) -> DataFrame:
        """Order lines with their return flag."""
        def make() -> DataFrame:
            with shuffles_removed(self.spark):
                return adapter.order_lines(self.spark, self.directory)
        return self.once("order lines", make)

    def _make(self, name: str) -> DataFrame:
        spark, directory = self.spark, self.directory
        if name == "Suppliers":
            return adapter.suppliers(spark, directory, FIRST_LOAD)
        if name == "Products":
            return adapter.products(spark, directory, self.table("Categories"))
        if name == "Orders":
            return order_jobs.recompute_totals(adapter.order_headers(spark, directory), self.order_lines())
        if name == "Payments":
            return order_jobs.derive_payments(self.table("Orders"), adapter.payment_method(F.col("OrderID")),
                                              adapter.payment_status(F.col("OrderID")))
        if name == "Returns":
            return return_jobs.delivered_returns(self.order_lines(), self.table("Orders"))
        makers = {"Categories": adapter.categories, "Employees": adapter.employees,
                  "Customers": adapter.customers, "ShippingAddresses": adapter.addresses,
                  "Inventory": adapter.inventory}
        return makers[name](spark, directory)

    def table(self, name: str) -> DataFrame:
        """A retail table; written when first asked for."""
        if name == "OrderDetails":
            return self.order_lines().drop("ReturnFlag")
        columns = [f.name for f in OLTP[name].schema.fields]

        def make() -> DataFrame:
            with shuffles_removed(self.spark):
                return materialize(self._make(name).select(*columns), name)
        return self.once(name, make)

    def oltp(self, names: Sequence[str] = SOURCES) -> dict[str, DataFrame]:
        """Tables the star schema is loaded from. Tables that do not need each other are made side by side."""
        with ThreadPoolExecutor(4) as pool:
            return dict(zip(names, pool.map(self.table, names)))

    def calendar(self) -> tuple[date, date]:
        """Whole years around all orders and loads."""
        span = adapter.raw(self.spark, self.directory, "orders").agg(
            F.year(F.min("o_orderdate")).alias("low"), F.year(F.max("o_orderdate")).alias("high")).collect()[0]
        return date(span["low"], 1, 1), date(max(span["high"], SECOND_LOAD.year), 12, 31)

    def star(self, name: str) -> DataFrame:
        """A table of the star schema after the first full load, of which only the steps it needs are run."""
        with self._loading:
            self._load(name)
        return self.store.read(name)

    def _load(self, name: str) -> None:
        reads, before = NEEDS[name]
        for other in before:
            self._load(other)
        if name == "FactReturns":
            self.once(name + " load", lambda: load_returns(self.store, self.oltp(reads), None, FIRST_LOAD))
        else:
            self.once(name + " load", lambda: run_step(self.store, self.oltp(reads), FIRST_LOAD, self.calendar(), name))


def workspace(spark: SparkSession, directory: str) -> Workspace:
    """The one workspace of this session for a data directory."""
    key = (spark.sparkContext.applicationId, directory)
    with _lock:
        if key not in _opened:
            bound_tasks(spark)
            _opened[key] = Workspace(spark, directory)
        return _opened[key]
