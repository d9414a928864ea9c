"""The full load of the star schema, step by step, with an error log."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from orderloom.functions import errors
from orderloom.functions.text import concat_blank_null
from orderloom.operators import checks
from orderloom.operators.columns import with_defaults
from orderloom.operators.keys import highest
from orderloom.operators.merge import require_unique
from orderloom.operators.skew import lookup_join
from orderloom.model import AUDIT, STAR
from orderloom.plans import dimensions, facts
from orderloom.session import materialize, materialize_parts, release, shuffles_removed
from orderloom.sources.tables import Entry, TableStore

Sources = dict[str, DataFrame]
# Lines above which the sales are loaded in shares, one after the other, so that only the shuffle files of one share are
# there at a time: so many shares of the lines, which are read for each, and so many shares of the months.
SHARED_LINES, LINE_SHARES, MONTH_SHARES = 16_000_000, 2, 4
# Rows of the sales and of their batch that a task of the merge gets, about.
MERGED_ROWS = 250_000


# The retail tables that the load of a table reads, and the tables of the star schema that have to be there before it.
NEEDS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "DimDate": ((), ()),
    "DimCustomer": (("Customers",), ()),
    "DimProduct": (("Products", "Categories", "Suppliers"), ()),
    "DimEmployee": (("Employees",), ()),
    "DimGeography": (("ShippingAddresses",), ()),
    "FactSales": (("OrderDetails", "Orders", "ShippingAddresses"),
                  ("DimDate", "DimCustomer", "DimProduct", "DimEmployee", "DimGeography")),
    "FactInventorySnapshot": (("Inventory", "Products"), ("DimDate", "DimProduct")),
    "FactReturns": (("Returns", "OrderDetails", "Orders"), ("DimDate", "DimCustomer", "DimProduct")),
}


@dataclass(frozen=True)
class LoadStep:
    name: str
    table: str
    run: Callable[[], None]


def _stage(store: TableStore, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
    """Write a version that nobody sees yet, with the rows that break a rule counted as they are written; refused if
    there are any, or if a key is not unique or a reference unknown."""
    counted, broken = checks.watched(name, STAR[name], df)
    version = store.stage(name, counted, partition_by)
    checks.require_contract(name, STAR[name], store.staged(name, version), _parents(store, name), broken())
    return version


@contextmanager
def _kept(store: TableStore, name: str, shares: Iterable[DataFrame]) -> Iterator[DataFrame]:
    """The rows of ``shares`` written apart under the same rules, for loads that then swap some partitions of a table;
    deleted at the end."""
    watched = [checks.watched(name, STAR[name], df) for df in shares]
    ready = materialize_parts([counted for counted, _ in watched], name)
    try:
        checks.require_contract(name, STAR[name], ready, _parents(store, name), _sum(broken() for _, broken in watched))
        yield ready
    finally:
        release(ready)


def _sum(counts: Iterable[dict[str, int]]) -> dict[str, int]:
    total: Counter[str] = Counter()
    for found in counts:
        total.update(found)
    return dict(total)


def _parents(store: TableStore, name: str) -> Sources:
    return {fk.parent: store.read(fk.parent) for fk in STAR[name].foreign}


def _write(store: TableStore, name: str, df: DataFrame, as_of: datetime, partition_by: Sequence[str] = ()) -> None:
    store.publish({name: _stage(store, name, df, partition_by)}, as_of)


def _load_date(store: TableStore, as_of: datetime, start: date, end: date) -> None:
    _write(store, "DimDate", dimensions.load_dim_date(store.read("DimDate"), start, end).coalesce(1), as_of)


def _load_customer(store: TableStore, oltp: Sources, as_of: datetime) -> None:
    """The current versions are one part of the table, which a load replaces; the versions it closes become a part of
    their own, and are never written again."""
    name = "DimCustomer"
    with _kept(store, name, [dimensions.customer_versions(
            store.read(name, "current"), oltp["Customers"], as_of.date())]) as versions:
        entries = [Entry(name, store.stage(name, versions.where("IsCurrent")), "current")]
        closed = versions.where("NOT IsCurrent")
        if not closed.isEmpty():
            version = store.stage(name, closed, ahead=2)
            entries.append(Entry(name, version, f"closed-{version}"))
        store.enter(entries, as_of)


def _load_product(store: TableStore, oltp: Sources, as_of: datetime) -> None:
    _write(store, "DimProduct", dimensions.load_dim_product(
        store.read("DimProduct"), oltp["Products"], oltp["Categories"], oltp["Suppliers"]), as_of)


def _load_employee(store: TableStore, oltp: Sources, as_of: datetime) -> None:
    _write(store, "DimEmployee", dimensions.load_dim_employee(store.read("DimEmployee"), oltp["Employees"]), as_of)


def _load_geography(store: TableStore, oltp: Sources, as_of: datetime) -> None:
    _write(store, "DimGeography", dimensions.load_dim_geography(
        store.read("DimGeography"), oltp["ShippingAddresses"]), as_of)


def _by_month(fact: DataFrame) -> DataFrame:
    """Rows gathered by month for writing: few files per month, and a large month in many tasks."""
    return facts.with_month(fact).hint("rebalance", facts.SALES_MONTH)


def _share(df: DataFrame, column: str, at: int, of: int) -> DataFrame:
    """The rows of ``df`` whose value of ``column`` falls to share ``at``, by a hash that no join deals rows out by."""
    return df if of == 1 else df.where(F.pmod(F.xxhash64(F.lit("share"), F.col(column)), F.lit(of)) == at)


def _load_sales(store: TableStore, oltp: Sources, as_of: datetime) -> None:
    lines, orders, calendar = oltp["OrderDetails"], oltp["Orders"], store.read("DimDate")
    shares = LINE_SHARES if lines.count() > SHARED_LINES else 1

    def source_of(at: int) -> DataFrame:
        return facts.sales_source(
            _share(lines, "OrderID", at, shares), _share(orders, "OrderID", at, shares), oltp["ShippingAddresses"],
            store.read("DimCustomer", "current"), store.read("DimProduct"), store.read("DimEmployee"),
            store.read("DimGeography"))

    if not store.exists("FactSales"):
        version, found = None, []
        for at in range(shares):
            # Rows are gathered by month before they get what follows from their other columns.
            fresh = facts.first_sales(_by_month(source_of(at)), lines, as_of)
            counted, broken = checks.watched("FactSales", STAR["FactSales"], fresh)
            version = store.stage("FactSales", counted, [facts.SALES_MONTH], onto=version)
            found.append(broken())
        written = store.staged("FactSales", version)
        facts.require_dates(written, calendar)  # the other references follow
        parents = {name: df for name, df in _parents(store, "FactSales").items() if name != "DimDate"}
        checks.require_contract("FactSales", STAR["FactSales"], written, parents, _sum(found))
        store.publish({"FactSales": version}, as_of)
        return
    source = materialize_parts((source_of(at) for at in range(shares)), "sales-source")
    try:
        facts.require_dates(source, calendar)
        _merge_sales(store, source, as_of, 1 if shares == 1 else MONTH_SHARES)
    finally:
        release(source)


def _merge_sales(store: TableStore, source: DataFrame, as_of: datetime, shares: int) -> None:
    """Upsert stored rows into the sales; ``source`` is deleted once they are merged.

    Rows are shuffled once, to tasks that hold a month, part of one or some small ones, as they are stored.
    """
    fact, month = store.read("FactSales"), facts.SALES_MONTH
    # Only months that hold a line of the batch, by the fact's own date, or that get a new one are rewritten.
    # Lines get their numbers as they come in, so the range of the batch skips most files of older ones.
    span = source.agg(F.min("OrderDetailID").alias("low"), F.max("OrderDetailID").alias("high")).collect()[0]
    if span["low"] is None:
        return
    arriving = facts.with_month(source).withColumn("_at", F.coalesce(month, F.lit(0))).drop(month)
    known = require_unique(arriving.select("OrderDetailID", "_at"), ["OrderDetailID"], "merge source")
    held = (fact.where(F.col("OrderDetailID").between(span["low"], span["high"])).select("OrderDetailID", month)
            .join(known, "OrderDetailID"))
    # What is collected here has at most as many rows as the calendar has months, or pairs of them.
    rows = Counter({r["_at"]: r["n"] for r in arriving.groupBy("_at").agg(F.count("*").alias("n")).collect()})
    met = held.select(month, "_at").distinct().collect()
    moved = any(r[month] != r["_at"] for r in met)
    touched = fact.where(F.col(month).isin([*{*rows, *(r[month] for r in met)}]))
    rows.update({r[month]: r["n"] for r in touched.groupBy(month).agg(F.count("*").alias("n")).collect()})
    used = [source]
    if moved:
        # A line stays in its month, whatever date the batch gives it.
        stays = materialize(held.where(F.col(month) != F.col("_at")).select(
            "OrderDetailID", F.col(month).alias("_stays")), "moved-lines")
        used.append(stays)
        arriving = lookup_join(arriving, stays, ["OrderDetailID"], ["OrderDetailID"], "left").withColumn(
            "_at", F.coalesce("_stays", "_at")).drop("_stays")
    merged = []
    for months in _dealt(rows, shares):
        old = touched.where(F.col(month).isin(months)).withColumnRenamed(month, "_at")
        placed = [_placed(df, {m: rows[m] for m in months}) for df in (old, arriving)]
        merged.append(facts.with_month(facts.merge_sales(
            *placed, source, as_of, highest(fact, "SalesKey"), ["_task"]).drop("_task")))
    with _kept(store, "FactSales", merged) as ready:
        release(*used)
        store.replace_partitions("FactSales", ready, [month])


def _dealt(rows: Mapping[int, int], shares: int) -> list[list[int]]:
    """The months, dealt out over ``shares`` of about as many rows."""
    dealt: list[tuple[int, list[int]]] = [(0, [])] * shares
    for month, n in sorted(rows.items(), key=lambda item: (-item[1], item[0])):
        least = min(range(shares), key=lambda at: dealt[at][0])
        dealt[least] = dealt[least][0] + n, [*dealt[least][1], month]
    return [sorted(months) for _, months in dealt if months]


def _placed(df: DataFrame, rows: Mapping[int, int]) -> DataFrame:
    """The rows of ``df`` of the given months ``_at``, shuffled to their ``_task``: a large month has several, small ones
    share one. The same months and rows give the same tasks."""
    layout, task, taken = [], 0, 0
    for month, n in rows.items():
        if taken and taken + n > MERGED_ROWS:
            task, taken = task + 1, 0
        tasks = -(-n // MERGED_ROWS)
        layout.append((month, task, tasks))
        task, taken = task + tasks - 1, MERGED_ROWS if tasks > 1 else taken + n
    place = df.sparkSession.createDataFrame(layout, "_at INT, _first INT, _tasks INT")
    at = F.col("_first") + F.pmod(F.xxhash64("OrderDetailID"), F.col("_tasks")).cast("int")
    placed = df.join(F.broadcast(place), "_at").withColumn("_task", at).drop("_at", "_first", "_tasks")
    return placed.repartitionById(max(task + 1, 2), "_task")  # a single partition would be shuffled again by a join


def _load_snapshot(store: TableStore, oltp: Sources, as_of: datetime) -> None:
    day = as_of.date()
    name, dim = "FactInventorySnapshot", store.read("DimProduct")
    source = facts.snapshot_source(oltp["Inventory"], oltp["Products"], dim, day)
    facts.require_dates(source, store.read("DimDate"))
    fact = store.read(name)
    today = fact.where(F.col("DateKey") == day.year * 10000 + day.month * 100 + day.day)
    with _kept(store, name, [facts.merge_snapshot(
            today, source, dim, as_of, highest(fact, "SnapshotKey"))]) as merged:
        if store.exists(name):
            store.replace_partitions(name, merged, ["DateKey"])
        else:
            store.write(name, merged, as_of, ["DateKey"])


def load_steps(store: TableStore, oltp: Sources, as_of: datetime, calendar: tuple[date, date]) -> list[LoadStep]:
    """The steps in the order their tables depend on each other."""
    return [
        LoadStep("DimDate", "DimDate", lambda: _load_date(store, as_of, *calendar)),
        LoadStep("DimCustomer", "DimCustomer", lambda: _load_customer(store, oltp, as_of)),
        LoadStep("DimProduct", "DimProduct", lambda: _load_product(store, oltp, as_of)),
        LoadStep("DimEmployee", "DimEmployee", lambda: _load_employee(store, oltp, as_of)),
        LoadStep("DimGeography", "DimGeography", lambda: _load_geography(store, oltp, as_of)),
        LoadStep("FactSales", "FactSales", lambda: _load_sales(store, oltp, as_of)),
        LoadStep("FactInventory", "FactInventorySnapshot", lambda: _load_snapshot(store, oltp, as_of)),
    ]


def log_failure(store: TableStore, procedure: str, error: Exception, as_of: datetime) -> None:
    """Add one row about ``error`` to the error log."""
    log = store.read("ErrorLog")
    row = store.spark.range(1).select(
        (highest(log, "ErrorLogID") + 1).alias("ErrorLogID"),
        concat_blank_null(procedure).alias("ErrorProcedure"),
        F.lit(errors.number_of(error)).cast("int").alias("ErrorNumber"),
        F.substring(F.lit(_reason(error)), 1, 2000).alias("ErrorMessage"))
    row = materialize(with_defaults(row, AUDIT["ErrorLog"], as_of), "error")
    if store.exists("ErrorLog"):
        store.append("ErrorLog", row)
    else:
        store.write("ErrorLog", row, as_of)


def _reason(error: Exception) -> str:
    text = error.getMessage() if isinstance(error, PySparkException) else str(error)
    return f"{type(error).__name__}: {text}"


def run_full_load(store: TableStore, oltp: Sources, as_of: datetime, calendar: tuple[date, date]) -> None:
    """Load all dimensions and facts from ``oltp`` (tables by name).

    Each step is published when it is done, and stays when a later one fails; the failure is logged with the
    name of its step and the number of what went wrong, and raised again. A step whose rows break the contract of
    their table is not published.
    """
    for step in load_steps(store, oltp, as_of, calendar):
        _run(store, step, as_of)


def run_step(store: TableStore, oltp: Sources, as_of: datetime, calendar: tuple[date, date], table: str) -> None:
    """The step of a full load that loads ``table``; what it needs (``NEEDS``) has been loaded before."""
    for step in load_steps(store, oltp, as_of, calendar):
        if step.table == table:
            _run(store, step, as_of)


def _run(store: TableStore, step: LoadStep, as_of: datetime) -> None:
    try:
        with shuffles_removed(store.spark):
            step.run()
    except Exception as error:
        try:
            log_failure(store, f"usp_ETL_RunFullLoad - failed at step: {step.name}", error, as_of)
        except Exception as unlogged:  # the first error is the one to be seen
            error.add_note(f"not logged: {unlogged}")
        raise


def load_returns(store: TableStore, oltp: Sources, refunds: DataFrame | None, as_of: datetime) -> None:
    """Load the return facts from the returns recorded so far."""
    source = facts.returns_source(oltp["Returns"], oltp["OrderDetails"], oltp["Orders"],
                                  store.read("DimCustomer", "current"), store.read("DimProduct"), refunds)
    fact = facts.merge_returns(store.read("FactReturns"), source, oltp["Returns"])
    _write(store, "FactReturns", fact, as_of)


def table_counts(store: TableStore, names: list[str]) -> DataFrame:
    """(TableName, RowCount) of the given tables, from file footers."""
    out = None
    for name in names:
        one = store.read(name).agg(F.count("*").alias("RowCount")).select(F.lit(name).alias("TableName"), "RowCount")
        out = one if out is None else out.unionByName(one)
    return out
