import random
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from shop import make, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderloom.model import OLTP, STAR, TABLES
from orderloom.operators import checks, prefix, skew
from orderloom.operators.columns import with_days_to_refund, with_defaults
from orderloom.operators.keys import highest, offset_keys, rank_keys
from orderloom.operators.merge import insert_absent, merge_upsert, update_from
from orderloom.operators.sampling import sample_rows
from orderloom.operators.scd2 import scd2_merge


# Upserts.

def test_merge_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 3, "c")], "k INT, id INT, v STRING")
    source = spark.createDataFrame([(9, 2, "B"), (9, 4, "D")], "k INT, id INT, v STRING")
    out = merge_upsert(target, source, ["id"], ["v"])
    assert rows(out) == [(1, 1, "a"), (2, 2, "B"), (3, 3, "c"), (9, 4, "D")]


def test_merge_condition_decides_over_all_columns(spark):
    schema = "id INT, price INT, name STRING"
    target = spark.createDataFrame([(1, 10, "a"), (2, 10, "b")], schema)
    source = spark.createDataFrame([(1, 10, "A"), (2, 11, "B")], schema)
    out = merge_upsert(target, source, ["id"], ["price", "name"], "t.price <> s.price")
    assert rows(out) == [(1, 10, "a"), (2, 11, "B")]


def test_merge_refuses_double_source_rows(spark):
    target = spark.createDataFrame([(1, "a")], "id INT, v STRING")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "id INT, v STRING")
    with pytest.raises(PySparkException, match="more than one row"):
        merge_upsert(target, source, ["id"], ["v"]).collect()


def test_merge_on_two_keys_and_into_empty(spark):
    schema = "d INT, p INT, q INT"
    empty = spark.createDataFrame([], schema)
    first = merge_upsert(empty, spark.createDataFrame([(1, 1, 5), (1, 2, 6)], schema), ["d", "p"], ["q"])
    again = merge_upsert(first, spark.createDataFrame([(1, 1, 7), (2, 1, 8)], schema), ["d", "p"], ["q"])
    assert rows(again) == [(1, 1, 7), (1, 2, 6), (2, 1, 8)]


def test_insert_absent_takes_each_new_key_once(spark):
    target = spark.createDataFrame([("a", "x")], "c STRING, s STRING")
    source = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "x")], "c STRING, s STRING")
    assert rows(insert_absent(target, source, ["c", "s"])) == [("b", "x")]


def test_update_from_leaves_rows_without_match(spark):
    target = spark.createDataFrame([(1, 0), (2, 0)], "id INT, total INT")
    values = spark.createDataFrame([(1, 5), (3, 9)], "id INT, total INT")
    assert rows(update_from(target, values, ["id"], {"total": F.col("v.total")})) == [(1, 5), (2, 0)]


# Versioned dimension.

def _dim(spark, *values):
    return spark.createDataFrame(list(values), STAR["DimCustomer"].schema)


def _source(spark, *values):
    return spark.createDataFrame(
        list(values), "CustomerID BIGINT, FullName STRING, Email STRING, CustomerSegment STRING, SignupDate DATE")


def _load(dim, source, day):
    return scd2_merge(dim, source, "CustomerID", "CustomerKey", ["CustomerSegment"], day)


def test_scd2_history(spark):
    signup, day1, day2 = date(2023, 1, 1), date(2024, 1, 1), date(2024, 1, 2)
    first = _load(_dim(spark), _source(spark, (1, "A", "a", "Standard", signup), (2, "B", "b", "VIP", signup)), day1)
    assert rows(first) == [(1, 1, "A", "a", "Standard", signup, day1, None, True),
                           (2, 2, "B", "b", "VIP", signup, day1, None, True)]
    # 1 changes segment; 2 changes only name and mail; 3 is new.
    source = _source(spark, (1, "A", "a", "VIP", signup), (2, "BB", "bb", "VIP", signup),
                     (3, "C", "c", "Standard", signup))
    second = _load(first, source, day2)
    assert rows(second) == [
        (1, 1, "A", "a", "Standard", signup, day1, day2, False),
        (2, 2, "B", "b", "VIP", signup, day1, None, True),
        (3, 1, "A", "a", "VIP", signup, day2, None, True),
        (5, 3, "C", "c", "Standard", signup, day2, None, True)]
    assert rows(_load(second, source, day2)) == rows(second)


def test_scd2_keeps_customers_the_source_lost_and_versions_twice_a_day(spark):
    signup, day = date(2023, 1, 1), date(2024, 1, 1)
    first = _load(_dim(spark), _source(spark, (1, "A", "a", "Standard", signup), (2, "B", "b", "VIP", signup)), day)
    second = _load(first, _source(spark, (1, "A", "a", "VIP", signup)), day)
    assert [(r["CustomerID"], r["EffectiveDate"], r["ExpiryDate"], r["IsCurrent"])
            for r in second.orderBy("CustomerKey").collect()] == [
        (1, day, day, False), (2, day, None, True), (1, day, None, True)]


# Keys.

def test_rank_keys_are_dense_in_order(spark):
    # One leading value fills two thirds of the rows.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("a"), "id")
    keyed = rank_keys(df, "k", ["a", "id"], 100)
    expected = sorted((r["a"], r["id"]) for r in df.collect())
    got = keyed.orderBy("k").collect()
    assert [r["k"] for r in got] == list(range(101, 3101))
    assert [(r["a"], r["id"]) for r in got] == expected


def test_rank_keys_of_nothing(spark):
    assert rank_keys(spark.range(0), "k", ["id"]).count() == 0


def test_offset_keys_follow_the_last_one(spark):
    used = spark.createDataFrame([(41,)], "k BIGINT")
    df = spark.createDataFrame([(10,), (13,)], "id BIGINT")
    assert rows(offset_keys(df, "k", "id", highest(used, "k"))) == [(10, 42), (13, 45)]
    assert rows(offset_keys(df, "k", "id", highest(used.where("k < 0"), "k"))) == [(10, 1), (13, 4)]


# Skewed joins.

@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_by_salt_equals_plain_join(spark, monkeypatch, how):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 8)
    # A third of the rows has key 1, a third has no key.
    many = spark.range(30000).select(
        "id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    one = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).where("k % 7 <> 0")
    got = skew.lookup_join(many, one, ["k"], ["id"], how)
    plain = many.join(one, ["k"], how)
    assert got.columns == plain.columns
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    spread = (skew.lookup_join(many, one, ["k"], ["id"]).where("k = 1")
              .groupBy(F.spark_partition_id()).count().count())
    assert spread > 1


def test_hot_keys_are_found_and_few(spark):
    df = spark.range(100000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    hot = [tuple(r) for r in skew.hot_keys(df, ["k"]).collect()]
    assert hot == [(spark.range(1).select(F.xxhash64(F.lit(-1).cast("long"))).collect()[0][0], 3)]


def test_no_task_of_a_lookup_join_gets_far_more_rows_than_others(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    n = F.col("id")
    many = spark.range(1000000).select("id", F.when(n % 3 == 0, 1).when(n % 250 == 1, 2).otherwise(n).alias("k"))
    one = spark.range(1000000).select(n.alias("k"))
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        parts = skew.lookup_join(many, one, ["k"], ["id"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in parts) == 1000000
    assert max(r["count"] for r in parts) <= 4 * 1000000 / 64


def test_broadcast_check_counts_rows(spark):
    assert skew.fits_broadcast(spark.range(100), 800)
    assert not skew.fits_broadcast(spark.range(101), 800)
    assert skew.fits_broadcast(spark.range(0), 0)


# Contracts.

def test_every_contract_names_its_own_columns():
    for name, table in TABLES.items():
        columns = {f.name for f in table.schema.fields}
        used = set(table.key) | set(table.domains) | set(table.ranges) | set(table.lengths) | set(table.defaults)
        used |= {c for u in table.unique for c in u} | {c for fk in table.foreign for c in fk.columns}
        assert used <= columns, name
        for fk in table.foreign:
            parent = {f.name for f in TABLES[fk.parent].schema.fields}
            assert set(fk.parent_columns) <= parent, name


def test_single_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, -1), (2, "zz", None)], "id INT, s STRING, n INT")
    assert rows(checks.check_not_null(df, "s", ["id"])) == [("s not null", "2", "s not null")]
    assert rows(checks.check_domain(df, "s", ["a"], ["id"])) == [("s domain", "2", "s domain")]
    assert rows(checks.check_range(df, "n", "n BETWEEN 0 AND 5", ["id"])) == [("n range", "2", "n range")]
    assert rows(checks.check_length(df, "s", 1, ["id"])) == [("s length", "2", "s length")]
    assert rows(checks.check_unique(df, ["id"])) == [("id unique", "2", "2 rows")]


def test_unique_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",)], "s STRING")
    assert checks.check_unique(df, ["s"]).count() == 1


def test_foreign_key_check_passes_nulls(spark):
    child = spark.createDataFrame([(1,), (None,), (9,), (9,)], "f INT")
    parent = spark.createDataFrame([(1,)], "id INT")
    assert rows(checks.check_foreign_key(child, ["f"], parent, ["id"])) == [("f foreign key", "9", "2 rows")]


def test_self_reference_and_row_rules_of_a_table(spark):
    staff = make(spark, "Employees", (1, "A", "A", None, "T", date(2020, 1, 1), "N"),
                 (2, "B", "B", 1, "T", date(2020, 1, 1), "N"), (3, "C" * 61, "C", 8, "T", date(2020, 1, 1), "N"))
    found = checks.table_violations("Employees", OLTP["Employees"], staff, {"Employees": staff})
    assert [(r["rule"], r["key"]) for r in found.orderBy("rule").collect()] == [
        ("Employees.FirstName length", "3"), ("Employees.ManagerID references Employees", "8")]


def test_split_valid_parts_a_batch(spark, shop):
    lines = spark.createDataFrame(
        [(1, 1, 10, 1, Decimal("1.00"), Decimal("0.00")), (2, 1, 99, 0, Decimal("1.00"), Decimal("2.00")),
         (3, 77, 10, 1, Decimal("1.00"), Decimal("0.00"))],
        "OrderDetailID BIGINT, OrderID BIGINT, ProductID BIGINT, Quantity INT, UnitPrice DECIMAL(10,2), "
        "Discount DECIMAL(4,2)")
    good, bad = checks.split_valid("OrderDetails", OLTP["OrderDetails"], lines, shop)
    assert [r["OrderDetailID"] for r in good.collect()] == [1]
    assert {r["OrderDetailID"]: sorted(r["broken_rules"]) for r in bad.collect()} == {
        2: ["OrderDetails.Discount range", "OrderDetails.ProductID references Products",
            "OrderDetails.Quantity range"],
        3: ["OrderDetails.OrderID references Orders"]}


def test_defaults_fill_left_out_columns_only(spark):
    sent = spark.createDataFrame([(1, "A", "B", "a@x", None)],
                                 "CustomerID BIGINT, FirstName STRING, LastName STRING, Email STRING, "
                                 "CustomerSegment STRING")
    row = with_defaults(sent, OLTP["Customers"], datetime(2024, 5, 6, 7)).collect()[0]
    assert row["CustomerSegment"] is None  # given as NULL
    assert row["SignupDate"] == date(2024, 5, 6) and row["IsActive"] is True and row["Phone"] is None


def test_days_to_refund(spark):
    df = spark.createDataFrame([(20240301, 20240305), (20240301, 0), (20240301, None)],
                               "ReturnDateKey INT, RefundDateKey INT")
    assert [r["DaysToRefund"] for r in with_days_to_refund(df).collect()] == [4, None, None]


def test_sample_is_repeatable_and_exact_in_size(spark):
    df = spark.range(1000)
    first, again = sample_rows(df, 50, "id", "s"), sample_rows(df.repartition(5), 50, "id", "s")
    assert rows(first) == rows(again) and first.distinct().count() == 50
    assert rows(sample_rows(df, 50, "id", "t")) != rows(first)


@pytest.mark.parametrize("span, fan", [(100_000, 1000), (3, 2), (10, 3), (1, 2)])
def test_crossings_equal_brute_force(spark, monkeypatch, span, fan):
    """Several bounds per key, a hot key, rows that add nothing, positions below zero, bounds nobody passes."""
    if span < 100:
        monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    draw = random.Random(span)
    held = {"hot": sorted(draw.sample(range(-500, 2000), 600)), "few": [5, 9, 70], "one": [-3], "none": []}
    values = {(k, at): draw.randrange(4) for k, places in held.items() for at in places}
    bounds = [(k, b) for k in (*held, "unknown") for b in (0, 1, 2, 5, 50, 400, 10_000)]
    expected = []
    for key, bound in bounds:
        total = 0
        for at in held.get(key, []):
            total += values[key, at]
            if total > bound:
                expected.append((key, bound, at, total - values[key, at]))
                break
    rows_of = spark.createDataFrame([(k, at, v) for (k, at), v in values.items()], "name string, place long, v int")
    asked = spark.createDataFrame(bounds, "name string, bound long")
    found = prefix.crossings(rows_of.repartition(5), ["name"], "place", F.col("v"), asked, span, fan)
    assert found.columns == ["name", "bound", "at", "before"]
    assert rows(found) == sorted(expected, key=repr)


def test_crossings_shuffle_the_rows_once(spark, monkeypatch):
    """Where the keys are too many to be sent around, rows and bounds meet in one exchange."""
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    rows_of = spark.range(40).select((F.col("id") % 4).alias("k"), "id", F.lit(2).alias("v"))
    found = prefix.crossings(rows_of, ["k"], "id", F.col("v"), spark.createDataFrame([(1, 3)], "k long, bound long"))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(k#\d+L, _unit#", text)) == 1
    assert rows(found) == [(1, 3, 5, 2)]


def test_crossings_pass_by_large_keys_without_a_bound(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    rows_of = spark.range(60).select(F.when(F.col("id") % 2 == 0, 1).when(F.col("id") < 40, 2).alias("k"), "id",
                                     F.lit(1).alias("v"))
    bounds = spark.createDataFrame([(1, 100), (2, 7), (2, 8), (None, 1)], "k int, bound long")
    found = prefix.crossings(rows_of, ["k"], "id", F.col("v"), bounds, 4, 3)
    assert rows(found) == [(2, 7, 15, 7), (2, 8, 17, 8)]


@pytest.mark.parametrize("size", [0, 64 << 20])
def test_known_keys_are_marked_as_by_a_left_join(spark, monkeypatch, size):
    """Unknown keys, no key, and a key that comes twice."""
    monkeypatch.setattr(skew, "BROADCAST_BYTES", size)
    many = spark.createDataFrame([(i, k) for i, k in enumerate([1, 2, 2, 3, None, 9])], "seq long, k long")
    one = spark.createDataFrame([(1,), (2,), (2,), (4,), (None,)], "k long")
    joined = many.join(one.withColumn("known", F.lit(True)), "k", "left").select("seq", "k", "known")
    assert rows(skew.with_known(many, one, "k", ["seq"], "known").select("seq", "k", "known")) == rows(joined)
