from datetime import datetime

from shop import rows

from orderloom.plans.audit import audit_new_lines
from orderloom.session import scratch_path
from orderloom.sources.tables import TableStore
from orderloom.streaming.batches import audit_line_stream, audit_lines, place_stream

NOW = datetime(2024, 6, 1)


def test_line_stream_audits_each_line_once(spark, shop):
    source, mark = scratch_path(spark, "lines"), scratch_path(spark, "mark")
    store = TableStore(spark, scratch_path(spark, "audit"))
    lines = shop["OrderDetails"]
    for part in ("OrderDetailID <= 2", "OrderDetailID > 2"):
        lines.where(part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(lines.schema).parquet(source)
        audit_line_stream(stream, store, mark, NOW).awaitTermination()
    assert rows(store.read("OrderAuditLog")) == rows(audit_new_lines(lines, NOW))


def test_a_batch_of_lines_that_is_run_again_keeps_its_keys(spark, shop):
    """Run again after it was stored, a batch adds nothing; run again after it died before, it has the same keys."""
    store = TableStore(spark, scratch_path(spark, "audit"))
    lines = shop["OrderDetails"]
    assert audit_lines(store, lines.where("OrderDetailID IN (1, 3)"), "lines-0", NOW)
    first = rows(store.read("OrderAuditLog"))
    assert [r[0] for r in first] == [1, 3]
    assert not audit_lines(store, lines.where("OrderDetailID IN (1, 3)"), "lines-0", NOW)
    assert rows(store.read("OrderAuditLog")) == first
    # The rows of the next batch are written, but its entry is not.
    store.stage("OrderAuditLog", audit_new_lines(lines.where("OrderDetailID >= 4"), NOW, 77))
    again = TableStore(spark, store.root)
    assert rows(again.read("OrderAuditLog")) == first
    assert audit_lines(again, lines.where("OrderDetailID >= 4"), "lines-1", NOW)
    assert [r[0] for r in rows(store.read("OrderAuditLog"))] == [1, 3]  # a reader keeps what it has seen
    assert [r[0] for r in rows(TableStore(spark, store.root).read("OrderAuditLog"))] == [1, 3, 4, 5]
    assert not audit_lines(store, lines.where("OrderDetailID >= 4"), "lines-1", NOW)
    assert audit_lines(again, lines.where("false"), "lines-2", NOW)
    assert again.read("OrderAuditLog").count() == 4


def test_place_stream_adds_new_places_only(spark, shop):
    source, mark = scratch_path(spark, "addresses"), scratch_path(spark, "mark")
    store = TableStore(spark, scratch_path(spark, "star"))
    addresses = shop["ShippingAddresses"]
    for part in ("AddressID = 1", "AddressID >= 2"):
        addresses.where(part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(addresses.schema).parquet(source)
        place_stream(stream, store, mark, NOW).awaitTermination()
    assert rows(store.read("DimGeography")) == [(1, "Pune", "MH", "India"), (2, "Delhi", "DL", "India")]
