"""The batch jobs for new lines and new places, run on each batch of a stream of new rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.operators.keys import highest, rank_keys
from orderloom.operators.merge import insert_absent
from orderloom.plans.audit import audit_new_lines
from orderloom.sources.tables import TableStore


def audit_lines(store: TableStore, lines: DataFrame, batch: str, as_of: datetime) -> bool:
    """Add an audit row for every line of a batch of new order lines; nothing if ``batch`` is stored already.

    AuditIDs go on from the highest one that the log names for an earlier batch, and the highest of this batch is
    stored with it in the same entry. So a batch that is run again, after it was stored or before, has the same keys.
    """
    top = store.content("OrderAuditLog").top
    start = store.read("OrderAuditLog").agg(F.max("AuditID")).collect()[0][0] or 0 if top is None else top
    span = lines.agg(F.min("OrderDetailID").alias("low"), F.max("OrderDetailID").alias("high")).collect()[0]
    used = 0 if span["low"] is None else span["high"] - span["low"] + 1
    return store.store_batch(batch, as_of, {"OrderAuditLog": audit_new_lines(lines, as_of, start)},
                             top={"OrderAuditLog": start + used})


def audit_line_stream(lines: DataFrame, store: TableStore, checkpoint: str, as_of: datetime,
                      name: str = "line-audit") -> StreamingQuery:
    """Add an audit row for every line of a stream of new order lines to the stored audit log, once each.

    The batches of the stream are stored under ``name`` and their number, so a batch that is run again adds nothing.
    """
    def write(batch: DataFrame, number: int) -> None:
        audit_lines(store, batch, f"{name}-{number}", as_of)

    return (lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def place_stream(addresses: DataFrame, store: TableStore, checkpoint: str, as_of: datetime) -> StreamingQuery:
    """Add the places of a stream of new addresses to DimGeography; known places are left alone, so a batch
    that is run again adds nothing."""
    place = ["City", "State", "Country"]

    def write(batch: DataFrame, number: int) -> None:
        dim = store.read("DimGeography")
        fresh = rank_keys(insert_absent(dim, batch, place), "GeographyKey", place,
                          highest(dim, "GeographyKey"), label="geography")
        if store.exists("DimGeography"):
            store.append("DimGeography", fresh)
        else:
            store.write("DimGeography", fresh, as_of)

    return (addresses.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
