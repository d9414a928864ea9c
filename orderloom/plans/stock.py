"""Stock jobs: restocking, and guarded updates of the inventory."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, functions as F

from orderloom.functions.errors import NEGATIVE_STOCK, NOTHING_TO_RESTOCK
from orderloom.operators.merge import require_unique, update_from


def replenish(inventory: DataFrame, products: DataFrame, as_of: date, top_up: int = 100,
              restocked: Observation | None = None) -> DataFrame:
    """Inventory after adding ``top_up`` pieces of every product that is short and still sold.

    Short means strictly below the reorder level. ``restocked`` counts the changed rows while they are
    written; see ``restock_notice``.
    """
    sold = products.where(~F.col("Discontinued")).select("ProductID", "ReorderLevel")
    joined = inventory.join(sold, "ProductID", "left")
    low = F.coalesce(F.col("QuantityOnHand") < F.col("ReorderLevel"), F.lit(False))
    out = joined.select(
        "ProductID",
        F.when(low, F.col("QuantityOnHand") + top_up).otherwise(F.col("QuantityOnHand")).cast("int")
        .alias("QuantityOnHand"),
        "WarehouseLocation",
        F.when(low, F.lit(as_of).cast("date")).otherwise(F.col("LastRestockDate")).alias("LastRestockDate"),
        low.alias("_low"))
    if restocked is not None:
        out = out.observe(restocked, F.count_if("_low").alias("rows"))
    return out.drop("_low")


def restock_notice(restocked: Observation) -> str | None:
    """The notice for a run that changed nothing. Waits for the job that ``restocked`` watches."""
    return None if restocked.get["rows"] else NOTHING_TO_RESTOCK


def _sound() -> Column:
    return F.coalesce(F.col("QuantityOnHand") >= 0, F.lit(False))


def apply_inventory_update(inventory: DataFrame, updates: DataFrame) -> DataFrame:
    """Inventory after a batch of replacement rows; unchanged if any of them has negative or unknown stock.

    Updates for unknown products have no effect.
    """
    accepted = ~updates.where(~_sound()).select(F.lit(1)).exists()
    batch = require_unique(updates, ["ProductID"], "inventory update").where(accepted)
    columns = ("QuantityOnHand", "WarehouseLocation", "LastRestockDate")
    return update_from(inventory, batch, ["ProductID"], {c: F.col(f"v.{c}") for c in columns})


def update_verdict(updates: DataFrame) -> DataFrame:
    """One row about a batch: its size, how many of its rows go negative or have no number, and the error if any."""
    return updates.agg(
        F.count("*").alias("BatchRows"),
        F.count_if(~_sound()).alias("NegativeRows")).select(
        "BatchRows", "NegativeRows",
        F.when(F.col("NegativeRows") > 0, F.lit(NEGATIVE_STOCK)).alias("ErrorMessage"))
