"""Business reports over the five tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import items_total
from ..operators.keyed import first_per_key
from ..operators.running import running_total
from ..specs import INVENTORY, ORDERS
from .common import recent


def avg_temp_per_device(weather: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Average temperature and reading count per device over the last 24 hours."""
    return (
        recent(weather, "recorded_at", "24 hours", as_of)
        .groupBy("device_id")
        .agg(
            # The sum stays exact, so the average does not depend on the order of rows.
            (F.sum("temperature").cast("double") / F.count("temperature")).alias("avg_temp"),
            F.count(F.lit(1)).alias("readings"),
        )
        .orderBy(F.desc("avg_temp"), "device_id")
    )


def revenue_top_customers(
    orders: DataFrame, status: str = "confirmed", n: int = 10, as_of: datetime | None = None
) -> DataFrame:
    """The ``n`` customers with the highest revenue over the last 7 days."""
    return (
        recent(orders, "created_at", "7 days", as_of)
        .where(F.col("order_status") == status)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").alias("revenue"))
        .orderBy(F.desc("revenue"), "customer_id")
        .limit(n)
    )


def shipments_in_transit(shipments: DataFrame) -> DataFrame:
    """Shipments under way, newest update first; expects the latest-state table."""
    return (
        shipments.where(F.col("shipment_status") == "in_transit")
        .orderBy(F.desc("last_update"), "shipment_id")
        .select("shipment_id", "order_id", "current_location", "destination_location")
    )


def running_stock(inventory: DataFrame) -> DataFrame:
    """Stock of each SKU in its warehouse after every change (the sum of all changes so far)."""
    return running_total(
        inventory.drop("current_stock"),
        keys=["item_sku", "warehouse_id"],
        order=[INVENTORY.event_time, INVENTORY.key],
        value="quantity_delta",
        name="current_stock",
    )


def low_stock(stock: DataFrame, below: int = 100) -> DataFrame:
    """Changes that left less than ``below`` units, lowest first."""
    return (
        stock.where(F.col("current_stock") < below)
        .orderBy("current_stock", "item_sku", "warehouse_id", "changed_at", "message_id")
        .select("item_sku", "warehouse_id", "current_stock", "changed_at")
    )


def session_timeline(events: DataFrame, user_id: int, session_id: str) -> DataFrame:
    """What one user did in one session, in order."""
    return (
        events.where((F.col("user_id") == user_id) & (F.col("session_id") == session_id))
        .orderBy("event_timestamp", "message_id")
        .select("event_type", "page_or_resource", "event_timestamp")
    )


def stock_by_sku(inventory: DataFrame) -> DataFrame:
    """Net stock, number of changes and last change per SKU and warehouse."""
    return inventory.groupBy("item_sku", "warehouse_id").agg(
        F.sum("quantity_delta").alias("net_stock"),
        F.count(F.lit(1)).alias("changes"),
        F.max("changed_at").alias("last_change"),
    )


def stock_by_reason(inventory: DataFrame) -> DataFrame:
    """Net quantity and number of changes per reason."""
    return inventory.groupBy("change_reason").agg(
        F.sum("quantity_delta").alias("net_quantity"), F.count(F.lit(1)).alias("changes")
    )


def events_by_user_action(events: DataFrame) -> DataFrame:
    """How often, and from when to when, each user did each kind of thing."""
    return events.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.min("event_timestamp").alias("first_at"),
        F.max("event_timestamp").alias("last_at"),
    )


def events_tumbling(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Events per type in fixed windows; on a stream, set a watermark first."""
    counted = events.groupBy(F.window("event_timestamp", width), "event_type").agg(
        F.count(F.lit(1)).alias("event_count")
    )
    return counted.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "event_type",
        "event_count",
    )


def orders_dedup(orders: DataFrame) -> DataFrame:
    """The first message of each order."""
    return first_per_key(orders, ORDERS.key, [ORDERS.event_time])


def order_total_check(parsed: DataFrame) -> DataFrame:
    """Stated total of each parsed order against the total of its items."""
    total = items_total(F.col("items"))
    return parsed.select(
        "order_id",
        "total_amount",
        total.alias("items_total"),
        (F.round("total_amount", 2) == total).alias("matches"),
    )


def order_items(parsed: DataFrame) -> DataFrame:
    """One row per item of each parsed order; orders without items have none."""
    return parsed.select("order_id", F.posexplode("items").alias("pos", "item")).select(
        "order_id", "pos", "item.*"
    )
