"""One declarative record per kind of message; everything else is generic.

A :class:`DatasetSpec` says how a message looks on the wire, which columns it
lands in, which of them identifies the row, and which values are acceptable.
Parsing, validation, sinks and streams are all driven by it, so a new kind needs
a record and no code.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


class TableColumn(NamedTuple):
    """A landed column: its name, the SQL expression over wire fields, its table type.

    ``max_length`` bounds text columns; ``uuid`` marks identifiers.
    """

    name: str
    expression: str
    type: str
    max_length: int | None = None
    uuid: bool = False


@dataclass(frozen=True)
class DatasetSpec:
    """Everything the library knows about one kind of message."""

    name: str
    topic: str
    table: str
    wire_schema: StructType
    columns: tuple[TableColumn, ...]
    key: str
    event_time: str
    policy: str = "ignore"  # "ignore": first row per key stays; "update": latest row wins
    device_topic: str | None = None
    must_have: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    domains: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    checks: Mapping[str, str] = field(default_factory=dict)
    defaults: tuple[TableColumn, ...] = ()  # table columns that no message carries

    def __post_init__(self) -> None:
        if self.policy not in ("ignore", "update"):
            raise ValueError(f"{self.name}: unknown policy {self.policy!r}")
        names = self.column_names
        for needed in (self.key, self.event_time, *self.must_have):
            if needed not in names:
                raise ValueError(f"{self.name}: {needed!r} is not a landed column")

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def device_filter(self) -> str | None:
        """The topic filter covering every attribute of this kind of device."""
        if self.device_topic is None:
            return None
        return self.device_topic.rsplit("/", 1)[0] + "/+"


def wire(**fields: DataType) -> StructType:
    """A wire schema; every field may be missing from a message."""
    return StructType([StructField(name, type_, True) for name, type_ in fields.items()])


# Epoch milliseconds outside the years 1..9999 have no timestamp; they become NULL
# (and are then reported as a missing event time) instead of failing the batch.
EVENT_TIME = (
    "CASE WHEN timestamp BETWEEN -62135596800000 AND 253402300799999 "
    "THEN CAST(timestamp_millis(timestamp) AS TIMESTAMP_NTZ) END"
)

_STRING, _INT, _LONG, _DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()

# Topics, field names, table columns, ranges and value lists below are
# part of the data contract and must be exactly these.

PRODUCTS = ("Widget-A", "Widget-B", "Gadget-X", "Tool-Y", "Accessory-Z")
PAGES = ("home", "products", "checkout", "profile", "search", "wishlist")

WEATHER = DatasetSpec(
    name="weather",
    topic="iot-weather-data",
    device_topic="devices/weather/data",
    table="weather_data",
    wire_schema=wire(
        message_id=_STRING, device_id=_STRING, temperature=_DOUBLE,
        humidity=_INT, pressure=_DOUBLE, timestamp=_LONG,
    ),
    columns=(
        TableColumn("message_id", "message_id", "string", uuid=True),
        TableColumn("device_id", "device_id", "string", max_length=50),
        TableColumn("temperature", "temperature", "decimal(5,2)"),
        TableColumn("humidity", "humidity", "decimal(5,2)"),
        TableColumn("pressure", "pressure", "decimal(7,2)"),
        TableColumn("recorded_at", EVENT_TIME, "timestamp_ntz"),
    ),
    key="message_id",
    event_time="recorded_at",
    must_have=("message_id", "device_id", "temperature", "humidity", "pressure"),
    required=("message_id", "device_id", "temperature", "humidity", "pressure", "timestamp"),
    ranges={"temperature": (-50, 60), "humidity": (0, 100), "pressure": (950, 1050)},
)

ORDERS = DatasetSpec(
    name="orders",
    topic="iot-orders-events",
    device_topic="devices/orders/new_order",
    table="sales_orders",
    wire_schema=wire(
        order_id=_STRING, customer_id=_INT, status=_STRING,
        items=ArrayType(wire(product=_STRING, quantity=_INT, price=_DOUBLE)),
        total_amount=_DOUBLE, timestamp=_LONG,
    ),
    columns=(
        TableColumn("order_id", "order_id", "string", uuid=True),
        TableColumn("customer_id", "customer_id", "int"),
        TableColumn("order_status", "status", "string", max_length=20),
        TableColumn("total_amount", "total_amount", "decimal(10,2)"),
        # A missing list counts as -1 whatever the session's ANSI setting.
        TableColumn("item_count", "coalesce(size(items), -1)", "int"),
        TableColumn("created_at", EVENT_TIME, "timestamp_ntz"),
        TableColumn("updated_at", EVENT_TIME, "timestamp_ntz"),
    ),
    key="order_id",
    event_time="created_at",
    must_have=("order_id", "customer_id", "order_status", "total_amount"),
    required=("order_id", "customer_id", "status", "items", "total_amount", "timestamp"),
    ranges={"customer_id": (1, 1000), "total_amount": (10, 500)},
    domains={
        "status": ("pending", "confirmed", "shipped", "delivered", "cancelled"),
        "items.product": PRODUCTS,
    },
    checks={
        "item_count": "items IS NULL OR size(items) BETWEEN 1 AND 10",
        "item_quantity": "items IS NULL OR forall(items, i -> i.quantity BETWEEN 1 AND 5)",
        "item_price": "items IS NULL OR forall(items, i -> i.price BETWEEN 10.0D AND 100.0D)",
        # A total that cannot be computed breaks the rule of what it lacks instead.
        "items_total": (
            "coalesce(round(total_amount, 2) = "
            "round(aggregate(items, 0.0D, (sum, i) -> sum + i.quantity * i.price), 2), true)"
        ),
    },
)

LOGISTICS = DatasetSpec(
    name="logistics",
    topic="iot-logistics-dispatch",
    device_topic="devices/logistics/dispatch",
    table="logistics_shipments",
    wire_schema=wire(
        shipment_id=_STRING, order_id=_STRING, status=_STRING,
        current_location=wire(latitude=_DOUBLE, longitude=_DOUBLE),
        origin=_STRING, destination=_STRING, timestamp=_LONG,
    ),
    columns=(
        TableColumn("shipment_id", "shipment_id", "string", uuid=True),
        TableColumn("order_id", "order_id", "string", uuid=True),
        TableColumn("shipment_status", "status", "string", max_length=20),
        TableColumn(
            "current_location",
            "concat_ws(',', current_location.latitude, current_location.longitude)",
            "string",
        ),
        TableColumn("origin_location", "origin", "string", max_length=100),
        TableColumn("destination_location", "destination", "string", max_length=100),
        TableColumn("last_update", EVENT_TIME, "timestamp_ntz"),
    ),
    key="shipment_id",
    event_time="last_update",
    policy="update",
    must_have=("shipment_id", "order_id", "shipment_status"),
    required=(
        "shipment_id", "order_id", "status", "current_location.latitude",
        "current_location.longitude", "origin", "destination", "timestamp",
    ),
    ranges={"current_location.latitude": (40, 41), "current_location.longitude": (-74, -73)},
    domains={"status": ("pending", "in_transit", "delivered")},
)

INVENTORY = DatasetSpec(
    name="inventory",
    topic="iot-inventory-changes",
    device_topic="devices/inventory/change",
    table="inventory_changes",
    wire_schema=wire(
        message_id=_STRING, item_sku=_STRING, warehouse_id=_STRING,
        quantity_delta=_INT, change_reason=_STRING, timestamp=_LONG,
    ),
    columns=(
        TableColumn("message_id", "message_id", "string", uuid=True),
        TableColumn("item_sku", "item_sku", "string", max_length=50),
        TableColumn("warehouse_id", "warehouse_id", "string", max_length=50),
        TableColumn("quantity_delta", "quantity_delta", "int"),
        TableColumn("change_reason", "change_reason", "string", max_length=100),
        TableColumn("changed_at", EVENT_TIME, "timestamp_ntz"),
    ),
    key="message_id",
    event_time="changed_at",
    must_have=("message_id", "item_sku", "warehouse_id", "quantity_delta"),
    required=(
        "message_id", "item_sku", "warehouse_id", "quantity_delta", "change_reason", "timestamp",
    ),
    ranges={"quantity_delta": (-50, 50)},
    domains={
        "warehouse_id": ("WH1", "WH2", "WH3", "WH4"),
        "change_reason": ("purchase", "sale", "adjustment", "return", "restock"),
    },
    defaults=(TableColumn("current_stock", "0", "int"),),
)

USER_EVENTS = DatasetSpec(
    name="user_events",
    topic="iot-users-activity",
    device_topic="devices/users/event",
    table="user_events",
    wire_schema=wire(
        message_id=_STRING, user_id=_INT, event_type=_STRING, page=_STRING,
        session_id=_STRING, event_value=_STRING, timestamp=_LONG,
    ),
    columns=(
        TableColumn("message_id", "message_id", "string", uuid=True),
        TableColumn("user_id", "user_id", "int"),
        TableColumn("event_type", "event_type", "string", max_length=50),
        TableColumn("page_or_resource", "page", "string", max_length=200),
        TableColumn("event_value", "event_value", "string", max_length=500),
        TableColumn("session_id", "session_id", "string", max_length=100),
        TableColumn("event_timestamp", EVENT_TIME, "timestamp_ntz"),
    ),
    key="message_id",
    event_time="event_timestamp",
    must_have=("message_id", "user_id", "event_type", "session_id"),
    required=(
        "message_id", "user_id", "event_type", "page", "session_id", "event_value", "timestamp",
    ),
    ranges={"user_id": (1, 10000)},
    domains={
        "event_type": ("click", "view", "add_to_cart", "purchase", "login", "logout"),
        "page": PAGES,
    },
    checks={"event_value": "event_value IS NULL OR try_cast(event_value AS INT) BETWEEN 1 AND 100"},
)

_SPECS: dict[str, DatasetSpec] = {}


def register(spec: DatasetSpec) -> DatasetSpec:
    """Make ``spec`` known by name."""
    _SPECS[spec.name] = spec
    return spec


def get_spec(name: str) -> DatasetSpec:
    if name not in _SPECS:
        raise KeyError(f"no dataset named {name!r}; known: {sorted(_SPECS)}")
    return _SPECS[name]


def all_specs() -> list[DatasetSpec]:
    return list(_SPECS.values())


for _spec in (WEATHER, ORDERS, LOGISTICS, INVENTORY, USER_EVENTS):
    register(_spec)
