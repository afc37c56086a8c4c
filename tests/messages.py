"""Hand-written messages with every defect the validation has to catch."""

import json
import uuid

# Fixed value: a product of the contract.
PRODUCT = "Widget-A"

ORDER = {
    "order_id": str(uuid.UUID(int=7_001)),
    "customer_id": 88,
    "status": "confirmed",
    "items": [{"product": PRODUCT, "quantity": 4, "price": 12.25}],
    "total_amount": 49.0,
    "timestamp": 1_715_940_000_000,
}
WEATHER = {
    "message_id": str(uuid.UUID(int=7_002)),
    "device_id": "roof-probe-7",
    "temperature": -3.25,
    "humidity": 41,
    "pressure": 987.5,
    "timestamp": 1_715_940_060_000,
}
SHIPMENT = {
    "shipment_id": str(uuid.UUID(int=7_003)),
    "order_id": ORDER["order_id"],
    "status": "in_transit",
    "current_location": {"latitude": 40.25, "longitude": -73.75},
    "origin": "Depot 3",
    "destination": "Dock 12",
    "timestamp": 1_715_943_600_000,
}


def text(message, drop=(), **changes):
    merged = {k: v for k, v in {**message, **changes}.items() if k not in drop}
    return json.dumps(merged)


def item(**changes):
    return [{**ORDER["items"][0], **changes}]


# (kind, message text, the errors it must get)
EDGE_CASES = [
    ("orders", text(ORDER), []),
    ("orders", "not json", ["malformed"]),
    ("orders", None, ["malformed"]),
    ("orders", "", ["malformed"]),
    ("orders", "[1]", ["malformed"]),
    ("orders", text(ORDER)[:-1], ["malformed"]),
    ("orders", text(ORDER, customer_id=1.5), ["type", "required:customer_id"]),
    ("orders", text(ORDER, customer_id=99999999999), ["type", "required:customer_id"]),
    ("orders", text(ORDER, timestamp="1715940000000"), ["type", "required:timestamp"]),
    ("orders", text(ORDER, items=item(quantity="q")), ["type", "check:item_quantity"]),
    ("orders", text(ORDER, items=None), ["required:items"]),
    ("orders", text(ORDER, drop=["items"]), ["required:items"]),
    ("orders", text(ORDER, items=[]), ["check:item_count", "check:items_total"]),
    ("orders", text(ORDER, items=item(quantity=6), total_amount=73.5), ["check:item_quantity"]),
    ("orders", text(ORDER, items=item(price=9.5), total_amount=38.0), ["check:item_price"]),
    ("orders", text(ORDER, items=item(product="Lever-Q")), ["domain:items.product"]),
    ("orders", text(ORDER, items=item(product=None)), ["domain:items.product"]),
    ("orders", text(ORDER, items=item() + item(product="Tool-Y"), total_amount=98.0), []),
    ("orders", text(ORDER, total_amount=49.01), ["check:items_total"]),
    ("orders", text(ORDER, items=item(price=99.99, quantity=5) + item(), total_amount=548.95),
     ["range:total_amount"]),
    ("orders", text(ORDER, items=[{"product": PRODUCT, "price": 12.25}]), ["check:item_quantity"]),
    ("orders", text(ORDER, extra="ignored"), []),
    ("orders", text(ORDER, status="lost"), ["domain:status"]),
    ("orders", text(ORDER, customer_id=1001), ["range:customer_id"]),
    ("orders", text(ORDER, total_amount=123456789.0),
     ["range:total_amount", "check:items_total", "fit:total_amount"]),
    ("weather", text(WEATHER), []),
    ("weather", text(WEATHER, humidity=65.0), ["type", "required:humidity"]),
    ("weather", text(WEATHER, drop=["message_id"]), ["required:message_id"]),
    ("weather", text(WEATHER, temperature=12345.6), ["range:temperature", "fit:temperature"]),
    ("weather", text(WEATHER, temperature=float("nan")), ["range:temperature", "fit:temperature"]),
    ("weather", text(WEATHER, device_id="d" * 51), ["length:device_id"]),
    ("weather", text(WEATHER, timestamp=9223372036854775807), ["fit:recorded_at", "stale"]),
    ("weather", text(WEATHER, timestamp=-9223372036854775808), ["fit:recorded_at", "stale"]),
    ("weather", text(WEATHER, timestamp=WEATHER["timestamp"] + 86_400_000), []),
    ("weather", text(WEATHER, timestamp=WEATHER["timestamp"] + 86_400_001), ["stale"]),
    ("weather", text(WEATHER, timestamp=WEATHER["timestamp"] - 86_400_001), ["stale"]),
    ("logistics", text(SHIPMENT), []),
    (
        "logistics",
        text(SHIPMENT, current_location={"latitude": 40.25}),
        ["required:current_location.longitude"],
    ),
    (
        "logistics",
        text(SHIPMENT, current_location={"latitude": 40.25, "longitude": -74.5}),
        ["range:current_location.longitude"],
    ),
    (
        "logistics",
        text(SHIPMENT, shipment_id=SHIPMENT["shipment_id"][:-1] + "x"),
        ["uuid:shipment_id"],
    ),
    (
        "logistics",
        text(SHIPMENT, shipment_id=SHIPMENT["shipment_id"] + "\n"),
        ["uuid:shipment_id"],
    ),
    ("logistics", text(SHIPMENT, timestamp=None), ["required:timestamp"]),
]
