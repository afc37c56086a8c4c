"""The registered queries as SQL over the given tables.

No message is built or parsed here: each statement goes from the tables straight to
the expected rows.
"""

from __future__ import annotations

# Messages that come in late come in these parts.
PARTS = 3
UUID = "'00000000-0000-4000-8000-' || lpad(CAST({} AS VARCHAR), 12, '0')"
ARRIVAL = "make_timestamp((epoch_us({ts}) // 1000 + {n} % 30 * 1000 + 250) * 1000)"
PAGES = "['home', 'products', 'checkout', 'profile', 'search', 'wishlist']"
PRODUCTS = "['Widget-A', 'Widget-B', 'Gadget-X', 'Tool-Y', 'Accessory-Z']"

# The wire fields of every message, plus n (its number), pos_offset and arrival.
WIRE = {
    "weather": f"""
        SELECT {UUID.format("event_id")} AS message_id,
               'weather-sensor-' || lpad(CAST(user_id % 10 + 1 AS VARCHAR), 2, '0') AS device_id,
               value AS temperature,
               CAST(event_id % 101 AS INTEGER) AS humidity,
               CAST(950 + event_id % 101 AS DOUBLE) AS pressure,
               epoch_us(ts) // 1000 AS "timestamp",
               event_id AS n, event_id // 2 AS pos_offset,
               {ARRIVAL.format(ts="ts", n="event_id")} AS arrival
        FROM events""",
    "user_events": f"""
        SELECT {UUID.format("event_id")} AS message_id,
               CAST(user_id AS INTEGER) AS user_id,
               event_type,
               ({PAGES})[event_id % 6 + 1] AS page,
               'sess-' || CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR)
                   AS session_id,
               json_extract_string(props, '$.k') AS event_value,
               epoch_us(ts) // 1000 AS "timestamp",
               event_id AS n, event_id // 2 AS pos_offset,
               {ARRIVAL.format(ts="ts", n="event_id")} AS arrival
        FROM events""",
    "orders": f"""
        SELECT {UUID.format("o_orderkey")} AS order_id,
               CAST(o_custkey AS INTEGER) AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'pending'
                   ELSE 'confirmed' END AS status,
               CAST(o_orderkey % 11 AS INTEGER) AS item_count,
               CASE WHEN o_orderstatus = 'O' THEN coalesce(item_cents, 0) / 100.0::DOUBLE
                   ELSE o_totalprice END AS total_amount,
               coalesce(item_cents, 0) / 100.0::DOUBLE AS items_total,
               coalesce(unlisted, false) AS unlisted,
               epoch_us(o_orderdate) // 1000 AS "timestamp",
               o_orderkey AS n, o_orderkey // 2 AS pos_offset,
               {ARRIVAL.format(ts="o_orderdate", n="o_orderkey")} AS arrival
        FROM orders LEFT JOIN (
            SELECT o_orderkey AS k, CAST(sum(quantity * cents) AS BIGINT) AS item_cents,
                   bool_or(NOT list_contains({PRODUCTS}, product)) AS unlisted
            FROM items GROUP BY o_orderkey) ON o_orderkey = k""",
    "logistics": f"""
        SELECT {UUID.format("l_orderkey")} AS shipment_id,
               {UUID.format("l_orderkey")} AS order_id,
               CASE l_linestatus WHEN 'O' THEN 'in_transit' ELSE 'delivered' END AS status,
               (40000 + l_partkey % 1000) / 1000.0::DOUBLE AS latitude,
               (-74000 + l_suppkey % 1000) / 1000.0::DOUBLE AS longitude,
               'SUPP-' || CAST(l_suppkey AS VARCHAR) AS origin,
               'LINE-' || CAST(l_linenumber AS VARCHAR) AS destination,
               epoch_us(l_shipdate) // 1000 AS "timestamp",
               l_orderkey AS n, l_orderkey * 8 + l_linenumber AS pos_offset,
               {ARRIVAL.format(ts="l_shipdate", n="l_orderkey")} AS arrival
        FROM lineitem""",
    "inventory": f"""
        SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
                   || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS message_id,
               'SKU-' || CAST(l_partkey AS VARCHAR) AS item_sku,
               'WH' || CAST(l_suppkey % 4 + 1 AS VARCHAR) AS warehouse_id,
               CAST(CASE l_returnflag WHEN 'R' THEN l_quantity ELSE -l_quantity END AS INTEGER)
                   AS quantity_delta,
               CASE l_returnflag WHEN 'R' THEN 'return' ELSE 'sale' END AS change_reason,
               epoch_us(l_shipdate) // 1000 AS "timestamp",
               l_orderkey AS n, l_orderkey * 8 + l_linenumber AS pos_offset,
               {ARRIVAL.format(ts="l_shipdate", n="l_orderkey")} AS arrival
        FROM (SELECT *, md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                  CAST(l_quantity AS DECIMAL(18,2)), CAST(l_extendedprice AS DECIMAL(18,2)),
                  CAST(l_discount AS DECIMAL(18,2)), CAST(l_tax AS DECIMAL(18,2)),
                  l_returnflag, l_linestatus, epoch_us(l_shipdate) // 1000)) AS h FROM lineitem)""",
}

ITEMS = f"""
    SELECT o_orderkey, pos,
           CASE WHEN o_orderkey % 89 = 5 AND pos = 0 THEN 'Lever-Q'
                ELSE ({PRODUCTS})[(o_orderkey + pos + 1) % 5 + 1] END AS product,
           CAST((o_orderkey + pos + 1) % 5 + 1 AS INTEGER) AS quantity,
           1000 + (o_custkey * 37 + o_orderkey + (pos + 1) * 1009) % 9001 AS cents
    FROM (SELECT o_orderkey, o_custkey, unnest(range(o_orderkey % 11)) AS pos FROM orders)"""

TIME = 'make_timestamp("timestamp" * 1000)'

# The columns an ingest job hands to its table.
INGEST = {
    "weather": f"message_id, device_id, temperature, humidity, pressure, {TIME} AS recorded_at",
    "orders": f"""order_id, customer_id, status AS order_status, total_amount, item_count,
                  {TIME} AS created_at, {TIME} AS updated_at""",
    "logistics": f"""shipment_id, order_id, status AS shipment_status,
                     CAST(latitude AS VARCHAR) || ',' || CAST(longitude AS VARCHAR)
                         AS current_location,
                     origin AS origin_location, destination AS destination_location,
                     {TIME} AS last_update""",
    "inventory": f"""message_id, item_sku, warehouse_id, quantity_delta, change_reason,
                     {TIME} AS changed_at""",
    "user_events": f"""message_id, user_id, event_type, page AS page_or_resource, event_value,
                       session_id, {TIME} AS event_timestamp""",
}

# What the table types change.
NARROW = {
    "weather": """* REPLACE (TRY_CAST(temperature AS DECIMAL(5,2)) AS temperature,
                             CAST(humidity AS DECIMAL(5,2)) AS humidity,
                             CAST(pressure AS DECIMAL(7,2)) AS pressure)""",
    "orders": "* REPLACE (TRY_CAST(total_amount AS DECIMAL(10,2)) AS total_amount)",
    "logistics": "*",
    "inventory": "*, 0::INTEGER AS current_stock",
    "user_events": "*",
}

TABLES = {
    "weather": "weather_data",
    "orders": "sales_orders",
    "logistics": "logistics_shipments",
    "inventory": "inventory_changes",
    "user_events": "user_events",
}

KEYS = {
    "weather": "message_id",
    "orders": "order_id",
    "logistics": "shipment_id",
    "inventory": "message_id",
    "user_events": "message_id",
}

# Rules a well-formed message of the test data can break, in the order they are listed.
BROKEN = {
    "weather": ["CASE WHEN temperature NOT BETWEEN -50 AND 60 THEN 'range:temperature' END"],
    "orders": [
        "CASE WHEN customer_id NOT BETWEEN 1 AND 1000 THEN 'range:customer_id' END",
        "CASE WHEN total_amount NOT BETWEEN 10 AND 500 THEN 'range:total_amount' END",
        "CASE WHEN unlisted THEN 'domain:items.product' END",
        "CASE WHEN item_count NOT BETWEEN 1 AND 10 THEN 'check:item_count' END",
        """CASE WHEN CAST(total_amount AS DECIMAL(18,2)) <> CAST(items_total AS DECIMAL(18,2))
            THEN 'check:items_total' END""",
    ],
    "logistics": [],
    "inventory": ["CASE WHEN quantity_delta NOT BETWEEN -50 AND 50 THEN 'range:quantity_delta' END"],
    "user_events": [
        "CASE WHEN user_id NOT BETWEEN 1 AND 10000 THEN 'range:user_id' END",
        """CASE WHEN event_type NOT IN ('click', 'view', 'add_to_cart', 'purchase', 'login',
            'logout') THEN 'domain:event_type' END""",
        "CASE WHEN CAST(event_value AS INTEGER) NOT BETWEEN 1 AND 100 THEN 'check:event_value' END",
        """CASE WHEN n % 97 <> 3 AND abs("timestamp" - epoch_us(TIMESTAMP '2024-01-30') // 1000) > 86400000
            THEN 'stale' END""",
    ],
}


def _errors(kind: str) -> str:
    damage = [
        "CASE WHEN n % 97 = 3 THEN 'type' END",
        f"CASE WHEN n % 97 = 4 THEN 'required:{KEYS[kind]}' END",
        "CASE WHEN n % 97 = 3 THEN 'required:timestamp' END",
    ]
    return f"""CASE WHEN n % 97 <= 2 THEN 'malformed'
               ELSE concat_ws(',', {", ".join(damage + BROKEN[kind])}) END"""


def _with(*names: str) -> str:
    """A WITH clause holding the named relations and what they are made of."""
    kinds = {kind for kind, table in TABLES.items() for n in names if n in (table, f"wire_{kind}")}
    parts = [f"items AS ({ITEMS})"] if "orders" in kinds or "items" in names else []
    for kind in sorted(kinds):
        parts.append(f"wire_{kind} AS ({WIRE[kind]})")
        if TABLES[kind] in names:
            parts.append(
                f"""{TABLES[kind]} AS (SELECT {NARROW[kind]} FROM (
                    SELECT {INGEST[kind]}, arrival AS ingested_at FROM wire_{kind}))"""
            )
    return "WITH " + ", ".join(parts) + " "


def _union_tables(select: str) -> str:
    return " UNION ALL ".join(select.format(table=table) for table in TABLES.values())


def _device_messages() -> str:
    topics = """['devices/weather/data', 'devices/orders/new_order', 'devices/logistics/dispatch',
        'devices/inventory/change', 'devices/users/event', 'devices/weather/status',
        'devices/weather', 'devices/weather/a/b']"""
    return f"""WITH device_messages AS (
        SELECT ({topics})[event_id % 8 + 1] AS topic,
               '{{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type
                   || '"}}' AS payload,
               1::INTEGER AS qos, false AS retain,
               'device-' || CAST(user_id % 10 AS VARCHAR) AS clientid, ts
        FROM events) """


DESTINATION = """CASE split_part(topic, '/', 2) WHEN 'weather' THEN 'iot-weather-data'
    WHEN 'orders' THEN 'iot-orders-events' WHEN 'logistics' THEN 'iot-logistics-dispatch'
    WHEN 'inventory' THEN 'iot-inventory-changes' ELSE 'iot-users-activity' END"""
EXACT = """topic IN ('devices/weather/data', 'devices/orders/new_order',
    'devices/logistics/dispatch', 'devices/inventory/change', 'devices/users/event')"""

LATEST_SHIPMENT = """SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY last_update DESC, order_id DESC,
        shipment_status DESC, current_location DESC, origin_location DESC,
        destination_location DESC, ingested_at DESC) AS place
    FROM logistics_shipments) WHERE place = 1"""

# On a stream, equal times are decided by the position of the message.
LATEST_ARRIVED = """SELECT * EXCLUDE (place, pos_offset, n) FROM (
    SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY last_update DESC,
        pos_offset DESC, n % 2 DESC, order_id DESC, shipment_status DESC, current_location DESC,
        origin_location DESC, destination_location DESC) AS place
    FROM (SELECT {columns}, arrival AS ingested_at, pos_offset, n FROM wire_logistics))
    WHERE place = 1""".format(columns=INGEST["logistics"])

def _come_in(kind: str) -> str:
    """A WITH clause whose last relation holds the messages with the part they come in and
    its mark: a day before the newest message of all earlier parts, none in the first."""
    return _with(f"wire_{kind}") + f""", placed AS (
        SELECT w.*, least({PARTS} * ("timestamp" - first + CASE WHEN n % 7 = 1 THEN 259200000
            WHEN n % 5 = 0 THEN 72000000 ELSE 0 END) // (last - first + 1), {PARTS - 1}) AS part
        FROM wire_{kind} w, (
            SELECT min("timestamp") AS first, max("timestamp") AS last FROM wire_{kind})),
        newest AS (SELECT part, max("timestamp") AS newest FROM placed GROUP BY part),
        come_in AS (SELECT p.*, (SELECT max(newest) FROM newest n WHERE n.part < p.part)
            - 86400000 AS mark FROM placed p)
    """


RUNNING_STOCK = """SELECT * EXCLUDE (current_stock), CAST(sum(quantity_delta) OVER (
        PARTITION BY item_sku, warehouse_id ORDER BY changed_at, message_id
        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS current_stock
    FROM inventory_changes"""


def _described(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count({column}) AS n,
        CAST(sum({column}) AS DOUBLE) / count({column}) AS mean,
        round(stddev_samp({column}), 6) AS stddev, CAST(min({column}) AS DOUBLE) AS min,
        CAST(max({column}) AS DOUBLE) AS max FROM weather_data"""


def _filled(column: str, lost: str) -> str:
    return f"""SELECT '{column}' AS column_name, f AS non_null, t AS total_rows,
        CAST(f AS DOUBLE) / t AS ratio, CAST(f AS DOUBLE) / t >= 0.96 AS passes
        FROM (SELECT count(*) FILTER (WHERE event_id % 97 NOT IN ({lost})) AS f, count(*) AS t
              FROM events)"""


def _violation(kind: str, rule: str, condition: str) -> str:
    return f"""SELECT '{kind}' AS dataset, '{rule}' AS rule,
        count(*) FILTER (WHERE {condition}) AS violations FROM wire_{kind}"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    for kind, table in TABLES.items():
        key = KEYS[kind]
        spoilt = f"{_errors(kind)}"
        sql[f"ingest_{kind}"] = (
            _with(f"wire_{kind}")
            + f"SELECT {INGEST[kind]}, arrival AS ingested_at FROM wire_{kind}"
        )
        sql[f"conform_{kind}"] = _with(table) + f"SELECT * FROM {table}"
        sql[f"quarantine_{kind}"] = (
            _with(f"wire_{kind}")
            + f"""SELECT * FROM (SELECT CAST(n % 2 AS INTEGER) AS source_partition,
                  pos_offset AS source_offset, {spoilt} AS errors FROM wire_{kind})
                  WHERE errors <> ''"""
        )
        sql[f"valid_{kind}"] = (
            _with(f"wire_{kind}")
            + f"""SELECT {NARROW[kind]} FROM (SELECT {INGEST[kind]}, arrival AS ingested_at
                  FROM wire_{kind} WHERE {spoilt} = '')"""
        )

    hidden = "EXCLUDE (n, pos_offset, arrival)"
    for kind in ("weather", "inventory", "user_events", "logistics"):
        sql[f"parse_{kind}"] = _with(f"wire_{kind}") + f"SELECT * {hidden} FROM wire_{kind}"
    sql["parse_orders"] = _with("wire_orders") + """
        SELECT order_id, customer_id, status, coalesce(item_text, '') AS items, total_amount,
               "timestamp"
        FROM wire_orders LEFT JOIN (
            SELECT o_orderkey, string_agg(product || ':' || CAST(quantity AS VARCHAR) || ':'
                || CAST(CAST(cents / 100.0::DOUBLE AS DECIMAL(10,2)) AS VARCHAR), ';'
                ORDER BY pos) AS item_text
            FROM items GROUP BY o_orderkey) ON o_orderkey = n"""

    sql["read_messages_limit"] = """
        SELECT CAST(event_id % 2 AS INTEGER) AS "partition", event_id // 2 AS "offset",
               '{"message_id":"00000000-0000-4000-8000-' || lpad(CAST(event_id AS VARCHAR), 12, '0')
               || '","device_id":"weather-sensor-' || lpad(CAST(user_id % 10 + 1 AS VARCHAR), 2, '0')
               || '","temperature":' || CAST(value AS VARCHAR)
               || ',"humidity":' || CAST(event_id % 101 AS VARCHAR)
               || ',"pressure":' || CAST(CAST(950 + event_id % 101 AS DOUBLE) AS VARCHAR)
               || ',"timestamp":' || CAST(epoch_us(ts) // 1000 AS VARCHAR) || '}' AS value
        FROM events ORDER BY 2, 1 LIMIT 20"""
    sql["route_exact"] = _device_messages() + f"""
        SELECT {DESTINATION} AS destination, topic, payload, qos, retain
        FROM device_messages WHERE {EXACT}"""
    sql["route_wildcard"] = _device_messages() + f"""
        SELECT {DESTINATION} AS destination, topic, payload, qos, retain
        FROM device_messages WHERE {EXACT} OR topic = 'devices/weather/status'"""
    sql["route_envelope"] = _device_messages() + f"""
        SELECT {DESTINATION} AS topic, clientid AS key, payload AS value, ts AS "timestamp",
               'clientid=' || clientid || ',topic=' || topic || ',qos=1' AS headers
        FROM device_messages WHERE {EXACT}"""

    sql["route_by_table"] = """
        WITH messages AS (
            SELECT event_id, user_id, event_type, event_id % 10 = 0 AS deep,
                   'devices/' || user_id || '/' || event_type
                       || CASE WHEN event_id % 10 = 0 THEN '/raw' ELSE '' END AS topic
            FROM events)
        SELECT topic, event_id, 'user-' || user_id AS destination
        FROM messages WHERE NOT deep AND user_id % 3 = 0
        UNION ALL SELECT topic, event_id, 'buyer-' || user_id
        FROM messages WHERE NOT deep AND user_id % 5 = 0 AND event_type = 'purchase'
        UNION ALL SELECT topic, event_id, 'type-' || event_type FROM messages WHERE NOT deep
        UNION ALL SELECT topic, event_id, 'raw' FROM messages WHERE deep"""
    sql["epoch_ms_to_ts"] = """
        SELECT '00000000-0000-4000-8000-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS message_id,
               epoch_us(ts) // 1000 AS "timestamp", date_trunc('millisecond', ts) AS recorded_at
        FROM events"""
    sql["order_item_count"] = _with("wire_orders") + "SELECT order_id, item_count FROM wire_orders"
    sql["order_total_check"] = _with("wire_orders") + """
        SELECT order_id, total_amount, items_total,
               CAST(total_amount AS DECIMAL(18,2)) = CAST(items_total AS DECIMAL(18,2)) AS matches
        FROM wire_orders"""
    sql["order_items_exploded"] = _with("items") + f"""
        SELECT {UUID.format("o_orderkey")} AS order_id, CAST(pos AS INTEGER) AS pos, product,
               quantity, cents / 100.0::DOUBLE AS price
        FROM items"""
    sql["location_text"] = _with("wire_logistics") + """
        SELECT shipment_id, CAST(latitude AS VARCHAR) || ',' || CAST(longitude AS VARCHAR) AS location
        FROM wire_logistics"""
    sql["filter_startswith"] = _with("weather_data") + """
        SELECT * FROM weather_data WHERE device_id LIKE 'weather-sensor-0%'"""
    sql["describe_numeric"] = _with("weather_data") + " UNION ALL ".join(
        _described(column) for column in ("temperature", "humidity", "pressure")
    )

    sql["avg_temp_per_device"] = _with("weather_data") + """
        SELECT device_id, CAST(sum(temperature) AS DOUBLE) / count(temperature) AS avg_temp,
               count(*) AS readings
        FROM weather_data
        WHERE recorded_at > (SELECT max(recorded_at) FROM weather_data) - INTERVAL 24 HOUR
        GROUP BY device_id ORDER BY avg_temp DESC, device_id"""
    sql["revenue_top_customers"] = _with("sales_orders") + """
        SELECT customer_id, count(*) AS order_count,
               CAST(sum(total_amount) AS DECIMAL(20,2)) AS revenue
        FROM sales_orders
        WHERE created_at > (SELECT max(created_at) FROM sales_orders) - INTERVAL 7 DAY
          AND order_status = 'confirmed'
        GROUP BY customer_id ORDER BY revenue DESC, customer_id LIMIT 10"""
    sql["shipments_in_transit"] = _with("logistics_shipments") + f"""
        SELECT shipment_id, order_id, current_location, destination_location
        FROM ({LATEST_SHIPMENT}) WHERE shipment_status = 'in_transit'
        ORDER BY last_update DESC, shipment_id"""
    sql["running_stock"] = _with("inventory_changes") + RUNNING_STOCK
    sql["low_stock"] = _with("inventory_changes") + f"""
        SELECT item_sku, warehouse_id, current_stock, changed_at FROM ({RUNNING_STOCK})
        WHERE current_stock < 100
        ORDER BY current_stock, item_sku, warehouse_id, changed_at, message_id"""
    sql["session_timeline"] = _with("user_events") + """
        SELECT event_type, page_or_resource, event_timestamp FROM user_events
        WHERE user_id = 8 AND session_id = 'sess-8-2024-01-01'
        ORDER BY event_timestamp, message_id"""
    sql["stock_by_sku"] = _with("inventory_changes") + """
        SELECT item_sku, warehouse_id, CAST(sum(quantity_delta) AS BIGINT) AS net_stock,
               count(*) AS changes, max(changed_at) AS last_change
        FROM inventory_changes GROUP BY item_sku, warehouse_id"""
    sql["stock_by_reason"] = _with("inventory_changes") + """
        SELECT change_reason, CAST(sum(quantity_delta) AS BIGINT) AS net_quantity,
               count(*) AS changes
        FROM inventory_changes GROUP BY change_reason"""
    sql["events_by_user_action"] = _with("user_events") + """
        SELECT user_id, event_type, count(*) AS event_count, min(event_timestamp) AS first_at,
               max(event_timestamp) AS last_at
        FROM user_events GROUP BY user_id, event_type"""
    sql["events_tumbling"] = _with("user_events") + """
        SELECT CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS window_start,
               CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) + INTERVAL 1 HOUR
                   AS window_end,
               event_type, count(*) AS event_count
        FROM user_events GROUP BY 1, 2, 3"""

    hours = "CAST(date_trunc('hour', recorded_at) AS TIMESTAMP) AS hour"
    sql["hourly_counts"] = _with("weather_data") + f"""
        SELECT {hours}, count(*) AS message_count FROM weather_data
        GROUP BY 1 ORDER BY 1 DESC LIMIT 24"""
    sql["volume_trend"] = _with("weather_data") + f"""
        SELECT {hours}, count(*) AS row_count FROM weather_data
        WHERE recorded_at > (SELECT max(recorded_at) FROM weather_data) - INTERVAL 24 HOUR
        GROUP BY 1 ORDER BY 1 DESC"""
    sql["processing_lag"] = _with("weather_data") + """
        SELECT avg(lag) AS avg_lag_seconds, max(lag) AS max_lag_seconds
        FROM (SELECT (epoch_us(ingested_at) - epoch_us(recorded_at)) / 1e6::DOUBLE AS lag
              FROM weather_data)"""
    sql["data_freshness"] = _with(*TABLES.values()) + f""", newest AS (
        {_union_tables("SELECT '{table}' AS table_name, max(ingested_at) AS latest_data FROM {table}")})
        SELECT table_name, latest_data,
               (epoch_us(TIMESTAMP '2030-01-01') - epoch_us(latest_data))
                   / 1e6::DOUBLE AS lag_seconds
        FROM newest"""
    sql["table_counts_row"] = _with(*TABLES.values()) + "SELECT " + ", ".join(
        f"(SELECT count(*) FROM {table}) AS {table}" for table in TABLES.values()
    )
    sql["table_counts_long"] = _with(*TABLES.values()) + _union_tables(
        "SELECT 'iot' AS schema_name, '{table}' AS table_name, count(*) AS row_count FROM {table}"
    ) + " ORDER BY table_name"
    sql["latest_rows"] = _with("weather_data") + """
        SELECT * FROM weather_data ORDER BY ingested_at DESC, message_id DESC LIMIT 5"""
    sql["max_ingested"] = _with("weather_data") + """
        SELECT max(ingested_at) AS max_ingested_at FROM weather_data"""
    sql["count_rows"] = "SELECT count(*) AS row_count FROM events"
    # The same results, whether columns or footers are read.
    sql["footer_freshness"] = sql["data_freshness"]
    sql["footer_table_counts"] = sql["table_counts_long"]
    sql["footer_max_ingested"] = sql["max_ingested"]
    sql["offsets_by_partition"] = """
        SELECT 'iot-weather-data' AS topic, CAST(event_id % 2 AS INTEGER) AS "partition",
               min(event_id // 2) AS first_offset, max(event_id // 2) + 1 AS next_offset,
               max(event_id // 2) + 1 - min(event_id // 2) AS message_count
        FROM events GROUP BY 1, 2"""

    lost = {"message_id": "0, 1, 2, 4", "timestamp": "0, 1, 2, 3"}
    sql["non_null_ratio"] = " UNION ALL ".join(
        _filled(column, lost.get(column, "0, 1, 2"))
        for column in ("message_id", "device_id", "temperature", "humidity", "pressure", "timestamp")
    )
    sql["range_violations"] = _with(*[f"wire_{kind}" for kind in TABLES]) + " UNION ALL ".join([
        _violation("weather", "range:temperature", "temperature NOT BETWEEN -50 AND 60"),
        _violation("weather", "range:humidity", "humidity NOT BETWEEN 0 AND 100"),
        _violation("weather", "range:pressure", "pressure NOT BETWEEN 950 AND 1050"),
        _violation("orders", "range:customer_id", "customer_id NOT BETWEEN 1 AND 1000"),
        _violation("orders", "range:total_amount", "total_amount NOT BETWEEN 10 AND 500"),
        _violation("logistics", "range:current_location.latitude", "latitude NOT BETWEEN 40 AND 41"),
        _violation(
            "logistics", "range:current_location.longitude", "longitude NOT BETWEEN -74 AND -73"
        ),
        _violation("inventory", "range:quantity_delta", "quantity_delta NOT BETWEEN -50 AND 50"),
        _violation("user_events", "range:user_id", "user_id NOT BETWEEN 1 AND 10000"),
    ])
    sql["domain_violations"] = _with(*[f"wire_{kind}" for kind in TABLES]) + " UNION ALL ".join([
        _violation("orders", "domain:status",
                   "status NOT IN ('pending', 'confirmed', 'shipped', 'delivered', 'cancelled')"),
        _violation("orders", "domain:items.product", "unlisted"),
        _violation("logistics", "domain:status",
                   "status NOT IN ('pending', 'in_transit', 'delivered')"),
        _violation("inventory", "domain:warehouse_id",
                   "warehouse_id NOT IN ('WH1', 'WH2', 'WH3', 'WH4')"),
        _violation("inventory", "domain:change_reason", """change_reason NOT IN
                   ('purchase', 'sale', 'adjustment', 'return', 'restock')"""),
        _violation("user_events", "domain:event_type", """event_type NOT IN
                   ('click', 'view', 'add_to_cart', 'purchase', 'login', 'logout')"""),
        _violation("user_events", "domain:page", """page NOT IN
                   ('home', 'products', 'checkout', 'profile', 'search', 'wishlist')"""),
    ])
    sql["stale_messages"] = _with("wire_user_events") + """
        SELECT message_id, "timestamp" FROM wire_user_events
        WHERE abs("timestamp" - epoch_us(TIMESTAMP '2024-01-30') // 1000) > 86400000"""

    sql["orders_dedup"] = _with("sales_orders") + "SELECT * FROM sales_orders"
    sql["insert_if_absent"] = _with("sales_orders") + """
        SELECT * REPLACE (CASE WHEN order_status = 'delivered' THEN ingested_at
                          ELSE ingested_at + INTERVAL 1 DAY END AS ingested_at)
        FROM sales_orders"""
    sql["latest_per_shipment"] = _with("logistics_shipments") + LATEST_SHIPMENT
    sql["update_latest"] = _with("logistics_shipments") + LATEST_SHIPMENT
    sql["user_events_dedup"] = _with("user_events") + "SELECT * FROM user_events"

    sql["export_restore"] = sql["conform_orders"]
    sql["ingest_new_kind"] = f"""
        SELECT {UUID.format("event_id")} AS message_id,
               'machine-0' || CAST(user_id % 5 + 1 AS VARCHAR) AS machine_id,
               CAST(value AS DECIMAL(5,2)) AS cpu_usage,
               CAST(event_id % 103 AS DECIMAL(5,2)) AS memory_usage,
               CAST(event_id % 1001 AS INTEGER) AS disk_io,
               date_trunc('millisecond', ts) AS recorded_at
        FROM events WHERE value BETWEEN 0 AND 100 AND event_id % 103 <= 100"""
    sql["ingest_open_fields"] = _with("wire_weather") + f"""
        SELECT CASE WHEN n % 97 <> 4 THEN message_id END AS message_id, device_id,
               TRY_CAST(temperature AS DECIMAL(5,2)) AS temperature, {TIME} AS recorded_at,
               CASE n % 97 WHEN 4 THEN '{{"other":"' || message_id || '"}}'
                   WHEN 5 THEN '{{"extra":1}}' END AS extra_fields,
               CASE WHEN n % 97 = 5 THEN 1 END AS extra
        FROM wire_weather WHERE n % 97 > 2"""
    sql["stream_progress"] = """
        SELECT 'weather' AS query, count(*) AS input_rows, CAST(0 AS BIGINT) AS latest_batch
        FROM events"""
    valid_weather = f"""SELECT {NARROW["weather"]} FROM (SELECT {INGEST["weather"]}
        FROM wire_weather WHERE {_errors("weather")} = '')"""
    sql["stream_insert_if_absent"] = _with("wire_weather") + valid_weather
    sql["stream_insert_bucketed"] = sql["stream_insert_if_absent"]
    sql["stream_insert_filtered"] = sql["stream_insert_if_absent"]
    sql["stream_update_latest"] = _with("logistics_shipments") + (
        f"SELECT * EXCLUDE (ingested_at) FROM ({LATEST_ARRIVED})"
    )
    sql["stream_quarantine"] = sql["quarantine_weather"]
    sql["stream_stats"] = _with("wire_weather") + f"""
        SELECT 'weather.' || name AS metric_name, CAST(n AS BIGINT) AS metric_value FROM (
            SELECT 'read' AS name, count(*) AS n FROM wire_weather UNION ALL
            SELECT 'valid', count(*) FROM wire_weather WHERE {_errors("weather")} = '' UNION ALL
            SELECT 'rejected', count(*) FROM wire_weather WHERE {_errors("weather")} <> '')"""
    sql["stream_events_tumbling"] = f"""SELECT * FROM ({sql["events_tumbling"]})
        WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM events)
            - INTERVAL 24 HOUR"""
    sql["stream_open_windows"] = f"""SELECT * FROM ({sql["events_tumbling"]})
        WHERE window_end > (SELECT date_trunc('millisecond', max(ts)) FROM events)
            - INTERVAL 24 HOUR"""
    sql["stream_dedup"] = sql["user_events_dedup"]
    sql["stream_running_stock"] = _come_in("inventory") + f"""
        SELECT * EXCLUDE ("timestamp") FROM (
            SELECT {INGEST["inventory"]}, "timestamp",
                   CAST(sum(quantity_delta) OVER (PARTITION BY item_sku, warehouse_id
                       ORDER BY "timestamp", message_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
                       AS current_stock
            FROM come_in WHERE mark IS NULL OR "timestamp" > mark)
        WHERE "timestamp" <= (SELECT max("timestamp") FROM come_in) - 86400000"""
    sql["stream_late_events"] = _come_in("user_events") + f"""
        SELECT {INGEST["user_events"]}, arrival AS ingested_at, CAST(part AS INTEGER) AS batch_id
        FROM come_in WHERE "timestamp" <= mark"""
    sql["stream_stock_by_sku"] = sql["stock_by_sku"]
    sql["stream_events_by_user_action"] = sql["events_by_user_action"]
    sql["stream_hourly_counts"] = _with("weather_data") + """
        SELECT CAST(date_trunc('hour', recorded_at) AS TIMESTAMP) AS hour,
               count(*) AS message_count
        FROM weather_data GROUP BY 1"""
    sql["stream_progress_log"] = _come_in("weather") + f"""
        SELECT 'weather' AS query, CAST(part AS BIGINT) AS batch_id, count(*) AS input_rows,
               count(*) AS read, count(*) FILTER ({_errors("weather")} = '') AS valid,
               count(*) FILTER ({_errors("weather")} <> '') AS rejected
        FROM come_in GROUP BY part"""
    return sql
