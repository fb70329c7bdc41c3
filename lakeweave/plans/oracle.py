"""DuckDB SQL oracles for the registered queries.

Each entity is rebuilt straight from the test tables with the same
modulo dirt rules as ``sources/testdata.py`` (no JSON round trip), then
the operator semantics are restated in plain SQL: filters, first-arrival
de-duplication with ``row_number``, ``time_bucket`` windows from the
epoch, window-function running sums.  Orders are cut into parts of
``PART_LINES`` lines by the same rule as in ``sources/testdata.py``.
"""

from __future__ import annotations

from ..operators.derive import INITIAL_STOCK, WAREHOUSES
from ..sources import testdata as td
from . import catalog as cat


def _lp(expr: str, n: int) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), {n}, '0')"


def _iso(ts: str) -> str:
    return f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00')"


def _parse(txt: str) -> str:
    return f"TRY_CAST(replace({txt}, '+00:00', '') AS TIMESTAMP)"


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _every(expr: str, n: int) -> str:
    return f"({expr} % {n} = 0)"


DUP, BRK, NUL, NEG, BAD = (td.DUPLICATE_EVERY, td.BROKEN_EVERY, td.NULL_REF_EVERY,
                           td.NEGATE_EVERY, td.BAD_TIME_EVERY)

# field lists in entity-schema order
PAY_FIELDS = ["payment_id", "order_id", "customer_id", "amount", "currency", "payment_method",
              "payment_status", "created_at", "event_type"]
ORD_FIELDS = ["order_id", "customer_id", "order_status", "total_amount", "currency", "created_at",
              "event_type"]
INV_FIELDS = ["inventory_id", "product_id", "product_name", "warehouse_id", "quantity_change",
              "quantity_on_hand", "change_reason", "created_at", "event_type"]
CUS_FIELDS = ["customer_id", "full_name", "email", "phone", "address", "city", "segment",
              "created_at", "updated_at", "event_type"]
TAIL = ['topic', '"partition"', '"offset"', 'kafka_timestamp']


def _bronze(rec: str, key: str, fields: list[str], topic: str, extra: str = "") -> str:
    cols = ",\n    ".join(f"CASE WHEN _broken THEN NULL ELSE f_{f} END AS {f}" for f in fields)
    return f"""SELECT {key} AS kafka_key,
    {cols},
    '{topic}' AS topic, "partition", "offset", kafka_timestamp{extra}
  FROM {rec}"""


# --- entity CTEs ---------------------------------------------------------------
PAY_CTE = f"""pay_src AS (
  SELECT event_id, ts, user_id, event_type, value, 0 AS copy FROM events
  UNION ALL
  SELECT event_id, ts, user_id, event_type, value, 1 AS copy FROM events WHERE {_every('event_id', DUP)}
), pay_rec AS (
  SELECT
    'PAY' || {_lp('event_id', 12)} AS f_payment_id,
    CASE WHEN {_every('event_id', NUL)} THEN NULL ELSE 'ORD' || {_lp('event_id', 12)} END AS f_order_id,
    'CUST' || {_lp('user_id', 5)} AS f_customer_id,
    CASE WHEN {_every('event_id', NEG)} THEN -value ELSE value END AS f_amount,
    'VND' AS f_currency,
    {_list(td.PAYMENT_METHODS)}[event_id % {len(td.PAYMENT_METHODS)} + 1] AS f_payment_method,
    CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'pending' END AS f_payment_status,
    CASE WHEN {_every('event_id', BAD)} THEN 'garbage' ELSE {_iso('ts')} END AS f_created_at,
    'payment_processed' AS f_event_type,
    CAST(event_id % {td.TOPIC_PARTITIONS} AS INTEGER) AS "partition",
    event_id * 2 + copy AS "offset",
    CAST(ts AS TIMESTAMP) AS kafka_timestamp,
    {_every('event_id', BRK)} AS _broken
  FROM pay_src
), bronze_payments AS (
  {_bronze('pay_rec', 'f_order_id', PAY_FIELDS, 'payments')}
)"""

ORD_CTE = f"""ord_lines AS (
  SELECT l.l_orderkey,
    'P' || {_lp('l.l_partkey', 6)} AS product_id,
    p.p_name AS product_name,
    CASE WHEN {_every('l.l_partkey', td.NULL_QUANTITY_EVERY)} THEN NULL ELSE CAST(l.l_quantity AS INTEGER) END AS quantity,
    l.l_extendedprice / l.l_quantity AS unit_price,
    l.l_extendedprice,
    (row_number() OVER (PARTITION BY l.l_orderkey ORDER BY coalesce(l.l_partkey % {td.LINE_RANGES}, 0), l.l_partkey NULLS FIRST,
                        l.l_quantity, l.l_extendedprice) - 1) // {td.PART_LINES} AS part
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
), ord_tot AS (
  SELECT l_orderkey, part, count(*) AS n_items, round(sum(l_extendedprice), 2) AS total
  FROM ord_lines GROUP BY l_orderkey, part
), ord_src AS (
  SELECT o.*, coalesce(t.part, 0) AS part, t.n_items, t.total, 0 AS copy
  FROM orders o LEFT JOIN ord_tot t ON o.o_orderkey = t.l_orderkey
  UNION ALL
  SELECT o.*, coalesce(t.part, 0) AS part, t.n_items, t.total, 1 AS copy
  FROM orders o LEFT JOIN ord_tot t ON o.o_orderkey = t.l_orderkey
  WHERE {_every('o.o_orderkey', DUP)}
), ord_rec AS (
  SELECT
    o_orderkey AS _k, part AS _part,
    'ORD' || {_lp('o_orderkey', 12)} || '-' || CAST(part AS VARCHAR) AS f_order_id,
    CASE WHEN {_every('o_orderkey', NUL)} THEN NULL ELSE 'CUST' || {_lp('o_custkey', 5)} END AS f_customer_id,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'cancelled' WHEN o_orderstatus = 'F' THEN 'shipped'
         WHEN o_orderstatus = 'O' THEN 'created' ELSE 'confirmed' END AS f_order_status,
    CASE WHEN {_every('o_orderkey', NEG)} THEN -1 ELSE 1 END
      * CASE WHEN n_items IS NULL THEN round(o_totalprice, 2) ELSE total END AS f_total_amount,
    'VND' AS f_currency,
    CASE WHEN {_every('o_orderkey', BAD)} THEN 'garbage'
         ELSE {_iso('o_orderdate + to_seconds(o_orderkey % 86400)')} END AS f_created_at,
    'order_created' AS f_event_type,
    CAST(coalesce(n_items, 0) AS INTEGER) AS f_item_count,
    CAST(o_custkey % {td.TOPIC_PARTITIONS} AS INTEGER) AS "partition",
    (o_orderkey * 2 + copy) * {td.MAX_PARTS} + part AS "offset",
    CAST(o_orderdate + to_seconds(o_orderkey % 86400) AS TIMESTAMP) AS kafka_timestamp,
    {_every('o_orderkey', BRK)} AS _broken
  FROM ord_src
), bronze_orders AS (
  {_bronze('ord_rec', 'f_customer_id', ORD_FIELDS + ['item_count'], 'orders', ', _k, _part, _broken')}
)"""

INV_CTE = f"""inv_rec AS (
  SELECT
    'INV' || {_lp('l.l_orderkey', 10)} || {_lp('l.l_linenumber', 2)} AS f_inventory_id,
    CASE WHEN {_every('l.l_orderkey', NUL)} THEN NULL ELSE 'P' || {_lp('l.l_partkey', 6)} END AS f_product_id,
    p.p_name AS f_product_name,
    {_list(WAREHOUSES)}[l.l_suppkey % {len(WAREHOUSES)} + 1] AS f_warehouse_id,
    -CAST(l.l_quantity AS INTEGER) AS f_quantity_change,
    25 - CAST(l.l_quantity AS INTEGER) AS f_quantity_on_hand,
    'sale' AS f_change_reason,
    CASE WHEN {_every('l.l_orderkey', BAD)} THEN 'garbage'
         ELSE {_iso('l.l_shipdate + to_seconds(l.l_orderkey % 86400)')} END AS f_created_at,
    'inventory_updated' AS f_event_type,
    CAST(l.l_partkey % {td.TOPIC_PARTITIONS} AS INTEGER) AS "partition",
    l.l_orderkey * 16 + l.l_linenumber AS "offset",
    CAST(l.l_shipdate + to_seconds(l.l_orderkey % 86400) AS TIMESTAMP) AS kafka_timestamp,
    {_every('l.l_orderkey', BRK)} AS _broken
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
), bronze_inventory AS (
  {_bronze('inv_rec', 'f_product_id', INV_FIELDS, 'inventory')}
)"""

CUS_CTE = f"""cus_rec AS (
  SELECT
    CASE WHEN {_every('event_id', NUL)} THEN NULL ELSE 'CUST' || {_lp('user_id', 5)} END AS f_customer_id,
    'Customer ' || CAST(user_id AS VARCHAR) || ' #' || CAST(event_id AS VARCHAR) AS f_full_name,
    'user' || CAST(user_id AS VARCHAR) || '.' || CAST(event_id AS VARCHAR) || '@example.com' AS f_email,
    '09' || {_lp('event_id % 100000000', 8)} AS f_phone,
    CAST(event_id % 997 AS VARCHAR) || ' Le Loi' AS f_address,
    {_list(td.CITIES)}[event_id % {len(td.CITIES)} + 1] AS f_city,
    {_list(td.SEGMENTS)}[event_id % {len(td.SEGMENTS)} + 1] AS f_segment,
    {_iso('ts')} AS f_created_at,
    CASE WHEN {_every('event_id', BAD)} THEN 'garbage' ELSE {_iso('ts')} END AS f_updated_at,
    CASE WHEN event_type = 'signup' THEN 'customer_created' ELSE 'customer_updated' END AS f_event_type,
    CAST(user_id % {td.TOPIC_PARTITIONS} AS INTEGER) AS "partition",
    event_id AS "offset",
    CAST(ts AS TIMESTAMP) AS kafka_timestamp,
    {_every('event_id', BRK)} AS _broken
  FROM events
), bronze_customers AS (
  {_bronze('cus_rec', 'f_customer_id', CUS_FIELDS, 'customers')}
)"""

PAY_COLS = ["kafka_key"] + PAY_FIELDS + TAIL
ORD_COLS = ["kafka_key"] + ORD_FIELDS[:3] + ["item_count"] + ORD_FIELDS[3:] + TAIL
INV_COLS = ["kafka_key"] + INV_FIELDS + TAIL
CUS_COLS = ["kafka_key"] + CUS_FIELDS + TAIL


def _first_arrival(bronze: str, key: str, where: str, cols: list[str], extra: str = "") -> str:
    tie = ", ".join(f"{c} NULLS FIRST" for c in ['kafka_timestamp', '"partition"', '"offset"'] + cols)
    return f"""SELECT * EXCLUDE (_rn) FROM (
    SELECT {', '.join(cols)}, created_at_ts{extra},
      row_number() OVER (PARTITION BY {key} ORDER BY {tie}) AS _rn
    FROM (SELECT *, {_parse('created_at')} AS created_at_ts FROM {bronze}) t
    WHERE {where}
  ) d WHERE _rn = 1"""


PAY_WHERE = ("payment_id IS NOT NULL AND order_id IS NOT NULL AND amount > 0 "
             "AND created_at_ts IS NOT NULL AND payment_status = 'success'")
ORD_WHERE = "order_id IS NOT NULL AND customer_id IS NOT NULL AND total_amount > 0 AND created_at_ts IS NOT NULL"
INV_WHERE = ("inventory_id IS NOT NULL AND product_id IS NOT NULL AND quantity_on_hand >= 0 "
             "AND created_at_ts IS NOT NULL")

SILVER_PAY = f"silver_payments AS ({_first_arrival('bronze_payments', 'payment_id', PAY_WHERE, PAY_COLS)})"
SILVER_ORD = f"silver_orders AS ({_first_arrival('bronze_orders', 'order_id', ORD_WHERE, ORD_COLS, ', _k, _part')})"
SILVER_INV = f"silver_inventory AS ({_first_arrival('bronze_inventory', 'inventory_id', INV_WHERE, INV_COLS)})"
ORD_ITEMS = """silver_items AS (
  SELECT s.*, l.product_id, l.product_name, l.quantity, l.unit_price,
    row_number() OVER (PARTITION BY s.order_id
                       ORDER BY l.product_id, l.product_name, l.quantity, l.unit_price) - 1 AS item_pos
  FROM silver_orders s JOIN ord_lines l ON s._k = l.l_orderkey AND s._part = l.part
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _sel(cols: list[str]) -> str:
    return ", ".join(cols)


def _bucket(width: str, ts: str = "created_at_ts") -> tuple[str, str]:
    start = f"time_bucket(INTERVAL '{width}', {ts}, TIMESTAMP '1970-01-01')"
    return start, f"{start} + INTERVAL '{width}'"


def _gold_revenue(width: str) -> str:
    s, e = _bucket(width)
    return _with(PAY_CTE, SILVER_PAY) + f"""SELECT {s} AS window_start, {e} AS window_end,
  round(sum(amount), 2) AS total_revenue, CAST(count(*) AS BIGINT) AS transaction_count
FROM silver_payments GROUP BY ALL"""


def _gold_units(width: str) -> str:
    s, e = _bucket(width)
    return _with(ORD_CTE, SILVER_ORD, ORD_ITEMS) + f"""SELECT {s} AS window_start, {e} AS window_end,
  product_id, product_name, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold
FROM silver_items GROUP BY ALL"""


def _gold_activity(width: str) -> str:
    s, e = _bucket(width)
    return _with(ORD_CTE, SILVER_ORD) + f"""SELECT {s} AS window_start, {e} AS window_end, customer_id,
  CAST(count(*) AS BIGINT) AS order_count, round(sum(total_amount), 2) AS total_spent,
  max(created_at_ts) AS last_order_at
FROM silver_orders GROUP BY ALL"""


def _rejects(entity: str, bronze: str, rules: list[tuple[str, str]]) -> str:
    parts = []
    for name, pred in rules:
        parts.append(f"SELECT '{entity}' AS entity, '{name}' AS rule, "
                     f"CAST(count_if(NOT coalesce({pred}, false)) AS BIGINT) AS \"rows\" FROM typed_{entity}")
    allp = " AND ".join(f"({p})" for _, p in rules)
    parts.append(f"SELECT '{entity}' AS entity, 'all_rules' AS rule, "
                 f"CAST(count_if(NOT coalesce({allp}, false)) AS BIGINT) AS \"rows\" FROM typed_{entity}")
    return f"typed_{entity} AS (SELECT *, {_parse('created_at')} AS created_at_ts FROM {bronze})", \
        "\nUNION ALL\n".join(parts)


REJECT_RULES = {
    "orders": [("order_id_present", "order_id IS NOT NULL"), ("customer_id_present", "customer_id IS NOT NULL"),
               ("total_amount_positive", "total_amount > 0"), ("event_time_parsed", "created_at_ts IS NOT NULL")],
    "payments": [("payment_id_present", "payment_id IS NOT NULL"), ("order_id_present", "order_id IS NOT NULL"),
                 ("amount_positive", "amount > 0"), ("event_time_parsed", "created_at_ts IS NOT NULL"),
                 ("payment_status_is_success", "payment_status = 'success'")],
    "inventory": [("inventory_id_present", "inventory_id IS NOT NULL"),
                  ("product_id_present", "product_id IS NOT NULL"),
                  ("quantity_on_hand_non_negative", "quantity_on_hand >= 0"),
                  ("event_time_parsed", "created_at_ts IS NOT NULL")],
}


def _reject_counts() -> str:
    ctes, unions = [PAY_CTE, ORD_CTE, INV_CTE], []
    for entity, bronze in (("orders", "bronze_orders"), ("payments", "bronze_payments"),
                           ("inventory", "bronze_inventory")):
        cte, q = _rejects(entity, bronze, REJECT_RULES[entity])
        ctes.append(cte)
        unions.append(q)
    return _with(*ctes) + "\nUNION ALL\n".join(unions)


def _dedup_latest() -> str:
    rest = INV_COLS[:1] + INV_COLS[2:] + ["created_at_ts"]     # all but the key, df order
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["created_at_ts", '"offset"'] + rest)
    return _with(INV_CTE) + f"""SELECT * EXCLUDE (_rn) FROM (
  SELECT {_sel(INV_COLS)}, created_at_ts,
    row_number() OVER (PARTITION BY inventory_id ORDER BY {order}) AS _rn
  FROM (SELECT *, {_parse('created_at')} AS created_at_ts FROM bronze_inventory) t
  WHERE {INV_WHERE}
) d WHERE _rn = 1"""


def _movements_cte() -> str:
    return f"""movements AS (
  SELECT order_id, CAST(item_pos AS INTEGER) AS item_pos, product_id, product_name,
    {_list(WAREHOUSES)}[item_pos % {len(WAREHOUSES)} + 1] AS warehouse_id,
    -quantity AS quantity_change, 'sale' AS change_reason, created_at, created_at_ts
  FROM silver_items WHERE coalesce(order_status <> 'cancelled', true)
)"""


def _classify() -> str:
    order = f"{_parse('updated_at')} NULLS LAST, \"offset\""
    w = f"OVER (PARTITION BY customer_id ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return _with(CUS_CTE) + f"""SELECT customer_id,
  CASE WHEN _rn = 1 THEN full_name ELSE _fn END AS full_name,
  CASE WHEN _rn = 1 THEN email ELSE _fe END AS email,
  CASE WHEN _rn = 1 THEN phone ELSE _fp END AS phone,
  address, city,
  CASE WHEN _rn = 1 THEN 'new' ELSE segment END AS segment,
  CASE WHEN _rn = 1 THEN created_at ELSE _fc END AS created_at,
  updated_at,
  CASE WHEN _rn = 1 THEN 'customer_created' ELSE 'customer_updated' END AS event_type
FROM (
  SELECT *, row_number() {w} AS _rn,
    first_value(full_name) {w} AS _fn, first_value(email) {w} AS _fe,
    first_value(phone) {w} AS _fp, first_value(created_at) {w} AS _fc
  FROM bronze_customers WHERE customer_id IS NOT NULL
) c"""


HISTORY_CTE = f"""cus_points AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT customer_id, city, segment, _at,
      row_number() OVER (PARTITION BY customer_id, _at ORDER BY "offset" DESC, city DESC NULLS LAST, segment DESC NULLS LAST) AS _rn
    FROM (SELECT *, {_parse('updated_at')} AS _at FROM bronze_customers) t
    WHERE customer_id IS NOT NULL AND _at IS NOT NULL
  ) p WHERE _rn = 1
), cus_marked AS (
  SELECT *, lag(_at) OVER w IS NULL OR lag(city) OVER w IS DISTINCT FROM city OR lag(segment) OVER w IS DISTINCT FROM segment AS _start
  FROM cus_points WINDOW w AS (PARTITION BY customer_id ORDER BY _at)
), customer_history AS (
  SELECT customer_id, city, segment, row_number() OVER v AS version, _at AS valid_from,
    lead(_at) OVER v AS valid_to, lead(_at) OVER v IS NULL AS is_current
  FROM cus_marked WHERE _start WINDOW v AS (PARTITION BY customer_id ORDER BY _at)
)"""


ORDER_TIME = (f"make_timestamp({cat.EVENTS_FROM} + "
              f"CAST(floor((epoch_us(created_at_ts) - {cat.ORDERS_FROM}) / {cat.ORDER_SCALE}) AS BIGINT))")

DIM_CUSTOMER = """dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id, valid_from) AS customer_key, customer_id, valid_from, valid_to, is_current, city, segment
  FROM customer_history
  UNION ALL SELECT 0, NULL, NULL, NULL, NULL, NULL, NULL
)"""
DIM_PRODUCT = """dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, max(product_name) AS product_name
  FROM silver_items WHERE product_id IS NOT NULL GROUP BY product_id
  UNION ALL SELECT 0, NULL, NULL
)"""


def _star_sql() -> dict[str, str]:
    return {
        "dim_customer": _with(CUS_CTE, HISTORY_CTE, DIM_CUSTOMER) + "SELECT * FROM dim_customer",
        "dim_product": _with(ORD_CTE, SILVER_ORD, ORD_ITEMS, DIM_PRODUCT) + "SELECT * FROM dim_product",
        "fact_order_items": _with(ORD_CTE, SILVER_ORD, ORD_ITEMS, DIM_PRODUCT, CUS_CTE, HISTORY_CTE, DIM_CUSTOMER) + f"""
SELECT i.order_id, CAST(i.item_pos AS INTEGER) AS item_pos, coalesce(c.customer_key, 0) AS customer_key,
  coalesce(p.product_key, 0) AS product_key, i.quantity, round(i.quantity * i.unit_price, 2) AS amount
FROM (SELECT *, {ORDER_TIME} AS _at FROM silver_items) i
ASOF LEFT JOIN (SELECT * FROM dim_customer WHERE customer_key > 0) c ON i.customer_id = c.customer_id AND i._at >= c.valid_from
LEFT JOIN dim_product p ON i.product_id = p.product_id""",
    }


def _tests_sql() -> dict[str, str]:
    parts = []
    for entity, key, ref in (("orders", "order_id", "customer_id"), ("payments", "payment_id", "order_id"),
                             ("inventory", "inventory_id", "product_id")):
        for layer, time in (("bronze", "created_at"), ("silver", "created_at_ts")):
            t = f"{layer}_{entity}"
            parts += [f"SELECT '{t}' AS layer, '{c}' AS column_name, 'not_null' AS test, CAST(count(*) - count({c}) AS BIGINT) AS failures, "
                      f"CAST(count(*) AS BIGINT) AS \"rows\" FROM {t}" for c in (key, ref, time)]
            parts.append(f"SELECT '{t}', '{key}', 'unique', CAST(count({key}) - count(DISTINCT {key}) AS BIGINT), CAST(count(*) AS BIGINT) FROM {t}")
    return {
        "layer_tests": _with(PAY_CTE, ORD_CTE, INV_CTE, SILVER_PAY, SILVER_ORD, SILVER_INV) + "\nUNION ALL\n".join(parts),
        "orphan_payments_stream": _with(PAY_CTE, ORD_CTE, SILVER_PAY, SILVER_ORD) + f"""SELECT p.payment_id, p.order_id, p.created_at_ts
FROM silver_payments p, (SELECT least(
    (SELECT max(created_at_ts) FROM silver_payments),
    (SELECT max({ORDER_TIME}) FROM silver_orders WHERE coalesce(order_status <> 'cancelled', true))) - INTERVAL '10 minutes' AS mark) w
WHERE p.created_at_ts + INTERVAL '5 days' < w.mark AND NOT EXISTS (
  SELECT 1 FROM (SELECT *, {ORDER_TIME} AS placed_at FROM silver_orders WHERE coalesce(order_status <> 'cancelled', true)) o
  WHERE split_part(o.order_id, '-', 1) = p.order_id
    AND o.placed_at BETWEEN p.created_at_ts - INTERVAL '5 days' AND p.created_at_ts + INTERVAL '5 days')""",
        "orphan_payments": _with(PAY_CTE, ORD_CTE, SILVER_PAY, SILVER_ORD) + """SELECT payment_id, order_id, amount, created_at_ts
FROM silver_payments p WHERE NOT EXISTS (
  SELECT 1 FROM silver_orders o WHERE split_part(o.order_id, '-', 1) = p.order_id AND coalesce(o.order_status <> 'cancelled', true))""",
    }


def _sessions() -> str:
    order = "PARTITION BY customer_id ORDER BY created_at_ts, order_id"
    return _with(ORD_CTE, SILVER_ORD, f"""marked AS (
  SELECT customer_id, created_at_ts, total_amount, order_id,
    CASE WHEN lag(created_at_ts) OVER w IS NULL OR created_at_ts > lag(created_at_ts) OVER w + INTERVAL '{cat.SESSION_GAP}' THEN 1 ELSE 0 END AS s
  FROM silver_orders WINDOW w AS ({order})
)""", f"""numbered AS (
  SELECT *, CAST(sum(s) OVER ({order} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM marked
)""", """sessions AS (
  SELECT customer_id, session, min(created_at_ts) AS session_start, max(created_at_ts) AS session_end,
    CAST(count(*) AS BIGINT) AS events, round(sum(total_amount), 2) AS spent FROM numbered GROUP BY customer_id, session
)""")


def _as_of(rows: str, at: str, *ctes: str) -> str:
    return _with(*ctes, CUS_CTE, HISTORY_CTE) + f"""SELECT r.*, h.city, h.segment, h.version, h.valid_from
FROM (SELECT {rows}, {at} AS _at FROM _rows) t ASOF LEFT JOIN customer_history h
  ON t.customer_id = h.customer_id AND t._at >= h.valid_from""".replace("r.*", ", ".join(f"t.{c.strip()}" for c in rows.split(",")))


def _bronze_items() -> str:
    return _with(ORD_CTE) + """SELECT b.* EXCLUDE (_k, _part, _broken, item_count),
  l.product_id, l.product_name, l.quantity, l.unit_price
FROM bronze_orders b LEFT JOIN ord_lines l ON b._k = l.l_orderkey AND b._part = l.part AND NOT b._broken"""


def oracle_sql() -> dict[str, str]:
    silver_ord_cols = _sel(ORD_COLS) + ", created_at_ts"
    return {
        "bronze_payments": _with(PAY_CTE) + "SELECT * FROM bronze_payments",
        "bronze_orders": _bronze_items(),
        "bronze_inventory": _with(INV_CTE) + "SELECT * FROM bronze_inventory",
        "bronze_customers": _with(CUS_CTE) + "SELECT * FROM bronze_customers",
        "bronze_corrupt_split": _with(PAY_CTE, ORD_CTE, INV_CTE, CUS_CTE) + "\nUNION ALL\n".join(
            f"SELECT '{t}' AS topic, CAST(count_if(NOT _broken) AS BIGINT) AS good_rows, "
            f"CAST(count_if(_broken) AS BIGINT) AS corrupt_rows FROM {r}"
            for t, r in (("orders", "ord_rec"), ("payments", "pay_rec"),
                         ("inventory", "inv_rec"), ("customers", "cus_rec"))),
        "silver_payments": _with(PAY_CTE, SILVER_PAY) + "SELECT * FROM silver_payments",
        "silver_orders": _with(ORD_CTE, SILVER_ORD) + f"SELECT {silver_ord_cols} FROM silver_orders",
        "silver_inventory": _with(INV_CTE, SILVER_INV) + "SELECT * FROM silver_inventory",
        "silver_reject_counts": _reject_counts(),
        "silver_dedup_latest": _dedup_latest(),
        "gold_revenue_1m": _gold_revenue("1 minute"),
        "gold_revenue_5m": _gold_revenue("5 minutes"),
        "gold_product_units_1m": _gold_units("1 minute"),
        "gold_product_units_1h": _gold_units("1 hour"),
        "gold_customer_activity_1m": _gold_activity("1 minute"),
        "gold_customer_activity_1h": _gold_activity("1 hour"),
        "layer_counts": _with(PAY_CTE, ORD_CTE, INV_CTE, SILVER_PAY, SILVER_ORD, SILVER_INV) + """
SELECT 'orders' AS topic, (SELECT CAST(count(*) AS BIGINT) FROM bronze_orders) AS bronze_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM silver_orders) AS silver_rows
UNION ALL
SELECT 'payments', (SELECT CAST(count(*) AS BIGINT) FROM bronze_payments),
       (SELECT CAST(count(*) AS BIGINT) FROM silver_payments)
UNION ALL
SELECT 'inventory', (SELECT CAST(count(*) AS BIGINT) FROM bronze_inventory),
       (SELECT CAST(count(*) AS BIGINT) FROM silver_inventory)""",
        "order_total_check": _with(ORD_CTE, SILVER_ORD) + """SELECT s.order_id, s.total_amount,
  round(coalesce(sum(l.quantity * l.unit_price), 0.0), 2) AS items_total,
  round(abs(round(coalesce(sum(l.quantity * l.unit_price), 0.0), 2) - s.total_amount), 2) <= 0.01 AS matches
FROM silver_orders s LEFT JOIN ord_lines l ON s._k = l.l_orderkey AND s._part = l.part
GROUP BY s.order_id, s.total_amount""",
        "stock_movements": _with(ORD_CTE, SILVER_ORD, ORD_ITEMS, _movements_cte()) + "SELECT * FROM movements",
        "running_stock": _with(ORD_CTE, SILVER_ORD, ORD_ITEMS, _movements_cte()) + f"""SELECT *,
  CAST(greatest({INITIAL_STOCK} + coalesce(sum(quantity_change) OVER (
    PARTITION BY product_id, warehouse_id ORDER BY created_at_ts, order_id, item_pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0), 0) AS INTEGER) AS quantity_on_hand
FROM movements""",
        "customer_classify": _classify(),
        "payable_orders": _with(ORD_CTE, SILVER_ORD) + """SELECT order_id, customer_id, total_amount AS amount
FROM silver_orders WHERE coalesce(order_status <> 'cancelled', true)""",
        "customer_history": _with(CUS_CTE, HISTORY_CTE) + "SELECT * FROM customer_history",
        "customer_history_merged": _with(CUS_CTE, HISTORY_CTE) + "SELECT * FROM customer_history",
        "orders_asof_customer": _as_of("order_id, customer_id, created_at_ts", ORDER_TIME,
                                       ORD_CTE, SILVER_ORD).replace("_rows", "silver_orders"),
        **_star_sql(),
        **_tests_sql(),
        "top_products_1h": f"""SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY total_quantity_sold DESC NULLS LAST,
    product_id NULLS FIRST, product_name NULLS FIRST) AS INTEGER) AS rank FROM ({_gold_units('1 hour')}) u
) r WHERE rank <= {cat.TOP}""",
        "customer_gaps": _sessions() + f"""SELECT *,
  next_start IS NOT NULL OR session_end + INTERVAL '{cat.SESSION_GAP}' <= (SELECT max(created_at_ts) FROM silver_orders) AS gone
FROM (SELECT *, lead(session_start) OVER (PARTITION BY customer_id ORDER BY session) AS next_start FROM sessions) s""",
        "customer_gaps_stream": _sessions() + f"""SELECT session_start AS window_start, session_end + INTERVAL '{cat.SESSION_GAP}' AS window_end,
  customer_id, events, spent FROM sessions
WHERE session_end + INTERVAL '{cat.SESSION_GAP}' <= (SELECT max(created_at_ts) FROM silver_orders) - INTERVAL '10 minutes'""",
        "payments_asof_customer": _as_of("payment_id, customer_id, created_at_ts", "created_at_ts",
                                         PAY_CTE, SILVER_PAY).replace("_rows", "silver_payments"),
        **_stream_sql(),
    }


def _text(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f') AS {col}"


def _inventory_stream() -> str:
    rest = [c for c in INV_COLS if c not in ("inventory_id", '"offset"')] + ["created_at_ts"]
    agree = {c: f"min({c}) IS NOT DISTINCT FROM max({c}) AND count({c}) IN (0, count(*))" for c in rest}
    return _with(INV_CTE) + f"""SELECT inventory_id, {', '.join(f'CASE WHEN {a} THEN min({c}) END AS {c}' for c, a in agree.items())},
  CAST({' + '.join(f'CAST({a} AS INTEGER)' for a in agree.values())} AS INTEGER) AS settled
FROM (SELECT *, {_parse('created_at')} AS created_at_ts FROM bronze_inventory) t WHERE {INV_WHERE}
GROUP BY inventory_id"""


def _stream_sql() -> dict[str, str]:
    """Streaming queries equal their batch counterparts (through the
    current-state view); append mode keeps only windows whose end the final
    watermark (max event time - 10 minutes) has reached."""
    rev = _gold_revenue("5 minutes")
    return {
        "bronze_payments_stream": _with(PAY_CTE) + "SELECT * FROM bronze_payments",
        "bronze_orders_stream": _bronze_items(),
        "bronze_inventory_stream": _with(INV_CTE) + "SELECT * FROM bronze_inventory",
        "bronze_customers_stream": _with(CUS_CTE) + "SELECT * FROM bronze_customers",
        "silver_dedup_stream": _with(PAY_CTE, SILVER_PAY) + 'SELECT * EXCLUDE ("offset") FROM silver_payments',
        "silver_orders_stream": _with(ORD_CTE, SILVER_ORD) + f"""SELECT * EXCLUDE ("offset")
FROM (SELECT {_sel(ORD_COLS)}, created_at_ts FROM silver_orders) s""",
        # natural duplicates of an inventory id differ in payload, and either may come first in a micro-batch
        "silver_inventory_stream": _inventory_stream(),
        "stamps_payments": _with(PAY_CTE, SILVER_PAY) + """SELECT count(*) AS silver_rows, count(*) AS ingested,
  count(*) AS cleaned, count(*) AS in_order FROM silver_payments""",
        "gold_revenue_stream_late": f"""WITH b AS (SELECT min(kafka_timestamp) AS lo, max(kafka_timestamp) AS hi FROM ({_with(PAY_CTE)} SELECT kafka_timestamp FROM bronze_payments) x),
s AS ({_with(PAY_CTE, SILVER_PAY)} SELECT amount, created_at_ts FROM silver_payments),
on_time AS (SELECT s.* FROM s, b WHERE floor((epoch(created_at_ts) - epoch(lo)) / greatest((epoch(hi) - epoch(lo)) / 3, 1e-6)) >= 1)
SELECT window_start, window_end, round(sum(amount), 2) AS total_revenue, CAST(count(*) AS BIGINT) AS transaction_count
FROM (SELECT amount, {_bucket('5 minutes')[0]} AS window_start, {_bucket('5 minutes')[1]} AS window_end FROM on_time) w
WHERE window_end <= (SELECT max(created_at_ts) FROM on_time) - INTERVAL '10 minutes'
GROUP BY ALL""",
        "gold_revenue_stream_current": rev,
        "gold_revenue_stream_final": f"""SELECT * FROM ({rev}) g
WHERE window_end <= (SELECT max({_parse('created_at')}) FROM ({_with(PAY_CTE, SILVER_PAY)} SELECT created_at FROM silver_payments) m) - INTERVAL '10 minutes'""",
        **dict.fromkeys(("load_revenue", "load_revenue_raw", "load_revenue_table", "load_revenue_incremental"), f"""SELECT {_text('window_start')}, {_text('window_end')}, total_revenue, transaction_count
FROM ({rev}) g"""),
        "load_products": f"""SELECT {_text('window_start')}, {_text('window_end')}, product_id, product_name,
  total_quantity_sold FROM ({_gold_units('1 hour')}) g""",
        "load_activity": f"""SELECT {_text('window_start')}, {_text('window_end')}, customer_id, order_count,
  total_spent, strftime(last_order_at, '%Y-%m-%d %H:%M:%S.%f') AS last_order_at
FROM ({_gold_activity('1 hour')}) g""",
    }
