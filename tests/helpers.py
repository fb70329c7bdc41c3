"""Small builders for hand-made test rows."""
from __future__ import annotations

import datetime as dt
import json

from lakeweave.schemas import ENVELOPE

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def envelope(spark, topic, values, keys=None, start_offset=0):
    """values: list of str (raw JSON text) or dict (dumped)."""
    rows = []
    for i, v in enumerate(values):
        text = v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
        key = (keys[i] if keys else None)
        rows.append((key.encode() if key else None, text.encode("utf-8"), topic, 0,
                     start_offset + i, T0 + dt.timedelta(seconds=i)))
    return spark.createDataFrame(rows, ENVELOPE)


def payment(pid="PAY1", oid="ORD1", amount=10.0, status="success", created_at="2024-01-01T00:00:07+00:00",
            **extra):
    d = {"payment_id": pid, "order_id": oid, "customer_id": "CUST00001", "amount": amount,
         "currency": "VND", "payment_method": "cod", "payment_status": status,
         "created_at": created_at, "event_type": "payment_processed"}
    d.update(extra)
    return d


def order(oid="ORD1", cid="CUST00001", total=100.0, status="created", items=None,
          created_at="2024-01-01T00:00:07+00:00"):
    return {"order_id": oid, "customer_id": cid, "order_status": status,
            "items": items if items is not None else [
                {"product_id": "P001", "product_name": "Áo thun", "quantity": 2, "unit_price": 25},
                {"product_id": "P002", "product_name": "Bolt", "quantity": 1, "unit_price": 50}],
            "total_amount": total, "currency": "VND", "created_at": created_at,
            "event_type": "order_created"}


def inventory(iid="INV1", pid="P001", on_hand=5, created_at="2024-01-01T00:00:07+00:00"):
    return {"inventory_id": iid, "product_id": pid, "product_name": "Áo thun", "warehouse_id": "WH_HN",
            "quantity_change": -1, "quantity_on_hand": on_hand, "change_reason": "sale",
            "created_at": created_at, "event_type": "inventory_updated"}
