from __future__ import annotations

from datetime import datetime
from decimal import Decimal


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def money(text: str) -> Decimal:
    return Decimal(text)


def as_set(df, *columns):
    return {tuple(row) for row in df.select(*(columns or df.columns)).collect()}


def metric_map(df):
    return {(str(row.metric_date), row.metric_name, row.dimension_key): row.metric_value for row in df.collect()}


PAYMENT = "id bigint, order_id bigint, user_id bigint, payment_amount decimal(16,2), payment_status string, create_time timestamp_ntz"
LINE = "id bigint, order_id bigint, sku_id bigint, order_price decimal(16,2), sku_num bigint, create_time timestamp_ntz"
REFUND = "id bigint, order_id bigint, sku_id bigint, refund_amount decimal(16,2), refund_status string, create_time timestamp_ntz"
EVENT = "event_id string, uid bigint, action_id string, event_time_ms bigint, biz_date string"


def payment(id, order, user, amount, status="SUCCESS", time="2026-09-01 10:00:00"):
    return (id, order, user, money(amount), status, at(time))
