"""Declared schemas and keys of every table."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "decimal(16,2)"
METRIC = "decimal(18,2)"
RATE = "decimal(16,4)"


# Short type names for the table declarations below.
BIG, INT, TEXT, DAY, TIME = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.TimestampNTZType()
AMOUNT, WEIGHT, VALUE = T.DecimalType(16, 2), T.DecimalType(8, 2), T.DecimalType(18, 2)


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names and types of sources, details and results.
EVENT = struct(
    common=struct(uid=BIG, platform=TEXT, province_id=BIG, ts=TEXT),
    page=struct(page_id=TEXT),
    action=struct(action_id=TEXT, item=BIG),
    ts=TEXT,
    event_id=TEXT,
    event_time_ms=BIG,
    biz_date=TEXT,
    source_timezone=TEXT,
)

# Business tables.
USER_INFO = struct(
    id=BIG, login_name=TEXT, nick_name=TEXT, passwd=TEXT, name=TEXT, phone_num=TEXT, email=TEXT, head_img=TEXT,
    user_level=TEXT, birthday=DAY, gender=TEXT, create_time=TIME, operate_time=TIME, update_time=TIME,
)
PROVINCE = struct(
    id=BIG, name=TEXT, region_id=BIG, area_code=TEXT,
)
CATEGORY = struct(
    id=BIG, name=TEXT, category_level=INT, parent_id=BIG,
)
SPU_INFO = struct(
    id=BIG, spu_name=TEXT, description=TEXT, category_id=BIG, create_time=TIME, update_time=TIME,
)
SKU_INFO = struct(
    id=BIG, spu_id=BIG, sku_name=TEXT, price=AMOUNT, weight=WEIGHT, category_id=BIG, create_time=TIME,
    update_time=TIME,
)
ORDER_INFO = struct(
    id=BIG, consignee=TEXT, consignee_tel=TEXT, total_amount=AMOUNT, order_status=TEXT, user_id=BIG,
    payment_way=TEXT, delivery_address=TEXT, order_comment=TEXT, out_trade_no=TEXT, trade_body=TEXT,
    create_time=TIME, operate_time=TIME, expire_time=TIME, process_status=TEXT, tracking_no=TEXT,
    parent_order_id=BIG, img_url=TEXT, province_id=BIG, benefit_reduce_amount=AMOUNT,
    original_total_amount=AMOUNT, feight_fee=AMOUNT, update_time=TIME,
)
ORDER_DETAIL = struct(
    id=BIG, order_id=BIG, sku_id=BIG, sku_name=TEXT, img_url=TEXT, order_price=AMOUNT, sku_num=BIG,
    create_time=TIME, update_time=TIME,
)
PAYMENT_INFO = struct(
    id=BIG, out_trade_no=TEXT, order_id=BIG, user_id=BIG, payment_type=TEXT, trade_no=TEXT,
    payment_amount=AMOUNT, subject=TEXT, payment_status=TEXT, create_time=TIME, callback_time=TIME,
    update_time=TIME,
)
ORDER_REFUND_INFO = struct(
    id=BIG, user_id=BIG, order_id=BIG, sku_id=BIG, refund_type=TEXT, refund_num=BIG, refund_amount=AMOUNT,
    refund_reason_type=TEXT, refund_reason_txt=TEXT, refund_status=TEXT, create_time=TIME, update_time=TIME,
)

BUSINESS_TABLES = {
    "user_info": USER_INFO,
    "base_province": PROVINCE,
    "base_category": CATEGORY,
    "spu_info": SPU_INFO,
    "sku_info": SKU_INFO,
    "order_info": ORDER_INFO,
    "order_detail": ORDER_DETAIL,
    "payment_info": PAYMENT_INFO,
    "order_refund_info": ORDER_REFUND_INFO,
}

# Detail tables.
TRAFFIC_DETAIL = struct(
    uid=BIG, platform=TEXT, province_id=BIG, page_id=TEXT, action_id=TEXT, item=BIG, ts=TEXT, event_id=TEXT,
    event_time_ms=BIG, biz_date=TEXT, source_timezone=TEXT,
)
PAYMENT_DETAIL = struct(
    id=BIG, order_id=BIG, user_id=BIG, payment_type=TEXT, trade_no=TEXT, payment_amount=AMOUNT,
    payment_status=TEXT, create_time=TIME, callback_time=TIME,
)
REFUND_DETAIL = struct(
    id=BIG, user_id=BIG, order_id=BIG, sku_id=BIG, refund_amount=AMOUNT, refund_status=TEXT, create_time=TIME,
)
ORDER_LINE = struct(
    id=BIG, order_id=BIG, sku_id=BIG, sku_name=TEXT, order_price=AMOUNT, sku_num=BIG, create_time=TIME,
)

# Metric tables.
DAY_METRIC = struct(
    metric_date=DAY, metric_name=TEXT, dimension_key=TEXT, metric_value=VALUE,
)
MINUTE_METRIC = struct(
    metric_date=DAY, window_start=TIME, metric_name=TEXT, dimension_key=TEXT, metric_value=VALUE,
)
DAY_KEY = ["metric_date", "metric_name", "dimension_key"]
MINUTE_KEY = ["metric_date", "window_start", "metric_name", "dimension_key"]

DETAIL_DAY = T.StructField("day", DAY)
RESULT_STAMP = T.StructField("updated_at", TIME)


def _with(schema: T.StructType, field: T.StructField) -> T.StructType:
    return T.StructType(schema.fields + [field])


# Keyed tables: schema, primary key, day column. Details carry the day they count for; results a write time.
KEYED_TABLES = {
    "dwd_traffic_event": (TRAFFIC_DETAIL, ["event_id"], "biz_date"),
    "dwd_payment_detail": (_with(PAYMENT_DETAIL, DETAIL_DAY), ["id"], "day"),
    "dwd_refund_detail": (_with(REFUND_DETAIL, DETAIL_DAY), ["id"], "day"),
    "dwd_order_detail": (_with(ORDER_LINE, DETAIL_DAY), ["id"], "day"),
    "dws_traffic_day": (DAY_METRIC, DAY_KEY, "metric_date"),
    "dws_trade_day": (DAY_METRIC, DAY_KEY, "metric_date"),
    "dws_traffic_1m": (MINUTE_METRIC, MINUTE_KEY, "metric_date"),
    "dws_trade_1m": (MINUTE_METRIC, MINUTE_KEY, "metric_date"),
    "ads_traffic_day": (_with(DAY_METRIC, RESULT_STAMP), DAY_KEY, "metric_date"),
    "ads_trade_day": (_with(DAY_METRIC, RESULT_STAMP), DAY_KEY, "metric_date"),
    "ads_traffic_1m": (_with(MINUTE_METRIC, RESULT_STAMP), MINUTE_KEY, "metric_date"),
    "ads_trade_1m": (_with(MINUTE_METRIC, RESULT_STAMP), MINUTE_KEY, "metric_date"),
}


def change_schema(table: T.StructType) -> T.StructType:
    """Change rows of a table: `op` ('c', 'u', 'd'), `seq`, its columns, and for 'u' the old image in `before`."""
    return T.StructType(
        [T.StructField("op", TEXT), T.StructField("seq", BIG)] + table.fields + [T.StructField("before", table)]
    )
