"""Day and minute metrics in one long format: (metric_date[, window_start], metric_name, dimension_key, metric_value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shopstrata.functions.numbers import metric
from shopstrata.functions.times import epoch_ms_to_local, local_to_epoch_ms
from shopstrata.operators.lookup import lookup, preaggregate

ALL = "ALL"


@dataclass(frozen=True)
class Agg:
    """What a metric computes: a row count, a sum of a column or the distinct values of a column."""

    kind: str
    column: str | None = None

    def over_rows(self) -> Column:
        if self.kind == "rows":
            return F.count(F.lit(1))
        return F.sum(self.column) if self.kind == "sum" else F.count_distinct(self.column)


def rows() -> Agg:
    return Agg("rows")


def total(column: str) -> Agg:
    return Agg("sum", column)


def distinct(column: str) -> Agg:
    return Agg("distinct", column)


def to_long(wide: DataFrame, ids: list[str], names: list[str]) -> DataFrame:
    """One row per metric from one column per metric: all metrics of a source come from a single scan."""
    return wide.unpivot(ids, names, "metric_name", "metric_value")


def day_metrics(
    df: DataFrame, date: Column, specs: Mapping[str, Agg], dimension: Column | str | None = None
) -> DataFrame:
    """Metrics per day, recomputed from detail rows.

    Distinct counts shuffle on (day, value) first, so a day or a value with a large share of the rows is
    spread or already reduced; only per-day partial counts meet in the end.
    """
    key = F.lit(ALL) if dimension is None else (F.col(dimension) if isinstance(dimension, str) else dimension)
    keys = [date.alias("metric_date")] + ([] if dimension is None else [key.alias("dimension_key")])
    wide = df.groupBy(*keys).agg(*[metric(spec.over_rows()).alias(name) for name, spec in specs.items()])
    if dimension is None:
        wide = wide.withColumn("dimension_key", key)
    long = to_long(wide, ["metric_date", "dimension_key"], list(specs))
    return long.select("metric_date", "metric_name", "dimension_key", "metric_value")


def minute_metrics(
    df: DataFrame,
    event_time: str,
    specs: Mapping[str, Agg],
    date: str | None = None,
    where: Column | None = None,
    local_start: bool = False,
    unique: str | None = None,
    window: str = "1 minute",
    delay: str = "5 seconds",
) -> DataFrame:
    """Metrics per tumbling window, the same code for a batch and a stream.

    Rows are first reduced per (window, distinct value), then per window. Both steps are legal in append
    mode, and no state row grows with the number of values in a window. The watermark is declared before
    the filter, so filtered-out rows still move it; naming the event time in the filter keeps the optimizer
    from moving it below the watermark. `date` names the day column; without it the day is
    that of the window start. `unique` names a key whose repeats within a window count once; their state
    goes when the window closes. `local_start` turns the start of a zoned event time into business wall time.
    """
    distinct_columns = {spec.column for spec in specs.values() if spec.kind == "distinct"}
    if len(distinct_columns) > 1:
        raise ValueError("one distinct column per window aggregation")
    value = next(iter(distinct_columns), None)

    source = df
    if df.isStreaming:
        source = df.withWatermark(event_time, delay)
        where = where if where is None else F.when(F.col(event_time).isNotNull(), where)
    if where is not None:
        source = source.filter(where)

    source = source.withColumn("window", F.window(event_time, window))
    days = [date] if date else []
    if unique is not None:
        # Repeats are equal rows. An aggregate, unlike dropDuplicates, reduces them before the shuffle.
        needed = sorted({spec.column for spec in specs.values() if spec.column} - {unique})
        source = source.groupBy("window", *days, unique).agg(*[F.max(name).alias(name) for name in needed])
    partial = source.groupBy("window", *days, *([value] if value else [])).agg(
        *[
            (F.count(F.lit(1)) if spec.kind == "rows" else F.sum(spec.column)).alias(name)
            for name, spec in specs.items()
            if spec.kind != "distinct"
        ],
        F.count(F.lit(1)).alias("_n"),
    )
    wide = partial.groupBy("window", *days).agg(
        *[
            metric(F.count(spec.column) if spec.kind == "distinct" else F.sum(name)).alias(name)
            for name, spec in specs.items()
        ]
    )
    start = F.col("window.start")
    if local_start:
        start = epoch_ms_to_local(F.unix_millis(start))
    wide = wide.select(
        (F.to_date(date) if date else F.to_date(start)).alias("metric_date"),
        start.cast("timestamp_ntz").alias("window_start"),
        F.lit(ALL).alias("dimension_key"),
        *specs,
    )
    long = to_long(wide, ["metric_date", "window_start", "dimension_key"], list(specs))
    return long.select("metric_date", "window_start", "metric_name", "dimension_key", "metric_value")


def union_metrics(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def with_default_dimension(df: DataFrame) -> DataFrame:
    """A missing dimension_key is written as 'ALL'."""
    return df.withColumn("dimension_key", F.coalesce("dimension_key", F.lit(ALL)))


# The metric sets of the two domains.

BROWSE = "browse"


def traffic_day(detail: DataFrame, browse: str = BROWSE) -> DataFrame:
    """browse_pv and day_uv per business day; day_uv is its own distinct count, never a sum of minutes."""
    browsed = detail.filter(F.col("action_id") == browse)
    return day_metrics(browsed, F.to_date("biz_date"), {"browse_pv": rows(), "day_uv": distinct("uid")})


def traffic_minute(detail: DataFrame, browse: str = BROWSE, unique: str | None = None) -> DataFrame:
    """browse_pv and browse_uv per minute and business day."""
    timed = detail.withColumn("event_time", F.timestamp_millis("event_time_ms"))
    return minute_metrics(
        timed,
        "event_time",
        {"browse_pv": rows(), "browse_uv": distinct("uid")},
        date="biz_date",
        where=F.col("action_id") == browse,
        local_start=True,
        unique=unique,
    )


# Metric names and definitions.
PAYMENT_DAY = {
    "gmv": total("payment_amount"),
    "payment_order_count": distinct("order_id"),
    "payment_user_count": distinct("user_id"),
}
ORDER_DAY = {"order_gmv": total("line_amount"), "order_count": distinct("order_id"), "order_detail_count": rows()}


def payment_day(payments: DataFrame, success: str = "SUCCESS", names: Sequence[str] = tuple(PAYMENT_DAY)) -> DataFrame:
    """gmv, payment_order_count and payment_user_count (or some of them) by payment day. Refunds never lower gmv."""
    return day_metrics(
        payments.filter(F.col("payment_status") == success),
        F.to_date("create_time"),
        {name: PAYMENT_DAY[name] for name in names},
    )


def refund_day(refunds: DataFrame, success: str = "SUCCESS") -> DataFrame:
    """refund_amount by the day of the refund."""
    return day_metrics(
        refunds.filter(F.col("refund_status") == success),
        F.to_date("create_time"),
        {"refund_amount": total("refund_amount")},
    )


def order_day(lines: DataFrame, names: Sequence[str] = tuple(ORDER_DAY)) -> DataFrame:
    """order_gmv, order_count and order_detail_count (or some of them) by order day."""
    return day_metrics(
        lines.withColumn("line_amount", F.col("order_price") * F.col("sku_num")),
        F.to_date("create_time"),
        {name: ORDER_DAY[name] for name in names},
    )


def trade_day(
    payments: DataFrame,
    refunds: DataFrame,
    lines: DataFrame,
    paid: str = "SUCCESS",
    refunded: str = "SUCCESS",
) -> DataFrame:
    return union_metrics(payment_day(payments, paid), refund_day(refunds, refunded), order_day(lines))


def trade_minute(payments: DataFrame, success: str = "SUCCESS", unique: str | None = None) -> DataFrame:
    """gmv and payment_order_count per minute of local payment time.

    A stream's watermark needs a zoned time, so wall time passes through epoch milliseconds there.
    """
    event_time = "create_time"
    if payments.isStreaming:
        event_time = "event_time"
        payments = payments.withColumn(event_time, F.timestamp_millis(local_to_epoch_ms(F.col("create_time"))))
    return minute_metrics(
        payments,
        event_time,
        {"gmv": total("payment_amount"), "payment_order_count": distinct("order_id")},
        where=F.col("payment_status") == success,
        local_start=payments.isStreaming,
        unique=unique,
    )


def closed_windows(minutes: DataFrame, latest: DataFrame, window: str = "1 minute", delay: str = "5 seconds") -> DataFrame:
    """The windows a watermark of `latest` (one row, one column: the latest local event time) has closed."""
    watermark = latest.scalar() - F.expr(f"INTERVAL {delay}")
    return minutes.filter(F.col("window_start") + F.expr(f"INTERVAL {window}") <= watermark)


def gmv_province(
    payments: DataFrame, orders: DataFrame, provinces: DataFrame, success: str = "SUCCESS", order_key: str = "order_id"
) -> DataFrame:
    """gmv by province name, through the order's province."""
    per_order = preaggregate(
        payments.filter(F.col("payment_status") == success),
        [F.to_date("create_time").alias("metric_date"), order_key],
        {"amount": F.col("payment_amount")},
    )
    placed = lookup(per_order, orders, order_key, cols=["province_id"])
    per_province = preaggregate(placed, ["metric_date", "province_id"], {"amount": F.col("amount")})
    named = lookup(per_province, provinces, "province_id", cols=["name"])
    return day_metrics(named, F.col("metric_date"), {"gmv_province": total("amount")}, dimension="name")


def order_amount_category(lines: DataFrame, skus: DataFrame, categories: DataFrame) -> DataFrame:
    """Order amount by category name, through the line's sku."""
    per_sku = preaggregate(
        lines,
        [F.to_date("create_time").alias("metric_date"), "sku_id"],
        {"amount": F.col("order_price") * F.col("sku_num")},
    )
    sorted_out = lookup(per_sku, skus, "sku_id", cols=["category_id"])
    per_category = preaggregate(sorted_out, ["metric_date", "category_id"], {"amount": F.col("amount")})
    named = lookup(per_category, categories, "category_id", cols=["name"])
    return day_metrics(named, F.col("metric_date"), {"order_amount_category": total("amount")}, dimension="name")


def province_recompute(
    payments: DataFrame, orders: DataFrame, provinces: DataFrame, success: str = "SUCCESS", order_key: str = "order_id"
) -> DataFrame:
    """Batch recomputation of gmv by province, with the number of paid orders behind each value.

    An order has one `order_key`, so its orders are counted per key, before the lookup.
    """
    paid = payments.filter(F.col("payment_status") == success)
    per_key = paid.groupBy(F.to_date("create_time").alias("metric_date"), order_key).agg(
        F.sum("payment_amount").alias("amount"), F.count_distinct(paid["order_id"]).alias("orders")
    )
    placed = lookup(per_key, orders, order_key, cols=["province_id"])
    named = lookup(placed, provinces, "province_id", cols=["name"])
    return named.groupBy("metric_date", F.col("name").alias("dimension_key")).agg(
        metric(F.round(F.sum("amount"), 2)).alias("metric_value"), F.sum("orders").alias("pay_orders")
    )


def category_recompute(lines: DataFrame, skus: DataFrame, categories: DataFrame) -> DataFrame:
    """Batch recomputation of the order amount by category, with the number of order lines behind each value."""
    per_sku = lines.groupBy(F.to_date("create_time").alias("metric_date"), "sku_id").agg(
        F.sum(F.col("order_price") * F.col("sku_num")).alias("amount"), F.count(F.lit(1)).alias("line_rows")
    )
    named = lookup(
        lookup(per_sku, skus, "sku_id", cols=["category_id"]), categories, "category_id", cols=["name"]
    )
    return named.groupBy("metric_date", F.col("name").alias("dimension_key")).agg(
        metric(F.round(F.sum("amount"), 2)).alias("metric_value"), F.sum("line_rows").alias("detail_rows")
    )
