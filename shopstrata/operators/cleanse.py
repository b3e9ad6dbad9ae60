"""Raw rows to detail rows: flattening, column subsets, dedup, change compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shopstrata.functions.times import to_precision


# The columns of each detail table, here and in the functions below.
def flatten_events(events: DataFrame) -> DataFrame:
    """Nested behaviour events to one flat row each."""
    return events.select(
        F.col("common.uid").alias("uid"),
        F.col("common.platform").alias("platform"),
        F.col("common.province_id").alias("province_id"),
        F.col("page.page_id").alias("page_id"),
        F.col("action.action_id").alias("action_id"),
        F.col("action.item").alias("item"),
        "ts",
        "event_id",
        "event_time_ms",
        "biz_date",
        "source_timezone",
    )


def _millis(name: str) -> Column:
    return to_precision(F.col(name), "MILLISECOND").alias(name)


def _detail(raw: DataFrame, kept: Sequence[str], times: Sequence[str]) -> DataFrame:
    """The kept columns with times in milliseconds; the change columns pass through where present."""
    change = [name for name in ("op", "seq", "before") if name in raw.columns]
    return raw.select(*kept, *[_millis(name) for name in times], *change)


def payment_detail(payments: DataFrame) -> DataFrame:
    kept = ["id", "order_id", "user_id", "payment_type", "trade_no", "payment_amount", "payment_status"]
    return _detail(payments, kept, ["create_time", "callback_time"])


def refund_detail(refunds: DataFrame) -> DataFrame:
    return _detail(refunds, ["id", "user_id", "order_id", "sku_id", "refund_amount", "refund_status"], ["create_time"])


def order_detail(lines: DataFrame) -> DataFrame:
    return _detail(lines, ["id", "order_id", "sku_id", "sku_name", "order_price", "sku_num"], ["create_time"])


def dedup_earliest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first by `order_by`."""
    return _first_ranked(df, keys, [F.asc(name) for name in order_by])


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the last by `order_by` (compaction of a change log)."""
    return _first_ranked(df, keys, [F.desc(name) for name in order_by])


def _first_ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rank 1 of each key.

    The rank filter sits directly on the ranking, so Spark limits every map task to one row per key before
    the shuffle (WindowGroupLimit); a key that holds a large share of the input arrives as one row per task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
