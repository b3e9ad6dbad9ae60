"""Dashboard queries over the result tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from shopstrata.functions.times import shift_zone
from shopstrata.streaming.keyed_table import KeyedTable

# The metrics shown as cards.
CARDS = ("gmv", "payment_order_count", "payment_user_count", "browse_pv", "day_uv")


def published(result: KeyedTable, days: int = 1) -> DataFrame:
    """The published rows of the last `days` days up to the latest day ever published: the folders of other days are not read."""
    last = result.changes().agg(F.max(result.day)).first()[0]
    if last is None:
        return result.snapshot(F.lit(False))
    return result.snapshot(F.col(result.day) > F.lit(last - timedelta(days=days)))


def latest_cards(days: DataFrame, names: Sequence[str] = CARDS) -> DataFrame:
    """Each metric's value on its latest day."""
    return (
        days.filter(F.col("metric_name").isin(*names))
        .groupBy("metric_name")
        .agg(
            F.max("metric_date").alias("metric_date"),
            F.max_by("metric_value", "metric_date").cast("decimal(20,2)").alias("metric_value"),
        )
    )


def refund_total(days: DataFrame) -> DataFrame:
    """Refunds of all days together."""
    refunds = days.filter(F.col("metric_name") == "refund_amount")
    return refunds.agg(F.sum("metric_value").cast("decimal(20,2)").alias("refunds"))


def minute_series(
    minutes: DataFrame, names: Sequence[str], start: str | None = None, end: str | None = None
) -> DataFrame:
    """One UTC time series column per metric, window starts within [start, end] of business wall time, ordered."""
    shown = minutes.filter(F.col("metric_name").isin(*names))
    if start is not None:
        shown = shown.filter(F.col("window_start") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        shown = shown.filter(F.col("window_start") <= F.lit(end).cast("timestamp_ntz"))
    value = F.col("metric_value").cast("double")
    series = shown.groupBy(shift_zone(F.col("window_start")).alias("time")).agg(
        *[F.max(F.when(F.col("metric_name") == name, value)).alias(name) for name in names]
    )
    return series.orderBy("time")


def recent_detail(*tables: DataFrame, days: int = 3) -> DataFrame:
    """Rows of each table's last days, newest first. Each table counts back from its own latest date.

    The dimension key is kept so that rows of a breakdown can be told apart.
    """
    parts = []
    for table in tables:
        latest = table.agg(F.max("metric_date").alias("latest"))
        recent = F.col("metric_date") >= F.date_sub(latest.scalar(), days)
        parts.append(table.filter(recent).select("metric_date", "metric_name", "dimension_key", "metric_value"))
    shown = parts[0]
    for part in parts[1:]:
        shown = shown.unionByName(part)
    return shown.orderBy(F.desc("metric_date"), "metric_name", "dimension_key")


def by_value(breakdown: DataFrame) -> DataFrame:
    """A breakdown, largest value first."""
    return breakdown.orderBy(F.desc("metric_value"), "metric_date", "dimension_key")
