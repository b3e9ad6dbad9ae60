"""The retail roles (events, payments, refunds, order lines, dimensions) played by the generic star-schema tables.

Money arrives as double and is cast per row. Status columns stay as stored, so that filters on them reach the
parquet scan; the status that counts as paid is PAID.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopstrata.functions.numbers import money
from shopstrata.functions.times import local_to_epoch_ms

PAID = "F"
REFUNDED = "R"

# Event types that play an action of the behaviour log; others keep their name.
ACTIONS = {"signup": "launch", "view": "browse", "click": "click", "purchase": "pay"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """The table as a file stream. The bracket makes the path a pattern, which may match one file or a folder."""
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/{name}.parque[t]")


def nested_events(events: DataFrame) -> DataFrame:
    """`events` as nested behaviour events; `ts` is read as business wall time."""
    action = F.col("event_type")
    for stored, played in ACTIONS.items():
        action = F.when(F.col("event_type") == stored, played).otherwise(action)
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    item = F.get_json_object("props", "$.k").cast("bigint")
    nothing = F.lit(None).cast("bigint")
    return events.select(
        F.struct(
            F.col("user_id").alias("uid"),
            F.lit("app").alias("platform"),
            nothing.alias("province_id"),
            text.alias("ts"),
        ).alias("common"),
        F.struct(F.col("event_type").alias("page_id")).alias("page"),
        F.struct(action.alias("action_id"), item.alias("item")).alias("action"),
        text.alias("ts"),
        F.col("event_id").cast("string").alias("event_id"),
        local_to_epoch_ms(F.col("ts")).alias("event_time_ms"),
        F.to_date("ts").cast("string").alias("biz_date"),
        F.lit("Asia/Shanghai").alias("source_timezone"),
    )


def traffic_detail(events: DataFrame) -> DataFrame:
    """The detail columns the traffic metrics need, straight from `events`.

    `action_id` stays as stored and `biz_date` stays a date, which saves a round trip through text.
    """
    return events.select(
        F.col("user_id").alias("uid"),
        F.col("event_type").alias("action_id"),
        F.col("event_id").cast("string").alias("event_id"),
        local_to_epoch_ms(F.col("ts")).alias("event_time_ms"),
        F.to_date("ts").alias("biz_date"),
    )


BROWSE = "view"
PURCHASE = "purchase"


def payments(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("payment_type"),
        money(F.col("o_totalprice")).alias("payment_amount"),
        F.col("o_orderstatus").alias("payment_status"),
        F.col("o_orderdate").alias("create_time"),
    )


def purchases(events: DataFrame) -> DataFrame:
    """Payments with a time of day: purchase events, `value` as the amount."""
    return events.select(
        F.col("event_id").alias("id"),
        F.col("event_id").alias("order_id"),
        F.col("user_id"),
        money(F.col("value")).alias("payment_amount"),
        F.col("event_type").alias("payment_status"),
        F.col("ts").alias("create_time"),
    )


def order_lines(lineitem: DataFrame) -> DataFrame:
    """Order lines. The extended price stands for the unit price, so that a line carries its own price."""
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("sku_id"),
        money(F.col("l_extendedprice")).alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.col("l_shipdate").alias("create_time"),
    )


def refunds(lineitem: DataFrame, *more: Column) -> DataFrame:
    return lineitem.select(
        *more,
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        money(F.col("l_extendedprice")).alias("refund_amount"),
        F.col("l_returnflag").alias("refund_status"),
        F.col("l_shipdate").alias("create_time"),
    )


def user_dim(customer: DataFrame) -> DataFrame:
    """The first lookup hop: the buyer's province."""
    return customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("bigint").alias("province_id"))


def province_dim(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("bigint").alias("region_id"),
    )


def sku_dim(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("sku_name"),
        F.col("p_type").alias("category_id"),
    )


def category_dim(part: DataFrame) -> DataFrame:
    """One row per part type; its text is both key and name."""
    return part.select(F.col("p_type").alias("id"), F.col("p_type").alias("name")).distinct()
