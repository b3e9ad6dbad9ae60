"""The whole chain over the test tables: streamed results equal batch recomputation, and a replay changes nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import as_set
from shopstrata.operators import cleanse, metrics
from shopstrata.plans.registry import QUERIES
from shopstrata.sources import readers, retail
from shopstrata.streaming.warehouse import Sources, Warehouse

DATA = "/root/testdata/sf0.001"


def created(df):
    """Change rows that create every row."""
    return df.select("*", F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("seq"))


def roles(spark):
    """Payments, refunds and order lines on the 30 days of the events table, and their dimensions."""
    events = retail.table(spark, DATA, "events")
    bought = retail.purchases(events)
    payments = bought.filter("payment_status = 'purchase'").withColumn("payment_status", F.lit("SUCCESS"))
    payments = payments.select(
        "*", F.lit("card").alias("payment_type"), F.lit("t").alias("trade_no"), F.col("create_time").alias("callback_time")
    )
    refunds = bought.filter("payment_status = 'error'").select(
        "id", "user_id", "order_id", F.col("user_id").alias("sku_id"), F.col("payment_amount").alias("refund_amount"),
        F.lit("SUCCESS").alias("refund_status"), "create_time",
    )
    lines = bought.filter("payment_status = 'click'").select(
        "id", (F.col("order_id") / 2).cast("bigint").alias("order_id"), F.col("user_id").alias("sku_id"),
        F.lit("s").alias("sku_name"), F.col("payment_amount").alias("order_price"), F.lit(2).cast("bigint").alias("sku_num"),
        "create_time",
    )
    orders = bought.select(F.col("order_id").alias("id"), (F.col("user_id") % 5).alias("province_id"))
    provinces = spark.range(5).select("id", F.concat(F.lit("province "), "id").alias("name"))
    skus = spark.range(200).select("id", (F.col("id") % 3).alias("category_id"))
    categories = spark.range(3).select("id", F.concat(F.lit("category "), "id").alias("name"))
    return payments, refunds, lines, orders, provinces, skus, categories


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warehouse"))
    payments, refunds, lines, orders, provinces, skus, categories = roles(spark)
    nested = retail.nested_events(retail.table(spark, DATA, "events"))
    readers.encode_events(nested).coalesce(1).write.text(f"{folder}/in/events")
    inputs = {"payments": payments, "refunds": refunds, "lines": lines}
    for name, df in inputs.items():
        created(df).coalesce(1).write.parquet(f"{folder}/in/{name}")

    def stream(name):
        return lambda: spark.readStream.schema(created(inputs[name]).schema).parquet(f"{folder}/in/{name}")

    sources = Sources(
        lambda: readers.read_events(spark, f"{folder}/in/events", streaming=True),
        stream("payments"), stream("refunds"), stream("lines"),
        lambda: orders, lambda: provinces, lambda: skus, lambda: categories,
    )
    built = Warehouse(spark, f"{folder}/out", sources)
    built.run_once()
    return built


def result(warehouse, name):
    return as_set(warehouse.tables[name].snapshot().drop("updated_at"))


def test_eleven_daily_metrics_equal_batch(spark, warehouse):
    payments, refunds, lines, orders, provinces, skus, categories = roles(spark)
    batch = metrics.union_metrics(
        metrics.trade_day(payments, refunds, lines),
        metrics.gmv_province(payments, orders, provinces),
        metrics.order_amount_category(lines, skus, categories),
    )
    assert result(warehouse, "ads_trade_day") == as_set(batch)
    assert len({row[1] for row in result(warehouse, "ads_trade_day")}) == 9
    assert result(warehouse, "ads_traffic_day") == as_set(QUERIES["traffic_day"](spark, DATA))


def test_closed_minutes_equal_batch(spark, warehouse):
    payments = roles(spark)[0]
    closed = metrics.closed_windows(metrics.trade_minute(payments), payments.agg(F.max("create_time")))
    assert result(warehouse, "ads_trade_1m") == as_set(closed)
    flat = cleanse.flatten_events(retail.nested_events(retail.table(spark, DATA, "events")))
    latest = retail.table(spark, DATA, "events").agg(F.max("ts"))
    assert result(warehouse, "ads_traffic_1m") == as_set(metrics.closed_windows(metrics.traffic_minute(flat), latest))


def test_replay_from_the_start_changes_nothing(spark, warehouse):
    names = [name for name in warehouse.tables if name.startswith("ads_")]
    before = {name: as_set(warehouse.tables[name].snapshot()) for name in names}
    replay = Warehouse(spark, warehouse.root, warehouse.sources)
    replay.checkpoint = lambda hop: f"{warehouse.root}/checkpoints-again/{hop}"
    replay.layers = [replay._details(), replay._metrics(), replay._results()]
    replay.run_once()
    assert {name: as_set(replay.tables[name].snapshot()) for name in names} == before


def test_every_hop_starts_as_its_own_query(warehouse):
    queries = warehouse.start("1 hour", "1 hour")
    try:
        assert len(queries) == 16
        assert all(query.isActive for query in queries.values())
    finally:
        for query in queries.values():
            query.stop()
