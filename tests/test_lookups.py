"""Cached lookups: what they read, how long they keep it, and breakdowns whose lookups change."""

from __future__ import annotations

import pytest
from helpers import PAYMENT, as_set, metric_map, money, payment
from test_retraction import CHANGE, PAID, SCHEMA, change, read_rows

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shopstrata.operators import metrics
from shopstrata.streaming.dimensions import PUSHED, KeyCache, looked_up
from shopstrata.streaming.incremental import SignedMetrics


class Dimension:
    """A dimension that changes, and how often it was read."""

    def __init__(self, spark, **names):
        self.spark, self.reads, self.now, self.names = spark, 0, 0.0, {int(k[1:]): v for k, v in names.items()}

    def read(self):
        self.reads += 1
        return self.spark.createDataFrame(list(self.names.items()), "id bigint, name string")


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "province bigint")


def test_rows_are_kept_until_they_are_too_old(spark, tmp_path):
    source = Dimension(spark, k1="one", k2="two")
    cache = KeyCache(spark, str(tmp_path), source.read, ["name"], ttl_seconds=60, clock=lambda: source.now)
    reads = source.reads

    def get(*values):
        return as_set(cache.get(keys(spark, *values)), "id", "name")

    assert get(1, 1, None, 9) == {(1, "one")}
    assert source.reads == reads + 1
    source.names |= {1: "uno", 9: "nine"}
    source.now = 59
    assert get(1, 9) == {(1, "one")} and source.reads == reads + 1  # a key without a row is remembered too
    assert get(2, 1) == {(1, "one"), (2, "two")} and source.reads == reads + 2  # a new key is fetched, a known one is not
    source.now = 61
    assert get(1, 9, 2) == {(1, "uno"), (9, "nine"), (2, "two")}
    assert get() == set()


def test_a_full_cache_drops_the_oldest(spark, tmp_path):
    source = Dimension(spark, k1="one", k2="two", k3="three")
    cache = KeyCache(spark, str(tmp_path), source.read, ["name"], most=2, clock=lambda: source.now)
    for source.now, asked in enumerate([(1,), (2,), (3,)]):
        assert cache.get(keys(spark, *asked)).count() == 1
    assert as_set(cache.table, "id") == {(2,), (3,)}
    assert cache.get(keys(spark, 1, 2, 3)).count() == 3


@pytest.mark.parametrize("asked", [3, PUSHED + 500])
def test_few_keys_read_few_rows_of_the_dimension(spark, tmp_path, asked):
    wide = spark.range(40_000).select("id", F.concat(F.lit("n"), "id").alias("name"), F.lit("x").alias("not_read"))
    wide.repartitionByRange(20, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "dim"))
    cache = KeyCache(spark, str(tmp_path / "cache"), lambda: spark.read.parquet(str(tmp_path / "dim")), ["name"])
    wanted = spark.range(asked).select((F.col("id") * 5).alias("sku"))
    found = {}
    read = read_rows(spark, lambda: found.update(rows=cache.get(wanted).count()))
    assert found["rows"] == asked
    if asked <= PUSHED:
        assert read < 8_000  # files without an asked key are skipped
    again = read_rows(spark, lambda: cache.get(wanted).count())
    assert again <= 8 * asked + 100  # only the cache


def test_what_was_counted_is_taken_back_though_the_lookup_changed(spark, tmp_path):
    source = Dimension(spark, k1="north", k2="south")
    cache = KeyCache(spark, str(tmp_path / "cache"), source.read, ["name"], ttl_seconds=0, clock=lambda: source.now)
    schema = StructType([*SCHEMA, StructField("name", StringType())])
    signed = SignedMetrics(
        spark, str(tmp_path / "signed"), schema, ["id"], {"gmv_province": metrics.total("payment_amount")}, PAID, dimension="name", buckets=2
    )
    write = signed.hop("hop", lambda rows: looked_up(rows, [("user_id", cache)]))

    def send(batch, *changes):
        source.now += 1
        write(spark.createDataFrame(changes, CHANGE), batch)
        return {key[2]: value for key, value in metric_map(signed.metrics()).items()}

    assert send(0, change(payment(1, 1, 1, "10.00")), change(payment(2, 2, 2, "5.00")), change(payment(3, 3, 9, "99.00"))) == {
        "north": money("10.00"),
        "south": money("5.00"),
    }
    source.names[1] = "east"
    assert send(1, change(payment(1, 1, 1, "12.00"), seq=2)) == {"east": money("12.00"), "south": money("5.00")}
    source.names[9] = "west"
    assert send(2, change(payment(3, 3, 9, "99.00"), seq=2), (2, None, None, None, None, None, "d", 2)) == {
        "east": money("12.00"),
        "west": money("99.00"),
    }


def test_breakdowns_equal_their_batch_form(spark, tmp_path):
    rows = [payment(i, i, i % 4, f"{i}.25", "SUCCESS" if i % 3 else "PENDING", f"2026-09-0{1 + i % 2} 10:00:00") for i in range(50)]
    users = spark.createDataFrame([(0, 10), (1, 11), (2, 10)], "id bigint, province_id bigint")
    names = spark.createDataFrame([(10, "A"), (11, "B")], "id bigint, name string")
    want = metrics.gmv_province(spark.createDataFrame(rows, PAYMENT), users, names, order_key="user_id")
    schema = StructType([*SCHEMA, StructField("name", StringType())])
    caches = [KeyCache(spark, str(tmp_path / str(k)), lambda d=d: d, c) for k, (d, c) in enumerate([(users, ["province_id"]), (names, ["name"])])]
    signed = SignedMetrics(spark, str(tmp_path / "s"), schema, ["id"], {"gmv_province": metrics.total("payment_amount")}, PAID, dimension="name", buckets=2)
    write = signed.hop("hop", lambda batch: looked_up(batch, list(zip(["user_id", "province_id"], caches, strict=True))))
    for batch in range(2):
        write(spark.createDataFrame([change(row) for row in rows[batch::2]], CHANGE), batch)
    assert metric_map(signed.metrics()) == metric_map(want)
