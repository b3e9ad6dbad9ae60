"""Signed changes against recomputation, and what a batch reads."""

from __future__ import annotations

import random

import pytest
from helpers import PAYMENT, as_set, at, metric_map, money, payment

from pyspark.sql import functions as F

from shopstrata.operators import metrics, retraction
from shopstrata.schemas import PAYMENT_DETAIL
from shopstrata.streaming.incremental import SignedMetrics

COLUMNS = ["id", "order_id", "user_id", "payment_amount", "payment_status", "create_time"]
SCHEMA = PAYMENT_DETAIL.__class__([PAYMENT_DETAIL[name] for name in COLUMNS])
CHANGE = PAYMENT + ", op string, seq bigint"
PAID = "payment_status = 'SUCCESS'"


@pytest.fixture
def signed(spark, tmp_path):
    def make(**more):
        return SignedMetrics(spark, str(tmp_path / "signed"), SCHEMA, ["id"], metrics.PAYMENT_DAY, PAID, **more)

    return make


def change(row, op="u", seq=1):
    return (*row, op, seq)


def gone(id, seq):
    return (id, None, None, None, None, None, "d", seq)


def test_a_change_takes_back_what_it_replaces(spark, signed):
    now = signed()
    write = now.hop("one")

    def send(batch, *changes):
        write(spark.createDataFrame(changes, CHANGE), batch)
        return metric_map(now.metrics())

    def day(date, gmv, orders, users):
        return {(date, name, "ALL"): money(value) for name, value in zip(metrics.PAYMENT_DAY, (gmv, orders, users), strict=True)}

    first = day("2026-09-01", "30.00", "1.00", "2.00")
    assert send(0, change(payment(1, 7, 1, "10.00")), change(payment(2, 7, 2, "20.00"))) == first
    assert send(1, change(payment(2, 7, 2, "20.00", "FAILED"), seq=2)) == day("2026-09-01", "10.00", "1.00", "1.00")
    assert send(1, change(payment(2, 7, 2, "20.00", "FAILED"), seq=2)) == day("2026-09-01", "10.00", "1.00", "1.00")  # the batch again
    moved = change(payment(1, 8, 1, "12.00", time="2026-09-02 00:00:00"), seq=3)
    assert send(2, moved) == day("2026-09-02", "12.00", "1.00", "1.00")
    assert send(3, moved, change(payment(1, 7, 1, "10.00"))) == day("2026-09-02", "12.00", "1.00", "1.00")  # sent again, and an older one
    assert send(4, gone(1, 4), gone(99, 1)) == {}
    assert send(5, change(payment(1, 7, 1, "10.00"), "c", 5), change(payment(3, 7, 3, "0.00"), "c", 1)) == day("2026-09-01", "10.00", "1.00", "2.00")
    assert send(6, change(payment(5, 7, 3, "1.00", time="2026-09-01 10:00:00")[:5] + (None,), "c", 1)) == day("2026-09-01", "10.00", "1.00", "2.00")


@pytest.mark.parametrize("minutes", [False, True])
def test_random_batches_equal_recomputation(spark, signed, minutes):
    rng = random.Random(4)
    now = signed(minutes=minutes, buckets=3) if not minutes else SignedMetrics(
        spark, signed().rows.path + "-m", SCHEMA, ["id"], {k: metrics.PAYMENT_DAY[k] for k in ("gmv", "payment_order_count")}, PAID, minutes=True, buckets=3
    )
    write, live, seqs, latest = now.hop("many"), {}, {}, None
    for batch in range(5):
        sent = []
        for _ in range(40):
            id = rng.randrange(30)
            seqs[id] = seqs.get(id, 0) + 1
            if rng.random() < 0.2:
                sent.append(gone(id, seqs[id]))
                live.pop(id, None)
            else:
                time = f"2026-09-0{rng.randrange(1, 4)} 10:0{rng.randrange(3)}:{rng.randrange(10, 60)}"
                row = payment(id, rng.randrange(5), rng.choice([None, 1, 2, 3]), f"{rng.randrange(100)}.50", rng.choice(["SUCCESS", "PENDING"]), time)
                sent.append(change(row, seq=seqs[id]))
                live[id] = row
                latest = max(latest or row[5], row[5])
        rng.shuffle(sent)
        write(spark.createDataFrame(sent + sent[:5], CHANGE), batch)
    rows = spark.createDataFrame(list(live.values()), PAYMENT)
    if minutes:
        # One row per key and batch is kept, so the latest time of the table may lie before the latest ever sent.
        kept = now.rows.changes().agg(F.max("create_time"))
        assert as_set(now.closed()) == as_set(metrics.closed_windows(metrics.trade_minute(rows), kept))
        assert now.closed().count() > 0
    else:
        assert metric_map(now.metrics()) == metric_map(metrics.payment_day(rows))


def read_rows(spark, work):
    """Input rows of the stages that `work` runs."""
    context = spark.sparkContext
    nothing = context._gateway.new_array(context._jvm.double, 0), context._jvm.java.util.ArrayList()

    def stages():
        listed = context._jsc.sc().statusStore().stageList(None, False, False, *nothing)
        return {listed.apply(k).stageId(): listed.apply(k).inputRecords() for k in range(listed.size())}

    context._jsc.sc().listenerBus().waitUntilEmpty()
    before = stages()
    work()
    context._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(rows for stage, rows in stages().items() if stage not in before)


def test_a_batch_reads_what_it_touches(spark, signed):
    now = signed(buckets=64)
    write = now.hop("big")
    ids = F.col("id")
    day = spark.range(20_000).select(
        ids, ids.alias("order_id"), (ids % 5000).alias("user_id"), F.lit(1).cast("decimal(16,2)").alias("payment_amount"), F.lit("SUCCESS").alias("payment_status"),
        F.lit(at("2026-09-01 10:00:00")).alias("create_time"), F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("seq"),
    )
    write(day, 0)
    one = spark.createDataFrame([change(payment(5, 5, 5, "3.00"), seq=2)], CHANGE)
    read = read_rows(spark, lambda: write(one, 1))
    assert 0 < read < 4_000  # three folders of 64 of the keys and values, though the day has 20,000 rows
    assert metric_map(now.metrics())["2026-09-01", "gmv", "ALL"] == money("20002.00")


def test_images_give_the_same_signed_rows(spark):
    log = spark.createDataFrame(
        [
            ("c", 1, 1, 10, None),
            ("u", 2, 1, 15, (1, 10)),
            ("d", 3, 2, None, (2, 7)),
            ("u", 4, 3, 9, (3, 9)),
        ],
        "op string, seq bigint, id bigint, amount int, before struct<id bigint, amount int>",
    )
    rows = retraction.weighted(retraction.from_images(log, ["id", "amount"]))
    assert as_set(rows) == {(1, 10, 1), (1, 10, -1), (1, 15, 1), (2, 7, -1)}
