from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import EVENT, LINE, PAYMENT, REFUND, as_set, at, metric_map, money, payment
from shopstrata.operators import metrics, quality
from shopstrata.plans import marts

DAY = "2026-09-01"

# The refunds of the published test day: id (also the order), sku, amount, time.
REFUNDS = [
    (2026090100022, 300201, "593.00", "2026-09-03 13:16:17"),
    (2026090100033, 100202, "10448.10", "2026-09-02 21:35:18"),
    (2026090100035, 100301, "266.40", "2026-09-03 17:15:14"),
    (2026090100042, 200201, "117.40", "2026-09-02 13:40:18"),
    (2026090100074, 100201, "3680.40", "2026-09-01 13:13:31"),
    (2026090100107, 100202, "10764.09", "2026-09-03 14:27:45"),
    (2026090100112, 300201, "8191.50", "2026-09-02 18:54:18"),
    (2026090100123, 100102, "3438.05", "2026-09-02 18:40:16"),
    (2026090100144, 200301, "3799.35", "2026-09-03 09:35:57"),
    (2026090100155, 100102, "2307.08", "2026-09-03 11:43:10"),
    (2026090100163, 200101, "118.50", "2026-09-03 02:08:02"),
    (2026090100176, 100102, "5340.32", "2026-09-02 22:41:47"),
]


def test_refunds_of_the_test_day(spark):
    rows = [(id, id, sku, money(amount), "SUCCESS", at(time)) for id, sku, amount, time in REFUNDS]
    got = metric_map(metrics.refund_day(spark.createDataFrame(rows, REFUND)))
    assert got == {
        ("2026-09-01", "refund_amount", "ALL"): money("3680.40"),
        ("2026-09-02", "refund_amount", "ALL"): money("27535.37"),
        ("2026-09-03", "refund_amount", "ALL"): money("17848.42"),
    }


def test_two_payments_of_one_order_and_failed_ones(spark):
    rows = [payment(1, 10, 7, "5.00"), payment(2, 10, 7, "2.50"), payment(3, 11, 8, "9.00", status="FAILED")]
    got = metric_map(metrics.payment_day(spark.createDataFrame(rows, PAYMENT)))
    assert got == {
        (DAY, "gmv", "ALL"): money("7.50"),
        (DAY, "payment_order_count", "ALL"): money("1.00"),
        (DAY, "payment_user_count", "ALL"): money("1.00"),
    }


def test_minute_visitors_do_not_add_up_to_day_visitors(spark):
    base = 1788220800000
    rows = [("a", 1, "browse", base, DAY), ("b", 1, "browse", base + 61_000, DAY), ("c", 1, "click", base, DAY)]
    detail = spark.createDataFrame(rows, EVENT)
    minutes = metrics.traffic_minute(detail).filter("metric_name = 'browse_uv'")
    assert as_set(minutes, "window_start", "metric_value") == {
        (at("2026-09-01 08:00:00"), money("1.00")),
        (at("2026-09-01 08:01:00"), money("1.00")),
    }
    assert metric_map(metrics.traffic_day(detail)) == {
        (DAY, "browse_pv", "ALL"): money("2.00"),
        (DAY, "day_uv", "ALL"): money("1.00"),
    }


@pytest.fixture
def shop(spark):
    payments = spark.createDataFrame([payment(1, 10, 7, "5.00"), payment(2, 11, 8, "2.50")], PAYMENT)
    orders = spark.createDataFrame([(10, 1), (11, 2)], "id bigint, province_id bigint")
    provinces = spark.createDataFrame([(1, "north"), (2, "south")], "id bigint, name string")
    return payments, orders, provinces


def rollup(payments, orders, provinces):
    days = metrics.union_metrics(metrics.payment_day(payments), metrics.gmv_province(payments, orders, provinces))
    row = quality.rollup_check(days, {"gmv_province": "gmv"}).first()
    return str(row.parts), str(row.anchor), row.ok


def test_breakdown_adds_up_to_its_anchor(shop):
    assert metric_map(metrics.gmv_province(*shop)) == {
        (DAY, "gmv_province", "north"): money("5.00"),
        (DAY, "gmv_province", "south"): money("2.50"),
    }
    assert rollup(*shop) == ("7.50", "7.50", True)


def test_fact_without_dimension_is_dropped_and_noticed(shop):
    payments, orders, provinces = shop
    assert rollup(payments, orders.filter("id = 10"), provinces) == ("5.00", "7.50", False)


def test_duplicate_dimension_is_noticed(shop):
    payments, orders, provinces = shop
    assert rollup(payments, orders, provinces.unionByName(provinces)) == ("15.00", "7.50", False)


def test_order_amount_by_category(spark):
    lines = [(1, 10, 1, money("2.00"), 3, at("2026-09-01 09:00:00")), (2, 10, 2, money("1.50"), 2, at("2026-09-01 09:00:00"))]
    lines = spark.createDataFrame(lines, LINE)
    skus = spark.createDataFrame([(1, 5), (2, 5)], "id bigint, category_id bigint")
    categories = spark.createDataFrame([(5, "phones")], "id bigint, name string")
    assert metric_map(metrics.order_amount_category(lines, skus, categories)) == {
        (DAY, "order_amount_category", "phones"): money("9.00")
    }
    assert as_set(metrics.category_recompute(lines, skus, categories), "dimension_key", "metric_value", "detail_rows") == {
        ("phones", money("9.00"), 2)
    }


def test_full_funnel_and_zero_denominator(spark):
    stages = ["launch", "browse", "click", "add_cart"]
    rows = [(f"{s}{u}", u, s, 0, DAY) for s, users in zip(stages, (4, 3, 2, 1)) for u in range(users)]
    row = marts.flow_funnel(spark.createDataFrame(rows, EVENT)).first()
    assert (row.launch_users, row.browse_users, row.click_users, row.add_cart_users, row.order_users, row.pay_users) == (4, 3, 2, 1, 0, 0)
    assert [str(row[name]) for name in ("click_rate", "add_cart_rate", "order_rate", "pay_rate")] == [
        "0.6667", "0.5000", "0.0000", "0.0000",
    ]


def test_refund_day_without_sales_has_rate_zero(spark):
    payments = spark.createDataFrame([payment(1, 10, 7, "4.00")], PAYMENT)
    refunds = spark.createDataFrame([(1, 10, 1, money("1.00"), "SUCCESS", at("2026-09-02 01:00:00"))], REFUND)
    got = as_set(marts.trade_refund(payments, refunds).select(F.col("dt").cast("string"), F.col("refund_rate").cast("string")))
    assert got == {("2026-09-01", "0.0000"), ("2026-09-02", "0.0000")}


def test_rank_ties_go_to_the_lower_sku(spark):
    lines = [(i, i, sku, money("1.00"), 1, at("2026-09-01 09:00:00")) for i, sku in enumerate((3, 1, 2))]
    lines = spark.createDataFrame(lines, LINE)
    skus = spark.createDataFrame([(1, "a", 5), (2, "b", 5)], "id bigint, sku_name string, category_id bigint")
    categories = spark.createDataFrame([(5, "phones")], "id bigint, name string")
    top = marts.sku_topn(lines, spark.createDataFrame([], REFUND), skus, categories, n=2)
    assert as_set(top, "sku_rank", "sku_id", "sku_name") == {(1, 1, "a"), (2, 2, "b")}
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_retention_against_brute_force(spark):
    import random
    from datetime import date, timedelta

    rng = random.Random(3)
    start = date(2026, 9, 1)
    visits = {(rng.randrange(12), start + timedelta(days=rng.randrange(10))) for _ in range(40)}
    rows = [(str(i), uid, "browse", 0, str(day)) for i, (uid, day) in enumerate(sorted(visits) * 2)]
    got = as_set(
        marts.user_retention(spark.createDataFrame(rows, EVENT)), "start_dt", "start_users", "retention_n", "retained_users"
    )
    last = max(day for _, day in visits)
    want = set()
    for day in {day for _, day in visits}:
        users = {uid for uid, other in visits if other == day}
        for n in range(1, 8):
            later = day + timedelta(days=n)
            if later <= last:
                want.add((day, len(users), n, sum((uid, later) in visits for uid in users)))
    assert got == want


def test_only_one_distinct_column_per_window(spark):
    df = spark.createDataFrame([payment(1, 10, 7, "5.00")], PAYMENT)
    with pytest.raises(ValueError):
        metrics.minute_metrics(df, "create_time", {"a": metrics.distinct("order_id"), "b": metrics.distinct("user_id")})


def test_province_recompute_counts_orders(shop):
    got = as_set(metrics.province_recompute(*shop), "dimension_key", "metric_value", "pay_orders")
    assert got == {("north", money("5.00"), 1), ("south", money("2.50"), 1)}
