"""Batch result marts over the detail roles.

Choices where the mart's definition leaves room: a zero denominator gives rate 0, equal amounts rank by sku id,
any action makes a user active, retention is reported for 1 to 7 days up to the last day with data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window as W, functions as F

from shopstrata.functions.numbers import money, ratio
from shopstrata.operators.lookup import lookup, preaggregate
from shopstrata.schemas import MONEY


def _paid(payments: DataFrame, success: str) -> DataFrame:
    return payments.filter(F.col("payment_status") == success).withColumn("dt", F.to_date("create_time"))


def _refunded(refunds: DataFrame, success: str) -> DataFrame:
    return refunds.filter(F.col("refund_status") == success).withColumn("dt", F.to_date("create_time"))


def _zero(name: str):
    return F.coalesce(F.col(name), F.lit(0)).cast(MONEY).alias(name)


def gmv_day(payments: DataFrame, success: str = "SUCCESS") -> DataFrame:
    days = _paid(payments, success).groupBy("dt").agg(
        money(F.sum("payment_amount")).alias("gmv_amount"),
        F.count_distinct("order_id").alias("payment_order_count"),
        F.count_distinct("user_id").alias("payment_user_count"),
    )
    return days.withColumn("avg_payment_amount", ratio(F.col("gmv_amount"), F.col("payment_order_count"), MONEY))


def trade_refund(payments: DataFrame, refunds: DataFrame, paid: str = "SUCCESS", refunded: str = "SUCCESS") -> DataFrame:
    gmv = _paid(payments, paid).groupBy("dt").agg(F.sum("payment_amount").alias("gmv_amount"))
    back = _refunded(refunds, refunded).groupBy("dt").agg(F.sum("refund_amount").alias("refund_amount"))
    both = gmv.join(back, "dt", "full_outer").select("dt", _zero("gmv_amount"), _zero("refund_amount"))
    return both.withColumn("refund_rate", ratio(F.col("refund_amount"), F.col("gmv_amount")))


def sku_topn(
    lines: DataFrame,
    refunds: DataFrame,
    skus: DataFrame,
    categories: DataFrame,
    n: int = 10,
    refunded: str = "SUCCESS",
) -> DataFrame:
    """The n best-selling skus per day.

    The rank filter lets Spark keep n rows per day in every task before the shuffle, so a day is never
    ranked whole in one task. Orders, names and refunds are looked up for ranked rows only.
    """
    amount = F.col("order_price") * F.col("sku_num")
    dated = lines.withColumn("dt", F.to_date("create_time"))
    sold = dated.groupBy("dt", "sku_id").agg(
        F.sum("sku_num").alias("order_sku_num"),
        money(F.sum(amount)).alias("order_amount"),
    )
    best_first = W.partitionBy("dt").orderBy(F.desc("order_amount"), "sku_id")
    top = sold.withColumn("sku_rank", F.row_number().over(best_first)).filter(F.col("sku_rank") <= n)
    keys = top.select(F.col("dt").alias("_dt"), F.col("sku_id").alias("_sku"))
    ranked = F.col("dt").eqNullSafe(F.col("_dt")) & F.col("sku_id").eqNullSafe(F.col("_sku"))
    ordered = dated.select("dt", "sku_id", "order_id").join(keys, ranked, "left_semi")
    orders = ordered.groupBy(F.col("dt").alias("_dt"), F.col("sku_id").alias("_sku")).agg(
        F.count_distinct("order_id").alias("order_count")
    )
    returned = _refunded(refunds, refunded).join(keys, ranked, "left_semi")
    back = returned.groupBy("dt", "sku_id").agg(F.sum("refund_amount").alias("refund_amount"))
    top = top.join(orders, ranked).drop("_dt", "_sku")
    named = lookup(top, skus, "sku_id", cols=["sku_name", "category_id"], how="left")
    named = lookup(named, categories.withColumnRenamed("name", "category_name"), "category_id", cols=["category_name"], how="left")
    return named.join(back, ["dt", "sku_id"], "left").select(
        "dt",
        F.col("sku_rank").cast("bigint").alias("sku_rank"),
        "sku_id",
        "sku_name",
        "category_id",
        "category_name",
        "order_count",
        "order_sku_num",
        "order_amount",
        _zero("refund_amount"),
    )


def area_stats(
    payments: DataFrame,
    refunds: DataFrame,
    orders: DataFrame,
    users: DataFrame,
    provinces: DataFrame,
    paid: str = "SUCCESS",
    refunded: str = "SUCCESS",
) -> DataFrame:
    """Per day and province: paying users, payment and refund amounts.

    `orders` gives an order's buyer (order_id, user_id), `users` the buyer's province (id, province_id).
    Both facts shrink to one row per day and buyer before the buyer is looked up.
    """
    spent = preaggregate(_paid(payments, paid), ["dt", "user_id"], {"payment_amount": F.col("payment_amount")})
    per_order = preaggregate(
        _refunded(refunds, refunded), ["dt", "order_id"], {"refund_amount": F.col("refund_amount")}
    )
    bought = lookup(per_order, orders, "order_id", dim_key="order_id", cols=["user_id"])
    returned = preaggregate(bought, ["dt", "user_id"], {"refund_amount": F.col("refund_amount")})
    both = spent.withColumn("paid", F.lit(1)).unionByName(returned, allowMissingColumns=True)
    per_user = both.groupBy("dt", "user_id").agg(
        F.max("paid").alias("paid"),
        F.sum("payment_amount").alias("payment_amount"),
        F.sum("refund_amount").alias("refund_amount"),
    )
    placed = lookup(per_user, users, "user_id", cols=["province_id"])
    areas = placed.groupBy("dt", "province_id").agg(
        F.count("paid").alias("payment_user_count"),
        F.sum("payment_amount").alias("payment_amount"),
        F.sum("refund_amount").alias("refund_amount"),
    )
    named = lookup(areas, provinces, "province_id", cols=["name"])
    amounts = named.select(
        "dt",
        "province_id",
        F.col("name").alias("province_name"),
        "payment_user_count",
        _zero("payment_amount"),
        _zero("refund_amount"),
    )
    return amounts.withColumn("refund_rate", ratio(F.col("refund_amount"), F.col("payment_amount")))


def user_stats(payments: DataFrame, refunds: DataFrame, paid: str = "SUCCESS", refunded: str = "SUCCESS") -> DataFrame:
    """Per day: paying users, those with at least two paid orders, payment and refund amounts."""
    per_user = _paid(payments, paid).groupBy("dt", "user_id").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("payment_amount").alias("amount")
    )
    days = per_user.groupBy("dt").agg(
        F.count("user_id").alias("payment_user_count"),
        F.count_if((F.col("orders") >= 2) & F.col("user_id").isNotNull()).alias("repeat_payment_user_count"),
        F.sum("amount").alias("payment_amount"),
    )
    back = _refunded(refunds, refunded).groupBy("dt").agg(F.sum("refund_amount").alias("refund_amount"))
    none = F.lit(0).cast("bigint")
    both = days.join(back, "dt", "full_outer").select(
        "dt",
        F.coalesce("payment_user_count", none).alias("payment_user_count"),
        F.coalesce("repeat_payment_user_count", none).alias("repeat_payment_user_count"),
        _zero("payment_amount"),
        _zero("refund_amount"),
    )
    return both.select(
        "dt",
        "payment_user_count",
        "repeat_payment_user_count",
        ratio(F.col("repeat_payment_user_count"), F.col("payment_user_count")).alias("repeat_payment_rate"),
        "payment_amount",
        "refund_amount",
    )


# The funnel stages and the rates between them (name: later stage / earlier stage).
FUNNEL_STAGES = ("launch", "browse", "click", "add_cart", "order", "pay")
FUNNEL_RATES = {
    "click_rate": ("click", "browse"),
    "add_cart_rate": ("add_cart", "click"),
    "order_rate": ("order", "add_cart"),
    "pay_rate": ("pay", "order"),
}


def flow_funnel(
    detail: DataFrame,
    stages: Mapping[str, str] | None = None,
    rates: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Distinct users per day and stage. `stages` maps a stage to its action; rates between left-out stages go.

    Each user's day is reduced to one row of stage flags first: one shuffle on (day, user) for all stages.
    """
    stages = stages or {stage: stage for stage in FUNNEL_STAGES}
    rates = FUNNEL_RATES if rates is None else rates
    per_user = detail.groupBy(F.to_date("biz_date").alias("dt"), "uid").agg(
        *[F.max(F.when(F.col("action_id") == action, 1)).alias(stage) for stage, action in stages.items()]
    )
    days = per_user.filter(F.col("uid").isNotNull()).groupBy("dt").agg(
        *[F.count(stage).alias(f"{stage}_users") for stage in stages]
    )
    return days.select(
        "*",
        *[
            ratio(F.col(f"{later}_users"), F.col(f"{earlier}_users")).alias(name)
            for name, (later, earlier) in rates.items()
            if later in stages and earlier in stages
        ],
    )


def user_retention(detail: DataFrame, days: int = 7) -> DataFrame:
    """Users active on a day and again n days later, for n = 1..days.

    Events are first reduced to distinct (user, day) pairs. A frame n days ahead then tells whether the user
    came back, so the work is linear in the pairs and needs no join.
    """
    active_days = detail.filter(F.col("uid").isNotNull()).select("uid", F.to_date("biz_date").alias("day")).distinct()
    by_day = W.partitionBy("uid").orderBy(F.unix_date("day"))
    starts = active_days.select(
        F.col("day").alias("start_dt"),
        *[F.count(F.lit(1)).over(by_day.rangeBetween(n, n)).alias(f"_back_{n}") for n in range(1, days + 1)],
    ).filter(F.col("start_dt").isNotNull())
    back = {n: F.count_if(F.col(f"_back_{n}") > 0) for n in range(1, days + 1)}
    per_start = starts.groupBy("start_dt").agg(
        F.count(F.lit(1)).alias("start_users"), *[column.alias(str(n)) for n, column in back.items()]
    )
    # One row per calendar day from here on.
    last = F.max("start_dt").over(W.partitionBy(F.lit(0)))
    long = per_start.withColumn("_last", last).unpivot(
        ["start_dt", "start_users", "_last"], [str(n) for n in back], "n", "retained_users"
    )
    n = F.col("n").cast("int")
    observed = long.select(
        "start_dt",
        "start_users",
        F.date_add("start_dt", n).alias("retention_dt"),
        n.cast("bigint").alias("retention_n"),
        "retained_users",
        ratio(F.col("retained_users"), F.col("start_users")).alias("retention_rate"),
        "_last",
    )
    return observed.filter(F.col("retention_dt") <= F.col("_last")).drop("_last")
