"""Audits and reconciliation. Each returns a small DataFrame; none brings rows to the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shopstrata.functions.numbers import metric


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _stack(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


def manifest_check(tables: Mapping[str, DataFrame], manifest: DataFrame) -> DataFrame:
    """Row counts beside the manifest's `expected` per table_name. A table either side lacks is not ok."""
    joined = row_counts(tables).join(manifest, "table_name", "full_outer")
    return joined.select("table_name", "row_count", "expected", F.col("row_count").eqNullSafe(F.col("expected")).alias("ok"))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key value: what an audit join needs, and one row however hot the key is."""
    return df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))


def orphans(name: str, child: DataFrame, foreign_key: str, parent: DataFrame, primary_key: str = "id") -> DataFrame:
    """Child rows without a parent row; a missing foreign key counts."""
    parents = parent.select(F.col(primary_key).alias("_key"))
    lost = key_counts(child, foreign_key).join(parents, "_key", "left_anti")
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("bad_count")).select(
        F.lit(name).alias("check_name"), "bad_count"
    )


def orphans_by_condition(
    child: DataFrame, foreign_key: str, parent: DataFrame, primary_key: str, checks: Mapping[str, tuple[Column, Column]]
) -> DataFrame:
    """Several orphan checks of one key in one pass: child rows that meet the first condition without a parent row that
    meets the second."""
    counts = child.groupBy(F.col(foreign_key).alias("_key")).agg(
        *[F.count_if(rows).alias(f"_rows_{name}") for name, (rows, _) in checks.items()]
    )
    parents = parent.groupBy(F.col(primary_key).alias("_key")).agg(
        *[F.bool_or(known).alias(f"_known_{name}") for name, (_, known) in checks.items()]
    )
    lost = {name: F.when(~F.coalesce(F.col(f"_known_{name}"), F.lit(False)), F.col(f"_rows_{name}")) for name in checks}
    totals = counts.join(parents, "_key", "left").agg(
        *[F.coalesce(F.sum(rows), F.lit(0)).alias(name) for name, rows in lost.items()]
    )
    return totals.unpivot([], list(checks), "check_name", "bad_count")


def join_hits(name: str, left: DataFrame, left_key: str, right: DataFrame, right_key: str = "id") -> DataFrame:
    """Rows of the inner join of two tables, from their per-key counts instead of the joined rows."""
    pairs = key_counts(left, left_key).join(
        key_counts(right, right_key).withColumnRenamed("_rows", "_matches"), "_key"
    )
    hits = F.coalesce(F.sum(F.col("_rows") * F.col("_matches")), F.lit(0))
    return pairs.agg(hits.alias("hits")).select(F.lit(name).alias("check_item"), "hits")


def union_checks(*checks: DataFrame) -> DataFrame:
    return _stack(checks)


def amount_by(df: DataFrame, group: Column, count_name: str, amount: str, amount_name: str) -> DataFrame:
    """Row count and rounded amount per group: status distributions and per-day baselines."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias(count_name), metric(F.round(F.sum(amount), 2)).alias(amount_name)
    )


def watermark_range(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Earliest and latest change time per table."""
    return _stack(
        [
            df.agg(F.min(time).alias("min_time"), F.max(time).alias("max_time")).select(
                F.lit(name).alias("table_name"), "min_time", "max_time"
            )
            for name, (df, time) in tables.items()
        ]
    )


def empty_source_sentinel(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Whether each change source holds rows from its first sequence number (0) on.

    `state` is 'ok', 'empty' (no row at all) or 'truncated' (rows, but the head is gone).
    """
    state = F.when(F.col("row_count") == 0, "empty").when(F.col("min_seq") > 0, "truncated").otherwise("ok")
    return _stack(
        [
            df.agg(F.count(F.lit(1)).alias("row_count"), F.min(seq).cast("bigint").alias("min_seq")).select(
                F.lit(name).alias("table_name"), "row_count", "min_seq", state.alias("state")
            )
            for name, (df, seq) in tables.items()
        ]
    )


def key_completeness(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows against distinct keys; equal when every key occurs once."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    counted = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("key_count")
    )
    return counted.select(
        F.lit(name).alias("table_name"),
        "row_count",
        "key_count",
        (F.col("row_count") == F.col("key_count")).alias("ok"),
    )


def rollup_check(metrics: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Per day, the sum of a broken-down metric against its anchor: `pairs` = {breakdown: anchor}.

    A lookup that lost rows makes `parts` too low, one that multiplied rows makes it too high.
    """
    named = [name for pair in pairs.items() for name in pair]
    summed = metrics.filter(F.col("metric_name").isin(*named))
    role = F.when(F.col("metric_name").isin(*pairs.keys()), "parts").otherwise("anchor")
    breakdown = F.col("metric_name")
    for part, anchor in pairs.items():
        breakdown = F.when(F.col("metric_name") == anchor, part).otherwise(breakdown)
    value = F.col("metric_value")
    both = summed.groupBy("metric_date", breakdown.alias("metric_name")).agg(
        metric(F.sum(F.when(role == "parts", value))).alias("parts"),
        metric(F.sum(F.when(role == "anchor", value))).alias("anchor"),
    )
    return both.withColumn("ok", F.col("parts").eqNullSafe(F.col("anchor")))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str = "metric_value") -> DataFrame:
    """Keys whose value differs between two results: `status` is 'missing', 'extra' or 'diff', seen from `left`."""
    mine = left.select(*keys, F.col(value).alias("left_value"), F.lit(True).alias("_left"))
    other = right.select(*keys, F.col(value).alias("right_value"), F.lit(True).alias("_right"))
    status = (
        F.when(F.col("_left").isNull(), "missing")
        .when(F.col("_right").isNull(), "extra")
        .when(~F.col("left_value").eqNullSafe(F.col("right_value")), "diff")
    )
    joined = mine.join(other, list(keys), "full_outer").withColumn("status", status)
    return joined.filter("status IS NOT NULL").select(*keys, "left_value", "right_value", "status")


def minute_day_gap(minutes: DataFrame, days: DataFrame, name: str = "browse_pv") -> DataFrame:
    """Per day, the sum of closed minutes of an additive metric, the day's value and what open minutes still hold."""
    closed = (
        minutes.filter(F.col("metric_name") == name)
        .groupBy("metric_date")
        .agg(metric(F.sum("metric_value")).alias("minute_sum"))
    )
    whole = days.filter(F.col("metric_name") == name).select("metric_date", F.col("metric_value").alias("day_value"))
    minute_sum = F.coalesce("minute_sum", F.lit(0)).cast("decimal(18,2)")
    return whole.join(closed, "metric_date", "left").select(
        "metric_date",
        minute_sum.alias("minute_sum"),
        "day_value",
        metric(F.col("day_value") - minute_sum).alias("tail_gap"),
    )


def uv_le_pv(minutes: DataFrame) -> DataFrame:
    """Per day: windows, their pv and uv sums, and the windows where uv exceeds pv (must be 0)."""
    value = F.col("metric_value")
    per_window = minutes.groupBy("metric_date", "window_start").agg(
        F.max(F.when(F.col("metric_name") == "browse_pv", value)).alias("pv"),
        F.max(F.when(F.col("metric_name") == "browse_uv", value)).alias("uv"),
    )
    return per_window.groupBy("metric_date").agg(
        F.count(F.lit(1)).alias("windows"),
        metric(F.sum("pv")).alias("pv_sum"),
        metric(F.sum("uv")).alias("uv_sum"),
        F.count_if(F.coalesce(F.col("uv") > F.col("pv"), F.lit(False))).alias("violations"),
    )


def content_hash(df: DataFrame) -> DataFrame:
    """Row count and an order-insensitive sum of row hashes: equal for two replays of the same content."""
    text = [F.coalesce(F.col(name).cast("string"), F.lit("\x00")) for name in df.columns]
    digest = F.md5(F.concat_ws("\x1f", *text))
    halves = [F.conv(F.substring(digest, start, 16), 16, 10).cast("decimal(20,0)") for start in (1, 17)]
    sums = [F.sum(half).cast("decimal(38,0)") for half in halves]
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), sums[0].alias("content_hash"), sums[1].alias("content_hash_low")
    )
