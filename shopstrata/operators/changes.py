"""Keyed changes on DataFrames: applying a change log, partial upserts, keyed updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shopstrata.functions.times import to_precision
from shopstrata.operators.cleanse import latest_per_key
from shopstrata.operators.metrics import with_default_dimension


def apply_changes(changes: DataFrame, keys: Sequence[str], seq: str = "seq", op: str = "op") -> DataFrame:
    """The table a change log leaves behind: the last change per key, without deleted keys."""
    return latest_per_key(changes, keys, [seq]).filter(F.col(op) != "d").drop(op, seq)


def upsert(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None
) -> DataFrame:
    """Insert new keys; on a known key overwrite only `update_cols` (default: every column of `rows`).

    Keys are unique on both sides. A column `rows` lacks stays null on insert.
    """
    given = set(rows.columns) - set(keys)
    replaced = given if update_cols is None else set(update_cols)
    old, new = target.withColumn("_known", F.lit(True)).alias("old"), rows.withColumn("_given", F.lit(True)).alias("new")
    joined = old.join(new, list(keys), "full_outer")

    def value(name: str):
        if name in keys:
            return F.col(name)
        if name not in given:
            return F.col(f"old.{name}")
        insert_or_replace = F.col("new._given") if name in replaced else F.col("old._known").isNull()
        return F.when(insert_or_replace, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    return joined.select(*[value(name) for name in target.columns])


def merge_partial(log: DataFrame, keys: Sequence[str], columns: Sequence[str], mask: str = "mask", seq: str = "seq") -> DataFrame:
    """The rows a log of partial upserts leaves behind: merged on read, without a join of the target.

    The first row of a key by `seq` inserts it whole. A later one sets only the columns named in its `mask`, an array, to null
    if it holds null; for each column the last row that sets it counts. Rows are reduced in the map tasks first.
    """
    inserted = F.min_by(F.struct(*columns), seq).alias("_first")
    sets = [F.max_by(F.struct(F.col(name).alias("v")), F.when(F.array_contains(mask, name), F.col(seq))).alias(f"_set_{name}") for name in columns]
    merged = log.groupBy(*keys).agg(inserted, *sets)

    def value(name: str):
        put = F.col(f"_set_{name}")
        return F.when(put.isNotNull(), put["v"]).otherwise(F.col(f"_first.{name}")).alias(name)

    return merged.select(*keys, *[value(name) for name in columns])


def update_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overwrite the columns of `updates` on matching keys; unmatched updates do nothing."""
    changed = [name for name in updates.columns if name not in keys]
    old, new = target.alias("old"), updates.withColumn("_given", F.lit(True)).alias("new")
    joined = old.join(new, list(keys), "left")
    return joined.select(
        *[
            F.when(F.col("new._given"), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)
            if name in changed
            else F.col(name)
            for name in target.columns
        ]
    )


def publish(metrics: DataFrame) -> DataFrame:
    """Metric rows as result rows: values pass through, window starts lose fractions, dimension defaults to ALL."""
    if "window_start" in metrics.columns:
        metrics = metrics.withColumn("window_start", to_precision(F.col("window_start"), "SECOND"))
    return with_default_dimension(metrics)
