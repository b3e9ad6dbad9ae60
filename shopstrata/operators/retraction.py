"""Signed changes: what a batch takes away from and adds to sums, counts and distinct values.

A changed row counts with weight -1 as it was and with +1 as it is. Sums and row counts add up over batches; a distinct
count follows from how many rows have each value: it rises when a value's rows come to one or more, and falls when they are gone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shopstrata.operators.cleanse import latest_per_key
from shopstrata.operators.metrics import Agg


def net_changes(changes: DataFrame, current: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key that really changes: its images `old` and `new` (null where there is no row), and `seq`.

    Both sides have op and seq; `current` holds the last change of each key. Of several changes of a key the last counts, and
    one that is not newer than `current` is left out, so sending changes again changes nothing.
    """
    last = latest_per_key(changes, keys, ["seq"])
    known = current.select(
        *keys, F.struct(*columns).alias("_image"), (F.col("op") != "d").alias("_live"), F.col("seq").alias("_seq")
    )
    both = last.join(known, list(keys), "left").filter(F.col("_seq").isNull() | (F.col("seq") > F.col("_seq")))
    return both.select(
        *keys,
        F.when(F.col("_live"), F.col("_image")).alias("old"),
        F.when(F.col("op") != "d", F.struct(*columns)).alias("new"),
        "seq",
    )


def from_images(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same from the `before` image that each change brings along, without a look at the table.

    For logs that hold each change once and a key's changes in full.
    """
    gone, born = F.col("op") == "d", F.col("op") == "c"
    return changes.select(
        F.when(~born, F.struct(*[F.col(f"before.{name}") for name in columns])).alias("old"),
        F.when(~gone, F.struct(*columns)).alias("new"),
        "seq",
    )


def weighted(net: DataFrame) -> DataFrame:
    """Each image as a row with `weight` -1 or +1; a change that leaves the row as it was has none."""
    images = F.array(
        F.struct(F.col("old").alias("image"), F.lit(-1).cast("bigint").alias("weight")),
        F.struct(F.col("new").alias("image"), F.lit(1).cast("bigint").alias("weight")),
    )
    sides = net.filter(~F.col("old").eqNullSafe(F.col("new"))).select(F.explode(images).alias("side"))
    return sides.filter("side.image IS NOT NULL").select("side.image.*", "side.weight")


def counted(rows: DataFrame, groups: Mapping[str, Column], where: Column | str) -> DataFrame:
    """The weighted rows that count, with their group columns; rows without a group count nowhere."""
    grouped = rows.filter(where)
    for name, column in groups.items():
        grouped = grouped.withColumn(name, column)
    return grouped.dropna(subset=list(groups))


def total_changes(rows: DataFrame, groups: Sequence[str], specs: Mapping[str, Agg]) -> DataFrame:
    """By group and metric: the change of its rows, and of its value where that is a sum or a row count."""
    signs = F.col("weight")

    def change(spec: Agg) -> Column:
        if spec.kind == "sum":
            column = F.coalesce(F.col(spec.column), F.lit(0))
            return F.sum(F.when(signs < 0, -column).otherwise(column))
        return F.sum(signs) if spec.kind == "rows" else F.lit(0)

    wide = rows.groupBy(*groups).agg(
        F.sum(signs).alias("n_rows"), *[change(spec).cast("decimal(18,2)").alias(name) for name, spec in specs.items()]
    )
    return wide.unpivot([*groups, "n_rows"], list(specs), "metric_name", "metric_value")


def value_changes(rows: DataFrame, groups: Sequence[str], specs: Mapping[str, Agg]) -> DataFrame:
    """By group, distinct metric and value: the change of the number of rows that have the value."""
    named = [
        F.struct(F.lit(name).alias("metric_name"), F.col(spec.column).cast("string").alias("value"))
        for name, spec in specs.items()
        if spec.kind == "distinct"
    ]
    if not named:
        named = [F.struct(F.lit("none").alias("metric_name"), F.lit(None).cast("string").alias("value"))]
    each = rows.select(*groups, "weight", F.explode(F.array(*named)).alias("v")).filter("v.value IS NOT NULL")
    return each.groupBy(*groups, "v.metric_name", "v.value").agg(F.sum("weight").alias("n")).filter("n <> 0")


def stepped(changes: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New multiplicities of the changed values, and `step`, by which each moves its distinct count: -1, 0 or +1."""
    known = current.select(*keys, F.col("n").alias("_n"), F.col("seq").alias("_seq"))
    before, after = F.coalesce("_n", F.lit(0)), F.col("n")
    joined = changes.withColumnRenamed("n", "_d").join(known, list(keys), "left")
    joined = joined.withColumn("n", F.coalesce("_n", F.lit(0)) + F.col("_d"))
    step = (after > 0).cast("bigint") - (before > 0).cast("bigint")
    return joined.select(*changes.drop("n").columns, "n", step.alias("step"), (F.coalesce("_seq", F.lit(0)) + 1).alias("seq"))
