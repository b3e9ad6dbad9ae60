"""Event-time order: republishing rows in time order and checking that arrival order is monotone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from shopstrata.operators.cleanse import latest_per_key
from shopstrata.session import shared_dir


def resequence(
    df: DataFrame, keys: Sequence[str], seq: Sequence[str], order_by: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Compact by key, sort by `order_by` over all rows and number the rows from 1 in `position`.

    Rows are range-partitioned and sorted within each partition; a position is the row's place in its
    partition plus the rows of all earlier partitions. The sorted rows are checkpointed so that both uses of
    them see the same partition bounds. Only the per-partition counts meet in one task. `order_by` must be
    unique per row.
    """
    spark = df.sparkSession
    compact = latest_per_key(df, keys, seq)
    ranged = (
        compact.repartitionByRange(partitions, *order_by) if partitions else compact.repartitionByRange(*order_by)
    )
    # The high bits of monotonically_increasing_id are the partition, the low 33 bits the place in it.
    place = F.monotonically_increasing_id()
    placed = ranged.sortWithinPartitions(*order_by).select(
        "*",
        F.shiftright(place, 33).alias("_part"),
        place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
    )
    shared_dir(spark)
    placed = placed.checkpoint()
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    return placed.join(offsets, "_part").select(
        *df.columns, (F.col("_offset") + F.col("_place") + 1).alias("position")
    )


def time_order_check(df: DataFrame, arrival: str, time: str, chunk: int = 1_000_000) -> DataFrame:
    """How far arrival order departs from time order: one row of counts.

    `steps_back` counts rows earlier than the row before, `behind` rows earlier than some row before. A row without
    a time is neither, nor is the row after it a step back.
    `arrival` is a unique number. Rows are windowed in chunks of the arrival range; chunk summaries, one row
    per million rows, carry the last and the latest time across chunk borders.
    """
    chunks = df.select(
        F.floor(F.col(arrival) / F.lit(chunk)).alias("_chunk"), F.col(arrival).alias("_arrival"), F.col(time).alias("_time")
    )
    in_order = W.partitionBy("_chunk").orderBy("_arrival")
    before = in_order.rowsBetween(W.unboundedPreceding, -1)
    marked = chunks.select(
        "_chunk",
        "_arrival",
        "_time",
        F.lag("_time").over(in_order).alias("_previous"),
        (F.row_number().over(in_order) == 1).alias("_first"),
        F.max("_time").over(before).alias("_latest"),
    )
    summary = chunks.groupBy("_chunk").agg(
        F.max_by("_time", "_arrival").alias("_last"), F.max("_time").alias("_max")
    )
    across = W.orderBy("_chunk")
    carried = summary.select(
        "_chunk",
        F.lag("_last").over(across).alias("_carried_previous"),
        F.max("_max").over(across.rowsBetween(W.unboundedPreceding, -1)).alias("_carried_latest"),
    )
    rows = marked.join(carried, "_chunk")
    steps_back = F.col("_time") < F.when(F.col("_first"), F.col("_carried_previous")).otherwise(F.col("_previous"))
    behind = F.col("_time") < F.greatest("_latest", "_carried_latest")
    return rows.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(F.coalesce(steps_back, F.lit(False))).alias("steps_back"),
        F.count_if(F.coalesce(behind, F.lit(False))).alias("behind"),
    )


def sequence_gaps(df: DataFrame, seq: str, first: int = 0, chunk: int = 1_000_000) -> DataFrame:
    """The runs of whole numbers from `first` on that `seq` lacks before its last one: `lost_from`, `lost_to`, `lost`.

    A run that begins at `first` is a lost head, any other an inner gap; numbers after the last cannot be told from ones never
    written. Repeats of a number do not count, nor do numbers before `first`. Rows are windowed in chunks of the
    range; one row a chunk carries the last number across chunk borders.
    """
    numbers = df.select(F.col(seq).cast("bigint").alias("_seq")).filter(F.col("_seq") >= first)
    chunks = numbers.withColumn("_chunk", F.floor((F.col("_seq") - first) / F.lit(chunk)))
    before = F.lag("_seq").over(W.partitionBy("_chunk").orderBy("_seq"))
    ends = chunks.groupBy("_chunk").agg(F.max("_seq").alias("_last"))
    carried = ends.select("_chunk", F.lag("_last").over(W.orderBy("_chunk")).alias("_carried"))
    rows = chunks.withColumn("_before", before).join(carried, "_chunk")
    previous = F.coalesce("_before", "_carried", F.lit(first - 1))
    found = rows.select((previous + 1).alias("lost_from"), (F.col("_seq") - 1).alias("lost_to"))
    found = found.filter("lost_to >= lost_from")
    return found.select("*", (F.col("lost_to") - F.col("lost_from") + 1).alias("lost"))
