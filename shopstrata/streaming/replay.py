"""Stored rows sent again as a stream in time order, and rows that come behind a stream's watermark as a result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shopstrata.operators.sequence import resequence
from shopstrata.session import run_dir
from shopstrata.sources.change_log import read_change_log
from shopstrata.streaming.hops import WriteBatch
from shopstrata.streaming.keyed_table import KeyedTable, batch_label


def write_in_order(df: DataFrame, keys: Sequence[str], seq: Sequence[str], order_by: Sequence[str], folder: str, files: int) -> T.StructType:
    """Sort the last row of each key by `order_by` into a log of about `files` files, numbered from 1 by place; returns the rows' schema.

    `order_by` is unique for a row. Files are ranges of places, so no task sorts more than its own.
    """
    placed = resequence(df, keys, seq, order_by).select(F.lit("c").alias("op"), F.col("position").alias("seq"), *df.columns)
    placed.repartitionByRange(files, "seq").sortWithinPartitions("seq").write.parquet(f"{folder}/log")
    return df.schema


def read_in_order(spark: SparkSession, folder: str, schema: T.StructType, progress: str, files_per_batch: int = 1) -> DataFrame:
    """The rows as a stream whose batches follow each other in the written order."""
    return read_change_log(spark, folder, schema, 0, files_per_batch, progress).drop("op", "seq")


def run_batches_to_table(stream: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """Run an append stream batch by batch until its input is used up; the new table, and the state rows dropped as late."""
    spark = stream.sparkSession
    folder = run_dir(spark, purpose)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(processingTime="0 seconds")
        .start(f"{folder}/table")
    )
    try:
        query.processAllAvailable()
        dropped = sum(step["numRowsDroppedByWatermark"] for batch in query.recentProgress for step in batch["stateOperators"])
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(f"{folder}/table"), dropped


LATE = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("latest", T.TimestampNTZType()),
        T.StructField("part", T.IntegerType()),
    ]
)


def late_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, LATE, ["batch_id"], "part")


def late_rows_hop(table: KeyedTable, checkpoint: str, time: str, window: str = "1 minute", delay: str = "5 seconds") -> WriteBatch:
    """Write how many rows of each batch belong to windows that the batches before it have closed: what a windowed
    stream over the same batches drops. `time` is a zone-free time; rows without one are not late."""

    def write(batch: DataFrame, batch_id: int) -> None:
        label = batch_label("late", checkpoint, batch_id)
        before = table.changes().filter(F.col("batch") != label).agg(F.max("latest")).scalar()
        known = F.coalesce(time, F.lit("1970-01-01").cast("timestamp_ntz"))  # a window drops rows without a time
        rows = batch.select(F.col(time).alias("_time"), known.alias("_known"))
        rows = rows.select("_time", F.window("_known", window).getField("end").alias("_end"))
        late = F.col("_time").isNotNull() & F.coalesce(F.col("_end") <= before - F.expr(f"INTERVAL {delay}"), F.lit(False))
        found = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(late).alias("late_rows"), F.max("_time").alias("latest"))
        found = found.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "*", F.lit(0).alias("part"))
        table.write(found.select("*", F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("seq")), label)

    return write
