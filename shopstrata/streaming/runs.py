"""Running a stream to the end of its input."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shopstrata.session import run_dir


def start_hop(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    follow: str | None = None,
) -> StreamingQuery:
    """Start one hop between layers. `follow` is a trigger interval; without it all present input is processed once."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    writer = writer.trigger(processingTime=follow) if follow else writer.trigger(availableNow=True)
    return writer.start()


def run_hop(stream: DataFrame, write_batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run one hop over its present input."""
    start_hop(stream, write_batch, checkpoint, mode).awaitTermination()


def wait_for_batches(query: StreamingQuery, batches: int, seconds: float = 120) -> None:
    """Until a query has finished so many batches that had rows, or has no more input."""
    until = time.monotonic() + seconds
    while query.isActive and time.monotonic() < until:
        if sum(step["numInputRows"] > 0 for step in query.recentProgress) >= batches:
            return
        time.sleep(0.05)
    if query.exception():
        raise query.exception()


def stop_hop(query: StreamingQuery, spark: SparkSession, seconds: float = 60) -> None:
    """Stop a query on the way, and wait until the jobs of its cut-off batch are over too.

    Stopping does not wait for them, and a cancelled write clears its folder: it must not meet the write of the batch's next try.
    """
    query.stop()
    until, quiet = time.monotonic() + seconds, 0
    while quiet < 10 and time.monotonic() < until:
        quiet = 0 if spark.sparkContext.statusTracker().getActiveJobsIds() else quiet + 1
        time.sleep(0.05)


def late_rows(query: StreamingQuery) -> int:
    """Rows a stream dropped behind its watermark, in the batches whose progress the session still keeps."""
    return sum(step["numRowsDroppedByWatermark"] for batch in query.recentProgress for step in batch["stateOperators"])


def run_to_table(stream: DataFrame, purpose: str) -> DataFrame:
    """Run an append stream over its present input into a new parquet table of the shared folder; return the table."""
    spark = stream.sparkSession
    folder = run_dir(spark, purpose)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/table")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")
