"""Keep-earliest dedup of a stream, with state that expires."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shopstrata.operators.cleanse import dedup_earliest

# The state code travels to the executors by value, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY_MS = 24 * 60 * 60 * 1000
#: Groups of ids that share a state row.
GROUPS = 4096


def change_rows(schema: T.StructType) -> T.StructType:
    return T.StructType(
        schema.fields + [T.StructField("op", T.StringType()), T.StructField("seq", T.LongType())]
    )


def _earliest_in_chunk(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for chunk in chunks:
        yield chunk.sort_values("event_time_ms", kind="stable").drop_duplicates("event_id")


class KeepEarliest(StatefulProcessor):
    """Per id of a group: emit a change when the id is new or an earlier event of it arrives.

    A state row lists the ids of its group with the time and day kept and when that changed last. An id goes `ttl_ms` after its own
    last change, the row `ttl_ms` after the last change of any.
    """

    def __init__(self, schema: T.StructType, ttl_ms: int):
        self.columns, self.ttl_ms = schema.fieldNames(), ttl_ms
        kinds = {"event_id": schema["event_id"].dataType, "event_time_ms": T.LongType(), "biz_date": T.StringType(), "changed": T.LongType()}
        self.state = T.StructType([T.StructField(name, T.ArrayType(kind)) for name, kind in kinds.items()])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", self.state, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first: dict[object, Row] = {}
        for row in rows:
            if row.event_id not in first or row.event_time_ms < first[row.event_id].event_time_ms:
                first[row.event_id] = row
        now = timerValues.getCurrentProcessingTimeInMs()
        known = {id: rest for id, *rest in zip(*(self.kept.get() or ())) if rest[2] + self.ttl_ms > now}
        news = {id: row for id, row in first.items() if id not in known or row.event_time_ms < known[id][0]}
        if not news:
            return
        held = known | {id: (row.event_time_ms, row.biz_date, now) for id, row in news.items()}
        self.kept.update((list(held), *map(list, zip(*held.values()))))
        for id, row in news.items():
            values = {name: row[name] for name in self.columns}
            seq = -row.event_time_ms
            yield Row(**values, op="u" if id in known else "c", seq=seq)
            if id in known and known[id][1] != row.biz_date:
                yield Row(**{**values, "biz_date": known[id][1]}, op="d", seq=seq)

    def close(self) -> None:
        pass


def ttl_dedup(events: DataFrame, ttl_ms: int = DAY_MS, groups: int = GROUPS) -> DataFrame:
    """Change rows of the earliest event per `event_id`; an id that returns `ttl_ms` after its last change is new.

    Rows need event_id, event_time_ms and biz_date. `seq` is the negated event time, so "last change wins" in
    a keyed table means "earliest event wins", in any order of arrival; an earlier event on another day also
    deletes the row on the old day. Copies are first dropped within each record batch of a task, so an
    id with very many copies reaches its state as few rows.

    The state of ids lies in `groups` rows, by a hash of the id, so that a call of the state serves many ids. A batch reads
    and writes the whole rows its ids are in: with some hundred ids a row, large batches cost little an id, and small ones
    are not dear. The number stays for the life of a checkpoint.
    """
    reduced = events.mapInPandas(_earliest_in_chunk, events.schema)
    grouped = reduced.withColumn("_group", F.pmod(F.xxhash64("event_id"), F.lit(groups)))
    return grouped.groupBy("_group").transformWithState(
        KeepEarliest(events.schema, ttl_ms), change_rows(events.schema), "append", "processingTime"
    )


def earliest_changes(events: DataFrame) -> DataFrame:
    """Change rows of the earliest event per `event_id` and business day of a batch, without state.

    A keyed table keeps the earliest of all batches, as `seq` is the negated event time. Enough where the id is made
    from the day; a repeat, however late, changes nothing.
    """
    first = dedup_earliest(events, ["event_id", "biz_date"], ["event_time_ms"])
    return first.select("*", F.lit("u").alias("op"), (-F.col("event_time_ms")).alias("seq"))


def daily_dedup(events: DataFrame, event_time: str, delay: str = "24 hours") -> DataFrame:
    """Change rows of the earliest event per `event_id` and business day, without leaving the JVM.

    Enough where the id is made from the day. State goes `delay` behind the latest event time. Every batch
    emits the ids it touched; `seq` is the negated event time, so a keyed table keeps the earliest.
    """
    rest = [name for name in events.columns if name not in ("event_id", "biz_date", event_time)]
    kept = F.min_by(F.struct(*rest), "event_time_ms").alias("_row")
    earliest = (
        events.withWatermark(event_time, delay)
        .groupBy("event_id", "biz_date", F.window(event_time, "1 day"))
        .agg(kept)
    )
    row = earliest.select("event_id", "biz_date", "_row.*")
    return row.withColumn("op", F.lit("u")).withColumn("seq", -F.col("event_time_ms"))


def watermark_dedup(events: DataFrame, event_time: str, ttl: str = "24 hours") -> DataFrame:
    """Change rows of the distinct (id, time) pairs, without leaving the JVM; a pair is forgotten `ttl` behind the latest event time.

    For ids of any kind, into a table keyed by `event_id` alone: `seq` is the negated event time, so the earliest event of an id wins
    there in any order of arrival and on whatever day, and what comes again after `ttl` changes nothing.
    """
    kept = events.withWatermark(event_time, ttl).dropDuplicatesWithinWatermark(["event_id", "event_time_ms"])
    return kept.drop(event_time).withColumn("op", F.lit("u")).withColumn("seq", -F.col("event_time_ms"))


@contextmanager
def expiring_state(spark: SparkSession):
    """Settings for queries started inside whose state expires.

    Expiry needs the RocksDB store. Batches without data are off: state that expires by the clock asks for one
    after another, and a run over the present input would not end.
    """
    settings = {
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
