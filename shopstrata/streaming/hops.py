"""The hops between layers, each a function for `foreachBatch`.

Raw changes -> detail tables -> metric tables -> result tables. Hops are separate streaming queries with separate
checkpoints; the keyed tables between them are the only thing they share.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from shopstrata.operators.changes import publish
from shopstrata.operators.metrics import closed_windows
from shopstrata.streaming.keyed_table import KeyedTable, batch_label, touched_days

WriteBatch = Callable[[DataFrame, int], None]


def _dates(days: Sequence) -> list[date]:
    """Days as dates; the traffic detail keeps its business day as text."""
    return [day if isinstance(day, date) else date.fromisoformat(day) for day in days]


def detail_hop(
    table: KeyedTable,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda changes: changes,
    time: str | None = None,
    moves: bool = True,
) -> WriteBatch:
    """Write change rows to a detail table.

    `prepare` turns raw columns into detail columns and keeps op, seq and, where present, `before`. `time` is the
    column whose date is the table's day. Old days come from the `before` image of a change when there is
    one. `moves=False` states that a key never changes its day.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch)
        if time is not None:
            rows = rows.withColumn(table.day, F.to_date(time))
        if moves:
            old_day = F.to_date(f"before.{time}") if "before" in rows.columns else None
            rows = table.route(rows, old_day)
        table.write(rows, batch_label("detail", checkpoint, batch_id))

    return write


def keyed_detail_hop(
    table: KeyedTable, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda changes: changes, buckets: int = 8
) -> WriteBatch:
    """Write change rows to a detail table that lies in folders by a hash of its key, its column `bucket`.

    A key never leaves its folder, so no change needs an old image or a look at the table, whatever it changes.
    """
    bucket = F.pmod(F.xxhash64(*table.keys), F.lit(buckets)).cast("int")

    def write(batch: DataFrame, batch_id: int) -> None:
        table.write(prepare(batch).withColumn(table.day, bucket), batch_label("keyed", checkpoint, batch_id))

    return write


def day_metric_hop(
    detail: KeyedTable,
    result: KeyedTable,
    checkpoint: str,
    compute: Callable[[DataFrame], DataFrame],
    names: Sequence[str],
) -> WriteBatch:
    """On changes of a detail table, recompute the metrics of the days they touch from the detail rows.

    Updates, deletions and moves between days need no signed sums: a touched day is computed anew, and a metric
    whose rows are gone is deleted. `names` are the metrics `compute` yields; others in the same result table
    are left alone. Cost is bounded by the touched days.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        days = touched_days(batch, detail.day)
        if not days:
            return
        fresh = compute(detail.snapshot(F.col(detail.day).isin(days)))
        label = batch_label(names[0], checkpoint, batch_id)
        result.upsert(fresh, label, _dates(days), F.col("metric_name").isin(*names))

    return write


def _with_open_days(touched: Sequence, known: Sequence, done: Sequence[date]) -> list:
    """The touched days, and before each that has no closed window yet the days whose last windows it may close."""
    closed, found = set(done), set(touched)
    for day in touched:
        if _dates([day])[0] in closed:
            continue
        for earlier in sorted((other for other in known if other < day), reverse=True):
            if earlier in touched:
                break
            found.add(earlier)
            if _dates([earlier])[0] in closed:
                break
    return sorted(found)


def minute_metric_hop(
    detail: KeyedTable, result: KeyedTable, checkpoint: str, compute: Callable[[DataFrame], DataFrame], time: Column
) -> WriteBatch:
    """On changes of a detail table, recompute the closed minutes of the days they touch from the detail rows.

    Rows may arrive in any order: a late, updated or deleted row corrects its minute, and none is dropped. A window
    is closed by the latest `time` (wall time, on the row's day) the table has been sent, so the last one
    stays open. Cost is bounded by the touched days.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        touched = touched_days(batch, detail.day)
        if not touched:
            return
        label = batch_label("minute", checkpoint, batch_id)
        known = touched_days(detail.changes(), detail.day)
        done = touched_days(result.changes().filter(F.col("batch") != label), result.day)
        days = _with_open_days(touched, known, done)
        latest = detail.changes().filter(F.col(detail.day) == max(known)).agg(F.max(time))
        minutes = compute(detail.snapshot(F.col(detail.day).isin(days)))
        result.upsert(closed_windows(minutes, latest), label, _dates(days), F.lit(True))

    return write


def window_metric_hop(result: KeyedTable, checkpoint: str, name: str) -> WriteBatch:
    """Write closed windows of an append stream whose rows come about in time order; `late_rows` counts the others."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # Kept for two uses, so that the stream's state is not gone through twice.
        windows = batch.persist()
        try:
            days = touched_days(windows, result.day)
            if days:
                result.upsert(windows, batch_label(name, checkpoint, batch_id), days)
        finally:
            windows.unpersist()

    return write


def publish_hop(metrics: KeyedTable, result: KeyedTable, checkpoint: str) -> WriteBatch:
    """Copy the touched days of a metric table to its result table. Nothing is computed and no state is kept."""

    def write(batch: DataFrame, batch_id: int) -> None:
        days = touched_days(batch, metrics.day)
        if not days:
            return
        rows = publish(metrics.snapshot(F.col(metrics.day).isin(days)))
        result.upsert(rows, batch_label("publish", checkpoint, batch_id), days, F.lit(True))

    return write
