from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import Row, functions as F, types as T

from helpers import PAYMENT, as_set, at, metric_map, money, payment
from shopstrata import schemas
from shopstrata.operators import cleanse, metrics
from shopstrata.sources import readers
from shopstrata.streaming import dedup, hops
from shopstrata.streaming.dedup import expiring_state
from shopstrata.streaming.dimensions import CachedDimension
from shopstrata.streaming.keyed_table import KeyedTable, batch_label
from shopstrata.streaming.runs import late_rows, run_hop, run_to_table
from test_cleanse import BASE, event, write_lines

PAY = T.StructType(
    [schemas.PAYMENT_DETAIL[n] for n in ("id", "order_id", "user_id", "payment_amount", "payment_status", "create_time")]
    + [T.StructField("pay_date", T.DateType())]
)
RESULT = T.StructType(schemas.DAY_METRIC.fields + [T.StructField("updated_at", T.TimestampNTZType())])


def minute_stream(spark, folder):
    flat = cleanse.flatten_events(readers.read_events(spark, folder, streaming=True))
    return metrics.traffic_minute(flat)


def test_last_open_window_never_fires(spark, tmp_path):
    lines = [json.dumps(event(f"e{s}", BASE + s * 1000, uid=s % 90)) for s in range(2_000)]
    folder = write_lines(tmp_path / "in", lines)
    got = run_to_table(minute_stream(spark, folder), "t")
    pv = got.filter("metric_name = 'browse_pv'")
    assert pv.count() == 33
    assert pv.agg(F.sum("metric_value")).first()[0] == money("1980.00")
    batch = metrics.traffic_minute(cleanse.flatten_events(readers.read_events(spark, folder)))
    last = spark.sql(f"SELECT convert_timezone('UTC', 'Asia/Shanghai', CAST(timestamp_millis({BASE + 1999000}) AS timestamp_ntz)) AS t")
    assert as_set(metrics.closed_windows(batch, last)) == as_set(got)


@pytest.mark.parametrize("later_ms,closed", [(65_000, 1), (64_999, 0)])
def test_window_closes_five_seconds_after_its_end(spark, tmp_path, later_ms, closed):
    # The later event is no browse: it moves the watermark although the filter drops it.
    lines = [json.dumps(event("a", BASE + 1_000)), json.dumps(event("b", BASE + later_ms, action="click"))]
    got = run_to_table(minute_stream(spark, write_lines(tmp_path / "in", lines)), "t")
    assert got.filter("metric_name = 'browse_pv'").count() == closed


def test_late_rows_are_dropped_and_rows_of_a_batch_are_not(spark, tmp_path):
    folder, checkpoint, out = tmp_path / "in", str(tmp_path / "cp"), str(tmp_path / "out")

    def run(lines):
        write_lines(folder, [json.dumps(line) for line in lines])
        query = (
            minute_stream(spark, str(folder)).writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(out)
        )
        query.awaitTermination()
        return late_rows(query)

    assert run([event("a", BASE + 600_000), event("b", BASE + 1_000)]) == 0
    late = run([event("c", BASE + 2_000), event("d", BASE + 700_000)])
    assert late + run([event("e", BASE + 3_000), event("f", BASE + 900_000)]) > 0
    pv = spark.read.parquet(out).filter("metric_name = 'browse_pv'")
    assert as_set(pv, "window_start", "metric_value") == {
        (at("2026-09-01 08:00:00"), money("1.00")),
        (at("2026-09-01 08:10:00"), money("1.00")),
        (at("2026-09-01 08:11:00"), money("1.00")),
    }


def changes_df(spark, rows):
    """rows: (op, seq, payment, old payment time or None)"""
    schema = "op string, seq bigint, " + PAYMENT + ", before struct<create_time: timestamp_ntz>"
    return spark.createDataFrame([(op, seq, *row, (at(old),) if old else None) for op, seq, row, old in rows], schema)


@pytest.fixture
def chain(spark, tmp_path):
    """Detail, metric and result table with a function that sends a batch of changes through all hops."""
    detail = KeyedTable(spark, str(tmp_path / "detail"), PAY, ["id"], "pay_date")
    day = KeyedTable(spark, str(tmp_path / "day"), schemas.DAY_METRIC, schemas.DAY_KEY, "metric_date")
    result = KeyedTable(spark, str(tmp_path / "result"), RESULT, schemas.DAY_KEY, "metric_date")
    first = hops.detail_hop(detail, "cp0", time="create_time")

    def send(rows, batch_id):
        first(changes_df(spark, rows), batch_id)
        cp = [str(tmp_path / name) for name in ("cp1", "cp2")]
        compute = hops.day_metric_hop(detail, day, cp[0], metrics.payment_day, list(metrics.PAYMENT_DAY))
        run_hop(detail.stream(), compute, cp[0])
        run_hop(day.stream(), hops.publish_hop(day, result, cp[1]), cp[1])
        return {key: value for key, value in metric_map(result.snapshot()).items() if key[1] == "gmv"}

    send.detail, send.day, send.result = detail, day, result
    return send


D1, D2 = "2026-09-01", "2026-09-02"


def test_updates_moves_and_deletions_reach_the_result(chain):
    p1, p2 = payment(1, 10, 7, "5.00"), payment(2, 11, 8, "3.00")
    assert chain([("c", 1, p1, None), ("c", 2, p2, None)], 0) == {(D1, "gmv", "ALL"): money("8.00")}
    failed = payment(1, 10, 7, "5.00", status="FAILED")
    assert chain([("u", 3, failed, f"{D1} 10:00:00")], 1) == {(D1, "gmv", "ALL"): money("3.00")}
    moved = payment(2, 11, 8, "3.00", time=f"{D2} 09:00:00")
    assert chain([("u", 4, moved, f"{D1} 10:00:00")], 2) == {(D2, "gmv", "ALL"): money("3.00")}
    assert chain([("d", 5, moved, f"{D2} 09:00:00")], 3) == {}
    assert chain.result.snapshot().count() == 0
    back = payment(2, 11, 8, "4.00")
    assert chain([("c", 6, back, None)], 4) == {(D1, "gmv", "ALL"): money("4.00")}


def test_replay_changes_nothing_and_keeps_updated_at(chain):
    rows = [("c", 1, payment(1, 10, 7, "5.00"), None), ("u", 2, payment(1, 10, 7, "6.00"), f"{D1} 10:00:00")]
    chain(rows, 0)
    before = as_set(chain.result.snapshot())
    for batch_id in (0, 1, 2):
        chain(rows, batch_id)
        chain(rows[:1], batch_id + 10)
        assert as_set(chain.result.snapshot()) == before
    time.sleep(0.01)
    changed = payment(1, 10, 9, "7.00")
    chain([("u", 3, changed, f"{D1} 10:00:00")], 20)
    stamps = {row.metric_name: row.updated_at for row in chain.result.snapshot().collect()}
    old = {row[1]: row[4] for row in before}
    assert stamps["gmv"] > old["gmv"]
    assert stamps["payment_order_count"] == old["payment_order_count"]


def test_moves_without_old_images_are_looked_up(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), PAY, ["id"], "pay_date")
    write = hops.detail_hop(table, "cp", prepare=lambda df: df.drop("before"), time="create_time")
    write(changes_df(spark, [("c", 1, payment(1, 10, 7, "5.00"), None)]), 0)
    write(changes_df(spark, [("u", 2, payment(1, 10, 7, "5.00", time=f"{D2} 01:00:00"), None)]), 1)
    assert as_set(table.snapshot().select("id", F.col("pay_date").cast("string"))) == {(1, D2)}


def test_two_writers_share_a_metric_table(spark, tmp_path):
    day = KeyedTable(spark, str(tmp_path / "day"), schemas.DAY_METRIC, schemas.DAY_KEY, "metric_date")
    detail = KeyedTable(spark, str(tmp_path / "detail"), PAY, ["id"], "pay_date")
    orders = CachedDimension(lambda: spark.createDataFrame([(10, 1)], "id bigint, province_id bigint"))
    provinces = spark.createDataFrame([(1, "north")], "id bigint, name string")
    hops.detail_hop(detail, "cp", time="create_time")(changes_df(spark, [("c", 1, payment(1, 10, 7, "5.00"), None)]), 0)
    plain = hops.day_metric_hop(detail, day, "a", metrics.payment_day, list(metrics.PAYMENT_DAY))
    by_province = hops.day_metric_hop(
        detail, day, "b", lambda df: metrics.gmv_province(df, orders.get(), provinces), ["gmv_province"]
    )
    batch = detail.changes()
    for write in (plain, by_province, plain, by_province):
        write(batch, 0)
    assert set(metric_map(day.snapshot())) == {
        (D1, "gmv", "ALL"), (D1, "payment_order_count", "ALL"), (D1, "payment_user_count", "ALL"),
        (D1, "gmv_province", "north"),
    }


def test_compaction_keeps_the_rows(chain):
    p1, p2 = payment(1, 10, 7, "5.00"), payment(2, 11, 8, "3.00")
    chain([("c", 1, p1, None), ("c", 2, p2, None), ("d", 3, p2, f"{D1} 10:00:00")], 0)
    before = as_set(chain.detail.snapshot())
    chain.detail.compact("one")
    assert as_set(chain.detail.snapshot()) == before == as_set(
        chain.detail.changes().filter("kind = 'base' AND op <> 'd'").select(*chain.detail.columns)
    )


def test_reads_skip_what_a_base_covers(chain):
    p1, p2 = payment(1, 10, 7, "5.00"), payment(2, 11, 8, "3.00")
    table = chain.detail
    for batch in range(3):
        chain([("c", 2 * batch + 1, p1, None), ("c", 2 * batch + 2, p2, None)], batch)
    rows, files = as_set(table.snapshot()), len(table.changes().inputFiles())
    table.compact("one")
    read = table.changes().select("kind", "batch").distinct().collect()
    assert as_set(table.snapshot()) == rows and [tuple(row) for row in read] == [("base", "one")]
    table.compact("two")  # a base covers the one before it
    assert {row.batch for row in table.changes().select("batch").collect()} == {"two"}
    table.retire()
    assert as_set(table.snapshot()) == rows and len(table.changes().inputFiles()) < files
    chain([("d", 9, p2, f"{D1} 10:00:00")], 3)
    assert len(as_set(table.snapshot())) == len(rows) - 1
    table.compact("three")
    table.retire()
    assert len(as_set(table.snapshot())) == len(rows) - 1


def test_windows_are_written_once_and_replays_add_nothing(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "m"), schemas.MINUTE_METRIC, schemas.MINUTE_KEY, "metric_date")
    rows = spark.createDataFrame(
        [(at("2026-09-01").date(), at("2026-09-01 08:00:00"), "gmv", "ALL", money("1.00"))], schemas.MINUTE_METRIC
    )
    write = hops.window_metric_hop(table, "cp", "minute")
    write(rows, 0)
    write(rows, 0)
    write(rows, 1)
    assert as_set(table.snapshot()) == as_set(rows)
    assert table.changes().count() == 1


def test_minutes_follow_the_detail_table_in_any_order_of_arrival(spark, tmp_path):
    detail = KeyedTable(spark, str(tmp_path / "detail"), PAY, ["id"], "pay_date")
    minutes = KeyedTable(spark, str(tmp_path / "m"), schemas.MINUTE_METRIC, schemas.MINUTE_KEY, "metric_date")
    write = hops.detail_hop(detail, "cp0", time="create_time")
    cp = str(tmp_path / "cp")
    hop = hops.minute_metric_hop(detail, minutes, cp, metrics.trade_minute, F.col("create_time"))
    schema = "op string, seq bigint, " + PAYMENT

    def send(batch_id, *rows):
        write(spark.createDataFrame([(op, seq, *row) for op, seq, row in rows], schema), batch_id)
        run_hop(detail.stream(), hop, cp)
        return {(str(r.window_start)[5:16], r.metric_value) for r in minutes.snapshot().filter("metric_name = 'gmv'").collect()}

    def pay(id, time, status="SUCCESS", amount="1.00"):
        return payment(id, id, 7, amount, status, time)

    assert send(0, ("c", 1, pay(1, f"{D1} 10:00:30")), ("c", 1, pay(2, f"{D1} 10:05:00", "PENDING"))) == {("09-01 10:00", money("1.00"))}
    # Earlier than all before, and a payment that is confirmed by an update in the open minute.
    got = send(1, ("c", 1, pay(3, f"{D1} 09:00:00")), ("u", 2, pay(2, f"{D1} 10:05:00")))
    assert got == {("09-01 09:00", money("1.00")), ("09-01 10:00", money("1.00"))}
    # The next day closes the last minute, but not its own; a deletion without values empties a minute.
    got = send(2, ("c", 1, pay(4, f"{D2} 00:00:01")), ("d", 2, (1, None, None, None, None, None)))
    assert got == {("09-01 09:00", money("1.00")), ("09-01 10:05", money("1.00"))}
    got = send(3, ("c", 1, pay(5, "2026-09-03 08:00:00")))
    assert got == {("09-01 09:00", money("1.00")), ("09-01 10:05", money("1.00")), ("09-02 00:00", money("1.00"))}
    before = as_set(minutes.snapshot())
    hop(detail.changes(), 0), hop(detail.changes(), 3)
    assert as_set(minutes.snapshot()) == before


def flat_events(spark, folder):
    return cleanse.flatten_events(readers.read_events(spark, folder, streaming=True))


def run_dedup(spark, tmp_path, lines, ttl_ms):
    folder = write_lines(tmp_path / "in", [json.dumps(line) for line in lines])
    checkpoint, out = str(tmp_path / "cp"), str(tmp_path / "out")
    with expiring_state(spark):
        query = (
            dedup.ttl_dedup(flat_events(spark, folder), ttl_ms).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        )
        query.awaitTermination()
    return spark.read.parquet(out)


def test_earlier_event_in_a_later_batch_replaces_and_moves(spark, tmp_path):
    other_day = {**event("x", BASE + 1_000), "biz_date": "2026-08-31"}
    run_dedup(spark, tmp_path, [event("x", BASE + 9_000), event("x", BASE + 9_500)], dedup.DAY_MS)
    run_dedup(spark, tmp_path, [event("x", BASE + 10_000)], dedup.DAY_MS)
    got = run_dedup(spark, tmp_path, [other_day], dedup.DAY_MS)
    assert as_set(got, "event_time_ms", "biz_date", "op") == {
        (BASE + 9_000, "2026-09-01", "c"), (BASE + 1_000, "2026-08-31", "u"), (BASE + 1_000, "2026-09-01", "d"),
    }
    table = KeyedTable(spark, str(tmp_path / "t"), schemas.TRAFFIC_DETAIL, ["event_id"], "biz_date")
    table.write(got, "all")
    assert as_set(table.snapshot(), "event_id", "event_time_ms") == {("x", BASE + 1_000)}


def test_repeat_after_expiry_counts_as_new(spark, tmp_path):
    run_dedup(spark, tmp_path, [event("x", BASE)], ttl_ms=1_000)
    time.sleep(2)
    got = run_dedup(spark, tmp_path, [event("x", BASE + 5_000)], ttl_ms=1_000)
    assert as_set(got, "event_time_ms", "op") == {(BASE, "c"), (BASE + 5_000, "c")}


def test_daily_dedup_into_a_keyed_table(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), schemas.TRAFFIC_DETAIL, ["event_id"], "biz_date")
    checkpoint = str(tmp_path / "cp")
    write = hops.detail_hop(table, checkpoint, moves=False)
    for seconds in (9, 1, 5):
        folder = write_lines(tmp_path / "in", [json.dumps(event("x", BASE + seconds * 1000))])
        timed = flat_events(spark, folder).withColumn("event_time", F.timestamp_millis("event_time_ms"))
        run_hop(dedup.daily_dedup(timed, "event_time"), write, checkpoint, "update")
    assert as_set(table.snapshot(), "event_id", "event_time_ms") == {("x", BASE + 1_000)}


def test_dimension_cache_expires_and_has_a_size_bound(spark):
    now, reads = [0.0], []

    def read():
        reads.append(now[0])
        return spark.range(3)

    cached = CachedDimension(read, ttl_seconds=10, clock=lambda: now[0])
    assert cached.get() is cached.get()
    now[0] = 11
    cached.get()
    assert reads == [0.0, 11]


def test_batch_label_is_stable_per_checkpoint():
    assert batch_label("a", "x", 1) == batch_label("a", "x", 1) != batch_label("a", "y", 1)


def test_repeats_within_an_open_window_count_once_even_behind_the_watermark(spark, tmp_path):
    folder, checkpoint, out = tmp_path / "in", str(tmp_path / "cp"), str(tmp_path / "out")

    def run(lines):
        write_lines(folder, [json.dumps(line) for line in lines])
        minutes = metrics.traffic_minute(flat_events(spark, str(folder)), unique="event_id")
        minutes.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(
            out
        ).awaitTermination()

    run([event("a", BASE + 1_000), event("a", BASE + 1_000), event("b", BASE + 50_000)])
    run([event("a", BASE + 1_000)])
    run([event("a", BASE + 1_000), event("new", BASE + 2_000), event("z", BASE + 90_000)])
    pv = spark.read.parquet(out).filter("metric_name = 'browse_pv'")
    assert as_set(pv, "window_start", "metric_value") == {(at("2026-09-01 08:00:00"), money("3.00"))}


def test_deletion_without_an_after_image_removes_the_row(spark, tmp_path):
    """With the day before the change given, and with the day looked up in the table."""
    for name, old_day in (("given", F.lit("2026-09-01").cast("date")), ("looked-up", None)):
        table = KeyedTable(spark, str(tmp_path / name), PAY, ["id"], "pay_date")
        shape = table.changes().schema
        empty = spark.createDataFrame([], shape)

        def row(op, seq, day, empty=empty):
            values = {"id": 1, "op": op, "seq": seq, "pay_date": day}
            columns = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in empty.schema]
            return spark.range(1).select(*columns)

        table.write(row("c", 1, "2026-09-01"), "a")
        table.write(table.route(row("d", 2, None), old_day), "b")
        assert table.snapshot().count() == 0
        assert table.changes().filter("pay_date IS NULL").count() == 0


class FakeState:
    """One state row in place of Spark's, and a clock."""

    def __init__(self):
        self.row, self.now, self.updates = None, 0, 0

    def getValueState(self, name, schema, ttlDurationMs):
        return self

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def get(self):
        return self.row

    def update(self, row):
        self.row, self.updates = row, self.updates + 1


def test_ids_that_share_a_state_row_expire_by_their_own_last_change():
    schema = T.StructType.fromDDL("event_id string, event_time_ms bigint, biz_date string")
    state, processor = FakeState(), dedup.KeepEarliest(schema, 1_000)
    processor.init(state)

    def send(now, *events):
        state.now = now
        rows = [Row(event_id=id, event_time_ms=time, biz_date=day) for id, time, day in events]
        return [tuple(row[name] for name in ("event_id", "event_time_ms", "biz_date", "op")) for row in processor.handleInputRows((0,), iter(rows), state)]

    assert send(0, ("a", 5, "1"), ("a", 4, "1"), ("b", 7, "1")) == [("a", 4, "1", "c"), ("b", 7, "1", "c")]
    assert send(400, ("a", 9, "1")) == [] and state.updates == 1  # no change, and a stays as old as it is
    assert send(600, ("b", 3, "0")) == [("b", 3, "0", "u"), ("b", 3, "1", "d")]
    assert send(1_000, ("a", 9, "1"), ("b", 8, "1"), (None, 1, "1")) == [("a", 9, "1", "c"), (None, 1, "1", "c")]
    assert send(1_700, ("c", 1, "1")) == [("c", 1, "1", "c")]
    assert set(state.row[0]) == {"a", None, "c"}  # b is gone from the row


def test_state_rows_are_no_more_than_groups(spark, tmp_path):
    folder = write_lines(tmp_path / "in", [json.dumps(event(f"id{k}", BASE + k)) for k in range(300)])
    with expiring_state(spark):
        query = (
            dedup.ttl_dedup(flat_events(spark, folder), groups=10).writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
        )
        query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 300
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 10
