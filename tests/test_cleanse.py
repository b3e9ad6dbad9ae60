from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F, types as T

from helpers import as_set, at
from shopstrata import schemas
from shopstrata.functions import times
from shopstrata.functions.event_keys import event_id
from shopstrata.operators import cleanse
from shopstrata.sources import readers

BASE = 1788220800000  # 2026-09-01 08:00:00 in Asia/Shanghai


def event(eid="e1", ms=BASE, uid=7, action="browse", item=None):
    return {
        "common": {"uid": uid, "platform": "app", "province_id": 3, "ts": "2026-09-01 08:00:00"},
        "page": {"page_id": "home"},
        "action": {"action_id": action, "item": item},
        "ts": "2026-09-01 08:00:00",
        "event_id": eid,
        "event_time_ms": ms,
        "biz_date": "2026-09-01",
        "source_timezone": "Asia/Shanghai",
    }


def write_lines(folder, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"part-{len(list(folder.iterdir()))}.json").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_earliest_event_is_kept_whatever_the_arrival(spark, tmp_path):
    lines = [json.dumps(event(ms=BASE + s * 1000)) for s in (9, 1, 5)]
    flat = cleanse.flatten_events(readers.read_events(spark, write_lines(tmp_path / "in", lines)))
    kept = cleanse.dedup_earliest(flat, ["event_id"], ["event_time_ms"])
    assert [row.event_time_ms for row in kept.collect()] == [BASE + 1000]
    assert kept.columns == schemas.TRAFFIC_DETAIL.fieldNames()


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(10_000).select(F.when(F.col("id") >= 0, "hot").alias("k"), "id")
    kept = cleanse.latest_per_key(df, ["k"], ["id"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_shuffle
    assert as_set(kept) == {("hot", 9999)}


def test_malformed_lines_fail_or_are_set_aside(spark, tmp_path):
    path = write_lines(tmp_path / "in", [json.dumps(event()), "{not json"])
    with pytest.raises(Exception):
        readers.read_events(spark, path).collect()
    good, bad = readers.quarantine(readers.read_events(spark, path, tolerant=True).cache())
    assert [row.event_id for row in good.collect()] == ["e1"]
    assert [row[0] for row in bad.collect()] == ["{not json"]


def test_keyed_records_decode_and_missing_values_delete(spark):
    key = T.StructType([schemas.PAYMENT_DETAIL["id"]])
    value = T.StructType([schemas.PAYMENT_DETAIL[name] for name in ("id", "payment_amount")])
    records = spark.createDataFrame(
        [('{"id":1}', '{"id":1,"payment_amount":2.50}', 0), ('{"id":1}', None, 1)], "key string, value string, offset long"
    )
    got = readers.decode_keyed(records, key, value)
    assert [(r.op, r.seq, r.id, str(r.payment_amount)) for r in got.orderBy("seq").collect()] == [
        ("u", 0, 1, "2.50"),
        ("d", 1, 1, "None"),
    ]


def test_business_day_turns_at_shanghai_midnight(spark):
    df = spark.createDataFrame([(at("2026-09-01 23:59:59"),), (at("2026-09-02 00:00:00"),)], "ts timestamp_ntz")
    ms = times.local_to_epoch_ms(F.col("ts"))
    got = df.select(ms.alias("ms"), times.biz_date(ms).cast("string").alias("day")).collect()
    assert [row.day for row in got] == ["2026-09-01", "2026-09-02"]
    assert got[1].ms == BASE + 16 * 3600 * 1000


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_time_rules_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on this day.
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:05.123456' AS ts")
        ms = times.local_to_epoch_ms(F.col("ts"))
        row = df.select(
            ms.alias("ms"),
            times.to_precision(F.col("ts"), "MILLISECOND").cast("string").alias("milli"),
            times.to_precision(F.col("ts"), "SECOND").cast("string").alias("second"),
            times.shift_zone(F.col("ts")).cast("string").alias("utc"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.ms == 1710009005123
    assert (row.milli, row.second) == ("2024-03-10 02:30:05.123", "2024-03-10 02:30:05")
    assert row.utc == "2024-03-09 18:30:05.123456"


def test_event_id_counts_a_missing_item_as_none(spark):
    df = spark.sql("SELECT '2026-09-01' d, 0 s, 100515 u, '2026-09-01 08:00:05' t, 'browse' a, 'home' p, CAST(NULL AS BIGINT) i")
    got = df.select(event_id(*[F.col(name) for name in "dsutapi"])).first()[0]
    import hashlib

    assert got == hashlib.md5(b"2026-09-01|0|100515|2026-09-01 08:00:05|browse|home|None").hexdigest()


def test_change_rows_read_with_old_images(spark, tmp_path):
    row = {"op": "u", "seq": 2, "id": 5, "payment_amount": 1.25, "before": {"id": 5, "payment_amount": 1.00}}
    got = readers.read_changes(spark, write_lines(tmp_path / "in", [json.dumps(row)]), schemas.PAYMENT_INFO).first()
    assert (got.op, got.seq, str(got.payment_amount), str(got.before.payment_amount)) == ("u", 2, "1.25", "1.00")


def test_business_tables_read_in_their_schema(spark, tmp_path):
    rows = spark.createDataFrame([(1, "north", 2, "10")], schemas.PROVINCE)
    rows.write.parquet(str(tmp_path / "base_province"))
    got = readers.read_business(spark, str(tmp_path), "base_province")
    assert got.schema == schemas.PROVINCE and as_set(got) == {(1, "north", 2, "10")}
