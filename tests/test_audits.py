"""Audits that can fail: damaged copies, lost numbers, late rows; and distinct counts merged from minutes."""

from __future__ import annotations

import os
import random

import pytest
from helpers import as_set, at, money

from pyspark.sql import functions as F

from test_retraction import read_rows

from shopstrata.operators import bitmaps, metrics, sequence
from shopstrata.plans import serving
from shopstrata.schemas import KEYED_TABLES
from shopstrata.sources import manifest
from shopstrata.streaming import replay
from shopstrata.streaming.keyed_table import KeyedTable
from shopstrata.streaming.runs import run_hop


@pytest.fixture
def copy(spark, tmp_path):
    path = str(tmp_path / "copy")
    spark.range(100).select("id", F.lit("x").alias("text")).repartitionByRange(4, "id").write.parquet(path)
    noted = manifest.file_manifest(spark, path, "id").toPandas()
    return path, spark.createDataFrame(noted, manifest.SCHEMA)


def parts(path):
    return sorted(f"{path}/{name}" for name in os.listdir(path) if name.endswith(".parquet"))


def audited(spark, path, noted):
    return manifest.audit("t", spark.read.schema("id bigint, text string").parquet(path), "id", noted).first()


def test_a_whole_copy_is_ok(spark, copy):
    path, noted = copy
    assert noted.count() == 4 and noted.agg(F.sum("expected")).first()[0] == 100
    assert tuple(audited(spark, path, noted)) == ("t", 100, 100, 0, True)


def test_a_removed_file_is_found(spark, copy):
    path, noted = copy
    os.remove(parts(path)[1])
    row = audited(spark, path, noted)
    assert not row.ok and row.bad_files == 1 and row.row_count < row.expected == 100


def test_a_file_with_other_rows_and_an_unknown_file_are_found(spark, copy):
    path, noted = copy
    other = str(path) + "-other"
    spark.range(25).select((F.col("id") + 1000).alias("id"), F.lit("x").alias("text")).coalesce(1).write.parquet(other)
    changed = parts(path)[0]
    rows = spark.read.parquet(changed).count()
    spark.read.parquet(other).limit(rows).coalesce(1).write.parquet(other + "-same")
    with open(parts(other + "-same")[0], "rb") as file, open(changed, "wb") as target:
        target.write(file.read())  # as many rows, other keys
    for name in os.listdir(path):
        if name.endswith(".crc"):
            os.remove(f"{path}/{name}")
    assert audited(spark, path, noted).bad_files == 1
    os.replace(parts(other)[0], f"{path}/part-unknown.parquet")
    assert audited(spark, path, noted).bad_files == 2


def test_lost_heads_and_inner_gaps(spark):
    rng = random.Random(6)
    numbers = sorted(rng.sample(range(3, 400), 120)) + [390, 395]
    df = spark.createDataFrame([(n,) for n in [*numbers, numbers[0], None, -5]], "n bigint")
    present, last = set(numbers), max(numbers)
    want, start = set(), None
    for n in range(last + 1):
        if n in present:
            if start is not None:
                want.add((start, n - 1, n - start))
            start = None
        elif start is None:
            start = n
    for chunk in (1_000_000, 7, 1):
        assert as_set(sequence.sequence_gaps(df, "n", chunk=chunk)) == want
    assert (0, numbers[0] - 1, numbers[0]) in want  # the head
    assert sequence.sequence_gaps(df.limit(0), "n").count() == 0


def test_days_merged_from_minutes_equal_a_distinct_count(spark):
    rng = random.Random(9)
    ids = [rng.choice([0, 5, 32_767, 32_768, 10**9, 2**40 + rng.randrange(50), rng.randrange(1000), None]) for _ in range(2000)]
    rows = spark.createDataFrame([(f"2026-09-0{1 + k % 3}", k % 60, id) for k, id in enumerate(ids)], "metric_date string, minute int, uid bigint")
    minutes = bitmaps.id_sets(rows, ["metric_date", "minute"], "uid")
    merged = bitmaps.set_sizes(bitmaps.merged(minutes, ["metric_date"]), ["metric_date"], "day_uv")
    want = {(row.metric_date, money(f"{row.n}.00")) for row in rows.groupBy("metric_date").agg(F.count_distinct("uid").alias("n")).collect()}
    assert as_set(merged, "metric_date", "metric_value") == want


PURCHASES = "id bigint, order_id bigint, user_id bigint, payment_amount decimal(16,2), payment_status string, create_time timestamp_ntz"


def test_rows_sorted_into_files_lose_no_window(spark, tmp_path):
    rng = random.Random(2)
    seconds = rng.sample(range(3600), 300)
    rows = [(k, k, k % 7, money("1.00"), "SUCCESS", at(f"2026-09-01 10:{s // 60:02d}:{s % 60:02d}")) for k, s in enumerate(seconds)]
    given = spark.createDataFrame(rows, PURCHASES)
    folder = str(tmp_path / "ordered")
    schema = replay.write_in_order(given, ["id"], ["create_time"], ["create_time", "id"], folder, 4)
    stream = replay.read_in_order(spark, folder, schema, str(tmp_path / "progress"))
    found, dropped = replay.run_batches_to_table(metrics.trade_minute(stream), "ordered")
    assert dropped == 0
    assert as_set(found) == as_set(metrics.closed_windows(metrics.trade_minute(given), given.agg(F.max("create_time"))))


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    table, checkpoint, source = replay.late_table(spark, str(tmp_path / "late")), str(tmp_path / "cp"), str(tmp_path / "in")
    write = replay.late_rows_hop(table, checkpoint, "t")
    batches = [["10:05:04"], ["10:03:59", "10:04:59", "10:09:00", None], ["10:07:00", "10:08:54", "10:08:55"]]
    for batch in batches:
        rows = [(at(f"2026-09-01 {t}") if t else None,) for t in batch]
        spark.createDataFrame(rows, "t timestamp_ntz").write.mode("append").parquet(source)
        run_hop(spark.readStream.schema("t timestamp_ntz").parquet(source), write, checkpoint)
    # 10:05:04 less 5 seconds closes what ends by 10:04:59, and 10:09:00 what ends by 10:08:55.
    assert as_set(table.snapshot(), "batch_id", "n_rows", "late_rows") == {(0, 1, 0), (1, 4, 1), (2, 3, 1)}


@pytest.mark.parametrize("days", [1, 3])
def test_panels_read_the_latest_days_alone(spark, tmp_path, days):
    table = KeyedTable(spark, str(tmp_path / "result"), *KEYED_TABLES["ads_traffic_day"])
    assert serving.published(table, days).count() == 0
    ids = F.col("id")
    rows = spark.range(3000).select(
        F.date_add(F.lit("2026-09-01").cast("date"), (ids % 30).cast("int")).alias("metric_date"), F.concat(F.lit("m"), ids).alias("metric_name"), F.lit("ALL").alias("dimension_key"),
        F.lit(1).cast("decimal(18,2)").alias("metric_value"), F.lit(None).cast("timestamp_ntz").alias("updated_at"), F.lit("u").alias("op"), F.lit(1).cast("bigint").alias("seq"),
    )
    table.write(rows, "all")
    shown, found = serving.published(table, days), {}
    read = read_rows(spark, lambda: found.update(n=shown.count()))
    assert found["n"] == read == 100 * days
    assert {str(row[0]) for row in shown.select("metric_date").distinct().collect()} == {f"2026-09-{30 - k}" for k in range(days)}
