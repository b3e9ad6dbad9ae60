from __future__ import annotations

import random

from pyspark.sql import functions as F

from helpers import as_set, at, money
from shopstrata.operators import changes, quality, sequence
from shopstrata.plans import serving
from shopstrata.sources.database import merge_statement


def test_partial_upsert_leaves_other_columns(spark):
    schema = "id bigint, status string, create_time timestamp_ntz"
    target = spark.createDataFrame([(1, "UNPAID", at("2026-09-01 08:00:00")), (2, "UNPAID", None)], schema)
    given = spark.createDataFrame([(1, "PAID", at("2026-09-09 00:00:00")), (3, None, at("2026-09-02 00:00:00"))], schema)
    got = as_set(changes.upsert(target, given, ["id"], ["status"]))
    assert got == {
        (1, "PAID", at("2026-09-01 08:00:00")),
        (2, "UNPAID", None),
        (3, None, at("2026-09-02 00:00:00")),
    }
    assert as_set(changes.upsert(changes.upsert(target, given, ["id"], ["status"]), given, ["id"], ["status"])) == got


def test_upsert_may_set_null(spark):
    schema = "id bigint, status string"
    target, given = spark.createDataFrame([(1, "PAID")], schema), spark.createDataFrame([(1, None)], schema)
    assert as_set(changes.upsert(target, given, ["id"])) == {(1, None)}


def test_update_by_key_ignores_unknown_keys(spark):
    target = spark.createDataFrame([(1, "PAID", "x"), (2, "PAID", "y")], "id bigint, status string, note string")
    updates = spark.createDataFrame([(1, "REFUNDED"), (9, "REFUNDED")], "id bigint, status string")
    assert as_set(changes.update_by_key(target, updates, ["id"])) == {(1, "REFUNDED", "x"), (2, "PAID", "y")}


def test_changes_in_any_order_and_repeated(spark):
    log = [("c", 1, 5, "a"), ("u", 2, 5, "b"), ("c", 1, 6, "a"), ("d", 2, 6, "a"), ("c", 1, 7, "z")]
    random.Random(1).shuffle(log)
    df = spark.createDataFrame(log * 3, "op string, seq bigint, id bigint, v string")
    assert as_set(changes.apply_changes(df, ["id"])) == {(5, "b"), (7, "z")}


def test_publish_truncates_and_defaults(spark):
    rows = [(at("2026-09-01 08:00:00.999"), None, money("1.00"))]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, dimension_key string, metric_value decimal(18,2)")
    assert as_set(changes.publish(df)) == {(at("2026-09-01 08:00:00"), "ALL", money("1.00"))}


def test_resequence_numbers_rows_in_time_order(spark):
    rng = random.Random(5)
    # A third of the rows share one time.
    rows = [(i % 400, i, 1_000 if i % 3 == 0 else rng.randrange(2_000)) for i in range(1_000)]
    df = spark.createDataFrame(rows, "id bigint, seq bigint, t bigint")
    got = sequence.resequence(df, ["id"], ["seq"], ["t", "id"], partitions=5)
    latest = {}
    for row in rows:
        latest[row[0]] = row
    want = sorted(latest.values(), key=lambda row: (row[2], row[0]))
    assert [tuple(row)[:3] for row in got.orderBy("position").collect()] == want
    assert sorted(row.position for row in got.collect()) == list(range(1, 401))


def test_time_order_check_across_chunks(spark):
    rng = random.Random(9)
    times = [rng.randrange(50) for _ in range(97)]
    df = spark.createDataFrame(list(enumerate(times)), "n bigint, t bigint")
    steps = sum(b < a for a, b in zip(times, times[1:]))
    behind = sum(t < max(times[:i], default=t) for i, t in enumerate(times))
    for chunk in (5, 10, 1000):
        row = sequence.time_order_check(df, "n", "t", chunk=chunk).first()
        assert tuple(row) == (97, steps, behind)


def test_time_order_check_with_missing_times(spark):
    df = spark.createDataFrame(list(enumerate([9, 8, None, 7, 6, None, 5, 9])), "n bigint, t bigint")
    for chunk in (2, 3, 4, 100):
        assert tuple(sequence.time_order_check(df, "n", "t", chunk=chunk).first()) == (8, 2, 4)


def test_reconcile_reports_each_kind(spark):
    schema = "k bigint, metric_value decimal(18,2)"
    left = spark.createDataFrame([(1, money("1.00")), (2, money("2.00")), (3, None), (5, None)], schema)
    right = spark.createDataFrame([(1, money("1.00")), (2, money("2.01")), (4, money("4.00")), (5, None)], schema)
    assert as_set(quality.reconcile(left, right, ["k"]), "k", "status") == {(2, "diff"), (3, "extra"), (4, "missing")}


def test_sentinel_and_manifest(spark):
    full = spark.range(3)
    tables = {"ok": (full, "id"), "none": (full.filter("id < 0"), "id"), "cut": (full.filter("id > 0"), "id")}
    assert as_set(quality.empty_source_sentinel(tables), "table_name", "state") == {
        ("ok", "ok"), ("none", "empty"), ("cut", "truncated"),
    }
    manifest = spark.createDataFrame([("a", 3), ("b", 4), ("gone", 1)], "table_name string, expected bigint")
    got = quality.manifest_check({"a": full, "b": full, "new": full}, manifest)
    assert as_set(got, "table_name", "ok") == {("a", True), ("b", False), ("gone", False), ("new", False)}


def test_orphans_count_missing_keys_and_hits_count_pairs(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk bigint")
    parent = spark.createDataFrame([(1,), (1,)], "id bigint")
    assert as_set(quality.orphans("c", child, "fk", parent)) == {("c", 2)}
    assert as_set(quality.join_hits("c", child, "fk", parent)) == {("c", 4)}


def test_content_hash_ignores_order_only(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "n bigint, s string")
    b = spark.createDataFrame([(2, None), (1, "x")], "n bigint, s string")
    c = spark.createDataFrame([(2, ""), (1, "x")], "n bigint, s string")
    assert as_set(quality.content_hash(a)) == as_set(quality.content_hash(b)) != as_set(quality.content_hash(c))


def test_series_range_and_recent_days(spark):
    minutes = spark.createDataFrame(
        [(at(f"2026-09-01 08:0{m}:00"), "gmv", money("1.00")) for m in range(5)],
        "window_start timestamp_ntz, metric_name string, metric_value decimal(18,2)",
    )
    shown = serving.minute_series(minutes, ["gmv"], "2026-09-01 08:01:00", "2026-09-01 08:03:00")
    assert [row.time for row in shown.collect()] == [at(f"2026-09-01 00:0{m}:00") for m in (1, 2, 3)]

    def table(last):
        return spark.range(10).select(
            F.date_sub(F.lit(last).cast("date"), F.col("id").cast("int")).alias("metric_date"),
            F.lit("gmv").alias("metric_name"), F.lit("ALL").alias("dimension_key"),
            F.lit("1.00").cast("decimal(18,2)").alias("metric_value"),
        )

    got = [str(row.metric_date) for row in serving.recent_detail(table("2026-09-10"), table("2026-01-04")).collect()]
    assert got == ["2026-09-10", "2026-09-09", "2026-09-08", "2026-09-07", "2026-01-04", "2026-01-03", "2026-01-02", "2026-01-01"]


def test_merge_statement_updates_only_values():
    assert merge_statement("t", "s", ["k", "v"], ["k"]) == (
        "INSERT INTO t (k, v) SELECT k, v FROM s ON DUPLICATE KEY UPDATE v = VALUES(v)"
    )


def test_partial_upserts_merge_column_by_column(spark):
    log = spark.createDataFrame(
        [
            (1, 3, "late", 30, ["status"]),
            (1, 1, "new", 10, ["status", "amount"]),
            (1, 2, "lost", 20, ["amount"]),
            (1, 4, None, 40, []),
            (2, 7, None, 5, ["amount"]),  # the first of its key inserts all it holds
            (3, 1, "a", 1, ["status"]),
            (3, 2, None, None, ["status", "amount"]),  # sets nulls
            (4, 5, "x", 2, None),
            (4, 6, "y", 3, None),
        ],
        "id int, seq int, status string, amount int, mask array<string>",
    )
    want = {(1, "late", 20), (2, None, 5), (3, None, None), (4, "x", 2)}
    assert as_set(changes.merge_partial(log, ["id"], ["status", "amount"])) == want
    assert changes.merge_partial(log.limit(0), ["id"], ["status", "amount"]).count() == 0
