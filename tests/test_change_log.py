"""A snapshot and its log as one stream: every change once, whatever was stopped or came later."""

from __future__ import annotations

import glob

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import as_set

from pyspark.sql.types import LongType, StringType, StructField, StructType

from shopstrata.plans import registry
from shopstrata.session import shared_dir
from shopstrata.sources.change_log import ChangeLogReader, change_rows, read_change_log
from shopstrata.streaming.hops import keyed_detail_hop
from shopstrata.streaming.keyed_table import KeyedTable
from shopstrata.streaming.runs import run_hop, start_hop, stop_hop, wait_for_batches

TABLE = StructType([StructField("id", LongType()), StructField("state", StringType())])
AS_OF = 10


def log_file(folder, name, *changes):
    (folder / "log").mkdir(parents=True, exist_ok=True)
    op, seq, id, state = map(list, zip(*changes, strict=True))
    pq.write_table(pa.table({"op": op, "seq": seq, "id": id, "state": pa.array(state, pa.string())}), folder / "log" / name)


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    (folder / "snapshot").mkdir(parents=True)
    for part in range(3):
        rows = {"id": [part * 2, part * 2 + 1], "state": ["old", "old"], "not_read": [1, 2]}
        pq.write_table(pa.table(rows), folder / "snapshot" / f"part-{part}.parquet")
    log_file(folder, "a.parquet", *[("c", n, n % 6, "older") for n in range(1, 9)])
    log_file(folder, "b.parquet", ("u", 9, 1, "older"), ("u", 10, 2, "older"), ("u", 11, 1, "new"), ("d", 12, 0, None))
    log_file(folder, "c.parquet", ("u", 13, 1, "newer"), ("c", 14, 9, "new"))
    return folder


def reader(folder, **options):
    return ChangeLogReader({"path": str(folder), "asof": str(AS_OF), **options}, change_rows(TABLE))


def rows_between(source, start, end):
    return [tuple(row.values()) for part in source.partitions(start, end) for batch in source.read(part) for row in batch.to_pylist()]


SNAPSHOT = {("c", AS_OF, id, "old") for id in range(6)}
LATER = {("u", 11, 1, "new"), ("d", 12, 0, None), ("u", 13, 1, "newer"), ("c", 14, 9, "new")}


def test_log_rows_of_the_snapshot_are_left_out(source):
    whole = reader(source)
    found = rows_between(whole, whole.initialOffset(), whole.latestOffset())
    assert set(found) == SNAPSHOT | LATER and len(found) == len(SNAPSHOT | LATER)


def test_bounded_batches_hold_every_change_once(source, tmp_path):
    bounded = reader(source, filesperbatch="2", progress=str(tmp_path / "progress"))
    at, found, sizes = bounded.initialOffset(), [], []
    while (end := bounded.latestOffset()) != at:
        rows = rows_between(bounded, at, end)
        bounded.commit(end)
        found, at = found + rows, end
        sizes.append(len(rows))
        if len(sizes) == 1:
            log_file(source, "d.parquet", ("u", 15, 9, "newest"))  # arrives on the way
        bounded = reader(source, filesperbatch="2", progress=str(tmp_path / "progress"))  # a new process for each batch
    assert sizes == [4, 4, 3]
    assert set(found) == SNAPSHOT | LATER | {("u", 15, 9, "newest")} and len(found) == 11


def test_a_note_that_lags_behind_is_stepped_over(source, tmp_path):
    """The batch before was finished, but its note was not written."""
    first = reader(source, filesperbatch="2", progress=str(tmp_path / "progress"))
    done = first.latestOffset()
    again = reader(source, filesperbatch="2", progress=str(tmp_path / "progress"))
    assert again.latestOffset() == done  # no news to Spark, so no batch
    assert again.latestOffset()["files"] == 3


def test_a_folder_without_a_log_or_snapshot(tmp_path):
    empty = reader(tmp_path)
    assert empty.latestOffset() == empty.initialOffset() == {"files": 0, "seq": AS_OF}
    assert empty.partitions(empty.initialOffset(), empty.latestOffset()) == []


def test_a_stopped_stream_resumes(spark, source, tmp_path):
    schema = StructType([*TABLE.fields, StructField("bucket", LongType())])
    table, checkpoint = KeyedTable(spark, str(tmp_path / "table"), schema, ["id"], "bucket"), str(tmp_path / "checkpoint")
    write = keyed_detail_hop(table, checkpoint, buckets=2)
    bounded = read_change_log(spark, str(source), TABLE, AS_OF, files_per_batch=1, progress=str(tmp_path / "progress"))
    started = start_hop(bounded, write, checkpoint, follow="0 seconds")
    wait_for_batches(started, 1)
    stop_hop(started, spark)
    log_file(source, "d.parquet", ("u", 15, 9, "newest"), ("d", 16, 2, None))
    run_hop(read_change_log(spark, str(source), TABLE, AS_OF), write, checkpoint)
    run_hop(read_change_log(spark, str(source), TABLE, AS_OF), write, checkpoint)
    assert as_set(table.snapshot(), "id", "state") == {(1, "newer"), (3, "old"), (4, "old"), (5, "old"), (9, "newest")}
    assert table.changes().count() == len(SNAPSHOT | LATER) + 2  # each change was written once


@pytest.mark.parametrize("name,rows", [("order", 8_000), ("refund", 4_000), ("payment", 1_500)])
def test_files_and_tasks_hold_no_more_rows_as_the_table_grows(spark, monkeypatch, name, rows):
    """Snapshot and log are cut by rows, also what one task sorts: four parts held a quarter of any table."""
    monkeypatch.setattr(registry, "FILE_ROWS", 200, raising=False)
    before = set(glob.glob(f"{shared_dir(spark)}/{name}-log-*"))
    result = registry.QUERIES[f"{name}_log_stream"](spark, "/root/testdata/sf0.001")
    (folder,) = set(glob.glob(f"{shared_dir(spark)}/{name}-log-*")) - before
    for kind in ("snapshot", "log"):
        sizes = [pq.read_metadata(file).num_rows for file in glob.glob(f"{folder}/in/{kind}/*.parquet")]
        assert max(sizes) <= 500 and len(sizes) >= 5, kind
    assert "REPARTITION_BY_NUM" in result._jdf.queryExecution().executedPlan().toString()
    assert result.rdd.getNumPartitions() >= rows // 400
