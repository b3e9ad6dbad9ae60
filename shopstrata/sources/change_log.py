"""A table's snapshot followed by its change log, as one stream of change rows.

The snapshot is the table as of a sequence number; the log holds change rows (op, seq, columns) in rising order. Every
snapshot row comes as a 'c' with the number it is as of, then every log row above that number, each once: a row of the log
that the snapshot already holds is left out, and none is missed in between.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

# The reader travels to the executors by value, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "change_log"


def change_rows(table: StructType) -> StructType:
    return StructType([StructField("op", StringType()), StructField("seq", LongType()), *table.fields])


@dataclass
class Part(InputPartition):
    """A file: one of the snapshot, or log rows of it with `low` < seq <= `high`."""

    file: str
    low: int
    high: int
    snapshot: bool


class ChangeLogReader(DataSourceStreamReader):
    """Offsets are {"files": snapshot files read, "seq": last number read}.

    Spark asks for the latest offset without telling where it is, so a reader with bounded batches notes each finished
    batch in the folder `progress`. The note may lag behind by the batch that a crash cut off; the same step from there leads to
    the same offset or beyond, and an offset that leads to no batch is stepped over.
    """

    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        self.root, self.as_of = options["path"].rstrip("/"), int(options["asof"])
        self.most = int(options.get("filesperbatch", 0)) or None
        self.progress = options["progress"].rstrip("/") if self.most else None
        self.schema = schema
        self.at: dict | None = None
        self.offered: dict | None = None
        self.ranges: dict[str, tuple[int, int]] = {}

    @staticmethod
    def _store(where: str) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(where) if "://" in where or where.startswith("file:") else (fs.LocalFileSystem(), where)

    def _files(self, folder: str) -> list[str]:
        store, where = self._store(f"{self.root}/{folder}")
        found = store.get_file_info(fs.FileSelector(where, allow_not_found=True))
        return sorted(file.path for file in found if file.base_name.endswith(".parquet"))

    def _log(self) -> list[tuple[int, int, str]]:
        """First and last number of each log file, in order. A file's footer is read once."""
        store, _ = self._store(self.root)
        for file in self._files("log"):
            if file not in self.ranges:
                about = pq.read_metadata(file, filesystem=store)
                column = about.schema.to_arrow_schema().get_field_index("seq")
                groups = [about.row_group(k).column(column).statistics for k in range(about.num_row_groups) if about.row_group(k).num_rows]
                self.ranges[file] = (min(g.min for g in groups), max(g.max for g in groups)) if groups else (0, 0)
        return sorted((first, last, file) for file, (first, last) in self.ranges.items() if last > self.as_of)

    def initialOffset(self) -> dict:
        return {"files": 0, "seq": self.as_of}

    def _noted(self) -> dict | None:
        store, where = self._store(f"{self.progress}/offset.json")
        if store.get_file_info(where).type == fs.FileType.NotFound:
            return None
        with store.open_input_file(where) as file:
            return json.loads(file.read())

    def latestOffset(self) -> dict:
        snapshot, log = len(self._files("snapshot")), self._log()
        if self.most is None:
            return {"files": snapshot, "seq": max([self.as_of, *(high for _, high, _ in log)])}
        self.at = self.offered or self.at or self._noted() or self.initialOffset()
        files = min(snapshot, self.at["files"] + self.most)
        room = self.most - (files - self.at["files"])
        ahead = [high for _, high, _ in log if high > self.at["seq"]][:room]
        self.offered = {"files": files, "seq": max(ahead) if files == snapshot and ahead else self.at["seq"]}
        return self.offered

    def partitions(self, start: dict, end: dict) -> list[Part]:
        self.at, self.offered = end, None
        low, high = start["seq"], end["seq"]
        files = self._files("snapshot")[start["files"] : end["files"]]
        log = [file for first, last, file in self._log() if last > low and first <= high]
        return [*(Part(file, 0, 0, True) for file in files), *(Part(file, low, high, False) for file in log)]

    def commit(self, end: dict) -> None:
        if self.progress:
            store, where = self._store(self.progress)
            store.create_dir(where)
            with store.open_output_stream(f"{where}/offset.json") as file:
                file.write(json.dumps(end).encode())

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        store, _ = self._store(self.root)
        target = to_arrow_schema(self.schema)
        names = [name for name in target.names if not partition.snapshot or name not in ("op", "seq")]
        with store.open_input_file(partition.file) as opened:
            for batch in pq.ParquetFile(opened).iter_batches(10_000, columns=names):
                rows = pa.table(batch)
                if partition.snapshot:
                    rows = rows.append_column("op", pa.array(["c"]).take(pa.array([0] * len(rows), pa.int32())))
                    rows = rows.append_column("seq", pa.array([self.as_of] * len(rows), pa.int64()))
                else:
                    seq = rows["seq"]
                    rows = rows.filter(pc.and_(pc.greater(seq, partition.low), pc.less_equal(seq, partition.high)))
                yield from rows.select(target.names).cast(target).to_batches()


class ChangeLog(DataSource):
    """Options: `path`, a folder with the folders snapshot and log of parquet files; `asOf`, the number the snapshot is as of;
    `filesPerBatch`, by default all there are, and with it `progress`, a folder of the query's own. The schema is the table's with op and seq."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: StructType) -> ChangeLogReader:
        return ChangeLogReader(dict(self.options), schema)


def read_change_log(
    spark: SparkSession, path: str, table: StructType, as_of: int, files_per_batch: int | None = None, progress: str | None = None
) -> DataFrame:
    """The stream of change rows. Log files hold rising ranges of numbers, and appear whole."""
    spark.dataSource.register(ChangeLog)
    reader = spark.readStream.format(NAME).schema(change_rows(table)).option("path", path).option("asOf", as_of)
    if files_per_batch:
        reader = reader.option("filesPerBatch", files_per_batch).option("progress", progress)
    return reader.load()
