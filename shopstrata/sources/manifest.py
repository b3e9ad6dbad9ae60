"""What a stored table should hold, from the footers of its files, and whether it still does."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

# The footer reader travels to the executors by value, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "file_name string, expected long, least string, most string"


def _footer(path: str, key: str) -> tuple[int, str | None, str | None]:
    """Rows of a file and the range of its key, without a look at the rows."""
    store, place = fs.FileSystem.from_uri(path)
    about = pq.read_metadata(place, filesystem=store)
    column = about.schema.to_arrow_schema().get_field_index(key)
    found = [about.row_group(k).column(column).statistics for k in range(about.num_row_groups)]
    found = [s for s in found if s is not None and s.has_min_max]
    return about.num_rows, *(str(f(s)) if found else None for f, s in ((lambda x: min(y.min for y in x), found), (lambda x: max(y.max for y in x), found)))


def file_manifest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Each parquet file under `path` with its rows and the least and most of the whole number `key`, read from the footers in tasks.

    Take it when a copy is written and keep it elsewhere; `audit` holds a later state of the copy against it.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            rows, least, most = zip(*[_footer(path, key) for path in paths], strict=True) if paths else ([], [], [])
            names = [path.rsplit("/", 1)[1] for path in paths]
            columns = [pa.array(names, pa.string()), pa.array(rows, pa.int64()), pa.array(least, pa.string()), pa.array(most, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["file_name", "expected", "least", "most"])

    return files.load(path).select("path").mapInArrow(run, SCHEMA)


def audit(name: str, table: DataFrame, key: str, manifest: DataFrame) -> DataFrame:
    """One row: rows counted in `table` and expected, files that are lost, unknown or not as noted, and whether all is as noted.

    Rows are counted by decoding the key of every one, a file at a time; only one row a file is compared.
    """
    counted = table.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(key).cast("string").alias("_least"), F.max(key).cast("string").alias("_most")
    )
    both = counted.join(manifest, "file_name", "full_outer")
    same = F.col("row_count").eqNullSafe(F.col("expected")) & F.col("_least").eqNullSafe(F.col("least")) & F.col("_most").eqNullSafe(F.col("most"))
    empty = F.col("row_count").isNull() & (F.col("expected") == 0)  # a file without rows shows none
    return both.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"),
        F.count_if(~(same | empty)).alias("bad_files"),
    ).select(F.lit(name).alias("table_name"), "*", (F.col("bad_files") == 0).alias("ok"))
