"""What the operators share: row packing, written intermediate tables, text as bytes, held-out rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopstrata.session import run_dir

#: The bytes that count as white space: [\x20\x09-\x0D].
WHITE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """The row as one struct column, so that no column of an operator can clash with a column of its input."""
    return F.struct(*[F.col(f"`{name}`") for name in (columns if columns is not None else df.columns)]).alias("row")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a table in the shared folder: computed once, and safe when an executor is lost later."""
    folder = run_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; null counts as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def non_empty(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch for batch in batches if batch.num_rows)


def held_out(id: str) -> Column:
    """True for the rows no label may be learnt from: crc32 of the id as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id: str, text: str, most: int) -> DataFrame:
    """About `most` labelled rows (all of them if there are fewer) as columns id, text, label; never held-out ones.

    Rows are chosen by a hash of their id. The chosen ids, bounded by `most`, are the only rows broadcast.
    """
    usable = labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(id))
    usable = usable.groupBy(F.col(id).alias("id")).agg(F.max(label).cast("double").alias("label"))
    total = usable.count()
    share = min(1.0, most / max(total, 1))
    chosen = usable.filter(F.pmod(F.xxhash64(F.col("id"), F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.join(F.broadcast(chosen), "id")
