"""Exact dedup by Grace hashing over complete contents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from shopstrata.llm.common import WHITE, as_bytes, non_empty, packed, written
from shopstrata.llm.grace import ContentTable, equal_contents

MEMORY = 32 << 20


def _grouped(memory: int):
    """Number the rows of a task and put equal texts of the task into one local group.

    The table is emptied when it is full: a text may then lead several local groups, which are joined up later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        rows = groups = 0
        table, group_of = ContentTable(), []
        for batch in non_empty(batches):
            digests, group, lead = [], [], []
            for text in as_bytes(batch.column("text")):
                content = text.translate(None, WHITE)
                digest = hashlib.sha256(content).digest()
                entry = table.find(digest, content)
                lead.append(entry < 0)
                if entry < 0:
                    if table.bytes >= memory:
                        table, group_of = ContentTable(), []
                    entry = table.add(digest, content)
                    group_of.append(first + groups)
                    groups += 1
                digests.append(digest)
                group.append(group_of[entry])
            count = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("id"),
                    pa.array(range(first + rows, first + rows + count), pa.int64()),
                    pa.array(group, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pc.if_else(pa.array(lead), batch.column("text").cast(pa.string()), pa.scalar(None, pa.string())),
                    pc.fill_null(pc.utf8_length(batch.column("text")), 0).cast(pa.int64()),
                    pa.array(lead),
                ],
                names=["row", "id", "number", "group", "digest", "text", "chars", "lead"],
            )
            rows += count

    return run


def _merged(memory: int):
    def records(batches):
        for batch in non_empty(batches):
            contents = as_bytes(batch.column("text"))
            yield from zip(
                batch.column("digest").to_pylist(),
                (content.translate(None, WHITE) for content in contents),
                batch.column("group").to_pylist(),
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, same = [], []
        for a, b in equal_contents(records(batches), memory):
            group.append(a)
            same.append(b)
            if len(group) == 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), pa.array(same, pa.int64())], names=["group", "same"])
                group, same = [], []
        yield pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), pa.array(same, pa.int64())], names=["group", "same"])

    return run


def exact_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", carry: Iterable[str] | None = None, memory: int = MEMORY
) -> DataFrame:
    """Group the rows whose texts are equal once white space is deleted; one row of each group is kept.

    Returns `row` (the columns `carry`, by default all), keep_id, group_size, kept and text_sha256, one row per input row.
    Each task first puts its own equal texts into local groups and passes on one text of each, so a text that a
    third of all rows share reaches the shuffle once per task. Those texts are dealt out by digest and compared whole in
    Grace tables of `memory` bytes. Rows come back to their group through the local group's number, which no
    large group shares.

    Null counts as empty; empty texts form one group. The longest original text stays, then the smallest id; a null id
    comes last. Of rows that repeat id and text, the first read stays and the others are marked dropped. An empty
    table gives an empty result. Columns of any name may be carried.
    """
    wanted = StructType(
        [
            StructField("row", docs.select(packed(docs, carry)).schema["row"].dataType),
            StructField("id", docs.schema[id].dataType),
            StructField("number", LongType()),
            StructField("group", LongType()),
            StructField("digest", BinaryType()),
            StructField("text", docs.select(F.col(text).cast("string").alias("t")).schema["t"].dataType),
            StructField("chars", LongType()),
            StructField("lead", BooleanType()),
        ]
    )
    given = docs.select(packed(docs, carry), F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    rows = written(given.mapInArrow(_grouped(memory), wanted), "exact-rows")
    leads = rows.filter("lead").select("group", "digest", "text").repartition("digest")
    same = leads.mapInArrow(_merged(memory), "group long, same long")
    best = F.min(F.struct(-F.col("chars"), F.col("id").isNull().alias("no_id"), "id", "number"))
    local = rows.groupBy("group").agg(best.alias("best"), F.count("*").alias("copies"))
    whole = Window.partitionBy("same")
    verdict = local.join(same, "group").select(
        "group", F.min("best").over(whole).alias("best"), F.sum("copies").over(whole).alias("copies")
    )
    return rows.join(verdict, "group").select(
        "row",
        F.col("best.id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("number") == F.col("best.number")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
