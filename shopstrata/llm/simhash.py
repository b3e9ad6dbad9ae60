"""SimHash near-dedup with deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shopstrata.llm.common import as_bytes, non_empty, packed, written
from shopstrata.llm.components import roots

SEED = 42
BITS = 3
SHINGLE = 3
#: Buckets above this are cut once more before they are compared.
COMPARED = 256


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the XXH64 of all word shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hashed(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: 1 - shingle].tolist()
    hashes = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    if len(hashes) < 2000:
        ones = np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
        ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ bits for i in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in non_empty(batches):
        prints = np.array([fingerprint(text) for text in as_bytes(batch.column("text"))], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(prints)], names=["row", "id", "print"])


def variants(prints: DataFrame) -> DataFrame:
    """Two segments of 32 bits: of three differing bits, one segment has one at most.

    So two linked fingerprints agree in one segment but for one bit. Each fingerprint gives 64 keys: segment, deleted bit and
    what is left of the segment.
    """
    keyed = prints.select("print", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v"))
    segment = F.expr("CASE WHEN v < 32 THEN print & 4294967295L ELSE shiftrightunsigned(print, 32) END")
    return keyed.select(
        "print",
        F.expr("shiftleft(CAST(v AS BIGINT), 32)")
        .bitwiseOR(segment.bitwiseAND(F.expr("~shiftleft(1L, v % 32)")))
        .alias("key"),
    )


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return starts, np.diff(np.r_[starts, len(keys)])


def _pairs(prints: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Positions of verified pairs within the runs, lag by lag over all runs at once."""
    left, right = [], []
    for lag in range(1, int(sizes.max(initial=0))):
        wide = sizes > lag
        starts, sizes = starts[wide], sizes[wide]
        counts = sizes - lag
        at = np.repeat(starts - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
        near = np.bitwise_count(prints[at] ^ prints[at + lag]) <= BITS
        left.append(at[near])
        right.append(at[near] + lag)
    return left, right


def bucket_links(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span what is connected inside the buckets of equal keys: each fingerprint and the least one reached.

    A large bucket is cut again: its fingerprints share one segment but for a bit, so of the other segment one half
    differs by one bit at most. Spanning links lose no connection, and there is one at most for each fingerprint.
    """
    starts, sizes = _runs(keys)
    small = sizes <= COMPARED
    left, right = _pairs(prints, starts[small & (sizes > 1)], sizes[small & (sizes > 1)])
    for start, size in zip(starts[~small].tolist(), sizes[~small].tolist()):
        own = prints[start : start + size]
        other = own >> np.uint64(32) if keys[start] >> 32 < 32 else own & np.uint64(0xFFFFFFFF)
        for half in (0, 16):
            part = (other >> np.uint64(half)) & np.uint64(0xFFFF)
            for bit in range(16):
                order = np.argsort(cut := part & ~np.uint64(1 << bit), kind="stable")
                a, b = _pairs(own[order], *_runs(cut[order]))
                left += [start + order[x] for x in a]
                right += [start + order[x] for x in b]
    if not left:
        return prints[:0], prints[:0]
    used, ends = np.unique(np.concatenate([prints[np.concatenate(left)], prints[np.concatenate(right)]]), return_inverse=True)
    a, b = ends[: len(ends) // 2], ends[len(ends) // 2 :]
    label = np.arange(len(used))
    while True:
        least = np.minimum(label[a], label[b])
        moved = label.copy()
        np.minimum.at(moved, a, least)
        np.minimum.at(moved, b, least)
        moved = moved[moved]
        if (moved == label).all():
            break
        label = moved
    off = label != np.arange(len(used))
    return used[off], used[label[off]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by key; the last bucket of a batch waits for the next one."""
    keys, prints = np.empty(0, np.int64), np.empty(0, np.uint64)

    def found(keys, prints):
        a, b = bucket_links(keys, prints)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in non_empty(batches):
        keys = np.concatenate([keys, batch.column("key").to_numpy()])
        prints = np.concatenate([prints, batch.column("print").to_numpy().view(np.uint64)])
        done = int(np.searchsorted(keys, keys[-1]))
        if done:
            yield found(keys[:done], prints[:done])
            keys, prints = keys[done:], prints[done:]
    if len(keys):
        yield found(keys, prints)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", carry: Iterable[str] | None = None) -> DataFrame:
    """Fingerprint every whole text and link fingerprints of three or fewer differing bits.

    Returns `row` (the columns `carry`, by default all), id, fingerprint (16 hex digits), component_id, the smallest id
    that links reach, and kept, true for exactly one row of each component: one with the smallest id, or one of those without
    if no row has an id. Equal fingerprints are one node, so copies cost nothing after the first aggregation.

    Null and empty texts have fingerprint zero and are linked like any other. Rows with a null id never name a component; if
    no row of it has an id, component_id is null. Repeated rows share a component. No rows in, no rows out.
    """
    given = docs.select(packed(docs, carry), F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    shape = StructType([*given.drop("text").schema.fields, StructField("print", LongType())])
    numbered = given.mapInArrow(_fingerprints, shape).withColumn("number", F.monotonically_increasing_id())
    rows = written(numbered, "fingerprints")
    head = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "number")).alias("head")
    nodes = rows.groupBy("print").agg(F.min("id").alias("id"), head)
    buckets = variants(nodes).repartition("key").sortWithinPartitions("key")
    root = roots(buckets.mapInArrow(_links, "a long, b long"))
    rooted = nodes.join(root, nodes["print"] == root["a"], "left").select("print", "id", "head", F.coalesce("b", "print").alias("root"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"), F.min("head").alias("first"))
    named = rooted.join(least, "root").select("print", "component_id", F.col("first.number").alias("first"))
    return rows.join(named, "print").select(
        "row", "id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id", (F.col("number") == F.col("first")).alias("kept")
    )
