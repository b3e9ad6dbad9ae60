"""An inverted index in shards of documents, with compressed posting blocks and their maxima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shopstrata.llm.common import as_bytes, non_empty
from shopstrata.session import run_dir

#: Bytes of text and documents a shard holds at most, but for a longer text, which makes a shard of its own.
SHARD_BYTES, SHARD_DOCS = 8 << 20, 1 << 16
#: Postings of a block.
BLOCK = 64
DOCS, LISTS = "docs", "lists"
ROW = pa.schema(
    [
        ("shard", pa.int64()),
        ("kind", pa.string()),
        ("term", pa.binary()),
        ("block", pa.int32()),
        ("n_rows", pa.int64()),
        ("n_terms", pa.int64()),
        ("first", pa.int32()),
        ("last", pa.int32()),
        ("most", pa.int64()),
        ("least", pa.int64()),
        ("payload", pa.binary()),
    ]
)
SPARK_ROW = (
    "shard long, kind string, term binary, block int, n_rows long, n_terms long, first int, last int, most long, least long, payload binary"
)


def _letters() -> bytes:
    """Bytes of terms as they are, A-Z as a-z, all others as zero: terms are digits, letters and whatever is not ASCII."""
    table = bytearray(256)
    for byte in range(256):
        if byte >= 0x80 or chr(byte).isalnum():
            table[byte] = ord(chr(byte).lower()) if byte < 0x80 else byte
    return bytes(table)


LETTERS = _letters()


def terms_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts in order, and the text each belongs to."""
    joined = np.frombuffer(b"\0".join(texts).translate(LETTERS) + b"\0", np.uint8)
    inside = joined != 0
    edges = np.flatnonzero(np.diff(np.r_[False, inside]))
    first, past = edges[::2], edges[1::2]
    offsets = np.r_[0, np.cumsum(past - first)]
    if offsets[-1] >= 1 << 31:
        raise ValueError("texts of over 2 GB in one shard")
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(joined[inside]))]
    starts = np.cumsum([0, *(len(text) + 1 for text in texts[:-1])])
    return pa.Array.from_buffers(pa.binary(), len(first), buffers), np.searchsorted(starts, first, side="right") - 1


def packed_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in seven bits a byte, low bits first, the top bit on all bytes but a number's last; and where each begins."""
    sizes = 1 + sum((values >> (7 * k) > 0).astype(np.int64) for k in range(1, 9))
    begins = np.r_[0, np.cumsum(sizes)]
    out = np.empty(begins[-1], np.uint8)
    for k in range(int(sizes.max(initial=0))):
        which = np.flatnonzero(sizes > k)
        more = np.where(sizes[which] > k + 1, 0x80, 0)
        out[begins[which] + k] = (values[which] >> (7 * k)) & 0x7F | more
    return out, begins


def unpacked_numbers(payload: bytes) -> np.ndarray:
    raw = np.frombuffer(payload, np.uint8).astype(np.int64)
    ends = np.flatnonzero(raw < 0x80)
    begins = np.r_[0, ends[:-1] + 1]
    place = np.arange(len(raw)) - np.repeat(begins, ends - begins + 1)
    return np.add.reduceat((raw & 0x7F) << (7 * place), begins)


def unpacked_block(payload: bytes, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block, as places in the shard, and how often each has the term."""
    both = unpacked_numbers(payload)
    return first + np.cumsum(both[::2]), both[1::2] + 1


def _binary(data: np.ndarray, begins: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(begins) - 1, [None, pa.py_buffer(begins.astype(np.int32)), pa.py_buffer(data)])


def shard_rows(shard: int, ids: list[int | None], texts: list[bytes], block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The rows of a shard: one with its documents, and one for each block of each term."""
    terms, owners = terms_of(texts)
    lengths = np.bincount(owners, minlength=len(texts)).astype(np.int64)
    known = np.array([i is not None for i in ids], np.uint8)
    about = np.array([i or 0 for i in ids], np.int64).tobytes() + lengths.tobytes() + known.tobytes()
    head = {"shard": [shard], "kind": [DOCS], "n_rows": [int((lengths > 0).sum())], "n_terms": [int(lengths.sum())], "payload": [about]}
    yield pa.RecordBatch.from_arrays([pa.array(head.get(f.name, [None]), f.type) for f in ROW], schema=ROW)
    if not len(terms):
        return
    coded = terms.dictionary_encode()
    pairs = np.sort(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) << 32 | owners)
    new = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    often = np.diff(np.r_[new, len(pairs)])
    term, doc = pairs[new] >> 32, pairs[new] & 0xFFFFFFFF
    opens = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    place = np.arange(len(term)) - np.repeat(opens, np.diff(np.r_[opens, len(term)]))
    blocks = np.flatnonzero(place % block == 0)
    gaps = np.diff(np.r_[0, doc])
    gaps[blocks] = 0
    data, begins = packed_numbers(np.column_stack([gaps, often - 1]).ravel())
    lasts = np.r_[blocks[1:], len(doc)] - 1
    columns = {
        "shard": np.full(len(blocks), shard),
        "kind": pa.array([LISTS]).take(pa.array(np.zeros(len(blocks), np.int32))),
        "term": coded.dictionary.take(pa.array(term[blocks])),
        "block": place[blocks] // block,
        "n_rows": lasts - blocks + 1,
        "first": doc[blocks],
        "last": doc[lasts],
        "most": np.maximum.reduceat(often, blocks),
        "least": np.minimum.reduceat(lengths[doc], blocks),
        "payload": _binary(data, np.r_[begins[2 * blocks], len(data)]),
    }
    arrays = [
        pa.nulls(len(blocks), f.type) if f.name not in columns else columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
        for f in ROW
    ]
    whole = pa.RecordBatch.from_arrays(arrays, schema=ROW)
    for at in range(0, whole.num_rows, 20_000):
        yield whole.slice(at, 20_000)


def build(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all rows, as a written table partitioned by `kind`.

    Every task makes shards of the rows it reads; nothing is shuffled, and a term that is in every document costs a shard no
    more than its own postings.
    """
    given = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size = TaskContext.get().partitionId() << 24, 0
        ids: list[int | None] = []
        texts: list[bytes] = []
        for batch in non_empty(batches):
            for id, text in zip(batch.column("id").to_pylist(), as_bytes(batch.column("text")), strict=True):
                if texts and (size + len(text) > SHARD_BYTES or len(texts) == SHARD_DOCS):
                    yield from shard_rows(shard, ids, texts)
                    shard, size, ids, texts = shard + 1, 0, [], []
                ids.append(id)
                texts.append(text)
                size += len(text)
        if texts:
            yield from shard_rows(shard, ids, texts)

    rows = given.mapInArrow(run, SPARK_ROW)
    folder = run_dir(docs.sparkSession, "lexical-index")
    rows.write.option("compression", "zstd").partitionBy("kind").parquet(folder)
    return docs.sparkSession.read.schema(rows.schema).parquet(folder)
