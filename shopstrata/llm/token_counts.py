"""Token counts of whole texts by finite-state transducers."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from shopstrata.llm.common import as_bytes, non_empty, packed
from shopstrata.llm.token_machines import END_BYTE, Counter, Cutter, class_runs

#: Bytes that the machines take at once.
BLOCK = 2 << 20
OUT = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]
#: After a letter, white space begins a word whatever stands before; nothing of a word reaches across.
_SAFE = re.compile(rb"[a-z](?=[ \n])")


@lru_cache(2)
def _counter(model: str) -> Counter:
    return Counter(model)


def _stretches(text: bytes, block: int) -> Iterator[bytes]:
    """A text as itself, or a very long one cut where a word surely begins."""
    while len(text) > block:
        cut = next((m.end() for m in _SAFE.finditer(text, block)), None)
        if cut is None:
            break
        yield text[:cut]
        text = text[cut:]
    yield text


class Machine:
    """Both transducers of a model in one worker."""

    def __init__(self, model: str, runs: tuple[np.ndarray, np.ndarray]) -> None:
        self.cutter, self.counter = Cutter(runs), _counter(model)
        special = [re.escape(x.encode()) for x in sorted(self.counter.special, key=len, reverse=True) if x]
        self.special = re.compile(b"|".join(special)) if special else None

    def counts(self, texts: list[bytes], block: int = BLOCK) -> np.ndarray:
        """The number of tokens of each text."""
        total = np.zeros(len(texts), np.int64)
        parts: list[bytes] = []
        owner: list[int] = []
        size = 0
        for at, text in enumerate(texts):
            if self.special and self.special.search(text):
                pieces = self.special.split(text)
                total[at] += len(pieces) - 1
            else:
                pieces = [text]
            for piece in pieces:
                for stretch in _stretches(piece, block):
                    parts.append(stretch)
                    owner.append(at)
                    size += len(stretch)
                    if size > block:
                        np.add.at(total, owner, self._block(parts))
                        parts, owner, size = [], [], 0
        if parts:
            np.add.at(total, owner, self._block(parts))
        return total

    def _block(self, parts: list[bytes]) -> np.ndarray:
        end = bytes([END_BYTE])
        raw = np.frombuffer(end.join(parts) + end, np.uint8)
        kinds, places = self.cutter.classes(raw)
        first = places[self.cutter.begins(kinds)]
        ends = np.flatnonzero(raw == END_BYTE)
        bounds = np.searchsorted(first, ends)  # words before each end
        sizes = np.diff(np.r_[first, ends[-1]])
        last = np.unique(bounds[bounds > 0]) - 1
        sizes[last] = ends[np.searchsorted(ends, first[last])] - first[last]
        summed = np.r_[0, np.cumsum(self.counter.count(raw, first, sizes))]
        return np.diff(np.r_[0, summed[bounds]])


def counted(docs: DataFrame, model: str, limit: int = 1024, text: str = "text", carry: Iterable[str] | None = None) -> DataFrame:
    """Count the tokens of every whole text, each row by itself.

    Returns `row` (the columns `carry`, by default all), n_bytes of UTF-8, n_tokens as the tokenizers library counts them
    without added tokens (special strings in a text count as one token each), and whether there are more than `limit`.
    `model` is a byte-level BPE file that every worker can read.

    Null counts as empty; an empty text has no tokens. Texts of any length are taken in blocks, cut where a word begins
    whatever stands before. Repeated rows give equal results; an empty table gives none. Bytes that are no UTF-8
    count as replacement characters, in n_bytes too.
    """
    given = docs.select(packed(docs, carry), F.col(text).cast("string").alias("text"))
    runs = class_runs(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(model, runs)
        for batch in non_empty(batches):
            texts = as_bytes(batch.column("text"))
            try:
                batch.column("text").validate(full=True)
            except pa.ArrowInvalid:
                texts = [x.decode("utf-8", "replace").encode() for x in texts]
            counts = machine.counts(texts)
            columns = [pa.array([len(x) for x in texts], pa.int64()), pa.array(counts), pa.array(counts > limit)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], names=["row", *(field.name for field in OUT)])

    return given.mapInArrow(run, StructType([given.schema["row"], *OUT]))
