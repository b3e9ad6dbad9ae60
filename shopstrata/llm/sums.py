"""Sums of arrays over all partitions, in two levels, for what is fitted from rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shopstrata.llm.common import non_empty

GROUPS = 16


def summed(rows: DataFrame, size: int, part: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of `part` (an array of `size` numbers) over all batches.

    Each task that has rows sends one array; 16 tasks add them up, and the driver adds those 16, whatever the number of rows.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in non_empty(batches):
            total = part(batch) + (0 if total is None else total)
        if total is None:
            return
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId() % GROUPS], "numbers": [np.asarray(total, float).tobytes()]})

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in non_empty(batches):
            for numbers in batch.column("numbers").to_pylist():
                total = np.frombuffer(numbers) + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"numbers": [total.tobytes()]})

    partial = rows.mapInArrow(local, "part long, numbers binary").repartition(GROUPS, "part")
    found = partial.mapInArrow(gathered, "numbers binary").collect()
    return np.sum([np.frombuffer(row.numbers) for row in found], axis=0) if found else np.zeros(size)
