"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from shopstrata.llm.common import as_bytes, labelled_sample, non_empty, packed, written
from shopstrata.llm.sums import summed

STATISTICS = 20
_UPPER = np.arange(65, 91)
_LOWER = np.arange(97, 123)
_DIGIT = np.arange(48, 58)
_POINT = np.array([33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63])
_SIGN = np.array([35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126])


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a whole text: its characters, words, repeats and lines. All are finite, also without words."""
    size = len(text)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower, digit = count[_UPPER].sum(), count[_LOWER].sum(), count[_DIGIT].sum()
    high = count[128:].sum()
    share = count[count > 0] / max(size, 1)
    words = text.split()
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    different = set(words)
    triples = len(set(zip(words, words[1:], words[2:])))
    lines = text.splitlines() or [b""]
    return [
        np.log1p(size),
        upper / max(upper + lower, 1),
        (upper + lower + high) / max(size, 1),
        digit / max(size, 1),
        count[_POINT].sum() / max(size, 1),
        count[_SIGN].sum() / max(size, 1),
        count[33] / n,
        count[124] / n,
        high / max(size, 1),
        float(-(share * np.log(share)).sum()),
        lengths.mean(),
        lengths.std(),
        np.log1p(len(different)) / np.log1p(n),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        triples / max(n - 2, 1),
        sum(word.isupper() for word in different) / max(len(different), 1),
        sum(word[:1].isupper() for word in different) / max(len(different), 1),
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        sum(line[-1:] in b".?!" and line != b"" for line in lines) / len(lines),
    ]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, values: np.ndarray) -> np.ndarray:
        """cos(wx + b) for random w and b, whose products approximate a Gaussian kernel; and a constant."""
        plain = np.clip((values - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.shifts)) * np.cos(plain @ self.waves + self.shifts)
        return np.column_stack([waves, np.ones(len(values))])

    def raw(self, values: np.ndarray) -> np.ndarray:
        return self.features(values) @ self.weights

    def score(self, values: np.ndarray) -> np.ndarray:
        """Calibrated; a hundredth of the raw score is mixed in, so that equal levels keep their order."""
        raw = self.raw(values)
        return 0.99 * np.interp(raw, self.knots, self.levels) + 0.01 / (1 + np.exp(-4 * (raw - 0.5)))


def isotonic(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; mean score and mean label of each pool."""
    pools: list[list[float]] = []
    for score, label, weight in zip(scores, labels, weights):
        pools.append([score * weight, label * weight, weight])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    found = np.array(pools)
    return found[:, 0] / found[:, 2], found[:, 1] / found[:, 2]


def _values(batch: pa.RecordBatch, column: str = "text") -> np.ndarray:
    return np.array([statistics(text) for text in as_bytes(batch.column(column))])


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id", text: str = "text",
    most: int = 20_000, waves: int = 300, width: float = 3.0, ridge: float = 1e-4, seed: int = 8,
) -> Model:
    """Fit on about `most` labelled rows (a documented bound), never on held-out ones.

    Three passes over the statistics of the sample, each a sum over partitions: mean and deviation; the normal equations of
    four fifths of the rows; and labels per step of the raw score for the last fifth, which isotonic regression turns into
    probabilities. Without labelled rows every score is one half. Null texts count as empty.
    """
    sample = labelled_sample(docs, labels, label, id, text, most)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(_values(batch)), pa.list_(pa.float64())), batch.column("label"), batch.column("calibrate")],
                names=["values", "label", "calibrate"],
            )

    marked = sample.withColumn("calibrate", F.crc32(F.concat(F.lit("calibrate"), F.col("id").cast("string"))) % 5 == 0)
    rows = written(marked.mapInArrow(measured, "values array<double>, label double, calibrate boolean"), "statistics")

    def values(batch):
        return np.array(batch.column("values").flatten()).reshape(-1, STATISTICS)

    def label_of(batch):
        return batch.column("label").to_numpy()

    def moments(batch):
        own = values(batch)
        return np.r_[len(own), own.sum(0), (own**2).sum(0)]

    total = summed(rows, 1 + 2 * STATISTICS, moments)
    count = max(total[0], 1)
    mean = total[1 : 1 + STATISTICS] / count
    scale = np.sqrt(np.maximum(total[1 + STATISTICS :] / count - mean**2, 1e-12))
    scale[scale < 1e-5] = 1
    random = np.random.default_rng(seed)
    size = waves + 1
    model = Model(
        mean, scale, random.normal(size=(STATISTICS, waves)) / width, random.uniform(0, 2 * np.pi, waves),
        np.zeros(size), np.array([0.0]), np.array([0.5]),
    )
    if total[0] == 0:
        return model

    def equations(batch):
        own = model.features(values(batch))
        return np.r_[(own.T @ own).ravel(), own.T @ label_of(batch)]

    sums = summed(rows.filter("NOT calibrate"), size * size + size, equations)
    penalty = ridge * count * np.diag(np.r_[np.ones(waves), 0.0]) + 1e-9 * np.eye(size)
    model.weights = np.linalg.solve(sums[: size * size].reshape(size, size) + penalty, sums[size * size :])
    steps = 2001

    def histogram(batch):
        at = np.clip(np.round((model.raw(values(batch)) + 0.5) * 1000), 0, steps - 1).astype(int)
        return np.r_[np.bincount(at, minlength=steps), np.bincount(at, label_of(batch), minlength=steps)]

    held = summed(rows.filter("calibrate"), 2 * steps, histogram)
    used = np.flatnonzero(held[:steps])
    if len(used):
        levels = held[steps:][used] / held[:steps][used]
        model.knots, model.levels = isotonic(used / 1000 - 0.5, levels, held[:steps][used])
    return model


def scored(docs: DataFrame, model: Model, text: str = "text", carry: Iterable[str] | None = None) -> DataFrame:
    """`row` (the columns `carry`, by default all) and score between 0 and 1, for every row by itself.

    Null and empty texts are scored like any other, by statistics of nothing; repeated rows score alike; no rows, no scores.
    """
    given = docs.select(packed(docs, carry), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.score(_values(batch)))], names=["row", "score"])

    return given.mapInArrow(run, StructType([given.schema["row"], StructField("score", DoubleType())]))
