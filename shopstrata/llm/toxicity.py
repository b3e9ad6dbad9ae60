"""Toxicity scores: a factorization machine over hashed terms."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from shopstrata.llm.common import as_bytes, labelled_sample, non_empty, packed, written

BUCKETS = 1 << 17
#: Letters in lower case; ASCII punctuation, digits and controls separate words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
REMEMBERED = 200_000


def words(text: bytes) -> set[bytes]:
    return set(text.translate(_FOLD).split())


def terms(word: bytes) -> list[int]:
    """Hashed terms of a word: itself and its beginnings of 4 and 7 bytes, which forms of one word share."""
    found = [zlib.crc32(word)]
    if len(word) > 4:
        found.append(zlib.crc32(b"4" + word[:4]))
    if len(word) > 7:
        found.append(zlib.crc32(b"7" + word[:7]))
    return [term % BUCKETS for term in found]


def hashed(text: bytes) -> np.ndarray:
    return np.unique(np.array([term for word in words(text) for term in terms(word)], np.int32))


@dataclass
class Model:
    """Score = sigmoid(bias + sum of weights + sum over pairs of terms of the product of their factors)."""

    kept: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    known: dict[bytes, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def _terms(self, word: bytes) -> tuple[int, ...]:
        found = tuple({self.kept[term] for term in terms(word) if term in self.kept})
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(word) <= 64:
            self.known[word] = found
        return found

    def score(self, text: bytes) -> float:
        at: set[int] = set()
        for word in words(text):
            found = self.known.get(word)
            at.update(self._terms(word) if found is None else found)
        chosen = list(at)
        own = self.factors[chosen]
        sums = own.sum(0)
        raw = self.bias + self.weights[chosen].sum() + 0.5 * float((sums**2).sum() - (own**2).sum())
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def raw_and_slopes(own: np.ndarray, bias: float) -> tuple[float, np.ndarray]:
    """The raw score of a row whose terms have these weights (first column) and factors, and its slope by each of them."""
    sums = own.sum(0)
    slopes = sums - own
    raw = bias + sums[0] + 0.5 * float((own[:, 1:] * slopes[:, 1:]).sum())
    slopes[:, 0] = 1
    return raw, slopes


@dataclass
class _State:
    """What the rounds hand on: weight and factors of each term in one table; the sums of their squared slopes, one for the weight
    and one (a mean) for the factors; and value and sum of the bias."""

    table: np.ndarray
    squares: np.ndarray
    bias: np.ndarray

    def after(self, sizes: np.ndarray, terms: np.ndarray, labels: np.ndarray, values: np.ndarray, rate: float, decay: float) -> tuple[_State, np.ndarray]:
        """One pass of AdaGrad over rows in the given order, by logistic loss; also the terms it reached."""
        table, squares, (bias, square) = self.table.copy(), self.squares.copy(), self.bias
        for label, at in zip(labels, np.split(terms, np.cumsum(sizes)[:-1])):
            value = values[at, None]
            raw, slopes = raw_and_slopes(table[at] * value, bias)
            error = 1 / (1 + np.exp(-min(max(raw, -30), 30))) - label
            slopes = slopes * (error * value) + decay * table[at]
            new = squares[at] + np.stack([slopes[:, 0] ** 2, (slopes[:, 1:] ** 2).mean(1)], axis=1)
            squares[at] = new
            slopes *= rate
            slopes[:, 0] /= np.sqrt(new[:, 0])
            slopes[:, 1:] /= np.sqrt(new[:, 1:])
            table[at] -= slopes
            square += error**2
            bias -= rate * error / np.sqrt(square)
        return _State(table, squares, np.array([bias, square])), np.unique(terms)


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text", most: int = 12_000,
    rank: int = 6, rounds: int = 10, rate: float = 0.3, decay: float = 2e-5, doubt: float = 30.0, shards: int = 4, seed: int = 9,
) -> Model:
    """Fit on about `most` labelled rows (a documented bound), never on held-out ones. Of rows with the same id one counts, that of the least text.

    The document counts of all hashed terms in the sample, by label, are summed over partitions. Every term that two documents
    have takes part. Its value as an input is x / (x + `doubt`), x being the chi-square of its counts: near 1 for terms that tell the labels
    apart, near 0 for those that differ by chance.

    Each round every shard of the sample, `shards` by a hash of the id, is gone over once in a task of its own, from where the last round ended;
    the shards' changes are added up, each term's divided by the number of shards that have it. So the result does not depend on
    partitions, and the driver holds `shards` tables of the terms they reach (2^17 at most). Without labelled rows every score is one half.
    """
    sample = labelled_sample(docs, labels, label, id, text, most)
    sample = sample.groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    sample = sample.withColumn("shard", F.pmod(F.xxhash64(F.col("id"), F.lit("shard")), F.lit(shards)).cast("int"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            found = [hashed(value) for value in as_bytes(batch.column("text"))]
            kept = [batch.column(name) for name in ("label", "shard", "id")]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), *kept], names=["terms", "label", "shard", "id"])

    shape = StructType(
        [
            StructField("terms", ArrayType(IntegerType())),
            StructField("label", DoubleType()),
            StructField("shard", IntegerType()),
            StructField("id", sample.schema["id"].dataType),
        ]
    )
    rows = written(sample.mapInArrow(listed, shape), "terms")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for batch in non_empty(batches):
            flat = batch.column("terms").flatten().to_numpy()
            label = np.repeat(batch.column("label").to_numpy(), np.diff(batch.column("terms").offsets.to_numpy()))
            seen += np.bincount(flat, minlength=BUCKETS)
            toxic += np.bincount(flat, label, minlength=BUCKETS)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[used]), pa.array(toxic[used])], names=["term", "seen", "toxic"])

    by_term = rows.mapInArrow(counted, "term long, seen double, toxic double").groupBy("term")
    counts = by_term.agg(F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic")).toArrow()  # a row for each bucket at most
    totals = rows.agg(F.count("*").alias("count"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("ones")).first()
    count, ones = totals["count"], totals["ones"]
    if count == 0:
        return Model({}, 0.0, np.zeros(0), np.zeros((0, rank)))
    order = np.argsort(counts.column("term").to_numpy())
    term, seen, toxic = (counts.column(name).to_numpy()[order] for name in ("term", "seen", "toxic"))
    expected = seen * ones / count
    odd = (toxic - expected) ** 2 / np.maximum(expected * (1 - seen / (count + 1)), 1e-9)
    chosen, odd = term[seen >= 2], odd[seen >= 2]
    values = (odd / (odd + doubt)).astype(np.float32)
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each shard; its rows come one after the other, ordered by id."""
        ordered = (row for batch in non_empty(batches) for row in batch.to_pylist())
        for shard, group in groupby(ordered, key=lambda row: row["shard"]):
            found, own = [], []
            for row in group:
                at = place[np.asarray(row["terms"], np.int64)]
                found.append(at[at >= 0])
                own.append(row["label"])
            sizes = np.array([len(at) for at in found], np.int32)
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "sizes": [sizes.tobytes()], "terms": [np.concatenate(found).tobytes()], "labels": [np.array(own).tobytes()]}
            )

    by_shard = rows.repartition(shards, "shard").sortWithinPartitions("shard", "id")
    parts = written(by_shard.mapInArrow(gathered, "shard int, sizes binary, terms binary, labels binary"), "shards")
    share = np.clip(ones / count, 1e-3, 1 - 1e-3)
    table = np.zeros((len(chosen), rank + 1), np.float32)
    table[:, 1:] = np.random.default_rng(seed).normal(scale=0.05, size=(len(chosen), rank))
    state = _State(table, np.full((len(table), 2), 1e-2, np.float32), np.array([np.log(share / (1 - share)), 1e-2]))
    for _ in range(rounds):
        state = _round(parts, state, values, rate, decay)
    table = state.table.astype(float) * values[:, None]
    return Model({int(term): i for i, term in enumerate(chosen)}, float(state.bias[0]), table[:, 0], table[:, 1:])


def _round(parts: DataFrame, state: _State, values: np.ndarray, rate: float, decay: float) -> _State:
    """The state after a pass over every shard, each from `state`, which is sent to the tasks and let go again."""
    sent = parts.sparkSession.sparkContext.broadcast((state, values, rate, decay))

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, *more = sent.value
        for batch in non_empty(batches):
            for row in batch.to_pylist():
                given = (np.frombuffer(row[name], kind) for name, kind in (("sizes", np.int32), ("terms", np.int32), ("labels", float)))
                new, at = state.after(*given, *more)
                changes = np.hstack([new.table[at] - state.table[at], new.squares[at] - state.squares[at]])
                found = {"terms": at.astype(np.int32), "changes": changes, "bias": new.bias - state.bias}
                yield pa.RecordBatch.from_pydict({"shard": pa.array([row["shard"]], pa.int32()), **{k: [x.tobytes()] for k, x in found.items()}})

    found = parts.mapInArrow(passed, "shard int, terms binary, changes binary, bias binary").toArrow().sort_by("shard")
    sent.destroy()
    wide = state.table.shape[1]
    total, reached = np.zeros((len(state.table), wide + 2), np.float32), np.zeros((len(state.table), 1), np.float32)
    bias = np.zeros(2)
    for reaches, changes, moved in zip(*(found.column(name) for name in ("terms", "changes", "bias"))):
        at = np.frombuffer(reaches.as_buffer(), np.int32)
        total[at] += np.frombuffer(changes.as_buffer(), np.float32).reshape(-1, wide + 2)
        reached[at] += 1
        bias += np.frombuffer(moved.as_buffer())
    table = state.table + total[:, :wide] / np.maximum(reached, 1)
    return _State(table, state.squares + total[:, wide:], state.bias + bias / [max(found.num_rows, 1), 1])


def scored(docs: DataFrame, model: Model, text: str = "text", carry: Iterable[str] | None = None) -> DataFrame:
    """`row` (the columns `carry`, by default all) and score between 0 and 1, for every row by itself.

    Null and empty texts get the score of no terms; repeated rows score alike; no rows, no scores.
    """
    given = docs.select(packed(docs, carry), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            scores = [model.score(value) for value in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], names=["row", "score"])

    return given.mapInArrow(run, StructType([given.schema["row"], StructField("score", DoubleType())]))
