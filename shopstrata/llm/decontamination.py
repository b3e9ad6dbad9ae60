"""Benchmark decontamination: rare word pairs join texts to items, Smith-Waterman alignment of words decides."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from shopstrata.llm.common import non_empty, packed, written

#: Items of fewer words have no copies.
FEWEST = 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of the best possible alignment score from which a passage counts as a copy; an item of few words needs this many of them.
LEAST = 0.5
LEAST_WORDS = 4
#: Bits of the filter that tells which word pairs no item has: 4 MB, whatever the benchmark's size.
FILTER_BITS = 1 << 25
#: Bits in one bitmap of Spark's bitmap functions, which number values above 0 from the second bitmap on.
_BITMAP = 1 << 15
_SPLIT = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
#: Scripts written without spaces: Thai to Tibetan, Burmese, Khmer, kana, Han. Each sign is a word.
_UNSPACED = re.compile("([฀-࿿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff])")
_POSITIVE = (1 << 63) - 1


def words(text: str | None) -> list[bytes]:
    """Words in lower case; ASCII punctuation separates them like white space, signs of unspaced scripts stand alone."""
    text = (text or "").lower()
    if not text.isascii():
        text = _UNSPACED.sub(r" \1 ", text)
    return text.encode("utf-8", "surrogatepass").translate(_SPLIT).split()


def numbered(found: list[bytes]) -> np.ndarray:
    """Words as positive 63-bit numbers."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).astype(np.int64) & _POSITIVE


def pairs(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every two words that are neighbours or have one word between them: place of the first, and the pair's code.

    The code does not tell the distance, so that a word put in or left out between the two changes nothing.
    """
    wide = numbers.view(np.uint64)
    places, codes = [], []
    for gap in (1, 2):
        mixed = (wide[:-gap] * np.uint64(0x9E3779B97F4A7C15) + wide[gap:]) * np.uint64(0xC2B2AE3D27D4EB4F)
        codes.append((mixed ^ (mixed >> np.uint64(29))).view(np.int64))
        places.append(np.arange(len(mixed)))
    return np.concatenate(places), np.concatenate(codes)


def least_score(size: int) -> float:
    """The alignment score from which a passage is a copy of an item of `size` words."""
    return max(LEAST * MATCH * size, min(size, LEAST_WORDS) * MATCH)


def pairs_left(size: int) -> int:
    """How many pair places of an item of `size` words every copy still holds.

    An item has 2 * size - 3 of them and a copy may lose `size` of the best score. A word put in costs 1 and parts at most two pairs
    of distance 2, or one of distance 1 where a word was put in before; a changed or missing word costs 3 and parts at most four; a
    word cut off at an end costs 2 and takes two. All pairs of distance 2 part for half the cost; the other half parts one each, which
    leaves about half as many pairs as words; 4 are given away for the ends.
    """
    return max(1, size // 2 - 4)


def left_out(size: int) -> int:
    """How many of an item's commonest pair places are no seeds; a copy holds pairs_left - left_out others at least."""
    return pairs_left(size) // 2


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman score of two word sequences and the first and past-the-last word of the passage's part.

    Row by row; gaps along the row come from a running maximum.
    """
    size = len(passage)
    scores = np.zeros(size + 1, np.int64)
    begins = np.arange(size + 1)
    steps = np.arange(size + 1) * -GAP
    best = (0, 0, 0)
    for number in item:
        diagonal = scores[:-1] + np.where((passage == number) & (number > 0), MATCH, MISMATCH)
        up = scores[1:] + GAP
        across = np.r_[0, np.maximum(np.maximum(diagonal, up), 0)]
        origin = np.r_[0, np.where(diagonal >= up, begins[:-1], begins[1:])]
        origin = np.where(across > 0, origin, np.arange(size + 1))
        lifted = across + steps
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(size + 1), 0))
        scores, begins = top - steps, origin[source]
        end = int(np.argmax(scores))
        if scores[end] > best[0]:
            best = (int(scores[end]), int(begins[end]), end)
    return best


def _may_align(item: np.ndarray, passage: np.ndarray) -> bool:
    """False only if no stretch of the passage holds as many of the item's words as the least score needs."""
    needed = least_score(len(item)) / MATCH
    held, counts = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(held, passage), len(held) - 1)
    known = held[at] == passage
    if np.minimum(np.bincount(at[known], minlength=len(held)), counts).sum() < needed:
        return False
    before = np.r_[0, np.cumsum(known)]  # a copy has at most two words for each of the item's
    ends = np.minimum(np.arange(len(before)) + 2 * len(item), len(passage))
    return (before[ends] - before).max() >= needed


def best_copy(item: np.ndarray, found: list[bytes], pieces: Iterable[int]) -> tuple[float, int, int] | None:
    """Similarity, first and past-the-last word of the best copy of an item in some pieces of a text; None if there is none.

    Piece p begins at word 2 * p * size and has 4 * size words, so every copy, of 2 * size words at most, lies in one.
    """
    step, best, low, high = 2 * len(item), None, None, -1
    ranges = []
    for piece in sorted(set(pieces)):
        if piece * step > high or low is None:
            low = piece * step
            ranges.append([low, 0])
        high = ranges[-1][1] = (piece + 2) * step
    for low, high in ranges:
        passage = numbered(found[low:high])
        if len(passage) and _may_align(item, passage):
            score, first, end = align(item, passage)
            if score >= least_score(len(item)) and (best is None or score > best[0]):
                best = (score, low + first, low + end)
    return best and (best[0] / (MATCH * len(item)), *best[1:])


def _items(benchmark: DataFrame, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Items as (item_id, words), and classes of equal ones as (item, words, size)."""
    given = benchmark.select(F.col(f"`{id}`").alias("item_id"), F.col(f"`{text}`").cast("string").alias("text"))
    shape = StructType([given.schema["item_id"], *StructType.fromDDL("words array<long>").fields])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            found = [numbered(words(value)) for value in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, pa.list_(pa.int64()))], names=shape.names)

    items = written(given.mapInArrow(listed, shape).filter(F.size("words") >= FEWEST), "items")
    classes = items.groupBy("words").agg(F.size("words").alias("size")).withColumn("item", F.monotonically_increasing_id())
    return items, written(classes, "item-classes")


def _pairs_of(classes: DataFrame) -> DataFrame:
    """One row for each pair place of each class, with how many are left out and how many others a copy needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            found = [np.asarray(value, np.int64) for value in batch.column("words").to_pylist()]
            codes = [pairs(x)[1] for x in found]
            out = [left_out(len(x)) for x in found]
            needed = [pairs_left(len(x)) - y for x, y in zip(found, out)]
            columns = [np.repeat(x, [len(c) for c in codes]) for x in (batch.column("item").to_numpy(), [len(x) for x in found], out, needed)]
            names = ["item", "size", "out", "needed", "seed"]
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in columns), pa.array(np.concatenate(codes))], names=names)

    return classes.select("item", "words").mapInArrow(run, "item long, size long, out long, needed long, seed long")


def _filter(seeds: DataFrame) -> np.ndarray:
    """A bit for each seed, by its lowest bits: FILTER_BITS at most come to the driver and go to the tasks."""
    at = F.col("seed").bitwiseAND(F.lit(FILTER_BITS - 1))
    rows = seeds.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
    out = np.zeros((FILTER_BITS + _BITMAP) // 8, np.uint8)
    for row in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        bits = np.frombuffer(row.bits, np.uint8)
        begin = row.bucket * len(bits)
        out[begin : begin + len(bits)] = bits
    return out


def _there(codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which numbers a filter lets through: all it was made of, and few others."""
    position = codes & (FILTER_BITS - 1)
    slot = np.where(position > 0, position - 1 + _BITMAP, 0)
    return bits[slot >> 3] >> (slot & 7) & 1 > 0


def _with_candidates(texts: DataFrame, near: DataFrame) -> DataFrame:
    """The texts whose pid `near` has, and few others, without a shuffle of texts."""
    seed = F.xxhash64("pid").alias("seed")
    bits = _filter(near.select(seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            chosen = batch.filter(pa.array(_there(batch.column("seed").to_numpy(), bits)))
            yield pa.RecordBatch.from_arrays(chosen.columns[:2], names=["pid", "text"])

    return texts.select("pid", "text", seed).mapInArrow(run, texts.select("pid", "text").schema)


def _met(docs: DataFrame, text: str, carry: list[str], bits: np.ndarray) -> DataFrame:
    """A written table of all rows: pid (unique), row, text (if `row` has none) and hits: places of pairs that the filter lets through."""
    given = docs.select(packed(docs, carry), F.col(f"`{text}`").cast("string").alias("text"))
    kept = ["row"] if text in carry else ["row", "text"]
    shape = StructType([*given.select(kept).schema.fields, *StructType.fromDDL("hits array<struct<place: int, seed: long>>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            places, seeds = [], []
            for value in batch.column("text").to_pylist():
                place, code = pairs(numbered(words(value)))
                there = _there(code, bits)
                places.append(place[there])
                seeds.append(code[there])
            offsets = pa.array(np.cumsum([0, *map(len, places)]), pa.int32())
            columns = [pa.array(np.concatenate(places), pa.int32()), pa.array(np.concatenate(seeds), pa.int64())]
            hits = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, names=["place", "seed"]))
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), hits], names=shape.names)

    return written(given.mapInArrow(run, shape).withColumn("pid", F.monotonically_increasing_id()), "met")


def _candidates(classes: DataFrame, places: DataFrame, met: DataFrame) -> DataFrame:
    """(pid, item, piece, seeds): pieces of texts that hold as many seeds of an item as each of its copies does.

    Seeds are the pair places of an item but its commonest over all texts. Equal items are one; how many texts hold a seed changes its
    rank within its item only, so copies of one passage do not push out each other's seeds.
    """
    hits = met.select("pid", F.explode("hits").alias("hit")).select("pid", "hit.*")
    counts = hits.groupBy("seed").count()
    order = Window.partitionBy("item").orderBy(F.coalesce("count", F.lit(0)).desc(), "seed")
    ranked = places.join(counts, "seed", "left").withColumn("rank", F.row_number().over(order)).filter("rank > out")
    seeds = written(ranked.groupBy("seed", "item", "size", "needed").agg(F.count("*").alias("weight")), "seeds")
    at = F.expr("place div (2 * size)")
    joined = hits.join(seeds, "seed").withColumn("piece", F.explode(F.filter(F.array(at, at - 1), lambda x: x >= 0)))
    of_piece = joined.groupBy("pid", "item", "piece").agg(F.sum("weight").alias("seeds"), F.first("needed").alias("needed"))
    return of_piece.filter("seeds >= needed").join(classes.select("item", "words"), "item").drop("needed")


def _found(docs: DataFrame, benchmark: DataFrame, id: str, text: str, carry: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rows as `_met` has them, their copies as (pid, item, similarity, seeds, first_word, end_word), and items as (item, item_id)."""
    items, classes = _items(benchmark, id, text)
    places = written(_pairs_of(classes), "item-pairs")
    met = _met(docs, text, carry, _filter(places))
    piece = F.struct("item", "words", "piece", "seeds")
    near = written(_candidates(classes, places, met).groupBy("pid").agg(F.collect_list(piece).alias("near")), "near")
    value = F.col(f"row.`{text}`").cast("string") if text in carry else F.col("text")
    # Texts without candidates are left out before the shuffle: a semi join would shuffle them all once the ids are too many to send.
    texts = _with_candidates(met.filter("size(hits) > 0").select("pid", value.alias("text")), near).join(near.hint("merge"), "pid")
    shape = "pid long, item long, similarity double, seeds long, first_word long, end_word long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            out = []
            for pid, value, near in zip(*(batch.column(name).to_pylist() for name in ("pid", "text", "near"))):
                found, by_item = words(value), {}
                for entry in near:
                    by_item.setdefault(entry["item"], []).append(entry)
                for item, entries in by_item.items():
                    copy = best_copy(np.array(entries[0]["words"], np.int64), found, [x["piece"] for x in entries])
                    if copy:
                        out.append((pid, item, copy[0], max(x["seeds"] for x in entries), *copy[1:]))
            columns = zip(*out) if out else [()] * 6
            types = [pa.float64() if i == 2 else pa.int64() for i in range(6)]
            names = ["pid", "item", "similarity", "seeds", "first_word", "end_word"]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, types)], names=names)

    return met, texts.mapInArrow(run, shape), items.join(classes, "words").select("item", "item_id")


def leaks(
    docs: DataFrame, benchmark: DataFrame, id: str = "item_id", text: str = "text", carry: Iterable[str] | None = None
) -> DataFrame:
    """Copies of benchmark items in whole texts, exact or edited; a row for each pair of a row and an item.

    Returns `row` (the columns `carry`, by default all), item_id, similarity (alignment score over the best possible one),
    seeds (most seed places of the item met in one piece of the text), first_word and end_word, of the best copy. Both tables name
    their text column `text`. A passage is a copy if its alignment reaches `least_score`.

    Pairs of near words are looked up in texts by a filter of fixed size, joined to the items by a plain join and counted by piece of
    text. The commonest pair places of an item are no seeds, but never so many that a copy could be missed: every copy has
    `pairs_left` pair places, of which at most half are left out. So the candidates hold all copies, and the alignment decides.

    Null and empty texts have no copies; items of fewer than three words have none either. Repeated rows and repeated items each
    give their own pairs; an empty table on either side gives no rows. Of equally good copies in a text the first is given.
    """
    carry = list(docs.columns if carry is None else carry)
    met, copies, items = _found(docs, benchmark, id, text, carry)
    found = copies.join(items, "item").join(met.select("pid", "row"), "pid")
    return found.select("row", "item_id", "similarity", "seeds", "first_word", "end_word")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no copy of a benchmark item, by the rules of `leaks`."""
    met, copies, _ = _found(docs, benchmark, id, text, docs.columns)
    return met.join(written(copies.select("pid").distinct(), "leaking"), "pid", "left_anti").select("row.*")
