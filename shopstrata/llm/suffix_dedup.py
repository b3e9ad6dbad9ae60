"""Removal of repeated byte strings across documents by suffix order."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from shopstrata.llm.suffix_blocks import Text

LENGTH = 50
#: Bytes of a k-gram whose least hash names a window.
GRAM = 20
#: Bytes of text that are treated as one unit.
UNIT = 8 << 20
#: Places whose hashes are held at a time.
PLACES = 1 << 16
#: Bytes of texts whose windows are named at a time, one text at least.
NAMED = 1 << 19
#: A name that more texts have is cut into windows, so that its pieces do not all meet in one bucket.
HOT = 4096
LAST = (1 << 63) - 1
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def _hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the 20 bytes from each place on."""
    base = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        one = data.astype(np.uint64) + np.uint64(1)
        two = one[:-1] * base + one[1:]
        four = two[:-2] * (base * base) + two[2:]
        eight = four[:-4] * base**np.uint64(4) + four[4:]
        sixteen = eight[:-8] * base**np.uint64(8) + eight[8:]
        out = sixteen[:-4] * base**np.uint64(4) + four[16:]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        return out


def _least(data: np.ndarray, length: int) -> np.ndarray:
    """The least hash of the 20-byte strings within the `length` bytes from each place on, some places at a time."""
    width = length - GRAM + 1
    out = np.empty(len(data) - length + 1, np.uint64)
    for a in range(0, len(out), PLACES):
        least, span = _hashes(data[a : a + PLACES + length - 1]), 1
        while span * 2 <= width:
            least, span = np.minimum(least[:-span], least[span:]), span * 2
        if span < width:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        out[a : a + PLACES] = least
    return out


def names(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one name: text number, first window and past-the-last window in the text, and the name.

    A window's name is the least hash of its 20-byte strings. Equal windows have equal names, and neighbours mostly share one.
    Some texts at a time are named, as there are several numbers of eight bytes for each window until it is known where runs end.
    """
    number = (np.cumsum([0, *map(len, texts)])[:-1] // NAMED) if texts else np.empty(0, np.int64)
    starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if texts else []
    parts = [_names(texts[a:b], length) for a, b in zip(starts, [*starts[1:], len(texts)])] or [_names([], length)]
    owner = np.concatenate([first + part[0] for first, part in zip([*starts, 0], parts)])
    return owner, np.concatenate([part[1] for part in parts]), np.concatenate([part[2] for part in parts])


def _names(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    whole = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if len(whole) < length:
        empty = np.empty(0, np.int64)
        return empty, np.empty((0, 2), np.int64), empty.astype(np.uint64)
    least = _least(whole, length)
    long = np.flatnonzero(sizes >= length)
    starts = (np.cumsum(sizes) - sizes)[long]
    ends = starts + sizes[long] - length + 1
    change = np.r_[True, least[1:] != least[:-1]]
    change[starts] = True
    first = np.flatnonzero(change)
    past = np.r_[first[1:], len(least)]
    text = np.searchsorted(starts, first, side="right") - 1
    inside = (text >= 0) & (first < ends[text]) if len(long) else np.zeros(len(first), bool)  # others cross into the next text
    first, past, text = first[inside], past[inside], text[inside]
    past = np.minimum(past, ends[text])
    return long[text], np.column_stack([first - starts[text], past - starts[text]]), least[first]


#: Bits of a name that are sent; the bucket stands for further bits.
SENT = 40


def _pack(short: np.ndarray) -> np.ndarray:
    """The five bytes of each shortened name."""
    return np.ascontiguousarray(short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).ravel()


def _unpack(packed: np.ndarray) -> np.ndarray:
    out = np.zeros((len(packed) // 5, 8), np.uint8)
    out[:, :5] = packed.reshape(-1, 5)
    return out.view("<u8").ravel()


def _codes(name: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket and the shortened name in one number, which sorts by bucket."""
    return (name % np.uint64(buckets)) << np.uint64(SENT) | name >> np.uint64(64 - SENT)


def _cells(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all cells of a binary column without nulls, one after another, and the size of each cell."""
    cells = column.cast(pa.large_binary()).combine_chunks()
    if not len(cells):
        return np.empty(0, np.uint8), np.empty(0, np.int64)
    _, offsets, data = cells.buffers()
    ends = np.frombuffer(offsets, np.int64)[cells.offset : cells.offset + len(cells) + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]], np.diff(ends)


def _binary(data: np.ndarray | bytes, sizes: np.ndarray) -> pa.Array:
    """A binary column whose cells of these sizes lie one after another in the data."""
    ends = np.r_[0, np.cumsum(sizes)]
    if ends[-1] > np.iinfo(np.int32).max:
        raise OverflowError("over 2 GB in one column")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)
    return starts, np.diff(np.r_[starts, len(values)])


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... for each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are known."""
    if not len(known):
        return np.zeros(len(values), bool)
    known = np.sort(known)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


RIGHT = "unit long, kind string, bucket long, rank long, digest binary, data binary"


class _Unit:
    """The texts of one unit that come first of their equals, in a fixed order, with their runs of windows."""

    def __init__(self, rows: pa.Table, right: pa.Table, length: int) -> None:
        kind = right.column("kind")
        first, self.right, self.verdicts = (right.filter(pc.equal(kind, x)) for x in ("first", "repeated", "verdict"))
        firsts = set(zip(first.column("rank").to_pylist(), first.column("digest").to_pylist()))
        self.rows = []
        texts: dict[tuple[int, bytes], bytes] = {}
        values = rows.column("text").cast(pa.large_binary()).to_pylist()
        for i, (rank, text) in enumerate(zip(rows.column("rank").to_pylist(), values)):
            key = (rank, hashlib.sha256(text).digest())
            self.rows.append((i, key, text))
            if key in firsts:
                texts[key] = text
        self.keys = sorted(texts)
        self.texts = [texts[key] for key in self.keys]
        self.ranks = np.array([rank for rank, _ in self.keys], np.int64)
        self.owner, self.spans, self.name = names(self.texts, length)

    def repeated(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the runs whose name another text has too, and which of them have a hot name."""
        data, sizes = _cells(self.right.column("data"))
        counts = sizes // 5
        bucket, cold = (self.right.column(x).to_numpy() for x in ("bucket", "rank"))
        known = np.repeat(bucket.astype(np.uint64), counts) << np.uint64(SENT) | _unpack(data)
        codes = _codes(self.name, buckets)
        runs = np.flatnonzero(_among(codes, known))
        return runs, _among(codes[runs], known[_within(counts) >= np.repeat(cold, counts)])

    def segments(self, buckets: int, length: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different pieces of text under repeated names, numbered; and of each occurrence text, first window, bucket and piece.

        A run is one piece, which goes where its name goes. What lies around a passage differs between texts, so the runs of a hot
        name are cut into windows, which go by their content: equal ones are one piece of the unit, others spread.
        """
        runs, hot = self.repeated(buckets)
        spans = self.spans[runs]
        many = np.where(hot, spans[:, 1] - spans[:, 0], 1)
        of = np.repeat(np.arange(len(runs)), many)
        begin = spans[of, 0] + _within(many)
        end = np.where(hot[of], begin + 1, spans[of, 1]) + length - 1
        owner = self.owner[runs][of]
        bucket = (self.name[runs][of] % np.uint64(buckets)).astype(np.int64)
        whole = b"".join(self.texts)
        sizes = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        starts = (np.cumsum(sizes) - sizes)[owner]
        pieces = [whole[a:b] for a, b in zip((starts + begin).tolist(), (starts + end).tolist())]
        for i in np.flatnonzero(hot[of]).tolist():
            bucket[i] = zlib.crc32(pieces[i]) % buckets
        number = {piece: i for i, piece in enumerate(dict.fromkeys(pieces))}
        return list(number), owner, begin, bucket, np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))

    def gone(self, buckets: int, length: int) -> tuple[list[int], list[int], list[int]]:
        """Begins and ends of the parts that smaller ranks have, in order of texts and places; where each text's parts begin."""
        _, owner, first, _, piece_of = self.segments(buckets, length)
        verdicts = _cells(self.verdicts.column("data"))[0].view(np.int64).reshape(-1, 4)
        verdicts = verdicts[np.argsort(verdicts[:, 0])]
        start = np.searchsorted(verdicts[:, 0], piece_of)
        many = np.searchsorted(verdicts[:, 0], piece_of, side="right") - start
        of = np.repeat(np.arange(len(piece_of)), many)
        _, a, b, rank = verdicts[np.repeat(start, many) + _within(many)].T
        taken = rank < self.ranks[owner[of]]
        of, a, b = of[taken], a[taken], b[taken]
        # Places count through all texts, with one place between texts, so that parts of two texts never touch.
        sizes = np.fromiter(map(len, self.texts), np.int64, len(self.texts)) + 1
        starts = np.cumsum(sizes) - sizes
        base = starts[owner[of]] + first[of]
        order = np.argsort(base + a)
        begin, end = (base + a)[order], np.maximum.accumulate((base + b)[order] + length - 1)
        new = np.r_[True, begin[1:] > end[:-1]][: len(begin)]
        last = np.r_[new[1:], True][: len(end)]
        begin, end = begin[new], end[last]
        text = np.searchsorted(starts, begin, side="right") - 1
        cuts = np.searchsorted(text, np.arange(len(self.texts) + 1))
        return (begin - starts[text]).tolist(), (end - starts[text]).tolist(), cuts.tolist()


def _name_rows(buckets: int, length: int):
    def run(key, rows, right):
        unit = _Unit(rows, right, length)
        codes = _codes(unit.name, buckets)
        order = np.argsort(codes)
        code, owner = codes[order], unit.owner[order]
        starts, counts = _runs(code)
        several = np.repeat(counts > 1, counts)  # a text counts once
        pairs = np.lexsort((owner[several], code[several]))
        some, owner = code[several][pairs], owner[several][pairs]
        new = np.r_[True, (some[1:] != some[:-1]) | (owner[1:] != owner[:-1])][: len(some)]
        code = code[starts]
        counts[counts > 1] = _runs(some[new])[1]
        bucket = code >> np.uint64(SENT)
        starts, many = _runs(bucket)
        once = counts == 1
        ones = np.add.reduceat(once, starts, dtype=np.int64) if len(starts) else many
        return pa.table(
            {
                "bucket": bucket[starts].astype(np.int64),
                "unit": np.full(len(starts), key[0].as_py()),
                "once": _binary(_pack(code[once]), 5 * ones),
                "more": _binary(_pack(code[~once]), 5 * (many - ones)),
                "texts": _binary(counts[~once].astype(np.int32), 4 * (many - ones)),
            },
            schema=pa.schema([("bucket", pa.int64()), ("unit", pa.int64()), *((x, pa.binary()) for x in ("once", "more", "texts"))]),
        )

    return run


def _common(hot: int):
    """Names that two texts of any unit have, sent back to each unit that has them; those of over `hot` texts come last."""

    def run(key, rows):
        units = rows.column("unit").to_numpy()
        (once, sizes), (more, sizes_more), (texts, _) = (_cells(rows.column(x)) for x in ("once", "more", "texts"))
        all_ = np.r_[_unpack(once), _unpack(more)]
        row = np.r_[np.repeat(np.arange(len(units)), sizes // 5), np.repeat(np.arange(len(units)), sizes_more // 5)]
        name, of = np.unique(all_, return_inverse=True)
        counts = np.bincount(of, np.r_[np.ones(len(once) // 5), np.frombuffer(texts.tobytes(), np.int32)], len(name)).astype(np.int64)[of]
        place = np.flatnonzero(counts > 1)
        often = counts[place] > max(hot, 1)
        order = np.argsort(2 * row[place] + often, kind="stable")
        all_, row, often = all_[place[order]], row[place[order]], often[order]
        starts, many = _runs(row)
        return pa.table(
            {
                "unit": units[row[starts]],
                "bucket": np.full(len(starts), key[0].as_py()),
                "rank": many - np.add.reduceat(often, starts, dtype=np.int64) if len(starts) else many,
                "data": _binary(_pack(all_), 5 * many),
            },
            schema=pa.schema([("unit", pa.int64()), ("bucket", pa.int64()), ("rank", pa.int64()), ("data", pa.binary())]),
        )

    return run


def _segment_rows(buckets: int, length: int):
    def run(key, rows, right):
        unit = _Unit(rows, right, length)
        pieces, owner, _, to, piece_of = unit.segments(buckets, length)
        low = np.full(len(pieces), LAST)
        high = np.full(len(pieces), np.iinfo(np.int64).min)
        bucket = np.zeros(len(pieces), np.int64)
        np.minimum.at(low, piece_of, unit.ranks[owner])
        np.maximum.at(high, piece_of, unit.ranks[owner])
        bucket[piece_of] = to
        order = np.argsort(bucket, kind="stable")
        starts, many = _runs(bucket[order])
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))[order]
        return pa.table(
            {
                "bucket": bucket[order[starts]],
                "unit": np.full(len(starts), key[0].as_py()),
                "numbers": _binary(order.astype(np.int32), 4 * many),
                "low": _binary(low[order], 8 * many),
                "high": _binary(high[order], 8 * many),
                "sizes": _binary(sizes.astype(np.int32), 4 * many),
                "data": _binary(b"".join([pieces[i] for i in order.tolist()]), np.add.reduceat(sizes, starts) if len(starts) else many),
            },
            schema=pa.schema([("bucket", pa.int64()), ("unit", pa.int64()), *((x, pa.binary()) for x in ("numbers", "low", "high", "sizes", "data"))]),
        )

    return run


def _verdicts(length: int):
    """Sort the windows of a bucket's pieces; send back to each unit the smallest rank that has each window."""

    def run(key, rows):
        sizes, per_row = _cells(rows.column("sizes"))
        sizes = sizes.view(np.int32)
        units = np.repeat(rows.column("unit").to_numpy(), per_row // 4)
        number = _cells(rows.column("numbers"))[0].view(np.int32)
        low, high = (_cells(rows.column(x))[0].view(np.int64) for x in ("low", "high"))
        ends = np.cumsum(sizes, dtype=np.int64)
        data = _cells(rows.column("data"))[0].tobytes()
        pieces = [data[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        distinct = {piece: i for i, piece in enumerate(dict.fromkeys(pieces))}
        same = np.fromiter(map(distinct.__getitem__, pieces), np.int64, len(pieces))
        least = np.full(len(distinct), LAST)
        np.minimum.at(least, same, low)
        text = Text(list(distinct), depth=length)
        sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
        counts = sizes - length + 1
        first = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(distinct)), counts)
        at = text.starts[owner] + np.arange(counts.sum()) - first[owner]
        found = np.empty(text.size, np.int64)
        rank_at = np.empty(text.size, np.int64)
        rank_at[at] = least[owner]
        for block in text.blocks(at):
            starts = np.flatnonzero(~text.alike(block, length))
            smallest = np.minimum.reduceat(rank_at[block], starts)
            found[block] = np.repeat(smallest, np.diff(np.r_[starts, len(block)]))
        found = found[at]
        # Runs of one rank within a piece, and for each unit's copy of the piece those runs, if they take anything away.
        cuts = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])])
        past = np.r_[cuts[1:], len(found)]
        of, begin, end, value = owner[cuts], cuts - first[owner[cuts]], past - first[owner[cuts]], found[cuts]
        runs_from = np.searchsorted(of, np.arange(len(distinct)))
        runs_of = np.diff(np.r_[runs_from, len(of)])
        asked = np.flatnonzero(np.minimum.reduceat(value, runs_from)[same] < high)
        asked = asked[np.argsort(units[asked], kind="stable")]
        many = runs_of[same[asked]]
        run_ = np.repeat(runs_from[same[asked]], many) + _within(many)
        table = np.column_stack([np.repeat(number[asked], many), begin[run_], end[run_], value[run_]]).astype(np.int64)
        unit = np.repeat(units[asked], many)
        starts, many = _runs(unit)
        return pa.table(
            {"unit": unit[starts], "data": _binary(table, table.itemsize * table.shape[1] * many)},
            schema=pa.schema([("unit", pa.int64()), ("data", pa.binary())]),
        )

    return run


def _removed(buckets: int, length: int, kept: bool):
    def run(key, rows, right):
        unit = _Unit(rows, right, length)
        begin, end, cuts = unit.gone(buckets, length)
        place = {own: i for i, own in enumerate(unit.keys)}
        out = {"id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
        ids = rows.column("id")
        for i, own, text in unit.rows:
            if own in place:
                a, b = cuts[place[own] : place[own] + 2]
                merged = list(zip(begin[a:b], end[a:b]))
            else:
                merged = [(0, len(text))] if len(text) >= length else []
            ends = [0, *(b for _, b in merged)]
            rest = b"".join([text[a:b] for a, b in zip(ends, [*(a for a, _ in merged), len(text)])])
            out["n_bytes"].append(len(text))
            out["n_removed"].append(len(text) - len(rest))
            out["n_spans"].append(len(merged))
            out["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
            out["kept"].append(rest if kept else None)
        out["id"] = ids
        kinds = [("id", ids.type), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]
        return pa.table(out, schema=pa.schema(kinds))

    return run


def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, kept: bool = True, unit_bytes: int = UNIT, hot: int = HOT
) -> DataFrame:
    """Remove each byte covered by a `length`-byte string that also starts in a document with a smaller id.

    Returns id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that are left; null if `kept` is false).

    Equal texts are found by digest; only the one with the smallest id is searched, the others go whole. Texts are dealt out by id
    and digest into units of about `unit_bytes`. Windows are named by the least hash of their 20-byte strings; units exchange names only,
    and learn which of theirs another text has. The pieces under these names, each once per unit, meet by name. There their
    suffixes are sorted one block at a time, ties of over 31 bytes by the ranks of a difference-cover sample, and neighbours that
    agree in `length` bytes share the smallest rank. Names only select; what decides is the text. A piece reaches beyond the
    passage that gave its name, so pieces around a common passage differ: a name that more than `hot` texts have is cut into
    windows that are dealt out by content, each once per unit.

    Null counts as empty. A null id is larger than any other; rows of equal ids do not remove each other's bytes, and rows that
    repeat id and text get equal results. `length` is at least 20. An empty table gives no rows.
    """
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rank = F.coalesce(F.col(id).cast("long"), F.lit(LAST))
    given = docs.select(F.col(id).alias("id"), rank.alias("rank"), value.alias("text"))
    total = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    units = max(8, -(-total // unit_bytes))
    buckets = min(units, 1 << (64 - SENT))

    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    unit = F.pmod(F.xxhash64("rank", "digest"), F.lit(units)).alias("unit")
    rows = given.select("id", "rank", "text", digest).select("id", "rank", "text", unit)
    firsts = given.groupBy(digest).agg(F.min("rank").alias("rank"))

    def right(df: DataFrame, kind: str) -> DataFrame:
        have = set(df.columns)
        kinds = {"unit": "long", "bucket": "long", "rank": "long", "digest": "binary", "data": "binary"}
        columns = [F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
        return df.select(columns[0], F.lit(kind).alias("kind"), *columns[1:])

    first = right(firsts.select(unit, "rank", "digest"), "first")
    by_unit = rows.groupBy("unit")
    names_ = by_unit.cogroup(first.groupBy("unit")).applyInArrow(
        _name_rows(buckets, length), "bucket long, unit long, once binary, more binary, texts binary"
    )
    common = right(names_.groupBy("bucket").applyInArrow(_common(hot), "unit long, bucket long, rank long, data binary"), "repeated")
    known = first.union(common)
    pieces = by_unit.cogroup(known.groupBy("unit")).applyInArrow(
        _segment_rows(buckets, length),
        "bucket long, unit long, numbers binary, low binary, high binary, sizes binary, data binary",
    )
    decided = right(pieces.groupBy("bucket").applyInArrow(_verdicts(length), "unit long, data binary"), "verdict")
    shape = StructType(
        [
            StructField("id", docs.schema[id].dataType),
            *(StructField(name, LongType()) for name in ("n_bytes", "n_removed", "n_spans")),
            StructField("kept_sha256", StringType()),
            StructField("kept", BinaryType()),
        ]
    )
    return by_unit.cogroup(known.union(decided).groupBy("unit")).applyInArrow(_removed(buckets, length, kept), shape)
