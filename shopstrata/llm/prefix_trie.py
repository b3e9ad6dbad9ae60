"""The prefix trie of conversations, from whole sequences collapsed first."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from shopstrata.llm.common import non_empty, written

#: Turns hashed as one chain, and turns summed in one window. A longer sequence has several of them.
CHAIN, SPAN = 256, 4096
ROOT = b""
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _hash(before: bytes, one: bytes) -> bytes:
    return hashlib.blake2b(before + one, digest_size=16).digest()


def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns as (conv, pos from 1, turn_hash, n_bytes of text), in the order of `turn`, null first.

    Null roles and texts count as empty; rows without a conversation are left out; equal turns go by role, then text.
    Rows are dealt out by ranges of all sort columns, so a conversation of any length lies in as many tasks as it needs.
    """
    rows = turns.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),  # lets ranges part equal rows
    ).filter("conv IS NOT NULL")
    order = ["conv", F.asc_nulls_first("turn"), "role", "text", "row"]
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    placed = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv",
            F.monotonically_increasing_id().alias("place"),  # the partition above bit 33, then the place in it
            F.unhex(F.sha2(whole, 256)).alias("turn_hash"),
            F.octet_length("text").cast("long").alias("n_bytes"),
        ),
        "trie-turns",
    ).withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy("conv", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select("conv", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return placed.join(offsets, ["conv", "part"]).select("conv", (F.col("place") + F.col("shift")).alias("pos"), "turn_hash", "n_bytes")


def rebuilt(turns: DataFrame, group: int = 5, most: int = 8) -> DataFrame:
    """Each conversation c as the first h turns of conversation c - c % 5, then its own turns after its first h.

    h is crc32(decimal c) % 9. Returns (conv, length, pos, turn_hash, n_bytes); a conversation without turns has one row with
    pos 0.
    """
    own = F.crc32(F.col("conv").cast("string")) % (most + 1)
    counts = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).withColumn("h", own)
    bases = counts.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = counts.withColumn("base", F.col("conv") - F.col("conv") % group).join(bases, "base", "left")
    convs = written(convs.withColumn("taken", taken).select("conv", "base", "h", "taken", length.alias("length")), "trie-conversations")
    late = turns.join(convs.select("conv", "h", "taken", "length"), "conv").filter("pos > h")
    late = late.select("conv", "length", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn_hash", "n_bytes")
    heads = turns.filter((F.col("pos") <= most) & (F.col("conv") % group == 0)).withColumnRenamed("conv", "base")
    early = heads.join(convs, "base").filter("pos <= h").select("conv", "length", "pos", "turn_hash", "n_bytes")
    none = convs.filter("length = 0").select("conv", "length", F.lit(0).cast("long").alias("pos"), F.lit(ROOT).alias("turn_hash"), F.lit(0).cast("long").alias("n_bytes"))
    return late.unionByName(early).unionByName(none)


def _stream(rows: DataFrame, keys: list[str], order: list[str], schema: str, step: Callable) -> DataFrame:
    """Rows of a key in order, each with what `step(before, row)` makes of it and of the one before; nothing is gathered."""
    names = [*rows.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, before = None, None
        for batch in non_empty(batches):
            found = []
            for row in batch.select(names).to_pylist():
                now = tuple(row[name] for name in keys)
                if now != key:
                    key, before = now, None
                before = step(before, row)
                found.append(before)
            made = list(zip(*found, strict=True))
            columns = [*batch.select(names).columns, *(pa.array(x, pa.binary()) for x in made)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *schema.split()])

    out = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in rows.schema] + [f"{name} binary" for name in schema.split()])
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, out)


def prefixes(turns: DataFrame) -> DataFrame:
    """Every prefix of every conversation: `node` stands for the sequence of its turns, `parent` for that without the last.

    Equal sequences have equal nodes, whoever holds them. Up to 256 turns are hashed as one chain; the chains of
    a longer conversation are joined by their ends, 1 row of 256 turns.
    """
    block = F.floor((F.col("pos") - 1) / CHAIN).cast("long").alias("block")
    some = turns.filter("pos > 0").select("*", block)

    def local(before, row):
        last = before[0] if before else ROOT
        return _hash(last, row["turn_hash"]), last

    chains = written(_stream(some, ["conv", "block"], ["pos"], "node parent", local).drop("turn_hash"), "trie-chains")
    ends = chains.filter((F.col("pos") % CHAIN == 0) & (F.col("pos") < F.col("length"))).select("conv", "block", F.col("node").alias("chain"))
    starts = _stream(ends, ["conv"], ["block"], "start", lambda before, row: (_hash(before[0], row["chain"]) if before else row["chain"],))
    starts = starts.select("conv", (F.col("block") + 1).alias("block"), "start")

    def mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            start, node, parent = (batch.column(name).to_pylist() for name in ("start", "node", "parent"))
            nodes = [_hash(a, b) for a, b in zip(start, node, strict=True)]
            parents = [_hash(a, b) if b else a for a, b in zip(start, parent, strict=True)]
            rest = [batch.column(name) for name in ("conv", "length", "pos", "n_bytes")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(nodes, pa.binary()), pa.array(parents, pa.binary())], names=["conv", "length", "pos", "n_bytes", "node", "parent"]
            )

    columns = ["conv", "length", "pos", "n_bytes", "node", "parent"]
    far = chains.filter("block > 0").join(starts, ["conv", "block"])
    far = far.mapInArrow(mixed, "conv long, length long, pos long, n_bytes long, node binary, parent binary")
    none = turns.filter("pos = 0").select("conv", "length", "pos", "n_bytes", F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"))
    return chains.filter("block = 0").select(*columns).unionByName(far).unionByName(none)


def end_lists(ends: DataFrame) -> DataFrame:
    """The SHA-256 of each sequence's conversations: decimal, ascending, joined by commas.

    Numbers are first put together by 65,536s; the texts of a sequence then pass through its hash in order, one by one.
    """
    text = F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))).alias("text")
    runs = ends.groupBy("node", F.shiftright("conv", 16).alias("bucket")).agg(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, found = None, None, []
        for batch in non_empty(batches):
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if node == key:
                    state.update(b",")
                else:
                    if state:
                        found.append((key, state.hexdigest()))
                    key, state = node, hashlib.sha256()
                state.update(text.encode())
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], names=["node", "ends_sha256"])
                found = []
        if state:
            found.append((key, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found])], names=["node", "ends_sha256"])

    return runs.repartition("node").sortWithinPartitions("node", "bucket").select("node", "text").mapInArrow(run, "node binary, ends_sha256 string")


def trie(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie over (conv, length, pos, turn_hash, n_bytes), as `rebuilt` gives them; an empty table has none.

    Identical conversations are collapsed into one weighted sequence with the list of those that end there; sequences that are
    a proper prefix of another are no leaves, which an anti-join tells; weights are summed by prefix. Each node is owned
    by one leaf below it, so that the sum over a subtree is the sum over its leaves of what they own from there on.

    Returns node, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    every = written(prefixes(sequences), "trie-prefixes")
    ends = every.filter("pos = length").select("node", "conv", "length")
    groups = written(ends.groupBy("node").agg(F.count(F.lit(1)).alias("weight"), F.min("conv").alias("conv")), "trie-groups")
    kept = every.join(groups.select(F.col("node").alias("sequence"), "weight", "conv"), "conv")
    inner = kept.filter("pos < length").select("node").distinct()
    above = groups.filter(F.col("node") != F.lit(ROOT)).select(F.lit(ROOT).alias("node")).limit(1)
    leaves = groups.join(inner.unionByName(above), "node", "left_anti").select(F.col("node").alias("sequence"), F.lit(1).alias("leaf"))
    rows = written(kept.filter("pos > 0").join(leaves, "sequence", "left").fillna(0, ["leaf"]), "trie-rows")
    roots = groups.join(leaves.withColumnRenamed("sequence", "node"), "node", "left").select(
        F.lit(ROOT).alias("node"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("n_bytes"),
        "weight", "conv", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.lit(None).cast("binary").alias("sequence"),
    )
    nodes = written(
        rows.unionByName(roots, allowMissingColumns=True)
        .groupBy("node")
        .agg(
            F.min("conv").alias("conv_id"),
            F.max("pos").alias("depth"),
            F.max("parent").alias("parent"),
            F.sum("weight").alias("n_convs"),
            F.sum("leaf").alias("n_leaves"),
            F.min(F.when(F.col("leaf") == 1, F.col("sequence"))).alias("owner"),
            ((F.sum("weight") - 1) * F.max("n_bytes")).alias("saved"),
        ),
        "trie-nodes",
    )
    spans = F.floor(F.col("pos") / SPAN).cast("long").alias("span")
    mine = F.when(F.col("owner") == F.col("sequence"), F.col("saved")).otherwise(0).alias("mine")
    paths = rows.filter("leaf = 1").select("sequence", "pos", "node", spans).join(nodes.select("node", "conv_id", "owner", "saved"), "node")
    paths = written(paths.select("sequence", "pos", "span", "node", "conv_id", mine), "trie-paths")
    totals = paths.groupBy("sequence", "span").agg(F.sum("mine").alias("total"), F.max_by("conv_id", "pos").alias("last"))
    along = W.partitionBy("sequence").orderBy("span")
    carried = totals.select(
        "sequence",
        "span",
        F.coalesce(F.sum("total").over(along.rowsBetween(1, W.unboundedFollowing)), F.lit(0)).alias("later"),
        F.lag("last").over(along).alias("above"),
    )
    here = W.partitionBy("sequence", "span").orderBy("pos")
    local = paths.select(
        "sequence", "span", "node", F.sum("mine").over(here.rowsBetween(W.currentRow, W.unboundedFollowing)).alias("below"), F.lag("conv_id").over(here).alias("before")
    )
    summed = local.join(carried, ["sequence", "span"]).groupBy("node").agg(
        F.sum(F.col("below") + F.col("later")).alias("saved_tokens"), F.max(F.coalesce("before", "above")).alias("above")
    )
    of_root = nodes.agg(F.sum("saved").alias("saved_tokens")).select(F.lit(ROOT).alias("node"), "saved_tokens", F.lit(None).cast("long").alias("above"))
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    first = groups.agg(F.min("conv")).scalar()
    return (
        nodes.join(summed.unionByName(of_root), "node")
        .join(children, "node", "left")
        .join(end_lists(ends), "node", "left")
        .select(
            "node",
            "conv_id",
            "depth",
            F.when(F.col("depth") == 1, first).otherwise(F.col("above")).alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.col("n_leaves").cast("long").alias("n_leaves"),
            F.col("saved_tokens").cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
