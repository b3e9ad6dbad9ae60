"""Ranked search by Block-Max MaxScore over the shards of an index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from shopstrata.llm.common import as_bytes, non_empty, written
from shopstrata.llm.lexical_index import DOCS, LISTS, build, terms_of, unpacked_block

#: Queries that a task takes at once, and documents between two looks at the bounds.
AT_ONCE, WINDOW = 256, 256
#: Entries of the query table up to which it is broadcast: 2^18 terms with what belongs to them, some 20 MB.
SMALL = 1 << 18
PIECE = 10**9


def share(often: np.ndarray, length: np.ndarray, docs: int, total: int) -> np.ndarray:
    """What a term's weight is multiplied with: (10^9 tf) div (1000 tf + 8 m), m = 10 + (90 n N) div L."""
    length = np.asarray(length, np.int64)
    times = 90 * docs
    if len(length) and int(length.max()) * times >= 1 << 63:
        m = np.array([10 + times * int(n) // total for n in length], np.int64)
    else:
        m = 10 + times * length // total
    return PIECE * often // (1000 * often + 8 * m)


class List:
    """The postings of a term in a shard. Blocks stay compressed until a document in them is needed."""

    def __init__(self, weight: int, blocks: list[dict], lengths: np.ndarray, docs: int, total: int) -> None:
        blocks = sorted(blocks, key=lambda row: row["block"])
        self.weight, self.lengths, self.docs, self.total = weight, lengths, docs, total
        self.first = np.array([row["first"] for row in blocks])
        self.last = np.array([row["last"] for row in blocks])
        most, least = (np.array([row[name] for row in blocks]) for name in ("most", "least"))
        self.bounds = weight * share(most, least, docs, total)
        self.bound = int(self.bounds.max())
        self.payloads = [row["payload"] for row in blocks]
        self.opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and their scores for this term."""
        if at not in self.opened:
            docs, often = unpacked_block(self.payloads[at], int(self.first[at]))
            self.opened[at] = docs, self.weight * share(often, self.lengths[docs], self.docs, self.total)
        return self.opened[at]

    def within(self, first: int, past: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Postings of documents from `first` on and before `past`, block by block."""
        for at in range(int(np.searchsorted(self.last, first)), int(np.searchsorted(self.first, past))):
            docs, scores = self.block(at)
            if docs[0] < first or docs[-1] >= past:
                inner = slice(*np.searchsorted(docs, (first, past)))
                docs, scores = docs[inner], scores[inner]
            yield docs, scores


def best(lists: list[List], n_docs: int, order: np.ndarray, k: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """The k best (place, score) of a shard. `order` ranks places for ties.

    Lists are sorted by their bounds. A document that is only in the first few, whose bounds together stay below the k-th best score so
    far, cannot be among the best; so candidates come from the other, essential lists. The others are looked up from the
    largest bound down, and a candidate goes as soon as its score with the maximum of its block and the bounds of the rest
    stays below: most blocks are never opened.
    """
    lists = sorted(lists, key=lambda one: one.bound)
    reach = np.cumsum([one.bound for one in lists])
    found = np.empty((0, 2), np.int64)
    least = 1
    for first in range(0, n_docs, window):
        essential = int(np.searchsorted(reach, least))
        if essential == len(lists):
            break
        score, past = np.zeros(window, np.int64), first + window
        for one in lists[essential:]:
            for docs, scores in one.within(first, past):
                score[docs - first] += scores
        docs = np.flatnonzero(score)
        score, docs = score[docs], docs + first
        for at in range(essential - 1, -1, -1):
            one, rest = lists[at], int(reach[at - 1]) if at else 0
            stays = score + reach[at] >= least
            docs, score = docs[stays], score[stays]
            if not len(docs):
                break
            block = np.minimum(np.searchsorted(one.last, docs), len(one.last) - 1)
            holds = (one.first[block] <= docs) & (docs <= one.last[block])
            stays = score + np.where(holds, one.bounds[block], 0) + rest >= least
            docs, score, block, holds = docs[stays], score[stays], block[stays], holds[stays]
            for b in np.unique(block[holds]).tolist():
                inside, scores = one.block(b)
                which = np.flatnonzero(block == b)
                place = np.minimum(np.searchsorted(inside, docs[which]), len(inside) - 1)
                score[which] += np.where(inside[place] == docs[which], scores[place], 0)
        keep = score >= least
        found = np.concatenate([found, np.column_stack([docs[keep], score[keep]])])
        if len(found) > k:
            found = found[np.lexsort((order[found[:, 0]], -found[:, 1]))[:k]]
        if len(found) == k:
            least = max(least, int(found[:, 1].min()))
    return [(int(doc), int(score)) for doc, score in found]


def query_terms(queries: DataFrame, text: str) -> DataFrame:
    """Each query's distinct terms: the columns of `queries` but `text`, and `term`."""
    rest = [name for name in queries.columns if name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            terms, owners = terms_of(as_bytes(batch.column(text)))
            table = pa.table({"owner": owners, "term": terms}).group_by(["owner", "term"]).aggregate([])
            given = batch.select(rest).take(table["owner"].combine_chunks())
            yield pa.RecordBatch.from_arrays([*given.columns, table["term"].combine_chunks()], names=[*rest, "term"])

    schema = ", ".join(f"{name} long" for name in rest)
    return queries.mapInArrow(run, f"{schema}, term binary")


def search(index: DataFrame, queries: DataFrame, k: int = 10, id: str = "item_id", text: str = "text") -> DataFrame:
    """The k best documents of an index for each row of `queries`: its id as `query_id`, rank from 1, doc_id, score.

    Lists of the queries' terms meet shard by shard, with up to 256 queries in a task; a shard gives each query at most k
    documents, and the k best of all shards' are the result. The queries' terms are broadcast while there are at most 2^18
    of them, and joined by shuffle beyond.

    A null or empty query has no terms and no result, nor has a document without terms. Rows of `queries` with one id are
    queries of their own. Equal scores go by ascending doc_id, null last. Weights are floor(1000 ln((2N+2)/(2df+1))).
    """
    spark = index.sparkSession
    numbered = queries.select(F.col(id).cast("long").alias("query_id"), F.monotonically_increasing_id().alias("query"), F.col(text).cast("string").alias("text"))
    wanted = written(query_terms(numbered, "text"), "query-terms")
    n_queries, n_terms = wanted.agg(F.count_distinct("query"), F.count(F.lit(1))).first()
    parts = -(-n_queries // AT_ONCE) or 1
    wanted = wanted.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int"))
    users = wanted.groupBy("term", "part").agg(F.collect_list("query").alias("users"))  # at most those of a part

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n_terms <= SMALL else df

    lists = index.filter(F.col("kind") == LISTS).drop("n_terms")
    hits = written(lists.join(small(wanted.select("term").distinct()), "term"), "query-lists")
    about = index.filter(F.col("kind") == DOCS).select("shard", "kind", "n_rows", "n_terms", "payload")
    shards, docs, total = about.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_rows"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * docs + 2) / (2 * F.sum("n_rows") + 1))).cast("long")
    weights = written(hits.groupBy("term").agg(weight.alias("weight")).filter("weight > 0"), "query-weights")
    used = hits.join(small(weights.join(users, "term")), "term")
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    used = used.unionByName(about.select("shard", "kind", "payload", every_part), allowMissingColumns=True)

    def run(key: tuple, group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        head = next(row["payload"] for row in rows if row["kind"] == DOCS)
        size = len(head) // 17
        ids, lengths = np.frombuffer(head, np.int64, 2 * size).reshape(2, size)
        known = np.frombuffer(head, np.uint8, size, 16 * size)
        order = np.empty(size, np.int64)
        order[np.lexsort((ids, 1 - known))] = np.arange(size)
        blocks: dict[bytes, list[dict]] = {}
        of_query: dict[int, list[bytes]] = {}
        for row in rows:
            if row["kind"] == LISTS:
                if row["term"] not in blocks:
                    for query in row["users"]:
                        of_query.setdefault(query, []).append(row["term"])
                blocks.setdefault(row["term"], []).append(row)
        lists = {term: List(found[0]["weight"], found, lengths, docs, total) for term, found in blocks.items()}
        out = []
        for query, terms in of_query.items():
            for place, score in best([lists[term] for term in terms], size, order, k):
                out.append((query, int(ids[place]) if known[place] else None, score))
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table({"query": pa.array(columns[0], pa.int64()), "doc_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.int64())})

    tasks = min(max(shards * parts // 2, 1), 100_000)  # a task has two shards or so, however many there are
    found = used.repartition(tasks, "shard", "part").groupBy("shard", "part").applyInArrow(run, "query long, doc_id long, score long")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    top = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    names = wanted.select("query", "query_id").distinct()
    return top.join(names, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked(docs: DataFrame, queries: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text", query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """Index all of `docs`, then search it; see `build` and `search`."""
    return search(build(docs, id, text), queries, k, query_id, query_text)
