"""Chat formatting: link quoted passages to the messages they come from, and order replies without their quotes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from shopstrata.llm.common import non_empty, packed, written

_MARK = re.compile(r"[ \t]*((?:>[ \t]?)+)")
#: The line that names whom a quote is from, in the languages of the corpus, and how it begins where it is broken in two.
_SAID = re.compile(
    r"^\s*(?:On|Am|Le|El|Il|Op|Em|В)?\b.{0,200}\b(?:wrote|schrieb|écrit|a écrit|escribió|ha scritto|schreef|escreveu|пишет|писала?|написала?)\b.{0,80}:\s*$",
    re.I,
)
_BROKEN = re.compile(r"^\s*(?:(?:On|Am|Le|El|Il|Op|Em|В)\b.*\d|.*<[^<>\s]+@[^<>\s]+>)", re.I)
#: Marks from which lines that stand alone are taken for an interpreter's prompt.
PROMPT = 3
_PLAIN = re.compile(r"\W+")


def normalised(lines: Iterable[str]) -> str:
    """Lower case, with everything but letters and digits as one space."""
    return _PLAIN.sub(" ", " ".join(lines).lower()).strip()


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _level(line: str) -> tuple[int, str]:
    marks = _MARK.match(line)
    return (marks.group(1).count(">"), line[marks.end() :]) if marks else (0, line)


def _without_source(own: list[str]) -> bool:
    """Take the line or two that say whom a quote is from off the end, with empty lines after; False if there is none."""
    end = len(own)
    while end and not own[end - 1].strip():
        end -= 1
    if not end or not _SAID.match(own[end - 1]):
        return False
    broken = end > 1 and not _BROKEN.match(own[end - 1]) and _BROKEN.match(own[end - 2])
    del own[end - 2 if broken else end - 1 :]
    return True


def parse(text: str) -> tuple[str, list[tuple[int, list[str]]]]:
    """A message's own text, and its quoted passages: level, and lines at that level in a row.

    The level is the number of marks in front. A line that says who wrote what follows goes with the quote, also where it is broken
    in two. Lines of three or more marks that no line with fewer and no such line goes with are a prompt's: own text.
    """
    own: list[str] = []
    quotes: list[tuple[int, list[str]]] = []
    for quoted, run in groupby(text.split("\n"), key=lambda line: _level(line)[0] > 0):
        lines = list(run)
        if not quoted:
            own += lines
            continue
        levels = [_level(line) for line in lines]
        if not _without_source(own) and min(level for level, _ in levels) >= PROMPT and all(line.lstrip().startswith(">" * PROMPT) for line in lines):
            own += lines
            continue
        while own and not own[-1].strip():
            own.pop()
        for level, group in groupby(levels, key=lambda x: x[0]):
            quotes.append((level, [rest for _, rest in group if not _SAID.match(rest)]))
    return "\n".join(own).strip("\n"), [(level, lines) for level, lines in quotes if normalised(lines)]


def passages(own: str) -> set[int]:
    """Hashes under which a message can be found: as a whole, by paragraph and by line."""
    paragraphs = re.split(r"\n\s*\n", own)
    found = {normalised([own]), *(normalised([x]) for x in paragraphs), *(normalised([x]) for x in own.split("\n"))}
    return {_hash(x) for x in found if x}


def lookups(lines: list[str]) -> list[tuple[int, int, int, int, int]]:
    """What a quoted passage is looked up by: (tier, first line, past the last line, hash, words), the whole before its parts.

    Tier 0 is the whole, 1 its paragraphs (empty quoted lines part them), 2 lines put together again where a client has
    wrapped them, 3 single lines. A line goes on in the next one if that one's first word would not have fitted beside it,
    the longest line of the paragraph being the width.
    """
    ranges: dict[tuple[int, int], int] = {(0, len(lines)): 0}
    filled = [bool(line.strip()) for line in lines]
    starts = [i for i, x in enumerate(filled) if x and not (i and filled[i - 1])]
    ends = [i + 1 for i, x in enumerate(filled) if x and not (i + 1 < len(lines) and filled[i + 1])]
    for first, past in zip(starts, ends):
        ranges.setdefault((first, past), 1)
        width = max(len(lines[i].rstrip()) for i in range(first, past))
        begin = first
        for i in range(first, past):
            ranges.setdefault((i, i + 1), 3)
            if i + 1 == past or len(lines[i].rstrip()) + 1 + len(lines[i + 1].split()[0]) <= width:
                ranges.setdefault((begin, i + 1), 2)
                begin = i + 1
    found = [(tier, a, b, normalised(lines[a:b])) for (a, b), tier in ranges.items()]
    return [(tier, a, b, _hash(x), len(x.split())) for tier, a, b, x in found if x]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = pa.struct([("tier", pa.int32()), ("first", pa.int32()), ("past", pa.int32()), ("hash", pa.int64()), ("words", pa.int32())])
    quote = pa.struct([("level", pa.int32()), ("number", pa.int32()), ("parts", pa.list_(part))])
    for batch in non_empty(batches):
        texts, quoted, hashes = [], [], []
        for value in batch.column("text").to_pylist():
            own, quotes = parse(value or "")
            texts.append(own)
            hashes.append(sorted(passages(own)))
            quoted.append(
                [
                    {"level": level, "number": i, "parts": [dict(zip(("tier", "first", "past", "hash", "words"), x)) for x in lookups(lines)]}
                    for i, (level, lines) in enumerate(quotes)
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in ("row", "conv", "turn")), pa.array(texts, pa.string()), pa.array(quoted, pa.list_(quote)), pa.array(hashes, pa.list_(pa.int64()))],
            names=["row", "conv", "turn", "own", "quotes", "hashes"],
        )


def _latest_before(asked: DataFrame, index: DataFrame) -> DataFrame:
    """For each asked (conv, hash, turn) the latest earlier turn in the index of that conversation and hash, if there is one.

    Askers and holders stand in one order of conversation, hash and turn, cut into ranges; no pairs are made, and a range takes
    over the last holder of the ranges before it. So a line that all messages of a conversation hold and quote is linear and spread.
    """
    held = index.select("conv", "hash", "turn", F.lit(True).alias("holds"))
    every = held.unionByName(asked.withColumn("holds", F.lit(False)))
    every = written(every.repartitionByRange("conv", "hash", "turn").withColumn("range", F.spark_partition_id()), "quote-order")
    within = Window.partitionBy("range", "conv", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    holder = F.when(F.col("holds"), F.col("turn"))
    near = every.withColumn("near", F.max(holder).over(within)).filter("NOT holds")
    before = Window.partitionBy("conv", "hash").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range that a conversation and hash reach into.
    far = every.groupBy("range", "conv", "hash").agg(F.max(holder).alias("last")).withColumn("far", F.max("last").over(before))
    found = near.join(far.filter("far IS NOT NULL").select("range", "conv", "hash", "far"), ["range", "conv", "hash"], "left")
    return found.select("conv", "hash", "turn", F.coalesce("near", "far").alias("from_turn")).filter("from_turn IS NOT NULL")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Root and place of the messages of whole conversations, that come one after the other, by turn; one conversation is held at a time.

    A reply stands behind what it replies to: backwards, sizes of subtrees add up; forwards, each message takes the next places of its parent's.
    """

    def placed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        convs, turns = table.column("conv").to_pylist(), table.column("turn").to_pylist()
        ups = table.column("reply_to").to_pylist()
        roots, places = list(turns), [0] * len(turns)
        start = 0
        for _, run in groupby(convs):
            end = start + sum(1 for _ in run)
            at = {turns[i]: i for i in range(start, end)}
            parents = [None if up is None else at[up] for up in ups[start:end]]
            sizes = dict.fromkeys(range(start, end), 1)
            for i in range(end - 1, start - 1, -1):
                if parents[i - start] is not None:
                    sizes[parents[i - start]] += sizes[i]
            free, heads = {}, 0
            for i in range(start, end):
                parent = parents[i - start]
                if parent is None:
                    places[i] = heads
                    heads += sizes[i]
                else:
                    roots[i], places[i] = roots[parent], free[parent]
                    free[parent] += sizes[i]
                free[i] = places[i] + 1
            start = end
        columns = [*(table.column(name).combine_chunks() for name in ("conv", "turn", "reply_to")), pa.array(roots, pa.int64()), pa.array(places, pa.int64())]
        yield from pa.table(columns, names=["conv", "turn", "reply_to", "root", "place"]).to_batches()

    waiting: list[pa.RecordBatch] = []
    for batch in non_empty(batches):
        convs = batch.column("conv").to_numpy()
        if waiting and convs[0] != waiting[-1].column("conv")[-1].as_py():
            yield from placed(pa.Table.from_batches(waiting))
            waiting = []
        last = int(np.searchsorted(convs, convs[-1]))  # where the conversation begins that may go on in the next batch
        if last:
            yield from placed(pa.Table.from_batches([*waiting, batch.slice(0, last)]))
            waiting = []
        waiting.append(batch.slice(last))
    if waiting:
        yield from placed(pa.Table.from_batches(waiting))


def _long_walk(tree: DataFrame) -> DataFrame:
    """As `_walk`, for conversations of any length, by doubling.

    The walk enters and leaves every message; each step knows the next one. Every round doubles how far a step sees, adding up the
    messages entered on the way, so a conversation of n messages takes log2(2n) joins on (conv, turn, leaving), whatever its depth.
    A conversation with a third of all rows is spread as any other; a message's replies are sorted together, on disk if need be.
    """
    tree = tree.withColumnRenamed("reply_to", "up")
    tree = written(tree.withColumn("beside", F.lead("turn").over(Window.partitionBy("conv", "up").orderBy("turn"))), "reply-tree")
    roots = written(tree.select("conv", "turn", F.coalesce("up", "turn").alias("root")), "roots")
    while True:  # every round doubles the part of a chain that is known
        above = roots.select("conv", F.col("turn").alias("root"), F.col("root").alias("higher"))
        moved = roots.join(above, ["conv", "root"])
        if moved.filter("higher <> root").isEmpty():
            break
        roots = written(moved.select("conv", "turn", F.col("higher").alias("root")), "roots")
    below = tree.filter("up IS NOT NULL").groupBy("conv", F.col("up").alias("turn")).agg(F.min("turn").alias("below"))
    step = lambda to, leaving: F.struct(to.alias("turn"), F.lit(leaving).alias("leaving"))
    known = tree.join(below, ["conv", "turn"], "left")
    enter = F.when(F.col("below").isNotNull(), step(F.col("below"), False)).otherwise(step(F.col("turn"), True))
    leave = F.when(F.col("beside").isNotNull(), step(F.col("beside"), False)).when(F.col("up").isNotNull(), step(F.col("up"), True))
    steps = known.select("conv", step(F.col("turn"), False).alias("at"), F.lit(1).cast("long").alias("entered"), enter.alias("to"))
    steps = steps.unionByName(known.select("conv", step(F.col("turn"), True).alias("at"), F.lit(0).cast("long").alias("entered"), leave.alias("to")))
    steps = written(steps, "walk")
    while not (open_ := steps.filter("to IS NOT NULL")).isEmpty():  # steps that see the end are joined no more
        ahead = steps.select("conv", F.col("at").alias("to"), F.col("entered").alias("more"), F.col("to").alias("further"))
        further = open_.join(ahead, ["conv", "to"]).select("conv", "at", (F.col("entered") + F.col("more")).alias("entered"), F.col("further").alias("to"))
        steps = written(further.unionByName(steps.filter("to IS NULL")), "walk")
    total = tree.groupBy("conv").count()
    entered = steps.filter("NOT at.leaving").select("conv", F.col("at.turn").alias("turn"), "entered")
    placed = entered.join(total, "conv").select("conv", "turn", (F.col("count") - F.col("entered")).alias("place"))
    found = tree.select("conv", "turn", F.col("up").alias("reply_to")).join(roots, ["conv", "turn"])
    return found.join(placed, ["conv", "turn"])


def _depth_first(tree: DataFrame, most: int) -> DataFrame:
    """Adds to messages (conv, turn, reply_to: an earlier turn, or null) their root, the head of their chain of replies, and their place
    when the conversation is walked depth first, earlier turns first.

    Conversations of up to `most` messages are each walked in a task, which holds three numbers a message; longer ones by doubling.
    """
    tree = written(tree, "replies")
    long = written(tree.groupBy("conv").count().filter(F.col("count") > most).select("conv"), "long")
    whole = tree.join(long, "conv", "left_anti").repartition("conv").sortWithinPartitions("conv", "turn")
    walked = whole.mapInArrow(_walk, "conv long, turn long, reply_to long, root long, place long")
    if long.isEmpty():
        return walked
    return walked.unionByName(_long_walk(tree.join(long, "conv", "left_semi")))


def with_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """A table of messages as a mail archive would have them: many quote one of the three turns before them.

    Which one, and how, follows from a hash of conversation and turn: three of four messages quote, a third of those what the quoted one
    itself quotes, too; a third of the quotes are wrapped, a fifth written in capitals. No message is left out, and each
    keeps its own text whole, after the quote. A turn that is not there is not quoted; null texts quote nothing and stay null.
    """
    dice = lambda name: F.xxhash64(F.col(conv), F.col(turn), F.lit(name))
    pick = lambda name, of: F.pmod(dice(name), F.lit(of))
    mark = lambda value: F.regexp_replace(value, r"(?m)^", "> ")
    wrap = lambda value: F.regexp_replace(value, r"([^\n]{30,60}) (?=[^\n])", "$1\n")

    def quoting(rows: DataFrame, sources: DataFrame) -> DataFrame:
        source = sources.groupBy(F.col(conv).alias("_c"), F.col(turn).alias("_t")).agg(F.max(text).alias("_s"))
        target = F.when(pick("quotes", 4) > 0, F.col(turn) - 1 - pick("which", 3))
        joined = rows.withColumn("_to", target).join(source, (F.col(conv) == F.col("_c")) & (F.col("_to") == F.col("_t")), "left")
        said = F.when(pick("wrap", 3) == 0, wrap(F.col("_s"))).when(pick("capitals", 5) == 0, F.upper("_s")).otherwise(F.col("_s"))
        quote = F.concat(F.lit("On Monday at 10, Someone wrote:\n"), mark(said), F.lit("\n\n"), F.col(text))
        return joined.withColumn("_q", F.when(F.trim("_s") != "", quote)).drop("_c", "_t", "_s", "_to")

    once = quoting(messages, messages)
    outer = once.withColumn(text, F.coalesce("_q", text)).drop("_q")
    twice = quoting(messages, outer).withColumnRenamed("_q", "_nested")
    quoted = F.when(pick("nested", 3) == 0, F.col("_nested"))
    plain = quoting(twice, messages)
    return plain.withColumn(text, F.coalesce(quoted, F.col("_q"), F.col(text))).select(messages.columns)


def linked(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", carry: Iterable[str] | None = None,
    abroad_words: int = 5, walk: int = 1 << 18,
) -> DataFrame:
    """Link every quoted passage to the latest earlier message of its conversation that has it, or else to the first message
    of another conversation that has it, if it has `abroad_words` words (a short line like "Thanks" is everyone's); and order each
    conversation depth first, so that every reply follows what it quotes and that one's earlier replies.

    Returns `row` (the columns `carry`, by default all), own_text (without quotes), n_quotes, deepest (quote level), n_linked,
    reply_to (turn of the conversation that most quotes of the shallowest level point to, then the latest), root (turn at the head
    of its chain of replies), quoted_from (array of conv and turn of all linked messages) and reply_order, the message's place in
    its conversation, from 0: sorted by it, own texts are the conversation without quotes. Conversations of up to `walk` messages are put in
    order by one task each, longer ones by joins, with the same result.

    Quotes are met by hashes of normalised text. The index keeps one row per hash and conversation and turn; what is looked up
    is reduced per conversation before it is shuffled on, so a line that a third of all messages share costs no pairs,
    within a conversation or across. A passage is looked up whole, then by paragraph, then by line, wrapped lines also put together; of what is found as one
    the parts do not count, and what is cut within a line is not found. A quote meets the latest earlier turn of its own conversation and one first message. A message quoted within one chain
    is found whatever its level. Null and empty texts have no quotes and are quoted by none. Rows without a conversation or turn
    are returned unlinked and without a place. Conversations and turns are whole numbers. Repeated rows are treated alike; an empty table gives no rows.
    """
    given = messages.select(
        packed(messages, carry), F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(text).cast("string").alias("text")
    )
    part = StructType([*(StructField(name, IntegerType()) for name in ("tier", "first", "past")), StructField("hash", LongType()), StructField("words", IntegerType())])
    quote = StructType([StructField("level", IntegerType()), StructField("number", IntegerType()), StructField("parts", ArrayType(part))])
    shape = StructType(
        [
            *given.drop("text").schema.fields,
            StructField("own", StringType()),
            StructField("quotes", ArrayType(quote)),
            StructField("hashes", ArrayType(LongType())),
        ]
    )
    rows = written(given.mapInArrow(_parsed, shape), "messages")
    asked = (
        rows.filter("size(quotes) > 0 AND conv IS NOT NULL AND turn IS NOT NULL")
        .select("conv", "turn", F.explode("quotes").alias("q"))
        .select("conv", "turn", "q.level", "q.number", F.explode("q.parts").alias("p"))
        .select("conv", "turn", "level", "number", "p.tier", "p.first", "p.past", "p.hash", "p.words")
        .distinct()
    )
    asked = written(asked, "asked")
    wanted = asked.select("hash").distinct()
    index = rows.filter("conv IS NOT NULL AND turn IS NOT NULL").select("conv", "turn", F.explode("hashes").alias("hash"))
    index = written(index.join(wanted, "hash", "left_semi").distinct(), "passages")
    inside = _latest_before(asked.select("conv", "hash", "turn").distinct(), index)
    # The first origin of a hash, and the first outside of that one's conversation, for askers in that conversation.
    by_conv = index.groupBy("hash", "conv").agg(F.min("turn").alias("turn"))
    first = by_conv.groupBy("hash").agg(F.min(F.struct("conv", "turn")).alias("origin"))
    others = by_conv.join(first, "hash").filter("conv <> origin.conv").groupBy("hash").agg(F.min(F.struct("conv", "turn")).alias("other"))
    first = first.join(others, "hash", "left")
    abroad = F.when(F.col("origin.conv") == F.col("conv"), F.col("other")).otherwise(F.col("origin"))
    anywhere = F.when(F.col("words") >= abroad_words, abroad)
    met = (
        asked.join(inside, ["conv", "hash", "turn"], "left")
        .join(first, "hash", "left")
        .withColumn("origin", F.when(F.col("from_turn").isNotNull(), F.struct(F.col("conv"), F.col("from_turn").alias("turn"))).otherwise(anywhere))
        .filter("origin IS NOT NULL")
    )
    # Of what some message has as one, the parts do not count.
    found = F.collect_set(F.struct("tier", "first", "past", "origin")).alias("found")
    of_quote = met.groupBy("conv", "turn", "level", "number").agg(found)
    covers = of_quote.withColumn("wider", F.expr("filter(found, x -> x.tier < 3)"))
    kept = "filter(found, x -> NOT exists(wider, y -> y.tier < x.tier AND y.first <= x.first AND y.past >= x.past))"
    of_quote = covers.select("conv", "turn", "level", F.explode(F.expr(f"transform({kept}, x -> x.origin)")).alias("origin"))
    of_message = of_quote.groupBy("conv", "turn").agg(F.count("*").alias("n_linked"), F.sort_array(F.collect_set("origin")).alias("quoted_from"))
    votes = of_quote.filter("origin.conv = conv").groupBy("conv", "turn", "level", F.col("origin.turn").alias("to")).agg(F.count("*").alias("n"))
    answers = votes.groupBy("conv", "turn").agg(F.max(F.struct(-F.col("level"), "n", "to")).alias("best"))
    replies = answers.select("conv", "turn", F.col("best.to").alias("reply_to"))
    every = rows.filter("conv IS NOT NULL AND turn IS NOT NULL").select("conv", "turn").distinct()
    walked = _depth_first(every.join(replies, ["conv", "turn"], "left"), walk)
    found = rows.join(of_message, ["conv", "turn"], "left").join(walked, ["conv", "turn"], "left")
    root = F.coalesce("root", "turn")
    return found.select(
        "row",
        F.col("own").alias("own_text"),
        F.size("quotes").alias("n_quotes"),
        F.coalesce(F.array_max(F.transform("quotes", lambda q: q["level"])), F.lit(0)).alias("deepest"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "reply_to",
        root.alias("root"),
        F.coalesce("quoted_from", F.array().cast("array<struct<conv:bigint,turn:bigint>>")).alias("quoted_from"),
        F.col("place").alias("reply_order"),
    )
