"""Token counts, ranked search and the prefix trie against the library, brute force and small hand cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer

from shopstrata.llm import lexical_index, lexical_search, prefix_trie, token_counts, token_machines
from shopstrata.llm.queries import QUERIES, model_path

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, term string, shard long, `group` string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7, None) for i, t in rows], DOC)


# Token counts.

MODEL = model_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(MODEL)


def lengths(library, texts):
    return [len(found.ids) for found in library.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def machine():
    return token_counts.Machine(MODEL, token_machines.class_runs(MODEL))


PIECES = [
    "'", "s", "t", "r", "re", "v", "ve", "l", "ll", "d", "m", "e", " ", "  ", "\n", "\t", " ", "　", " ", "1", "٣", "²", "é", "日本", "😀",
    "!", "?", "+", "a", "Z", "the", "ing", "tion", "<|endoftext|>", "<|endof", "\x00", "\x1c", "ՠ", "\U000e0041", "́",
]


def test_token_counts_equal_the_library(machine, library):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["", "a" * 700, "ab" * 3000, " " * 999, "'" * 300, "\n" * 50 + "x", "日" * 2000, "<|endoftext|>" * 3]
    want = lengths(library, texts)
    raw = [text.encode() for text in texts]
    assert machine.counts(raw).tolist() == want
    assert machine.counts(raw, block=40).tolist() == want  # long texts cut at every chance


def test_classes_equal_the_library(library):
    """Every character behind a letter, a digit and a sign, in one probe each."""
    first, kinds = token_machines.class_runs(MODEL)
    split = library.pre_tokenizer.pre_tokenize_str
    rng = random.Random(1)
    for point in [*range(0x250), *rng.sample(range(0x250, 0xD800), 3000), *rng.sample(range(0xE000, 0x110000), 2000)]:
        kind = int(kinds[np.searchsorted(first, point, side="right") - 1])
        got = [len(split(before + chr(point))) == 1 for before in "a1!"]
        assert got == [kind <= token_machines.LETTER, kind == token_machines.DIGIT, kind in (token_machines.OTHER, token_machines.QUOTE)], hex(point)


def test_chunks_enter_in_the_state_the_text_before_leaves():
    rng = np.random.default_rng(3)
    steps = rng.integers(0, token_machines.CLASSES, (9, 700)).astype(np.uint8)
    state, want = token_machines.FRESH, []
    for lane in range(steps.shape[1]):
        want.append(state)
        for kind in steps[:, lane].tolist():
            state = int(token_machines.NEXT[state * token_machines.CLASSES + kind])
    assert token_machines.entered(steps).tolist() == want


def test_steps_are_made_anew_past_the_limit(library):
    counter = token_machines.Counter(MODEL, most=50)
    words = [bytes([97 + k % 26, 97 + k // 26]) * 3 for k in range(500)]
    for _ in range(2):
        got = []
        for at in range(0, 500, 20):
            part = words[at : at + 20]
            sizes = np.array([len(x) for x in part])
            got += counter.count(np.frombuffer(b"".join(part), np.uint8), np.r_[0, np.cumsum(sizes)[:-1]], sizes).tolist()
        assert got == lengths(library, [x.decode() for x in words])


def test_token_counts_of_a_table(spark, library):
    rows = [(1, None), (2, ""), (3, "  \n"), (None, "It's a test"), (4, "It's a test"), (4, "It's a test"), (5, "word " * 1024), (6, "word " * 1025), (7, "x" * 300_000)]
    found = token_counts.counted(docs(spark, rows), MODEL).collect()
    assert found[0].row.asDict().keys() >= {"doc_id", "text", "term", "group"}
    for row, (_, text) in zip(found, rows, strict=True):
        want = lengths(library, [text or ""])[0]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((text or "").encode()), want, want > 1024)
    assert token_counts.counted(docs(spark, rows).limit(0), MODEL).count() == 0


def test_token_counts_query_equals_the_library(spark, library):
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op11_token_counts"](spark, SMALL).collect()
    assert len(found) == len(texts)
    want = dict(zip(texts, lengths(library, list(texts.values())), strict=True))
    assert all(row.n_tokens == want[row.doc_id] and row.over_limit == (want[row.doc_id] > 1024) for row in found)


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        token_machines.Counter(model_path("word_bpe_49k.json"))


# Ranked search.

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return [re.sub("[A-Z]+", lambda m: m[0].lower(), found) for found in TERM.findall(text or "")]


def brute_ranking(rows, text, k=10):
    counted = [(i, Counter(words(t))) for i, t in rows]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    found = []
    for i, c in counted:
        m = 10 + 90 * sum(c.values()) * n // total
        score = 0
        for term in set(words(text)) & set(c):
            df = sum(term in other for _, other in counted)
            score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * c[term] // (1000 * c[term] + 8 * m))
        if score > 0:
            found.append((-score, i is None, i or 0))
    return [(rank, None if missing else i, -score) for rank, (score, missing, i) in enumerate(sorted(found)[:k], 1)]


def check_ranking(spark, rows, queries, k=10):
    items = spark.createDataFrame([(i, t, "y") for i, t in queries], "item_id long, text string, doc_id string")
    got = defaultdict(list)
    for row in lexical_search.ranked(docs(spark, rows), items, k).collect():
        got[row.query_id].append((row.rank, row.doc_id, row.score))
    for i, text in queries:
        assert sorted(got.pop(i, [])) == brute_ranking(rows, text, k), i
    assert not got


@pytest.mark.parametrize("shard_docs", [1 << 16, 90])
def test_ranking_equals_brute_force(spark, monkeypatch, shard_docs):
    rng = random.Random(shard_docs)
    vocabulary = [f"w{k}" for k in range(60)] + ["Été", "日本", "x_y", "É1"]
    pick = lambda n: " ".join(vocabulary[min(int(rng.expovariate(0.12)), 63)] for _ in range(n))
    rows = [(k, pick(rng.choice([0, 1, 3, 8, 30]))) for k in range(1200)]
    rows += [(5000 + k, "w1 w2 W3 w40") for k in range(300)]  # ties
    rows += [(None, "w1 w2 w3"), (7, "w1 w2 w3"), (9000, None), (9001, ""), (9002, "-- !"), (9003, "w40 " * 9000), (9004, "w59 " + "w2 " * 500)]
    queries = [(k, pick(rng.choice([1, 2, 5, 25]))) for k in range(25)]
    queries += [(100, None), (101, ""), (102, "nowhere"), (103, "w1 w1 W2 w3 w40"), (104, "w59,w58.w57 ÉTÉ été 日本 x y")]
    monkeypatch.setattr(lexical_index, "SHARD_DOCS", shard_docs)
    check_ranking(spark, rows, queries)
    check_ranking(spark, rows[:40], queries[:4], k=3)
    check_ranking(spark, rows[:0], queries[:2])
    check_ranking(spark, rows[:40], [])


def test_blocks_stay_closed_when_their_maxima_are_too_low():
    """One good document early; a common term's later blocks cannot reach it."""
    n = 64 * 40
    texts = [b"rare rare rare common" if k < 12 else b"rare " * (k % 500 == 0) + b"common " + b"pad " * 50 for k in range(n)]
    rows = [row for batch in lexical_index.shard_rows(0, list(range(n)), texts) for row in batch.to_pylist()]
    size = len(rows[0]["payload"]) // 17
    counts = np.frombuffer(rows[0]["payload"], np.int64, 2 * size).reshape(2, size)[1]
    lists = {
        term: lexical_search.List(weight, [r for r in rows[1:] if r["term"] == term], counts, n, int(counts.sum()))
        for term, weight in ((b"rare", 5000), (b"common", 100))
    }
    found = lexical_search.best(list(lists.values()), n, np.arange(n), 10)
    assert sorted(doc for doc, _ in found) == list(range(10))
    assert len(lists[b"common"].payloads) == 40 and len(lists[b"common"].opened) < 8


def test_numbers_survive_packing():
    rng = np.random.default_rng(0)
    values = np.r_[0, 127, 128, 2**40, rng.integers(0, 2**33, 1000), rng.integers(0, 300, 1000)]
    data, begins = lexical_index.packed_numbers(values)
    assert lexical_index.unpacked_numbers(data.tobytes()).tolist() == values.tolist()
    assert begins[-1] == len(data)


def test_terms_are_runs_of_letters_digits_and_foreign_characters():
    text = "Añb_c1-É2 日本—x Y\x7fZ[q]"
    terms, owners = lexical_index.terms_of([text.encode(), b"", b"a"])
    assert [t.decode() for t in terms.to_pylist()] == [*words(text), "a"]
    assert owners.tolist()[-1] == 2 and pc.count(terms).as_py() == len(owners)


# The prefix trie.

TURN = "conv_id long, turn long, role string, text string, node string, pos string"


def brute_trie(rows):
    of = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            of[c].append((turn is not None, turn or 0, role or "", text or ""))
    of = {c: [x[2:] for x in sorted(turns)] for c, turns in of.items()}
    nodes = defaultdict(lambda: [set(), set()])
    for c in of:
        h = zlib.crc32(str(c).encode()) % 9
        base = int(math.fmod(c, 5))
        seq = tuple(of.get(c - base, [])[:h] + of[c][h:])
        for d in range(len(seq) + 1):
            nodes[seq[:d]][0].add(c)
        nodes[seq][1].add(c)
    children = Counter(node[:-1] for node in nodes if node)
    found = []
    below = {node: [0, 0] for node in nodes}
    for node, (members, _) in nodes.items():
        own = (len(members) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            below[node[:d]][0] += own
            below[node[:d]][1] += not children[node]
    for node, (members, ended) in nodes.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ended))).encode()).hexdigest()
        parent = min(nodes[node[:-1]][0]) if node else None
        found.append((min(members), len(node), parent, len(members), children[node], below[node][1], below[node][0], digest))
    return sorted(found, key=repr)


def check_trie(spark, rows):
    given = spark.createDataFrame([(*row, "n", "p") for row in rows], TURN)
    got = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.numbered(given))).drop("node")
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(rows)


def test_trie_equals_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for c in [*range(-12, 120), 70_000, 70_003, 2**40 + 1]:
        for turn in range(rng.choice([0, 1, 2, 4, 9, 12])):
            rows.append((c, rng.choice([turn, turn, turn, None, 1]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", "", None])))
    rows += [(None, 0, "user", "lost"), (200, None, None, None), (203, 0, "user", "a")]
    rows += rows[:20]  # repeated rows are turns of their own
    check_trie(spark, rows)


def test_trie_of_equal_conversations(spark):
    rows = [(c, t, "user", f"same {t % 2}") for c in range(0, 900, 5) for t in range(4)]
    rows += [(c, t, "user", f"same {t % 2}") for c in range(900, 950, 5) for t in range(2)]
    check_trie(spark, rows)
    check_trie(spark, [(1, 0, "user", "x"), (2, 0, "user", "x")])
    check_trie(spark, [])


def test_trie_of_long_conversations(spark, monkeypatch):
    """Several chains and several windows a conversation, and a leaf that another conversation parts from in each."""
    monkeypatch.setattr(prefix_trie, "CHAIN", 8)
    monkeypatch.setattr(prefix_trie, "SPAN", 16)
    rows = [(5, t, "user", f"t{t}") for t in range(150)]
    for c, length in ((10, 8), (15, 9), (20, 16), (25, 64), (30, 65), (35, 149), (40, 150)):
        rows += [(c, t, "user", f"t{t}") for t in range(length)]
    rows += [(45, t, "user", f"t{t}" if t < 100 else f"u{t}") for t in range(150)]
    rows += [(47, t, "user", f"t{t}") for t in range(40)]
    check_trie(spark, rows)


def test_trie_keeps_roles_and_texts_apart(spark):
    check_trie(spark, [(5, 0, "ab", "c"), (10, 0, "a", "bc"), (15, 0, "", "abc"), (20, 0, None, "abc")])
