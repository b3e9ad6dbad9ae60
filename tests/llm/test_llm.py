"""Small cases of every operator: nulls, empty and long texts, ties, repeats, empty tables, clashing names; and brute force."""

from __future__ import annotations

import hashlib
import random
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from shopstrata.llm import decontamination, exact_dedup, html_extraction, pieces, pii, quality, quotes, simhash, suffix_dedup, toxicity
from shopstrata.llm.components import roots
from shopstrata.llm.grace import equal_contents
from shopstrata.llm.queries import ORACLE, QUERIES, model_path

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, kept string, print long, `group` string"


def docs(spark, *texts):
    return spark.createDataFrame([(i, t, "k", 7, None) for i, t in texts], DOC)


EDGE = [(1, None), (2, ""), (3, " \t\n"), (None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (5, "a  b c\td"), (6, "x" * 200_000), (7, "é 日本 😀 ▁")]


def test_exact_dedup_edges(spark):
    found = exact_dedup.exact_duplicates(docs(spark, *EDGE)).select("row.*", "keep_id", "group_size", "kept").collect()
    assert found[0].asDict().keys() >= {"doc_id", "text", "print", "group"}
    by = [(r.doc_id, r.keep_id, r.group_size) for r in found]
    assert sorted(x for x in by if x[0] in (1, 2, 3)) == [(1, 3, 3), (2, 3, 3), (3, 3, 3)]  # the longest original text stays
    assert {x[1:] for x in by if x[0] in (4, 5, None)} == {(5, 4)}
    verdicts = exact_dedup.exact_duplicates(docs(spark, (None, "a"), (2, "a"), (2, "a"))).collect()
    assert sum(r.kept for r in verdicts) == 1 and {r.keep_id for r in verdicts} == {2}
    assert exact_dedup.exact_duplicates(docs(spark).limit(0)).count() == 0


def test_grace_spills_recursively():
    rng = random.Random(1)
    contents = [str(rng.randrange(3000)).encode() * 40 for _ in range(9000)]
    records = [(hashlib.sha256(c).digest(), c, i) for i, c in enumerate(contents)]
    first = {}
    want = {i: first.setdefault(c, i) for i, c in enumerate(contents)}
    assert dict(equal_contents(iter(records), 4000)) == want
    alike = [(bytes(32), str(i % 5).encode() * 50, i) for i in range(100)]  # equal digests, unequal contents
    assert dict(equal_contents(iter(alike), 60)) == {i: i % 5 for i in range(100)}


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_brute_force(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(50)}" for _ in range(400)]
    texts = list(EDGE)
    for i in range(60):
        words = list(base)
        words[rng.randrange(400)] = f"n{i}"
        texts.append((100 + i, " ".join(words)))
    found = simhash.near_duplicates(docs(spark, *texts)).select("row.doc_id", "row.text", "fingerprint", "component_id").collect()
    prints = [brute_print(r.text) for r in found]
    assert [r.fingerprint for r in found] == [f"{p:016x}" for p in prints]
    label = list(range(len(found)))
    for _ in found:
        for i, p in enumerate(prints):
            label[i] = min(label[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 3)
    for i, row in enumerate(found):
        ids = [r.doc_id for j, r in enumerate(found) if label[j] == label[i] and r.doc_id is not None]
        assert row.component_id == (min(ids) if ids else None)
    assert simhash.near_duplicates(docs(spark).limit(0)).count() == 0


def test_one_near_copy_stays(spark):
    import corpus_pipeline

    rng = random.Random(10)
    text = lambda seed: " ".join(f"{seed}{rng.randrange(10**6)}" for _ in range(50))
    a, b, c = text("a"), text("b"), text("c")
    rows = docs(spark, (None, a), (None, a), (None, a.upper()), (4, b), (4, b.upper()), (None, b), (9, b), (7, c))
    left = corpus_pipeline.near_duplicates(spark, rows, SMALL).collect()
    assert sorted((r.doc_id or 0, r.text.lower()) for r in left) == [(0, a), (4, b), (7, c)]


def test_hot_bucket_is_cut_again():
    rng = np.random.default_rng(3)
    near = [5 ^ sum(1 << int(b) for b in set((rng.choice(32, 2, replace=False) + 32).tolist())) for _ in range(900)]
    prints = np.unique(np.array([5, *near], np.uint64))
    assert len(prints) > simhash.COMPARED
    a, b = simhash.bucket_links(np.zeros(len(prints), np.int64), prints)
    assert len(a) == len(prints) - 1 and len(set(b.tolist())) == 1


def test_roots_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(70, 80), (5, 5)], "a long, b long")
    assert {(r.a, r.b) for r in roots(links).collect()} == {(i, 0) for i in range(1, 51)} | {(80, 70)}


def test_sentencepiece_equals_the_library(spark):
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=model_path()), pieces.codec(model_path())
    rng = random.Random(4)
    parts = ["a", "e", " ", "  ", "\n", "\t", "the", "ing", "▁", "é", "日", "😀", "0", "12", ".", "!!", "\0", "<s>", "<0x41>", "====", "ß", "_"]
    texts = ["", " " * 100, "=" * 99, "x" * 3000] + ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(2000)]
    for text in texts:
        ids, decimal = own.encode(text)
        assert ids.tolist() == library.encode(text) and decimal.decode() == ",".join(map(str, ids)) and own.decode(ids) == library.decode(ids.tolist())
    found = pieces.encode(docs(spark, *EDGE), model_path()).collect()
    assert [r.ids for r in found] == [library.encode(t or "") for _, t in EDGE]
    assert found[-1].decoded == "é 日本 😀  " and found[0].n_tokens == 0 and found[0].row["group"] is None


def brute_suffix(rows, length):
    out = {}
    for rank, text in rows:
        smaller = {x[i : i + length] for r, x in rows if r < rank for i in range(len(x) - length + 1)}
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if text[i : i + length] in smaller:
                gone[i : i + length] = b"\1" * length
        out.setdefault(rank, set()).add(bytes(c for c, g in zip(text, gone) if not g))
    return out


@pytest.mark.parametrize("unit", [300, 8 << 20])
def test_suffix_dedup_against_brute_force(spark, unit):
    rng = random.Random(5)
    shared = ["".join(rng.choice("abé ") for _ in range(rng.randrange(20, 200))) for _ in range(6)]
    texts = [(i, "".join(rng.choice([*shared, "".join(rng.choice("abc") for _ in range(30))]) for _ in range(3))) for i in range(40)]
    texts += [(None, shared[0]), (90, "ab" * 400), (91, "ba" * 300), (92, None), (93, ""), (94, texts[0][1]), (3, texts[3][1]), (3, shared[1])]
    found = suffix_dedup.without_repeats(docs(spark, *texts), unit_bytes=unit).collect()
    want = brute_suffix([(suffix_dedup.LAST if i is None else i, (t or "").encode()) for i, t in texts], 50)
    assert len(found) == len(texts)
    for row in found:
        assert bytes(row.kept) in want[suffix_dedup.LAST if row.id is None else row.id]
        assert row.n_bytes - row.n_removed == len(row.kept) and row.kept_sha256 == hashlib.sha256(row.kept).hexdigest()
    assert suffix_dedup.without_repeats(docs(spark).limit(0)).count() == 0


def bytes_by_bucket(texts, buckets, hot):
    """Bytes of pieces each bucket gets from one unit that holds the texts."""
    import pyarrow as pa

    rows = pa.table({"rank": range(len(texts)), "text": texts, "id": range(len(texts))})
    kinds = [("unit", pa.int64()), ("kind", pa.string()), ("bucket", pa.int64()), ("rank", pa.int64()), ("digest", pa.binary()), ("data", pa.binary())]
    right = [{"kind": "first", "rank": i, "digest": hashlib.sha256(t.encode()).digest()} for i, t in enumerate(texts)]
    named = suffix_dedup._name_rows(buckets, 50)([pa.scalar(0)], rows, pa.Table.from_pylist(right, pa.schema(kinds)))
    for i in range(named.num_rows):
        own = named.slice(i, 1)
        known = suffix_dedup._common(hot)([own["bucket"][0]], own)
        right += [{"kind": "repeated", **x} for x in known.to_pylist()]
    dealt = suffix_dedup._segment_rows(buckets, 50)([pa.scalar(0)], rows, pa.Table.from_pylist(right, pa.schema(kinds)))
    return {x["bucket"]: len(x["data"]) for x in dealt.to_pylist()}


def test_a_common_line_is_spread(spark):
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    line = letters(60)
    texts = [letters(80) + line + letters(80) for _ in range(600)]
    dealt = bytes_by_bucket(texts, 64, 500)
    assert max(dealt.values()) < 0.1 * sum(dealt.values())
    whole = bytes_by_bucket(texts, 64, 5000)
    assert max(whole.values()) > 0.3 * sum(whole.values())  # uncut, the pieces meet under a few names of the line
    some = [(i, t) for i, t in enumerate(texts[:40])] + [(None, texts[0]), (None, line), (3, line), (77, "ab" * 300), (78, "ba" * 200)]
    want = brute_suffix([(suffix_dedup.LAST if i is None else i, t.encode()) for i, t in some], 50)
    for unit in (700, 8 << 20):
        found = suffix_dedup.without_repeats(docs(spark, *some), unit_bytes=unit, hot=3).collect()
        assert len(found) == len(some)
        assert all(bytes(r.kept) in want[suffix_dedup.LAST if r.id is None else r.id] for r in found)


def test_decontamination(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("aeioustrn") for _ in range(5))
    item = [word() for _ in range(40)]
    edited = [w if i % 6 else word() for i, w in enumerate(item)]
    noise = lambda n: [word() for _ in range(n)]
    rows = [(1, " ".join(noise(50) + item + noise(9))), (2, " ".join(noise(70) + edited)), (3, " ".join(noise(300))), (4, None), (5, "")]
    rows += [(6, ", ".join(item).upper()), (6, ", ".join(item).upper())]
    bench = spark.createDataFrame([(9, " ".join(item)), (10, None), (11, "too short"), (12, " ".join(noise(30)))], "item_id long, text string")
    found = decontamination.leaks(docs(spark, *rows), bench).select("row.doc_id", "item_id", "similarity", "first_word", "end_word").collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 9), (2, 9), (6, 9), (6, 9)]
    whole = next(r for r in found if r.doc_id == 1)
    assert (whole.similarity, whole.first_word, whole.end_word) == (1.0, 50, 90)
    clean = decontamination.without_leaks(docs(spark, *rows), bench)
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5] and clean.columns == docs(spark).columns
    assert decontamination.leaks(docs(spark, *rows), bench.limit(0)).count() == 0


@pytest.mark.parametrize("many", [9, 3000])
def test_copies_of_one_edited_passage(spark, many):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeioustrn") for _ in range(5))
    item = [word() for _ in range(40)]
    edited = " ".join(w if i % 6 else word() for i, w in enumerate(item))
    bench = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    rows = docs(spark, *((i, edited) for i in range(many)), (many, " ".join(word() for _ in range(40))))
    found = decontamination.leaks(rows, bench).select("row.doc_id", "similarity").collect()
    assert sorted(r.doc_id for r in found) == list(range(many)) and {r.similarity for r in found} == {found[0].similarity}
    assert [r.doc_id for r in decontamination.without_leaks(rows, bench).collect()] == [many]


def brute_align(item, passage):
    table = np.zeros((len(item) + 1, len(passage) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if a == b and a else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
    return table.max()


def test_alignment_against_brute_force():
    rng = np.random.default_rng(7)
    for _ in range(150):
        item, passage = rng.integers(0, 6, rng.integers(1, 15)), rng.integers(0, 6, rng.integers(1, 30))
        assert decontamination.align(item, passage)[0] == brute_align(item, passage)


def brute_copies(item, text):
    item, text = decontamination.words(item), decontamination.words(text)
    numbers = {w: i for i, w in enumerate(sorted({*item, *text}), 1)}
    if len(item) < decontamination.FEWEST:
        return False
    return brute_align([numbers[w] for w in item], [numbers[w] for w in text]) >= decontamination.least_score(len(item))


def edit(rng, item, rate):
    out = []
    for w in item:
        kind = rng.random()
        if kind < rate:
            out += rng.choice([[], [rng.choice("xyz") + w], [w, rng.choice("xyz") + w], [w, "uu", "vv"]])
        else:
            out.append(w)
    return " ".join(out)


def test_leaks_against_alignment_of_all_pairs(spark):
    rng = random.Random(12)
    common = ["the", "of", "a", "to"]
    word = lambda: rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("aeioustrn") for _ in range(3))
    items = [" ".join(word() for _ in range(rng.choice([3, 4, 6, 9, 15, 25, 40]))) for _ in range(24)]
    items += [items[3], "the the the the the the the the the", "the of the of the of the of the of", "三人行必有我師焉擇其善者而從之", "one", ""]
    texts = [" ".join(word() for _ in range(rng.choice([0, 5, 60, 200]))) for _ in range(25)]
    for rate in (0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7):
        for item in items[:24]:
            noise = [" ".join(word() for _ in range(rng.randrange(30))) for _ in range(2)]
            texts.append(f"{noise[0]} {edit(rng, item.split(), rate)} {noise[1]}")
    texts += ["the " * 120, "x " * 30 + " y ".join(items[6].split()), "子曰三人行必有我師焉擇其善者而從之其不善者而改之", *texts[30:33]]
    texts.append(" ".join(w if i % 3 < 2 else "q" for i, w in enumerate(items[5].split())))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontamination.leaks(docs(spark, *enumerate(texts)), bench, carry=["doc_id"]).collect()
    want = {(i, j) for i, text in enumerate(texts) for j, item in enumerate(items) if brute_copies(item, text)}
    assert len(found) == len(want) > 100 and {(r.row.doc_id, r.item_id) for r in found} == want
    clean = decontamination.without_leaks(docs(spark, *enumerate(texts)), bench)
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {i for i, _ in want}


def test_a_text_of_one_word_is_linear(spark):
    bench = spark.createDataFrame([(1, "a " * 300), (2, "b c d e")], "item_id long, text string")
    found = decontamination.leaks(docs(spark, (1, "a " * 30_000), (2, "b " * 30_000)), bench).collect()
    assert [(r.row.doc_id, r.item_id, r.similarity) for r in found] == [(1, 1, 1.0)]


def test_html(spark):
    page = (
        '<html><head><title>No</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">Menu</a></li></ul></nav>'
        '<div class="ad">Buy this now.</div><article><h1>A title of it.</h1><p><b>First &amp;&nbsp;second\n part.<br><p>More text stands here, it is long.</p>'
        '</article><section class="comments"><div class="comment"><p>I disagree with it.</p></div></section><footer>&copy; x &middot; y.</footer>'
    )
    model = html_extraction.fit(spark.read.parquet(f"{SMALL}/pages.parquet"))
    rows = spark.createDataFrame([(1, page, "t"), (2, None, None), (3, "", None), (4, "<p", None), (5, page + "<p>", None)], "page_id long, html string, text string")
    found = {r.row.page_id: r for r in html_extraction.extracted(rows, model).collect()}
    want = "A title of it. First & second part. More text stands here, it is long."
    assert found[1].text == want and found[1].n_chars == len(want) and found[5].text == want and found[1].row.text == "t"
    assert {found[i].text for i in (2, 3, 4)} == {""}
    fixed = html_extraction.fit(rows.limit(0))
    assert html_extraction.extracted(rows.limit(0), fixed).count() == 0


def auc(scores, labels):
    order = np.argsort(np.argsort(scores)) + 1
    ones = labels.sum()
    return (order[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


@pytest.mark.parametrize(("name", "label"), [("op8_quality", "quality"), ("op9_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    folder = "/root/testdata/sf0.1"  # sf0.01 has some forty toxic rows to learn from
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES[name](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert auc(np.array([r.score for r in held]), np.array([labels[r.doc_id] for r in held])) > 0.95


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_of_edges(spark, module):
    labels = spark.createDataFrame([(i, 1 if i % 2 else 0) for i in range(40)] + [(None, 1), (99, None)], "doc_id long, label int")
    rows = docs(spark, *EDGE, *((i, "bad idiot text" if i % 2 else "good calm text") for i in range(10, 40)))
    for given in (labels, labels.limit(0)):
        model = module.fit(rows, given, label="label")
        found = module.scored(rows, model).collect()
        assert len(found) == rows.count() and all(0 <= r.score <= 1 for r in found) and found[0].score == found[1].score


def test_slopes_of_the_machine():
    own = np.random.default_rng(1).normal(size=(5, 4))
    raw, slopes = toxicity.raw_and_slopes(own, 0.5)
    pairs = sum(own[i, 1:] @ own[j, 1:] for i in range(5) for j in range(i))
    assert np.isclose(raw, 0.5 + own[:, 0].sum() + pairs)
    for at in np.ndindex(own.shape):
        more = own.copy()
        more[at] += 1e-6
        assert np.isclose((toxicity.raw_and_slopes(more, 0.5)[0] - raw) / 1e-6, slopes[at], atol=1e-4)
    model = toxicity.Model({t: i for i, t in enumerate(x for w in (b"ab", b"cd") for x in toxicity.terms(w))}, 0.5, own[:2, 0], own[:2, 1:])
    assert np.isclose(model.score(b"ab cd"), 1 / (1 + np.exp(-toxicity.raw_and_slopes(own[:2], 0.5)[0])))


def test_toxic_pairs_and_repeated_ids(spark):
    chance = random.Random(4)
    filler = ["".join(chance.choices("bcdfghklm", k=5)) for _ in range(3000)]
    rows = [(i, " ".join([*chance.sample(filler, 20), *(["zog"] if i % 4 in (0, 1) else []), *(["pax"] if i % 4 in (0, 2) else [])])) for i in range(1200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    frame = docs(spark, *rows)
    model = toxicity.fit(frame, labels)
    assert len(model.kept) > 3000  # every term that two documents have
    score = {words: model.score(words.encode()) for words in ("zog pax", "zog", "pax", "")}
    assert score["zog pax"] > 0.5 > max(score["zog"], score["pax"], score[""])
    again = toxicity.fit(frame.union(docs(spark, *[(0, "zog zz")] * 500)).repartition(7), labels)  # "... pax" of id 0 is the least text
    least = min(rows[0][1], "zog zz")
    assert (least == rows[0][1]) and again.bias == model.bias and np.array_equal(again.weights, model.weights) and np.array_equal(again.factors, model.factors)


def test_surrogates(spark):
    text = "Write to Jo.B4@mail.example.com or +1 (017) 555-7713, Mrs. Ada Stone; card 4539578763621486, 10.0.0.1, key 04dbebab91ab85687d33eeaaf9ac699e"
    rows = docs(spark, (1, text), (2, "jo.b4@MAIL.example.com"), (3, None), (4, ""), (5, "nothing 4.0. here"), (5, text))
    found = pii.replaced(rows, b"k").select("row.doc_id", "row.print", "text", "n_entities").collect()
    first, again = [r.text for r in found if r.n_entities == 6]
    assert first == again and next(r.text for r in found if r.doc_id == 2) in first
    for entity in ("Jo.B4", "017", "Ada", "Stone", "4539578763621486", "10.0.0.1", "04dbebab"):
        assert entity not in first
    assert [k for _, _, k, _ in pii.detect(first)] == [k for _, _, k, _ in pii.detect(text)]
    assert {r.doc_id: r.text for r in found if r.doc_id in (3, 4)} == {3: None, 4: ""} and len(found) == 6
    card = next(e for _, _, k, e in pii.detect(first) if k == "card")
    assert pii._luhn([int(c) for c in card]) == 0


def test_one_entity_in_many_forms(spark):
    rows = docs(
        spark,
        (1, "4539 5787 6362 1486|4539-5787-6362-1486|4539578763621486|DE89 3704 0044 0532 0130 00|DE89370400440532013000|+49 30 1234567|+49301234567|(212) 555-0143|+1 212 555 0143"),
        (2, "Mr. Adam Stone|Mr. Stone|Stone|Adam Stone|Ms. Eva Stone"),
        (3, "Frau Anna Weber|Dr. Anna Weber"),
        (4, "Dr. Anna Weber"),
    )
    found = {r.row.doc_id: r.text.split("|") for r in pii.replaced(rows, b"k").collect()}
    plain = ["".join(filter(str.isalnum, x)) for x in found[1]]
    assert len(set(plain[:3])) == len(set(plain[3:5])) == len(set(plain[5:7])) == 1 and plain[8] == "1" + plain[7]
    assert [len(x) for x in found[1]] == [19, 19, 16, 27, 22, 14, 12, 14, 15] and found[1][0][4] == " " and found[1][1][4] == "-"
    given, family = found[2][0].split(" ")[1:]
    assert found[2][1:4] == [f"Mr. {family}", family, f"{given} {family}"] and family not in found[2][4] and "Stone" not in str(found[2])
    assert found[3][0].removeprefix("Frau ") == found[3][1].removeprefix("Dr. ") == found[4][0].removeprefix("Dr. ")
    assert found[3][0].split(" ")[1] in pii.FIRST["latin"]["f"]


@pytest.mark.parametrize("token", ["sk-" + "abcDE" * 5, "ghp_" + "xY" * 18, "AKIA" + "QWER" * 4, "deadbeef" * 4, "FACE" * 8])
@pytest.mark.parametrize("around", ["key {}.", "key {}, 7.", "key {} of a@b.org"])
def test_secrets_without_digits(token, around):
    assert ("secret", token) in [x[2:] for x in pii.detect(around.format(token))]


NAMES = [
    ("господин Семёнов пришёл", "Семёнов"), ("Dr. Hans Peter Weber sagt", "Hans Peter Weber"), ("Mr. McDonald said", "McDonald"), ("Frau Anna-Maria Weber, die", "Anna-Maria Weber"),
    ("Mr. O'Brien went", "O'Brien"), ("Mr. O’Brien went", "O’Brien"), ("MR. ADAM STONE IS", "ADAM STONE IS"), ("Mr. Łukasz Nowak i", "Łukasz Nowak"), ("господин Ёлкин", "Ёлкин"),
    ("Herr Otto von der Heide kam", "Otto von der Heide"), ("Señora María de la Cruz Ñúñez vino", "María de la Cruz Ñúñez"), ("Mme Ève Été parle", "Ève Été"),
]


@pytest.mark.parametrize("text,name", NAMES)
def test_names_of_any_script_and_number_of_parts(text, name):
    ((start, end, kind, entity),) = pii.detect(text)
    assert kind.startswith("name") and text[start:end] == entity == name


def test_no_part_of_a_name_stays(spark):
    texts = [f"{text}. {name.split(' ')[-1]} again" for text, name in NAMES]
    found = {r.row.doc_id: r.text for r in pii.replaced(docs(spark, *enumerate(texts)), b"k").collect()}
    found = [found[i] for i in range(len(texts))]
    for text, (_, name) in zip(found, NAMES, strict=True):
        assert not any(part in text for part in name.split(" ") if part[0].isupper() and len(part) > 2), text
    assert " von " not in found[9] and "die" in found[3] and found[6].startswith("MR. ") and found[6].split(".")[1].isupper()


def test_numbers_that_are_phones_or_cards():
    for text in ("020 7946 0958", "0049 30 1234567", "0049301234567", "+49 30 1234567"):
        assert [x[2] for x in pii.detect(f"call {text} now")] == ["phone"], text
    assert pii.canonical("phone", "0049 30 1234567") == pii.canonical("phone", "+49 30 1234567")
    assert pii.rendered("phone", "+49 301234567", "+49 987654321", "0049 30 1234567") == "0049 98 7654321"
    assert [x[2] for x in pii.detect("card 4539578763621486")] == ["card"] and pii.detect("number 4539578763621487, 1234567890123") == []


def test_a_form_with_all_values_in_use_grows(spark):
    letters = "abcdefghijklmnopqrst"
    texts = [(i, f"to {a}@{b}.com now") for i, (a, b) in enumerate((a, b) for a in letters for b in letters)]  # 400 of 676
    found = [r.text.split(" ")[1] for r in pii.replaced(docs(spark, *texts), b"k").collect()]
    assert len(set(found)) == 400 and not set(found) & {t.split(" ")[1] for _, t in texts}
    assert all(x.endswith(".com") and x.count("@") == 1 for x in found)
    assert pii.rendered("ssn", "123-45-6789", "987-65-43210", "123-45-6789") == "987-65-43210"


def test_surrogates_stay_distinct(spark):
    many = spark.createDataFrame([("phone", f"+1 {i:02d}") for i in range(60)], "kind string, entity string")  # 100 numbers in all
    with pytest.raises(RuntimeError):
        pii.surrogates(spark.createDataFrame([("phone", f"+1 {i}") for i in range(10)], "kind string, entity string"), b"k", 3)
    found = pii.surrogates(many.filter("entity < '+1 30'"), b"k").collect()
    assert len({r.surrogate for r in found}) == 30 and not {r.surrogate for r in found} & {r.entity for r in found}


def test_quotes(spark):
    rows = [
        (1, 0, "Hello there, how are you?\nSecond line."), (1, 1, "On Monday Bob wrote:\n> Hello there, how are you?\n> Second line.\n\nFine, thanks."),
        (1, 2, "> > Hello there how are you?\n> Fine, thanks.\nGood!"), (1, 3, None), (1, 4, "> Second line.\nWhat?"), (2, 0, "> Good!\nnew"),
        (2, 1, ">never said\nx"), (None, 1, "> Good!"), (3, 0, ""), (3, 0, ""),
    ]
    found = quotes.linked(spark.createDataFrame(rows, "conv_id long, turn long, text string"), abroad_words=1).collect()
    got = {(r.row.conv_id, r.row.turn): (r.own_text, r.n_quotes, r.deepest, r.reply_to, r.root, [tuple(q) for q in r.quoted_from]) for r in found}
    assert len(found) == len(rows)
    assert got[1, 1] == ("Fine, thanks.", 1, 1, 0, 0, [(1, 0)])
    assert got[1, 2] == ("Good!", 2, 2, 1, 0, [(1, 0), (1, 1)])
    assert got[1, 3] == ("", 0, 0, None, 3, []) and got[1, 4][3:] == (0, 0, [(1, 0)])
    assert got[2, 0] == ("new", 1, 1, None, 0, [(1, 2)]) and got[2, 1][3:] == (None, 1, []) and got[None, 1][3] is None


def test_one_line_held_and_quoted_throughout_a_conversation(spark):
    n = 1500
    rows = [(1, i, "Thanks") for i in range(0, 2 * n, 2)] + [(1, i, "> Thanks\nyes") for i in range(1, 2 * n, 2)]
    found = quotes.linked(spark.createDataFrame(rows, "conv_id long, turn long, text string"))
    assert {r.row.turn: r.reply_to for r in found.collect()} == {i: i - 1 if i % 2 else None for i in range(2 * n)}
    held = spark.createDataFrame([(1, 7, i) for i in range(0, 2 * n, 2)], "conv long, hash long, turn long")
    asked = spark.createDataFrame([(1, 7, i) for i in range(1, 2 * n, 2)] + [(1, 7, 0), (2, 7, 5)], held.schema)
    got = quotes._latest_before(asked, held)
    assert sorted((r.turn, r.from_turn) for r in got.collect()) == [(i, i - 1) for i in range(1, 2 * n, 2)]


def test_wrapped_paragraphs_and_later_own_turns(spark):
    first, second, third = "The first paragraph goes on for a while here.", "A second one is in between.", "The third paragraph is also a long one."
    wrapped = "> The first paragraph goes\n> on for a while here.\n>\n> A second one is in\n> between.\nAgreed."
    rows = [
        (1, 0, f"{first}\n\n{second}\n\n{third}"), (1, 1, wrapped),
        (2, 0, f"{third}\n{second}\nEnd."), (2, 1, "> The third paragraph is\n> also a long one.\n> End.\nFine."),
        (5, 3, "> Only said later\nwhat?"), (5, 4, "Only said later"), (6, 2, "Only said later"), (6, 9, "Only said later"),
    ]
    found = quotes.linked(spark.createDataFrame(rows, "conv_id long, turn long, text string"), abroad_words=3).collect()
    got = {(r.row.conv_id, r.row.turn): (r.n_linked, r.reply_to, r.root, [tuple(q) for q in r.quoted_from]) for r in found}
    assert got[1, 1] == (2, 0, 0, [(1, 0)])
    assert got[2, 1] == (2, 0, 0, [(2, 0)])
    assert got[5, 3] == (1, None, 3, [(6, 2)])


def brute_links(rows):
    """What `linked` has to find, message by message against all others, for rows of distinct (conv, turn, text)."""
    own = {(c, t): quotes.parse(x or "") for c, t, x in rows}
    held = {at: quotes.passages(text) for at, (text, _) in own.items()}
    out, up = {}, {}
    for (c, t), (_, quoted) in own.items():
        links, votes = [], {}
        for level, lines in quoted:
            met = []
            for tier, first, past, key, size in quotes.lookups(lines):
                inside = [(c, x) for x in sorted({k[1] for k in own if k[0] == c and k[1] < t}) if key in held[c, x]]
                abroad = sorted(k for k in own if k[0] != c and key in held[k]) if size >= 5 else []
                if inside or abroad:
                    met.append((tier, first, past, inside[-1] if inside else abroad[0]))
            for x in met:
                if not any(y[0] < 3 and y[0] < x[0] and y[1] <= x[1] and y[2] >= x[2] for y in met):
                    links.append(x[3])
                    if x[3][0] == c:
                        votes[level, x[3][1]] = votes.get((level, x[3][1]), 0) + 1
        up[c, t] = max(((-level, n, to) for (level, to), n in votes.items()), default=(0, 0, None))[2]
        out[c, t] = [len(links), up[c, t], sorted(set(links))]
    for c in {c for c, _ in own}:
        order = []

        def walk(turn, root):
            order.append((turn, root))
            for reply in sorted(t for (d, t), to in up.items() if d == c and to == turn):
                walk(reply, root)

        for turn in sorted(t for (d, t), to in up.items() if d == c and to is None):
            walk(turn, turn)
        for place, (turn, root) in enumerate(order):
            out[c, turn] += [root, place]
    return out


@pytest.mark.parametrize("walk", [1 << 18, 4])
def test_links_against_brute_force(spark, walk):
    given = spark.read.parquet(f"{SMALL}/conversations.parquet")
    made = quotes.with_quotes(given).cache()
    assert made.columns == given.columns and made.count() == given.count()
    rows = [(r.conv_id, r.turn, r.text) for r in made.collect()]
    want = brute_links(rows)
    found = quotes.linked(made, walk=walk).collect()
    got = {(r.row.conv_id, r.row.turn): [r.n_linked, r.reply_to, [tuple(q) for q in r.quoted_from], r.root, r.reply_order] for r in found}
    assert got == want
    assert sum(x[0] > 0 for x in got.values()) > len(got) / 3
    assert max(r.deepest for r in found) >= 2


@pytest.mark.parametrize("size", [1, 2, 5, 100])
def test_conversations_across_batches(size):
    chance = random.Random(size)
    rows = [(c, t, chance.randrange(t) if t and chance.random() < 0.7 else None) for c in range(12) for t in range(chance.randrange(1, 15))]

    def down(conv, turn, root):
        yield turn, root
        for c, t, up in rows:
            if c == conv and up == turn:
                yield from down(conv, t, root)

    want = {}
    for c in range(12):
        order = [x for d, t, up in rows if d == c and up is None for x in down(c, t, t)]
        want |= {(c, t): (root, place) for place, (t, root) in enumerate(order)}
    shape = pa.schema([("conv", pa.int64()), ("turn", pa.int64()), ("reply_to", pa.int64())])
    batches = pa.Table.from_pylist([dict(zip(shape.names, r)) for r in rows], shape).to_batches(max_chunksize=size)
    got = pa.Table.from_batches(quotes._walk(iter([batches[0].slice(0, 0), *batches]))).to_pylist()
    assert {(r["conv"], r["turn"]): (r["root"], r["place"]) for r in got} == want and len(got) == len(rows)
    assert list(quotes._walk(iter([]))) == []


@pytest.mark.parametrize("walk", [1 << 18, 10])
def test_replies_depth_first(spark, walk):
    say = "This is what message number {} has to say."
    to = {1: 0, 2: 0, 3: 1, 5: 3, 6: 2}
    rows = [(7, i, (f"> {say.format(to[i])}\n" if i in to else "") + say.format(i)) for i in range(7)] + [(None, 1, "x"), (7, None, "y")]
    rows += [(8, i, (f"> {say.format(i - 1)} \n" if i else "") + say.format(i)) for i in range(300)]
    frame = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn long, text string, own string, place int")
    got = {(r.row.conv_id, r.row.turn): r.reply_order for r in quotes.linked(frame, walk=walk).collect()}
    assert sorted(range(7), key=lambda i: got[7, i]) == [0, 1, 3, 5, 2, 6, 4]
    assert [got[8, i] for i in range(300)] == list(range(300)) and got[None, 1] is None and got[7, None] is None
    assert quotes.linked(frame.limit(0)).count() == 0


def test_own_text_of_prompts_and_broken_sources():
    assert quotes.parse("Try this:\n>>> print(1)\n1") == ("Try this:\n>>> print(1)\n1", [])
    assert quotes.parse("A wrote:\n>>> deep\nown") == ("own", [(3, ["deep"])])
    assert quotes.parse(">>> deep\n> near\nown") == ("own", [(3, ["deep"]), (1, ["near"])])
    assert quotes.parse("Hi\nOn Monday at 10, Bob Smith <bob@example.org>\nwrote:\n> x\nown") == ("Hi\nown", [(1, ["x"])])
    assert quotes.parse("12 мая Иван пишет:\n> да\nнет") == ("нет", [(1, ["да"])])


@pytest.mark.parametrize("words", [1, 4])
def test_short_lines_link_within_a_conversation_only(spark, words):
    line = " ".join(["Thanks"] * words)
    rows = spark.createDataFrame([(1, 0, line), (9, 0, f"> {line}\nno"), (9, 1, line), (9, 2, f"> {line}\nyes")], "conv_id long, turn long, text string")
    assert {(r.row.conv_id, r.row.turn): r.n_linked for r in quotes.linked(rows).collect()} == {(1, 0): 0, (9, 0): 0, (9, 1): 0, (9, 2): 1}


def test_queries_and_pipeline(spark):
    import corpus_pipeline
    import duckdb

    duck = duckdb.connect()
    for name in ("documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    for name, sql in ORACLE.items():
        want = duck.execute(sql)
        columns = [column[0] for column in want.description]
        assert sorted(map(tuple, QUERIES[name](spark, SMALL).select(columns).collect())) == sorted(want.fetchall())
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    left = given
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, stage(spark, left, SMALL)
        assert left.columns == given.columns and left.exceptAll(before).isEmpty(), name
    want = {r.doc_id: r.text for r in left.collect()}
    assert len({"".join(t.split()) for t in want.values()}) == len(want)
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert found.keys() == want.keys()
    for id, row in found.items():
        assert row.decoded_sha256 == hashlib.sha256(want[id].encode()).hexdigest() and len(row.ids) == row.n_tokens


def test_naming_windows_holds_numbers_for_some_texts_only():
    """Several numbers of eight bytes for each window of a unit were held at once."""
    rng = random.Random(5)
    texts = [bytes(rng.choices(range(97, 105), k=rng.randrange(0, 6_000))) for _ in range(1_500)]
    tracemalloc.start()
    owner, spans, name = suffix_dedup.names(texts, 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15 * sum(map(len, texts))
    at = 0
    for i, text in enumerate(texts[:200]):
        _, own, least = suffix_dedup.names([text], 50)
        assert (owner[at : at + len(own)] == i).all() and (spans[at : at + len(own)] == own).all() and (name[at : at + len(own)] == least).all()
        at += len(own)
    assert len(name) > at and suffix_dedup.names([], 50)[1].shape == (0, 2)


def test_only_texts_with_candidates_are_shuffled(spark):
    """The pids choose the texts where they are read, however many there are."""
    texts = spark.range(5_000).selectExpr("id * 8589934592 as pid", "string(id) as text")
    near = texts.filter("cast(text as int) % 50 = 0").select("pid")
    found = decontamination._with_candidates(texts, near)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    kept = {row.pid for row in found.collect()}
    assert {row.pid for row in near.collect()} <= kept and len(kept) < 150


def test_names_of_many_units_meet_in_linear_time():
    """The same names from 4 and from 1,000 units; each unit was searched for in all common names before."""
    rng = np.random.default_rng(3)
    name = rng.integers(0, 1 << 40, 100_000, dtype=np.uint64)
    packed = name.view(np.uint8).reshape(-1, 8)[:, :5]
    kinds = pa.schema([("unit", pa.int64()), *((x, pa.binary()) for x in ("once", "more", "texts"))])
    times, back = [], []
    for units in (4, 1000):
        of = rng.permutation(np.repeat(np.arange(len(name)), 2)).reshape(units, -1)  # every name comes twice
        rows = [{"unit": i, "once": packed[own].tobytes(), "more": b"", "texts": b""} for i, own in enumerate(of)]
        rows[1] |= {"more": packed[:3].tobytes(), "texts": np.full(3, 9, np.int32).tobytes()}
        table = pa.Table.from_pylist(rows, kinds)
        began = time.process_time()
        back.append(suffix_dedup._common(5)([pa.scalar(7)], table).to_pylist())
        times.append(time.process_time() - began)
        assert [x["unit"] for x in back[-1]] == list(range(units)) and {x["bucket"] for x in back[-1]} == {7}
        often = {packed[i].tobytes() for i in range(3)}
        for row, own in zip(back[-1][:20], of):
            sent = [row["data"][i : i + 5] for i in range(0, len(row["data"]), 5)]
            assert set(sent[row["rank"] :]) == {x for x in sent if x in often} == often & {*sent}
            assert sorted(sent) == sorted([packed[i].tobytes() for i in own] + (sorted(often) if row["unit"] == 1 else []))
    assert times[1] < 0.5 + 10 * times[0]
