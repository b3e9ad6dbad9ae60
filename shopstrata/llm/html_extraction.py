"""Main text of pages: a linear-chain conditional random field over leaf blocks, decoded by Viterbi."""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shopstrata.llm.common import non_empty, packed
from shopstrata.llm.html_blocks import Block, blocks

_WORD = re.compile(r"[a-z]+")
#: What words in a class, id or role hint at.
HINTS = {
    "content": "article body content entry main post story text".split(),
    "menu": "breadcrumb breadcrumbs menu nav navbar navigation pagination pager tabs toolbar".split(),
    "advert": "ad ads advert advertisement banner promo promoted promotion sponsor sponsored".split(),
    "notice": "alert consent cookie cookies gdpr modal newsletter notice popup subscribe".split(),
    "comment": "comment comments discussion disqus replies reply respond".split(),
    "frame": "aside footer head header masthead sidebar topbar widget".split(),
    "more": "author byline copyright legal login meta related recommended search share sharing social tags".split(),
}
_HINT_OF = {word: hint for hint, words in HINTS.items() for word in words}


def features(block: Block, place: float) -> list[str]:
    """Names of what is true of a block: tags and hints above it, its length, links, punctuation and place."""
    tags = [name for name, _ in block.path]
    out = {f"in:{name}" for name in tags}
    out.add(f"tag:{tags[-1] if tags else 'none'}")
    for name, hooks in block.path:
        out.update(f"hint:{_HINT_OF[word]}" for word in _WORD.findall(hooks) if word in _HINT_OF)
        if hooks.endswith(" hidden"):
            out.add("hidden")
    inner = [word for _, hooks in block.path[-2:] for word in _WORD.findall(hooks)]
    out.update(f"near:{_HINT_OF[word]}" for word in inner if word in _HINT_OF)
    text = block.text
    size = len(text)
    out.add(f"size:{min(int(np.log2(size + 1)), 9)}")
    out.add(f"links:{int(3.999 * block.linked / max(size, 1))}")
    out.add("stop" if text[-1:] in ".!?\"»”" else "no stop")
    if any(c in text for c in "©|·»"):
        out.add("sign")
    out.add(f"place:{int(3.999 * place)}")
    out.add("bias")
    return list(out)


def _listed(page: str) -> tuple[list[Block], list[list[str]]]:
    own = blocks(page)
    return own, [features(block, i / len(own)) for i, block in enumerate(own)]


@dataclass
class Model:
    """Weights of features for a block being main text, and of neighbouring labels (rows: before, columns: after)."""

    weights: dict[str, float]
    moves: np.ndarray

    def main(self, listed: list[list[str]]) -> list[bool]:
        """Viterbi: the most likely labels of a page's blocks."""
        if not listed:
            return []
        get = self.weights.get
        scores = [sum([get(name, 0.0) for name in names]) for names in listed]
        (stay, start), (stop, go) = self.moves.tolist()
        off, on = 0.0, scores[0]
        back: list[tuple[bool, bool]] = []
        for score in scores[1:]:
            to_off, to_on = on + stop > off + stay, on + go >= off + start
            back.append((to_off, to_on))
            off, on = (on + stop if to_off else off + stay), (on + go if to_on else off + start) + score
        labels = [on > off]
        for to_off, to_on in reversed(back):
            labels.append(to_on if labels[-1] else to_off)
        return labels[::-1]


def labelled_page(rng: random.Random, sentences: list[str]) -> str:
    """A page whose containers are marked as main text or not; layout and wording vary."""
    say = lambda low, high: " ".join(rng.choice(sentences) for _ in range(rng.randint(low, high)))
    short = lambda: " ".join(rng.choice(sentences).split()[: rng.randint(1, 4)])
    links = lambda n: "".join(f'<li><a href="/x">{short()}</a></li>' for _ in range(n))
    other = [
        lambda: f"<nav><ul>{links(rng.randint(3, 8))}</ul></nav>",
        lambda: f'<div class="{rng.choice(["menu", "navbar", "nav-links", "breadcrumb"])}"><ul>{links(rng.randint(2, 6))}</ul></div>',
        lambda: f"<header><h2>{short()}</h2><p>{say(1, 1)}</p></header>",
        lambda: f'<div class="{rng.choice(["ad", "ads", "advert", "banner", "sponsored", "promo"])}">{say(1, 3)}</div>',
        lambda: f'<aside class="{rng.choice(["sidebar", "widget", "related"])}"><h3>{short()}</h3><p>{say(1, 3)}</p><ul>{links(3)}</ul></aside>',
        lambda: f'<aside><p>{say(1, 3)}</p></aside>',
        lambda: f'<div id="{rng.choice(["cookie-notice", "cookie-banner", "notice", "newsletter", "alert"])}"><p>{say(1, 2)}</p></div>',
        lambda: f'<form action="/s"><label>{short()}</label><input name="q"><button>{short()}</button><p>{say(0, 1)}</p></form>',
        lambda: f'<div class="{rng.choice(["share", "social", "tags", "related", "author"])}"><p>{short()}</p>{say(0, 1)}</div>',
    ]
    foot = [
        lambda: f"<footer>&copy; {short()} &middot; {say(0, 1)}</footer>",
        lambda: f'<div class="footer"><p>&copy; {short()}</p><p>{say(0, 1)}</p></div>',
    ]
    replies = [
        lambda: '<section class="comments" id="comments"><h3>' + short() + "</h3>"
        + "".join(f'<div class="comment"><p>{say(1, 4)}</p></div>' for _ in range(rng.randint(1, 4))) + "</section>",
        lambda: '<div class="comment-list">' + "".join(f'<div class="reply"><p>{say(1, 3)}</p></div>' for _ in range(rng.randint(1, 3))) + "</div>",
    ]
    body = [f"<h1>{say(1, 1)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 9)):
        kind = rng.random()
        if kind < 0.7:
            body.append(f"<p>{say(1, 8)}" + rng.choice(["</p>", "</p>", ""]))
        elif kind < 0.78:
            body.append(f"<p><b>{short()}<br><p>{say(1, 3)}</p>")
        elif kind < 0.84:
            body.append(f"<h2>{short()}</h2>")
        elif kind < 0.9:
            body.append("<ul>" + "".join(f"<li>{say(1, 1)}</li>" for _ in range(rng.randint(2, 4))) + "</ul>")
        elif kind < 0.95:
            body.append(f"<blockquote>{say(1, 2)}</blockquote><p>{short()}</p>")
        else:
            body.append(f"<table><tr><td>{short()}</td><td>{short()}</td></tr></table>")
    if rng.random() < 0.3:
        body.insert(rng.randint(0, len(body)), f"<div data-main=0>{rng.choice(other)()}</div>")
    tag = rng.choice(["article", "article", "article", "main", 'div class="post-content"', 'div class="entry"', 'div id="content"', "div"])
    main = f"<{tag}><div data-main=1>{''.join(body)}</div></{tag.split()[0]}>"
    if rng.random() < 0.5:
        main = f"<{tag} data-main=1>{''.join(body)}</{tag.split()[0]}>"
    above = "".join(rng.choice(other)() for _ in range(rng.randint(0, 4)))
    below = "".join(rng.choice(other)() for _ in range(rng.randint(0, 2)))
    said = rng.choice(replies)() if rng.random() < 0.4 else ""
    end = rng.choice(foot)() if rng.random() < 0.85 else ""
    return f"<html><head><title>{say(1, 1)}</title></head><body>{above}{main}{said}{below}{end}</body></html>"


def _labels(page: str) -> tuple[list[list[str]], list[int]]:
    """Features and labels of a labelled page; the marks themselves are no feature."""
    marked = re.sub(r"(<[a-z]+)((?: (?:class|id)=\"[^\"]*\")?) data-main=([01])", r'\1\2 role="mark\3"', page)
    own = blocks(marked)
    labels, plain = [], []
    for block in own:
        marks = [hook for _, hooks in block.path for hook in re.findall(r"mark[01]", hooks)]
        labels.append(int(bool(marks) and marks[-1] == "mark1"))
        plain.append(Block(block.text, [(name, re.sub(r"\s*mark[01]", "", hooks)) for name, hooks in block.path], block.linked))
    return [features(block, i / len(plain)) for i, block in enumerate(plain)], labels


def train(pages: list[str], rounds: int = 120, rate: float = 0.1, decay: float = 1e-3) -> Model:
    """Maximum likelihood by Adam; forward and backward sums run over all pages at once."""
    data = [x for x in map(_labels, pages) if x[1]]
    names = sorted({name for listed, _ in data for own in listed for name in own})
    place = {name: i for i, name in enumerate(names)}
    count, longest = len(data), max(len(labels) for _, labels in data)
    there = np.zeros((count, longest), bool)
    gold = np.zeros((count, longest), int)
    owner, term = [], []
    for i, (listed, labels) in enumerate(data):
        there[i, : len(labels)] = True
        gold[i, : len(labels)] = labels
        for j, own in enumerate(listed):
            owner += [i * longest + j] * len(own)
            term += [place[name] for name in own]
    owner, term = np.array(owner), np.array(term)
    both = there[:, 1:]
    true_moves = np.zeros((2, 2))
    np.add.at(true_moves, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    true_terms = np.bincount(term, gold.ravel()[owner], minlength=len(names))
    value = np.zeros(len(names) + 4)
    first, second = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, rounds + 1):
        weights, moves = value[:-4], value[-4:].reshape(2, 2)
        on = np.bincount(owner, weights[term], minlength=count * longest).reshape(count, longest)
        score = np.stack([np.zeros_like(on), on], axis=2)
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            ahead[:, t] = score[:, t] + np.logaddexp(ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1])
        last = there.sum(1) - 1
        total = np.logaddexp(*ahead[np.arange(count), last].T)
        for t in range(longest - 2, -1, -1):
            step_on = score[:, t + 1] + behind[:, t + 1]
            back = np.stack([np.logaddexp(step_on[:, 0] + m[0], step_on[:, 1] + m[1]) for m in moves], axis=1)
            behind[:, t] = np.where(there[:, t + 1, None], back, 0)
        chance = np.where(there, np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None]), 0)
        slope = np.zeros_like(value)
        slope[:-4] = np.bincount(term, chance.ravel()[owner], minlength=len(names)) - true_terms
        for a in (0, 1):
            for b in (0, 1):
                pair = np.exp(ahead[:, :-1, a] + moves[a, b] + score[:, 1:, b] + behind[:, 1:, b] - total[:, None])
                slope[len(names) + 2 * a + b] = pair[both].sum() - true_moves[a, b]
        slope = slope / count + decay * value
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        value = value - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(dict(zip(names, value[:-4].tolist())), value[-4:].reshape(2, 2))


def fit(pages: DataFrame, html: str = "html", sampled: int = 200, made: int = 500, seed: int = 3) -> Model:
    """Train on `made` labelled pages whose sentences come from about `sampled` given pages (documented bounds).

    The given pages carry no labels, so labelled ones are put together from marked containers in varying layouts. Their
    wording is that of the corpus: sentences of sampled pages, from all their blocks alike. Without pages, fixed words stand in.
    """
    total = max(pages.count(), 1)
    share = min(1.0, sampled / total)
    order = F.pmod(F.xxhash64(F.col(html), F.lit(seed)), F.lit(1 << 20))
    rows = pages.filter(order < int(share * (1 << 20)) + 1).select(F.col(html).alias("html"))

    def sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            found = [x.strip() for page in batch.column("html").to_pylist() for block in blocks(page or "") for x in block.text.split(". ")[:4]]
            yield pa.RecordBatch.from_pydict({"sentence": pa.array([x[:300] for x in found if x], pa.string())})

    sampled_rows = rows.mapInArrow(sentences, "sentence string").filter(F.length("sentence") > 12)
    found = sorted({row.sentence.rstrip(".") + "." for row in sampled_rows.orderBy(F.xxhash64("sentence"), "sentence").limit(4000).collect()})
    rng = random.Random(seed)
    return train([labelled_page(rng, found or ["One two three four five.", "Six seven eight."]) for _ in range(made)])


def extracted(pages: DataFrame, model: Model, html: str = "html", carry: Iterable[str] | None = None) -> DataFrame:
    """`row` (the columns `carry`, by default all), text (main blocks in page order, joined by one space) and n_chars.

    Null and empty pages, and pages without main text, give the empty text. Each row is treated by itself, however long it is;
    repeated rows give equal results; no rows in, no rows out.
    """
    given = pages.select(packed(pages, carry), F.col(html).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in non_empty(batches):
            texts = []
            for page in batch.column("html").to_pylist():
                own, listed = _listed(page or "")
                texts.append(" ".join(block.text for block, main in zip(own, model.main(listed)) if main))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["row", "text", "n_chars"],
            )

    return given.mapInArrow(run, StructType([given.schema["row"], StructField("text", StringType()), StructField("n_chars", LongType())]))
