"""Deterministic transducers of a byte-level BPE tokenizer: one cuts a text into words, one counts the tokens of a word.

Both are tables. Their steps run side by side on many stretches of text, one array operation a step.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

#: Stands between texts, and for a special token; no byte of UTF-8.
END_BYTE = 0xFF
# The endings that make a word of an apostrophe.
ENDINGS = ["s", "t", "m", "d", "re", "ve", "ll"]

# Classes of characters.
ONE, R_V, E, L_L, LETTER, DIGIT, QUOTE, OTHER, SPACE, WHITE, END = range(11)
# States of the cutter: what has been read of the present word.
FRESH, LETTERS, DIGITS, OTHERS, QUOTED, WANTS_E, WANTS_L, SPACE_1, WHITE_1, SPACE_N, WHITE_N = range(11)
STATES, CLASSES = 11, 11
HERE, BEFORE = 1, 2  # a word begins at this character, at the one before


def _cut(state: int, kind: int) -> tuple[int, int]:
    """The next state, and where a word begins."""
    letter, white = kind <= LETTER, kind in (SPACE, WHITE)
    opened = {DIGIT: DIGITS, QUOTE: QUOTED, OTHER: OTHERS, SPACE: SPACE_1, WHITE: WHITE_1, END: FRESH}
    afresh = LETTERS if letter else opened[kind], 0 if kind == END else HERE
    joined = LETTERS if letter else DIGITS if kind == DIGIT else OTHERS  # behind a space
    if state == LETTERS and letter:
        return LETTERS, 0
    if state == DIGITS and kind == DIGIT:
        return DIGITS, 0
    if state in (OTHERS, QUOTED) and kind in (OTHER, QUOTE):
        return OTHERS, 0
    if state == QUOTED and kind in (ONE, R_V, L_L):
        return {ONE: FRESH, R_V: WANTS_E, L_L: WANTS_L}[kind], 0
    if state in (WANTS_E, WANTS_L):
        if kind == (E if state == WANTS_E else L_L):
            return FRESH, 0
        return (LETTERS, BEFORE) if letter else (afresh[0], afresh[1] | BEFORE)
    if state in (SPACE_1, WHITE_1, SPACE_N, WHITE_N):
        if white:
            return (SPACE_N if kind == SPACE else WHITE_N), 0
        if kind == END:
            return FRESH, 0
        begins = BEFORE if state in (SPACE_N, WHITE_N) else 0  # the last white space of several
        if state in (SPACE_1, SPACE_N):
            return joined, begins
        return afresh[0], afresh[1] | begins
    return afresh


_TABLE = [[_cut(state, kind) for kind in range(CLASSES)] for state in range(STATES)]
NEXT = np.array([[x for x, _ in row] for row in _TABLE], np.uint8).ravel()
MARK = np.array([[x for _, x in row] for row in _TABLE], np.uint8).ravel()
CHUNK = 256


def class_runs(model: str) -> tuple[np.ndarray, np.ndarray]:
    """The class of every code point as the tokenizer's own library has it: first code points of runs, and their classes."""
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(model).pre_tokenizer.pre_tokenize_str
    kinds = np.full(0x110000, OTHER, np.uint8)
    for plane in (0, 1, 2, 3, 14):  # the others hold no letters, digits or white space
        points = [c for c in range(plane << 16, (plane + 1) << 16) if not 0xD800 <= c < 0xE000 and c != 0x20]
        # Neighbours in one word are of one class, so the first of each word stands for all of it.
        begins = [place[0] for _, place in split("".join(map(chr, points)))]
        probe = "".join(f"\na{c}\n1{c}\n!{c}" for c in (chr(points[at]) for at in begins))
        apart = np.zeros(len(probe), bool)
        apart[[place[0] for _, place in split(probe)]] = True
        joins = ~apart[2::3].reshape(-1, 3)
        found = np.select([joins[:, 0], joins[:, 1], joins[:, 2]], [LETTER, DIGIT, OTHER], WHITE)
        kinds[points] = np.repeat(found, np.diff([*begins, len(points)]))
    kinds[ord(" ")], kinds[ord("'")] = SPACE, QUOTE
    for ending in ENDINGS:
        kinds[ord(ending[0])] = ONE if len(ending) == 1 else L_L if ending == "ll" else R_V
    kinds[ord("e")] = E
    first = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]])
    return first.astype(np.int32), kinds[first]


class Cutter:
    """Finds where words begin. A chunk's map takes every state it may be entered in to the state it is left in; a prefix
    scan of the maps gives each chunk its true first state, and a second run marks the words."""

    def __init__(self, runs: tuple[np.ndarray, np.ndarray]) -> None:
        first, kinds = runs
        self.kinds = np.repeat(kinds, np.diff(np.r_[first, 0x110000]))

    def classes(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes of the characters of UTF-8 text, and the places of their first bytes."""
        places = np.flatnonzero((raw & 0xC0) != 0x80)
        lead = raw[places]
        code = lead.astype(np.int32)
        for least, past, mask, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0xF8, 0x07, 3)):
            which = np.flatnonzero((lead >= least) & (lead < past))
            if len(which):
                value = code[which] & mask
                for k in range(1, more + 1):
                    value = value << 6 | (raw[places[which] + k] & 0x3F)
                code[which] = value
        kinds = self.kinds[code]
        kinds[lead == END_BYTE] = END
        return kinds, places

    def begins(self, kinds: np.ndarray) -> np.ndarray:
        """True where a word begins; `kinds` starts where a text does."""
        lanes = -(-len(kinds) // CHUNK)
        steps = np.full(lanes * CHUNK, END, np.uint8)
        steps[: len(kinds)] = kinds
        steps = np.ascontiguousarray(steps.reshape(lanes, CHUNK).T)
        state = entered(steps)
        marks = np.empty((CHUNK, lanes), np.uint8)
        for step, mark in zip(steps, marks, strict=True):
            at = state * np.uint8(CLASSES) + step
            mark[:] = MARK[at]
            state = NEXT[at]
        marks = marks.T.ravel()[: len(kinds)]
        found = (marks & HERE).astype(bool)
        found[:-1] |= (marks[1:] & BEFORE).astype(bool)
        return found


def entered(steps: np.ndarray) -> np.ndarray:
    """The state in which each chunk is entered. `steps` has a column for each chunk."""
    lanes = steps.shape[1]
    maps = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], lanes, axis=1)
    for at in range(0, len(steps), 16):
        # A map that takes all states to one is followed from there as one state.
        open_ = np.flatnonzero((maps != maps[0]).any(axis=0))
        some, one = maps[:, open_], maps[0]
        for step in steps[at : at + 16]:
            one = NEXT[one * np.uint8(CLASSES) + step]
            if len(open_):
                some = NEXT[some * np.uint8(CLASSES) + step[open_]]
        maps = np.repeat(one[None], STATES, axis=0)
        maps[:, open_] = some
    reach = 1
    while reach < lanes:  # after each round a map stands for twice as many chunks, up to its own
        both = maps.copy()
        both[:, reach:] = np.take_along_axis(maps[:, reach:], maps[:, :-reach].astype(np.intp), axis=0)
        maps, reach = both, reach * 2
    return np.r_[np.uint8(FRESH), maps[FRESH, :-1]].astype(np.uint8)


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a visible character: itself where it has one, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Counter:
    """Counts the tokens of words.

    After each byte a word so far has one last token: the one that ends there and, merged anew with the last token before
    it, stays apart from it. A state holds what later bytes may need: of every place from which a token may still be under way, the
    place in the vocabulary's trie, the last token there, and the tokens counted since. A step's output is the change in the count.
    States and steps are made when a text first needs them, and kept in a table with open addresses; past `most` steps
    the table starts anew.
    """

    def __init__(self, model: str, most: int = 2_000_000) -> None:
        with open(model, encoding="utf-8") as file:
            given = json.load(file)
        form, split = given["model"], given.get("pre_tokenizer") or {}
        if form["type"] != "BPE" or form.get("ignore_merges") or form.get("byte_fallback") or given.get("normalizer"):
            raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError("a byte-level split without a space put in front is needed")
        added = given.get("added_tokens", [])
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in added):
            raise ValueError("special tokens must match literally")
        self.special = [x["content"] for x in added]
        letters = _byte_letters()
        spelled = lambda token: bytes(letters[c] for c in token)
        self.tokens = {bytes([b]): b for b in range(256)}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[int, int] | None] = [None] * 256
        for order, merge in enumerate(form["merges"]):
            left, right = map(spelled, merge.split(" ") if isinstance(merge, str) else merge)
            if left + right in self.tokens or left not in self.tokens or right not in self.tokens:
                raise ValueError("every merge must make a new token of earlier ones")
            self.rank[self.tokens[left], self.tokens[right]] = order
            self.parts.append((self.tokens[left], self.tokens[right]))
            self.tokens[left + right] = 256 + order  # tokens are numbered in the order of their merges
        self.child: dict[int, int] = {}
        self.token_at, self.inner = [-1], [True]
        for token, number in self.tokens.items():
            node = 0
            for byte in token:
                self.inner[node] = True
                after = self.child.setdefault(node << 8 | byte, len(self.token_at))
                if after == len(self.token_at):
                    self.token_at.append(-1)
                    self.inner.append(False)
                node = after
            self.token_at[node] = number
        self.apart = lru_cache(1_000_000)(self._apart)
        self.most = most
        self._anew()

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The symbols at one end of a token while it is merged, each with the merge that takes it up; the token itself last."""
        found, taken = [], len(self.parts)
        while True:
            found.append((token, taken))
            if self.parts[token] is None:
                return found[::-1]
            taken, token = token - 256, self.parts[token][side]

    def _apart(self, last: int, token: int) -> bool:
        """Whether merging both together again gives just these two: no merge across the seam comes before those that take up its
        symbols. Of equal merges the left one comes first."""
        for a, a_taken in self._edge(last, 1):
            for b, b_taken in self._edge(token, 0):
                order = self.rank.get((a, b))
                if order is not None and order < a_taken and order <= b_taken:
                    return False
        return True

    def _anew(self) -> None:
        start = ((0, -1, 0),)
        self.states, self.number = [start], {start: 0}
        self._table(1 << 16)
        self.steps = 0

    def _table(self, size: int) -> None:
        self.keys = np.full(size, -1, np.int64)
        self.after = np.zeros(size, np.int32)
        self.change = np.zeros(size, np.int8)
        self.shift = np.uint64(64 - size.bit_length() + 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _make(self, state: int, byte: int) -> tuple[int, int]:
        """The step from a state on a byte."""
        ends, ways = None, []
        for node, last, since in self.states[state]:  # from the first place on, so that the longest token is tried first
            after = self.child.get(node << 8 | byte)
            if after is None:
                continue
            token = self.token_at[after]
            if ends is None and token >= 0 and (last < 0 or self.apart(last, token)):
                ends = token, 1 - since
            if self.inner[after]:
                ways.append((after, last, since))
        token, change = ends
        found = (*((node, last, since + change) for node, last, since in ways), (0, token, 0))
        number = self.number.setdefault(found, len(self.states))
        if number == len(self.states):
            self.states.append(found)
        return number, change

    def _learn(self, keys: np.ndarray) -> None:
        for key in np.unique(keys).tolist():
            after, change = self._make(key >> 8, key & 255)
            self.steps += 1
            if 2 * self.steps > len(self.keys):
                old = self.keys, self.after, self.change
                self._table(2 * len(self.keys))
                held = old[0] >= 0
                for k, a, c in zip(*(x[held].tolist() for x in old), strict=True):
                    self._put(k, a, c)
            self._put(key, after, change)

    def _put(self, key: int, after: int, change: int) -> None:
        slot = ((key * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        while self.keys[slot] >= 0:
            slot = (slot + 1) & (len(self.keys) - 1)
        self.keys[slot], self.after[slot], self.change[slot] = key, after, change

    def _found(self, keys: np.ndarray) -> np.ndarray:
        """The place of every step in the table; steps that are not there are made."""
        while True:
            slots = self._slots(keys)
            held = self.keys[slots]
            wrong = np.flatnonzero(held != keys)
            missing = []
            while len(wrong):
                free = held[wrong] < 0
                if free.any():
                    missing.append(keys[wrong[free]])
                    wrong = wrong[~free]
                slots[wrong] = (slots[wrong] + 1) & (len(self.keys) - 1)
                held[wrong] = self.keys[slots[wrong]]
                wrong = wrong[held[wrong] != keys[wrong]]
            if not missing:
                return slots
            self._learn(np.concatenate(missing))

    def count(self, raw: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of tokens of each word, given by its place and its number of bytes."""
        if self.steps > self.most:
            self._anew()
        order = np.argsort(-sizes, kind="stable")
        places, left = first[order].astype(np.int64), sizes[order]
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        alive, step = len(order), 0
        while True:
            alive = int(np.searchsorted(-left[:alive], -step, side="left"))  # the words longer than `step`
            if alive < 16:
                break
            slots = self._found(state[:alive] << 8 | raw[places[:alive] + step])
            state[:alive] = self.after[slots]
            total[:alive] += self.change[slots]
            step += 1
        made = {}
        for lane in range(alive):  # the few longest words, one after the other
            at, sum_ = int(state[lane]), int(total[lane])
            for byte in raw[places[lane] + step : places[lane] + left[lane]].tobytes():
                key = at << 8 | byte
                if key not in made:
                    slot = self._found(np.array([key]))[0]
                    made[key] = int(self.after[slot]), int(self.change[slot])
                at, change = made[key]
                sum_ += change
            total[lane] = sum_
        result = np.empty(len(order), np.int64)
        result[order] = total
        return result
