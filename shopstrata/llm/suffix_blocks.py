"""Sorting suffixes block by block with the ranks of a difference-cover sample."""

from __future__ import annotations

import numpy as np

#: Every distance modulo 31 is a difference of two of these.
PERIOD = 31
COVER = np.array([1, 5, 11, 24, 25, 27])
_IN_COVER = np.zeros(PERIOD, bool)
_IN_COVER[COVER] = True
#: For two residues, the least shift that brings both into the cover.
SHIFT = np.array([[next(s for s in range(PERIOD) if _IN_COVER[(a + s) % PERIOD] and _IN_COVER[(b + s) % PERIOD]) for b in range(PERIOD)] for a in range(PERIOD)])
BLOCK = 1 << 20


def _dense(key: np.ndarray) -> np.ndarray:
    """Ranks of numbers from 0; equal numbers share one."""
    order = np.argsort(key)
    ordered = key[order]
    ranks = np.empty(len(key), np.int64)
    ranks[order] = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]]) if len(key) else 0
    return ranks


def _sort(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of several numbers, and for each place in it the first place of an equal row.

    A number counts only where those before it tie, and only those rows are moved.
    """
    order = np.argsort(keys[0])
    ordered = keys[0][order]
    place = np.arange(len(order))
    first = np.maximum.accumulate(np.where(np.r_[True, ordered[1:] != ordered[:-1]], place, 0)) if len(order) else place
    for key in keys[1:]:
        alone = first == place
        alone[:-1] &= alone[1:]
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        group, values = first[open_], key[order[open_]]
        new = np.argsort((group << 32) | _dense(values))
        order[open_] = order[open_[new]]
        values = values[new]
        starts = np.r_[True, (group[1:] != group[:-1]) | (values[1:] != values[:-1])]
        first[open_] = np.maximum.accumulate(np.where(starts, open_, 0))
    return order, first


class Text:
    """Strings laid end to end; a suffix ends with its string and counts as zeros from there on.

    With a `depth`, suffixes are put in order by that many bytes at least, otherwise by all they have.
    """

    def __init__(self, strings: list[bytes], depth: int | None = None) -> None:
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.cumsum(lengths) - lengths
        self.data = np.frombuffer(b"".join(strings) + bytes(80), np.uint8)
        self.ends = np.repeat(self.starts + lengths, lengths)
        self.size = int(lengths.sum())
        words = self.data.astype(np.uint64)
        for width in (1, 2, 4):
            words = (words[:-width] << np.uint64(8 * width)) | words[width:]
        self.words = words
        self.ranks = self._cover_ranks(depth)

    def word(self, at: np.ndarray, skip: int, most: int = 8) -> np.ndarray:
        """The `most` bytes from at + skip as one big-endian number, zeros behind the string's end."""
        place = at + skip
        left = self.ends[at] - place
        if len(left) and left.min() >= most:
            shift = np.uint64(8 * (8 - most))
            found = self.words[place]
            return (found >> shift) << shift if shift else found
        left = np.clip(left, 0, most)
        drop = (np.minimum(8 - left, 7) * 8).astype(np.uint64)
        found = (self.words[np.minimum(place, len(self.words) - 1)] >> drop) << drop
        return np.where(left > 0, found, np.uint64(0)) if (left <= 0).any() else found

    def head(self, at: np.ndarray) -> list[np.ndarray]:
        """The first 31 bytes."""
        return [self.word(at, 0), self.word(at, 8), self.word(at, 16), self.word(at, 24, 7)]

    def _cover_ranks(self, depth: int | None) -> np.ndarray:
        """Ranks of the sample suffixes, 0 elsewhere: by 31 bytes first, then by pairs of ranks at doubled distances."""
        ranks = np.zeros(self.size + 1, np.int64)
        sample = np.flatnonzero(_IN_COVER[np.arange(self.size) % PERIOD])
        if not len(sample):
            return ranks
        keys = self.head(sample)
        reach, longest = PERIOD, int((self.ends[sample] - sample).max())
        longest = longest if depth is None else min(longest, depth)
        while True:
            order, first = _sort(keys)
            ranks[sample[order]] = first + 1
            if reach >= longest or (first == np.arange(len(first))).all():
                return ranks
            ahead = sample + reach
            keys = [ranks[sample], np.where(ahead < self.ends[sample], ranks[np.minimum(ahead, self.size)], 0)]
            reach *= 2

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Order of suffixes that agree in 31 bytes: -1, 0 or 1, by the sample ranks at their common shift."""
        shift = SHIFT[a % PERIOD, b % PERIOD]
        rank_a = np.where(a + shift < self.ends[a], self.ranks[np.minimum(a + shift, self.size)], 0)
        rank_b = np.where(b + shift < self.ends[b], self.ranks[np.minimum(b + shift, self.size)], 0)
        return np.sign(rank_a - rank_b)

    def _sorted(self, at: np.ndarray) -> np.ndarray:
        order, group = _sort(self.head(at))
        at = at[order]
        # Ties are split three ways around a pivot each, all at once, until each is settled.
        open_ = np.arange(len(at))
        while len(open_):
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            sizes = np.diff(np.r_[starts, len(group)])
            many = np.repeat(sizes > 1, sizes)
            open_, group = open_[many], group[many]
            if not len(open_):
                break
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            sizes = np.diff(np.r_[starts, len(group)])
            pivot = np.repeat(at[open_[starts + sizes // 2]], sizes)
            side = self.compare(at[open_], pivot)
            order = np.argsort(group * 3 + side + 1)
            at[open_] = at[open_[order]]
            side, group = side[order], group[order]
            group = np.cumsum(np.r_[True, (group[1:] != group[:-1]) | (side[1:] != side[:-1])])
            unequal = side != 0
            open_, group = open_[unequal], group[unequal]
        return at

    def blocks(self, at: np.ndarray, most: int = BLOCK):
        """The given suffixes in order, one block of leading bytes at a time; equal first bytes stay in one block."""
        lead = self.word(at, 0)
        cuts = np.unique(np.quantile(lead[:: max(len(lead) // 20_000, 1)].astype(np.float64), np.linspace(0, 1, len(at) // most + 2)[1:-1]))
        part = np.searchsorted(cuts, lead.astype(np.float64), side="right")
        for number in range(len(cuts) + 1):
            chosen = at[part == number]
            if len(chosen):
                yield self._sorted(chosen)

    def alike(self, at: np.ndarray, length: int) -> np.ndarray:
        """For suffixes in order: whether each agrees with the one before in `length` bytes."""
        after, before = at[1:], at[:-1]
        same = np.arange(len(after))
        for skip in range(0, length, 8):
            size = min(8, length - skip)
            same = same[self.word(after[same], skip, size) == self.word(before[same], skip, size)]
        out = np.zeros(len(at), bool)
        out[same + 1] = True
        return out
