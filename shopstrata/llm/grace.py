"""Grace hashing inside one task: an open-addressing table of complete contents, with recursive spill files."""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterator

FANOUT_BITS = 4
#: A digest has 256 bits, 64 of them choose slots; equal digests of unequal contents stay together from this level on.
DEEPEST = 48


class ContentTable:
    """Open addressing with linear probing over complete contents; doubles when two thirds full."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, digest: bytes, content: bytes) -> int:
        """The number of an equal content, or -1."""
        hashed, mask = int.from_bytes(digest[:8], "little"), len(self.slots) - 1
        at = hashed & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == hashed and self.contents[entry] == content:
                return entry
            at = (at + 1) & mask
        return -1

    def add(self, digest: bytes, content: bytes) -> int:
        """Enter a content that is not there yet; its number."""
        hashed = int.from_bytes(digest[:8], "little")
        self.hashes.append(hashed)
        self.contents.append(content)
        self.bytes += len(content) + 150
        if 3 * len(self.hashes) > 2 * len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for entry, old in enumerate(self.hashes):
                self._place(entry, old)
        else:
            self._place(len(self.hashes) - 1, hashed)
        return len(self.hashes) - 1

    def _place(self, entry: int, hashed: int) -> None:
        mask = len(self.slots) - 1
        at = hashed & mask
        while self.slots[at] >= 0:
            at = (at + 1) & mask
        self.slots[at] = entry


def _read(path: str) -> Iterator[tuple[bytes, bytes, int]]:
    with open(path, "rb") as source:
        while True:
            try:
                yield pickle.load(source)
            except EOFError:
                return


def equal_contents(records: Iterator[tuple[bytes, bytes, int]], memory: int, level: int = 0) -> Iterator[tuple[int, int]]:
    """For each (digest, content, key): its key and the key of the first record with the same content.

    While the table has room, contents enter it. Once it holds `memory` bytes, a record is still compared with it, but a new
    content goes to one of 16 spill files by the next bits of its digest. Each file is then treated alike, with a fresh
    table, until nothing is left over. Copies of one text need no room, so a group of any size ends in one slot. The
    files are of this task alone and go when it ends, like Spark's own spills.
    """
    table, keys = ContentTable(), []
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        files: dict[int, object] = {}
        try:
            for digest, content, key in records:
                entry = table.find(digest, content)
                if entry >= 0:
                    yield key, keys[entry]
                elif table.bytes < memory or not keys or level >= DEEPEST:
                    table.add(digest, content)
                    keys.append(key)
                    yield key, key
                else:
                    part = (digest[8 + level // 2] >> (FANOUT_BITS * (level % 2))) & 15
                    if part not in files:
                        files[part] = open(os.path.join(folder, str(part)), "wb")
                    pickle.dump((digest, content, key), files[part], protocol=5)
        finally:
            for file in files.values():
                file.close()
        del table
        for part in sorted(files):
            path = os.path.join(folder, str(part))
            yield from equal_contents(_read(path), memory, level + 1)
            os.remove(path)
