"""SentencePiece merge-type encoding by backtracking, and decoding.

A model's vocabulary file is read with the sentencepiece library; encoding and decoding are done here.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, ArrayType

from shopstrata.llm.common import non_empty, packed

SPACE = "▁"
#: Encoded chunks a worker remembers; beyond it the memory starts anew.
REMEMBERED = 300_000


def _form(id: int) -> tuple[bytes, bytes]:
    return np.int32(id).tobytes(), f"{id},".encode()


class Codec:
    """Encode and decode with one BPE model with byte fallback, identity normalisation and a space put in front.

    Tokens of a text are found left to right: at each place the longest piece by an Aho-Corasick scan, or else the next shorter
    piece that begins there, such that merging the last token and the piece alone would give just these two. Where no
    piece fits, the place is marked as failed in a bitfield and the last token is taken back.
    """

    def __init__(self, model: str) -> None:
        library = sentencepiece.SentencePieceProcessor(model_file=model)
        count = library.get_piece_size()
        self.special = {i for i in range(count) if library.is_control(i) or library.is_unknown(i) or library.is_unused(i)}
        self.pieces = [library.id_to_piece(i) for i in range(count)]
        byte_ids = [i for i in range(count) if library.is_byte(i)]
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in byte_ids}
        self.id_of_byte = {value: i for i, value in self.byte_of.items()}
        plain = [i for i in range(count) if i not in self.special and i not in self.byte_of]
        self.id_of = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: library.get_score(i) for i in plain}
        if not all(library.encode(text) == self._check(text) for text in ("a  b", " a", "")) or len(self.id_of_byte) != 256:
            raise ValueError("a BPE model with byte fallback, identity normalisation and a space put in front is needed")
        self.automaton = ahocorasick.Automaton()
        for piece in self.id_of:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        # Where no piece holds two neighbouring characters, no merge joins them, and a text may be cut in between.
        bare = [piece.lstrip(SPACE) for piece in self.id_of]
        self.apart = not any(SPACE in piece or "\n" in piece for piece in bare)
        joined = {c for piece in bare for c in re.findall(r"(?<=[^\W\d_])[!-~]", piece)}
        cut = "".join(c for c in "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~" if c not in joined)
        early = f"[^\\W\\d_]+(?=[{re.escape(cut)}])|" if cut else ""
        self.chunks = re.compile(f"{SPACE}*(?:{early}[^{SPACE}\n]+)|{SPACE}+|\n").findall
        self.forms = {piece: _form(i) for piece, i in self.id_of.items()}
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.fits = lru_cache(200_000)(self._fits)
        self.shorter = lru_cache(200_000)(self._shorter)

    def _check(self, text: str) -> list[int]:
        return [self.id_of[piece] for piece in self._merged(SPACE + text.replace(" ", SPACE))] if text else []

    def _merged(self, text: str) -> list[str]:
        """Plain merging of a short text: the best score first, then the leftmost."""
        parts: list[str | None] = list(text)
        after = [*range(1, len(parts)), -1]
        before = [-1, *range(len(parts) - 1)]
        heap: list[tuple[float, int, str]] = []

        def offer(at: int) -> None:
            if at >= 0 and (to := after[at]) >= 0 and (both := parts[at] + parts[to]) in self.score:
                heapq.heappush(heap, (-self.score[both], at, both))

        for at in range(len(parts)):
            offer(at)
        while heap:
            _, at, both = heapq.heappop(heap)
            if parts[at] is None or (to := after[at]) < 0 or parts[at] + parts[to] != both:
                continue
            parts[at], parts[to], after[at] = both, None, after[to]
            if after[at] >= 0:
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [part for part in parts if part is not None]

    def _fits(self, last: str, piece: str) -> bool:
        """Whether merging both together again gives just these two tokens."""
        return self._merged(last + piece) == ([last, piece] if last else [piece])

    def _shorter(self, piece: str) -> str:
        """The next shorter piece that begins alike, a single character at the end; empty after that."""
        for end in range(len(piece) - 1, 0, -1):
            if end == 1 or piece[:end] in self.id_of:
                return piece[:end]
        return ""

    def tokens(self, text: str) -> list[str]:
        """The tokens of a text whose spaces are written as marks; a character outside the vocabulary is one token."""
        size, fits = len(text), self.fits
        longest = [1] * size
        for end, length in self.automaton.iter(text):  # of those that begin at one place, the longest ends last
            longest[end - length + 1] = length
        tokens: list[str] = []
        failed, at = 0, 0
        piece = text[: longest[0]] if text else ""
        while at < size:
            while piece:
                end = at + len(piece)
                if not (failed and (failed >> end) & 1) and fits(tokens[-1] if tokens else "", piece):
                    tokens.append(piece)
                    at = end
                    piece = text[at : at + longest[at]] if at < size else ""
                    break
                piece = self.shorter(piece)
            else:
                failed |= 1 << at
                if not tokens:
                    raise ValueError("the vocabulary cannot encode this text")
                piece = tokens.pop()
                at -= len(piece)
                piece = self.shorter(piece)
        return tokens

    def _chunk(self, chunk: str) -> tuple[bytes, bytes]:
        """A chunk's ids as int32 and as decimal text, each id followed by a comma."""
        forms = self.forms
        both = [forms[token] if token in forms else self._bytes(token) for token in self.tokens(chunk)]
        found = b"".join([x for x, _ in both]), b"".join([x for _, x in both])
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(chunk) <= 64:
            self.known[chunk] = found
        return found

    def _bytes(self, token: str) -> tuple[bytes, bytes]:
        forms = [_form(self.id_of_byte[value]) for value in token.encode("utf-8", "surrogatepass")]
        return b"".join([x for x, _ in forms]), b"".join([x for _, x in forms])

    def encode(self, text: str) -> tuple[np.ndarray, bytes]:
        """Ids of a whole text, and the same in decimal joined by commas."""
        if not text:
            return np.empty(0, np.int32), b""
        marked = SPACE + text.replace(" ", SPACE)
        get, parts = self.known.get, self.chunks(marked) if self.apart else [marked]
        found = [get(part) or self._chunk(part) for part in parts]
        return np.frombuffer(b"".join([x for x, _ in found]), np.int32), b"".join([x for _, x in found])[:-1]

    def decode(self, ids: np.ndarray) -> str:
        """Pieces put together with marks as spaces, the one in front taken away; bytes read as UTF-8."""
        raw = b"".join(map(self._raw.__getitem__, ids.tolist()))
        return raw.decode("utf-8", errors="replace")[1:] if raw[:1] == b" " else raw.decode("utf-8", errors="replace")

    @property
    def _raw(self) -> list[bytes]:
        if not hasattr(self, "_raw_pieces"):
            self._raw_pieces = [
                bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.special else piece.replace(SPACE, " ").encode()
                for i, piece in enumerate(self.pieces)
            ]
        return self._raw_pieces


@lru_cache(2)
def codec(model: str) -> Codec:
    """One codec per worker process and model."""
    return Codec(model)


OUT = [
    StructField("n_tokens", LongType()),
    StructField("ids", ArrayType(IntegerType())),
    StructField("decoded", StringType()),
    StructField("ids_sha256", StringType()),
    StructField("decoded_sha256", StringType()),
]


def encode(
    docs: DataFrame, model: str, text: str = "text", carry: Iterable[str] | None = None, keep: Iterable[str] = ("ids", "decoded")
) -> DataFrame:
    """Encode every whole text and decode it again, each row by itself.

    Returns `row` (the columns `carry`, by default all), n_tokens, those of ids and decoded that are in `keep`, and the SHA-256 of
    the ids in decimal joined by commas and of the decoded text. `model` is a path that every worker can read.

    Null counts as empty; an empty text has no ids and decodes to the empty text. A mark character in a text decodes to a
    space, as in the library. Repeated rows give equal results; an empty table gives none.
    """
    given = docs.select(packed(docs, carry), F.col(text).cast("string").alias("text"))
    chosen = [field for field in OUT if field.name not in ("ids", "decoded") or field.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for whole in non_empty(batches):
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                ids, decoded, counts, of_ids, of_text = [], [], [], [], []
                for value in batch.column("text").to_pylist():
                    found, decimal = own.encode(value or "")
                    back = own.decode(found)
                    counts.append(len(found))
                    of_ids.append(hashlib.sha256(decimal).hexdigest())
                    of_text.append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                    ids.append(found)
                    decoded.append(back if "decoded" in keep else None)
                columns = {
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids": pa.ListArray.from_arrays(
                        pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(np.concatenate(ids), pa.int32())
                    ),
                    "decoded": pa.array(decoded, pa.string()),
                    "ids_sha256": pa.array(of_ids),
                    "decoded_sha256": pa.array(of_text),
                }
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), *(columns[field.name] for field in chosen)], names=["row", *(field.name for field in chosen)]
                )

    return given.mapInArrow(run, StructType([given.schema["row"], *chosen]))
