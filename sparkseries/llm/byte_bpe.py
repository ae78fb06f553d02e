"""Byte-level BPE by dynamic programming over prefixes: every byte prefix has one valid last token."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .chunks import chunks
from .common import drop_worker_state, id_and_text, text_slices, worker_state

NEVER = 1 << 62
#: Parts of texts, and prefixes and pairs of tokens, that a worker remembers; reaching a number empties that memory, also within a text.
MOST_PARTS = 350_000
MOST_PREFIXES = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file of base-64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks, and which token may follow which.

    A token of rank r comes to be at time r of the merging, from two tokens of lower rank. Two tokens stand side by side in
    an encoding if no merge across their border comes first: not between any token that ends the left one while it is built and any token
    that begins the right one, before the first of both is merged away.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        #: Each token by its bytes: what is remembered refers to these and holds no copies of them.
        self.tokens = {token: token for token in ranks}
        self.longest = [1] * 256
        for token in ranks:
            self.longest[token[-1]] = max(self.longest[token[-1]], len(token))
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._ends: dict[bytes, list[tuple[bytes, int]]] = {}
        self._starts: dict[bytes, list[tuple[bytes, int]]] = {}
        self.known: dict[tuple[bytes, bytes], bool] = {}

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes this one; none for a byte."""
        if token not in self._halves:
            parts, limit = [token[i : i + 1] for i in range(len(token))], self.ranks[token]
            while len(parts) > 2:
                rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if rank >= limit:
                    raise ValueError(f"no merges lead to the token {token!r}")
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The tokens at one side of a token while it is built, with the time at which each is merged away."""
        found, until = [], NEVER
        while token is not None:
            found.append((token, until))
            until, pair = self.ranks[token], self.halves(token)
            token = pair[side] if pair else None
        return found

    def _merged(self, ends: list[tuple[bytes, int]], starts: list[tuple[bytes, int]]) -> bool:
        """Whether a merge across the border comes first."""
        rank_of = self.ranks.get
        for a, gone in ends:
            for b, merged in starts:
                # Of equal merges the left one comes first.
                across = rank_of(a + b, NEVER)
                if across < gone and across <= merged:
                    return True
        return False

    def beside(self, left: bytes, right: bytes) -> bool:
        """Whether `right` may follow `left` in an encoding."""
        known = self.known.get((left, right))
        if known is None:
            left, right = self.tokens[left], self.tokens[right]
            if len(self.known) >= MOST_PREFIXES:
                self.known.clear()
            if left not in self._ends:
                self._ends[left] = self._spine(left, 1)
            if right not in self._starts:
                self._starts[right] = self._spine(right, 0)
            known = self.known[left, right] = not self._merged(self._ends[left], self._starts[right])
        return known


class Prefixes(dict):
    """The last token of the encoding of each byte prefix seen so far; the empty prefix has an empty one.

    The last token of a prefix is the one token at its end that may follow the encoding of what stands before. A prefix is computed once,
    so bytes appended to a known one cost only themselves; for edits see `PrefixEncoding.replace`. The tokens before the last are those
    of the shorter prefix before it, so nothing else is stored.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__({b"": b""})
        self.vocabulary = vocabulary
        self.packed = {token: int(rank).to_bytes(4, "little") for token, rank in vocabulary.ranks.items()}

    def encode(self, data: bytes) -> bytes:
        """The ids of some bytes, as little-endian 32-bit numbers. All prefixes are remembered."""
        token_of, longest, vocabulary, known_beside = self.vocabulary.tokens.get, self.vocabulary.longest, self.vocabulary, self.vocabulary.known
        start = len(data)
        while (last := self.get(data[:start])) is None:
            start -= 1
        # Of the prefixes from `start` on.
        lasts = [last]
        for end in range(start + 1, len(data) + 1):
            least = max(0, end - longest[data[end - 1]])
            for at in range(end - 1, least - 1, -1):
                token = token_of(data[at:end])
                if token is not None:
                    before = lasts[at - start] if at >= start else self[data[:at]]
                    fits = not before or known_beside.get((before, token))
                    if fits is None:
                        fits = vocabulary.beside(before, token)
                    if fits:
                        self[data[:end]] = token
                        lasts.append(token)
                        break
            else:
                raise ValueError(f"no token ends with byte {data[end - 1]}")
        found, packed, at = [], self.packed, len(data)
        while at:
            token = lasts[at - start] if at >= start else self[data[:at]]
            found.append(packed[token])
            at -= len(token)
        return b"".join(found[::-1])


class PrefixEncoding:
    """The encoding of one sequence of bytes that is appended to and edited: the last token of each of its prefixes, by length."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [0]
        self.append(data)

    def append(self, more: bytes) -> PrefixEncoding:
        """Adds bytes at the end; what is stored for the bytes before stays as it is."""
        start, self.data = len(self.data), self.data + more
        for end in range(start + 1, len(self.data) + 1):
            self.last.append(self._last(end))
        return self

    def _last(self, end: int) -> int:
        """The length of the last token of the prefix that ends at `end`; all shorter prefixes are known."""
        data, last = self.data, self.last
        ranks, longest, beside = self.vocabulary.ranks, self.vocabulary.longest, self.vocabulary.beside
        for at in range(max(0, end - longest[data[end - 1]]), end):
            token = data[at:end]
            if token in ranks and (at == 0 or beside(data[at - last[at] : at], token)):
                return end - at
        raise ValueError(f"no token ends with byte {data[end - 1]}")

    def replace(self, start: int, end: int, new: bytes) -> PrefixEncoding:
        """The bytes from `start` to `end` replaced; prefixes up to `start` are kept.

        The last token of a prefix follows from its last bytes, as many as the longest token has, and the last tokens of the prefixes that
        end before these. So once old and new agree for as many prefixes in a row, and the tokens there lie behind the edit, they agree to the end.
        """
        old = self.last
        self.data = self.data[:start] + new + self.data[end:]
        self.last = last = old[: start + 1]
        moved, need, same = end - start - len(new), max(self.vocabulary.longest), 0
        changed = start + len(new)
        for place in range(start + 1, len(self.data) + 1):
            last.append(self._last(place))
            # A token before the edit has other bytes although it may be as long.
            behind = place - last[place] >= changed
            same = same + 1 if behind and old[place + moved] == last[place] else 0
            if same >= need:
                last.extend(old[place + moved + 1 :])
                break
        return self

    def tokens(self) -> list[int]:
        found, at = [], len(self.data)
        while at:
            found.append(self.vocabulary.ranks[self.data[at - self.last[at] : at]])
            at -= self.last[at]
        return found[::-1]


class Encoder(dict):
    """Parts of texts and their ids as little-endian 32-bit numbers; an unknown part is encoded when asked for."""

    #: A longer piece is encoded without remembering its prefixes, whose bytes would grow with the square of its length. A part of
    #: more characters, such as a line of a language without spaces, is not remembered: so many of them would have no bound in bytes.
    longest_shared = 64

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.vocabulary, self.pattern = Vocabulary(read_ranks(path)), regex.compile(pattern)
        self.prefixes = Prefixes(self.vocabulary)

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        if len(data) <= self.longest_shared:
            if len(self.prefixes) > MOST_PREFIXES:
                self.prefixes = Prefixes(self.vocabulary)
            return self.prefixes.packed.get(data) or self.prefixes.encode(data)
        return np.array(PrefixEncoding(self.vocabulary, data).tokens(), "<i4").tobytes()

    def __missing__(self, part: str) -> bytes:
        # A space and letters are one piece of the pattern.
        found = self._piece(part) if part[1:].isalpha() and part[0] == " " else b"".join(map(self._piece, self.pattern.findall(part)))
        if len(part) <= self.longest_shared:
            if len(self) >= MOST_PARTS:
                self.clear()
            self[part] = found
        return found

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, chunks(text)))


def list_of_ints(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every text, each match of `pattern` encoded by itself, without special tokens.

    A null or empty text has no ids. Rows repeat as they do in the input, a null id stays null, an empty table gives an empty
    result; the time for a long text grows with its length. `path` names a file of ranks that every executor has.
    """

    key = ("encoder", path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(key, lambda: Encoder(path, pattern))
        for part in text_slices(batches, holding=key):
            ids = list_of_ints([encoder.encode(text) for text in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id LONG, ids ARRAY<INT>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of `encode` with `decoded`, the bytes that the ids stand for; null ids are no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The worker may have encoded before; while it decodes, another one encodes for it.
        drop_worker_state(None)
        ranks = read_ranks(path)
        table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        tokens = pa.array(table, pa.binary())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column("ids")
                ends = np.cumsum([0, *(n or 0 for n in lists.value_lengths().to_pylist())])
                # The bytes of all ids stand in one buffer, text after text; its offsets at the ends of texts are those of the texts.
                taken = tokens.take(lists.flatten())
                if taken.null_count:
                    raise ValueError("an id is null or of no token")
                offsets = np.frombuffer(taken.buffers()[1], "<i4")[ends + taken.offset] if len(taken) else ends.astype("<i4")
                texts = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(np.ascontiguousarray(offsets)), taken.buffers()[2]])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, texts], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id LONG, ids ARRAY<INT>, decoded BINARY")
