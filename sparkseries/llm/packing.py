"""Best-fit packing of token sequences with a linear grouping scheme.

Lengths are bounded by the capacity, so the scheme works on how often each length occurs, whatever the number of documents. Large
lengths are put in groups of equal cardinality and rounded up to the largest of their group; a linear programme over configurations
of these few sizes (solved by column generation) says how often to use each configuration; its places are filled with actual
documents; what is left over and the small lengths are packed best-fit, the longest first, into the space that remains.
"""

from __future__ import annotations

import logging
import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import LOOSE_SPACE, chunks
from .common import id_and_text, kept, text_slices, worker_state

log = logging.getLogger(__name__)

CAPACITY = 2048
#: Groups of large lengths, and the shares of the capacity above which a length is large: the best plan of them is taken.
GROUPS = 96
LARGE_SHARES = (2, 3, 4)
MOST_ROUNDS = 3000
#: Parts of texts a worker remembers: up to so many that came up lately, and as many from before.
MOST_REMEMBERED = 400_000

PIECES = "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG"


#: A word of Latin letters, a run of marks and a line end are pieces of the tokenizer's splitting pattern wherever they stand like this. (No
#: apostrophe: with some letters behind it, it is a piece with them.)
LETTERS = "[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+"
MARKS = "[!-&(-/:-@\\[-`{-~]+"
PLAIN_WORD = re.compile(rf"( ?{LETTERS})({MARKS})?((?:\n{LETTERS}(?:{MARKS})?)*)")
PLAIN_PIECE = re.compile(rf"\n|{LETTERS}|{MARKS}")


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable, else the next one from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + number for number, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()
BLANK = chr(BYTE_LETTERS[ord(" ")])


def byte_letters(piece: str) -> str:
    if piece.isascii() and piece.isprintable():
        return piece.replace(" ", BLANK)
    return piece.encode().decode("latin-1").translate(BYTE_LETTERS)


class Tokens:
    """Parts of texts and their ids as little-endian 32-bit numbers.

    Memory has two generations. A part found in the older one moves to the younger; when that is full it becomes the older one, so parts
    that come up again and again stay and rare ones go.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def tokenized(self, piece: str) -> bytes:
        """The ids of what the splitting pattern leaves in one piece."""
        return array("I", [t.id for t in self.model.tokenize(byte_letters(piece))]).tobytes()

    def piece(self, word: str) -> bytes:
        """The ids of a word inside a part; as a part of its own it may be remembered."""
        return self.young.get(word) or self.old.get(word) or self.tokenized(word)

    def mark(self, piece: str) -> bytes:
        """The ids of a run of marks or a line end inside a part; short ones are few and stay remembered."""
        if len(piece) > 3:
            return self.tokenized(piece)
        if piece not in self.marks:
            self.marks[piece] = self.tokenized(piece)
        return self.marks[piece]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text without special tokens.

        Of the parts not remembered, plain words go to the tokenizer's model as the single pieces that they are, the others through the whole
        tokenizer in one call.
        """
        parts, which, ends = distinct_parts(texts)
        if len(self.young) > MOST_REMEMBERED:
            self.young, self.old = {}, self.young
        young, old, fresh = self.young, self.old, []
        found = list(map(young.get, parts))
        for at in [at for at, ids in enumerate(found) if ids is None]:
            part = parts[at]
            if (ids := old.get(part)) is None:
                if not (word := PLAIN_WORD.fullmatch(part)):
                    fresh.append(at)
                    continue
                head, marks, lines = word.groups()
                ids = self.piece(head) if head != part else self.tokenized(head)
                if marks:
                    ids += self.mark(marks)
                if lines:
                    ids += b"".join([self.piece(p) if p[0].isalpha() else self.mark(p) for p in PLAIN_PIECE.findall(lines)])
            young[part] = found[at] = ids
        for at, ids in zip(fresh, self.tokenizer.encode_batch_fast([parts[at] for at in fresh], add_special_tokens=False), strict=True):
            young[parts[at]] = found[at] = array("I", ids.ids).tobytes()
        # The ids of all parts one after the other, in one step.
        taken = pa.array(found, pa.large_binary()).take(pa.array(which))
        _valid, offsets, ids = taken.buffers()
        bounds = np.frombuffer(offsets, np.int64, len(which) + 1, 8 * taken.offset)[np.concatenate([[0], ends])].tolist()
        return [bytes(ids[a:b]) if b > a else b"" for a, b in zip(bounds, bounds[1:], strict=False)]


def distinct_parts(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct ones of the texts' `chunks`, which of them each chunk of all texts is, and how many chunks there are up to the end of each text.

    Texts that are cut at every space are cut and compared in Arrow; what stands before the first space of such a text is a part of its own.
    """
    loose = [bool(LOOSE_SPACE.search(text)) for text in texts]
    split = pc.split_pattern(pa.array(["" if odd else text for text, odd in zip(texts, loose, strict=True)], pa.large_string()), " ")
    coded = split.flatten().dictionary_encode()
    parts = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), coded.dictionary, pa.scalar(" ", pa.large_string())).to_numpy(zero_copy_only=False).tolist()
    starts = np.asarray(split.offsets, np.int64)
    which = coded.indices.to_numpy().astype(np.int64)
    # The first part of a text has no space before it; an empty one is no part.
    heads: dict[str, int] = {}
    for start in starts[:-1].tolist():
        head = parts[which[start]][1:]
        which[start] = heads.setdefault(head, len(parts) + len(heads)) if head else -1
    parts += heads
    numbers, firsts = np.diff(starts), starts[:-1]
    numbers = numbers - (which[firsts] < 0)
    which = which[which >= 0]
    ends = np.cumsum(numbers)
    if any(loose):
        number = {part: at for at, part in enumerate(parts)}
        own = np.split(which, ends[:-1])
        for at in np.flatnonzero(loose).tolist():
            own[at] = np.array([number.setdefault(part, len(number)) for part in chunks(texts[at])], np.int64)
        parts, which, ends = list(number), np.concatenate(own), np.cumsum([len(o) for o in own])
    # What only begins texts is no part with a space before it.
    used = np.zeros(len(parts), bool)
    used[which] = True
    return [part for part, some in zip(parts, used.tolist(), strict=True) if some], (np.cumsum(used) - 1)[which], ends


def cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a document: all but the first as long as the capacity."""
    first = size % capacity or min(size, capacity)
    return [(0, first)] + [(at, at + capacity) for at in range(first, size, capacity)]


def pieces(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of every document: its token ids and then `end_id`, cut only if longer than the capacity.

    (doc_id, piece, start, length, ids_crc32), and `ids` if asked for. A null or empty text has the end id only.
    """

    key = ("tokens", path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = worker_state(key, lambda: Tokens(path)), np.array([end_id], "<u4").tobytes()
        for part in text_slices(batches, holding=key):
            rows = []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), tokens.encode(part.column("text").to_pylist()), strict=True):
                ids += end
                for number, (a, b) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * a : 4 * b]
                    rows.append((doc_id, number, a, b - a, zlib.crc32(own), *((np.frombuffer(own, "<i4"),) if with_ids else ())))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
            columns = zip(*rows, strict=True) if rows else [[] for _name in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=False)], names)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, PIECES + (", ids ARRAY<INT>" if with_ids else ""))


def linear_groups(counts: np.ndarray, least: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, members): lengths from `least` on, the longest first, in groups of equal cardinality rounded up to their longest."""
    lengths = np.arange(len(counts) - 1, least - 1, -1)
    number = counts[lengths]
    lengths, number = lengths[number > 0], number[number > 0]
    if not len(lengths):
        return np.zeros(0, int), np.zeros(0, int)
    before = np.cumsum(number) - number
    group = before * groups // number.sum()
    first = np.concatenate([[True], group[1:] != group[:-1]])
    return lengths[first], np.add.reduceat(number, np.flatnonzero(first))


def best_configuration(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of the highest total price whose sizes fit into the capacity."""
    value = [np.zeros(capacity + 1)]
    choice = []
    paid = np.flatnonzero(prices > 1e-12)
    for _item in range(capacity // int(sizes.min())):
        last, now, took = value[-1], value[-1].copy(), np.full(capacity + 1, -1)
        for i in paid:
            offer = last[: capacity + 1 - sizes[i]] + prices[i]
            part, mine = now[sizes[i] :], took[sizes[i] :]
            better = offer > part + 1e-12
            part[better], mine[better] = offer[better], i
        value.append(now)
        choice.append(took)
        if not (took >= 0).any():
            break
    column, room = np.zeros(len(sizes), int), capacity
    for took in reversed(choice):
        if took[room] >= 0:
            column[took[room]] += 1
            room -= sizes[took[room]]
    return float(value[-1][capacity]), column


def configurations(sizes: np.ndarray, members: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(configuration, times): the optimum of the linear programme over configurations of few sizes, times rounded down."""
    n = len(sizes)
    if not n:
        return []
    columns = [np.eye(n, dtype=int)[i] * (capacity // sizes[i]) for i in range(n)]
    inverse = np.diag(1.0 / np.array([c[i] for i, c in enumerate(columns)]))
    need = members.astype(float)
    for number in range(MOST_ROUNDS + 1):
        if number == MOST_ROUNDS:
            log.warning("column generation stopped after %d rounds; the plan is valid, but may take more sequences", MOST_ROUNDS)
            break
        prices = np.maximum(inverse.sum(axis=0), 0)
        value, column = best_configuration(prices, sizes, capacity)
        if value <= 1 + 1e-4:
            break
        change, times = inverse @ column, inverse @ need
        steps = np.full(n, np.inf)
        grows = change > 1e-9
        steps[grows] = np.maximum(times[grows], 0) / change[grows]
        out = int(np.argmin(steps))
        if not np.isfinite(steps[out]):
            break
        columns[out] = column
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
    times = np.floor(np.maximum(inverse @ need, 0) + 1e-9).astype(int)
    used, found = np.zeros(n, int), []
    for column, number in sorted(zip(columns, times, strict=True), key=lambda x: -x[1]):
        most = np.min(((members - used)[column > 0]) // column[column > 0])
        number = int(min(number, most))
        if number > 0:
            found.append((column, number))
            used += column * number
    return found


class Space:
    """Kinds of sequences by what they hold: (lengths, times, room), found by best fit."""

    def __init__(self, capacity: int):
        self.capacity, self.by_room = capacity, defaultdict(list)

    def add(self, lengths: tuple[int, ...], times: int) -> None:
        room = self.capacity - sum(lengths)
        self.by_room[room].append((lengths, times))

    def best_fit(self, length: int, number: int) -> None:
        """Puts `number` pieces where the least room that is enough is left, one in each sequence at a time, then in new sequences."""
        while number:
            room = min((r for r, kinds in self.by_room.items() if r >= length and kinds), default=None)
            if room is None:
                fit = self.capacity // length
                if number >= fit:
                    self.add((length,) * fit, number // fit)
                    number %= fit
                if number:
                    self.add((length,) * number, 1)
                return
            lengths, times = self.by_room[room].pop()
            each = min(max(1, number // times), room // length) if number >= times else 1
            filled = min(times, number // each)
            self.add((*lengths, *(length,) * each), filled)
            if times > filled:
                self.by_room[room].append((lengths, times - filled))
            number -= filled * each

    def kinds(self) -> list[tuple[tuple[int, ...], int]]:
        return [kind for room in sorted(self.by_room) for kind in self.by_room[room]]


def substitute(columns: list[tuple[np.ndarray, int]], sizes: np.ndarray, left: np.ndarray, space: Space, small: int) -> None:
    """Fills the places of the configurations with actual lengths of their groups, the longest first, and takes them from `left`."""
    bounds = np.append(sizes, small)
    for column, times in columns:
        streams = []
        for g in np.flatnonzero(column):
            for one in range(column[g]):
                stream, want = [], times
                # Every second place of a group takes its shortest members, so that sums are even.
                lengths = range(sizes[g], bounds[g + 1], -1) if one % 2 == 0 else range(bounds[g + 1] + 1, sizes[g] + 1)
                for length in lengths:
                    take = min(want, int(left[length]))
                    if take:
                        stream.append([length, take])
                        left[length] -= take
                        want -= take
                    if not want:
                        break
                streams.append(stream)
        at = [0] * len(streams)
        while times:
            run = min(stream[i][1] for stream, i in zip(streams, at, strict=True))
            space.add(tuple(stream[i][0] for stream, i in zip(streams, at, strict=True)), run)
            for number, stream in enumerate(streams):
                stream[at[number]][1] -= run
                at[number] += stream[at[number]][1] == 0
            times -= run


def packing_plan(
    counts: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS, shares: tuple[int, ...] = LARGE_SHARES
) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences) for `counts[length]` pieces of each length up to the capacity.

    The grouping scheme runs once for each bound of large lengths; the plan with the fewest sequences is returned.
    """
    plans = [_plan(counts, capacity, groups, max(1, capacity // share)) for share in shares]
    return min(plans, key=lambda plan: sum(times for _lengths, times in plan))


def _plan(counts: np.ndarray, capacity: int, groups: int, small: int) -> list[tuple[tuple[int, ...], int]]:
    left = np.array(counts, np.int64)
    space = Space(capacity)
    if left[capacity]:
        space.add((capacity,), int(left[capacity]))
        left[capacity] = 0
    sizes, members = linear_groups(left, small + 1, groups)
    substitute(configurations(sizes, members, capacity), sizes, left, space, small)
    for length in range(capacity, 0, -1):
        if left[length]:
            space.best_fit(length, int(left[length]))
    return space.kinds()


def slots(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, sequence of that rank, offset), sorted: where the pieces of a length go by their rank."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def place(cut_pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """The rows of `pieces` with `sequence_id` and `offset`.

    Only the number of pieces of each length reaches the driver. Pieces of a length are alike, so each takes the place of
    its rank among them; ranks are counted in as many parts as there are shuffle partitions, so a frequent length does not meet in one task.
    """
    spark = cut_pieces.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    numbers = kept(dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("number")))
    counts = np.zeros(capacity + 1, np.int64)
    for length, number in numbers.groupBy("length").agg(F.sum("number")).collect():  # at most `capacity` rows
        counts[length] = number
    table = slots(packing_plan(counts, capacity, groups))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = numbers.select("length", "part", F.coalesce(F.sum("number").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("within", rank).join(firsts, ["length", "part"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("within")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.searchsorted(table[:, 0], np.arange(capacity + 2))
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                mine, (a, b) = lengths == length, bounds[length : length + 2]
                at[mine] = a + np.searchsorted(table[a:b, 1], ranks[mine], side="right") - 1
            sequence = table[at, 2] + ranks - table[at, 1] if len(at) else at
            offset = table[at, 3] if len(at) else at
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, PIECES + ", sequence_id LONG, offset LONG")


def pack(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece of every document and its place.

    Sequences hold at most `capacity` tokens and are filled without gaps. Null and empty texts are packed as their end id alone, repeated rows and
    rows with a null id like any others; an empty table gives an empty result. `path` names a tokenizer file that every executor has.
    """
    return place(kept(pieces(docs, path, end_id, capacity, id_col, text_col)), capacity)


def sequences(docs: DataFrame, placed: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves; ids of documents must be unique. A sequence is bounded by its capacity."""
    filled = pieces(docs, path, end_id, capacity, with_ids=True).join(placed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return filled.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
