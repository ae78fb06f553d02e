"""Repeated passages: confirmed by hashes, then located in all documents by sharded Aho-Corasick automata.

A window is `WINDOW` consecutive words. The steps, none of which holds more than a part of a document group in one task:

1. Every text is winnowed: of the phrases in each window the one with the least hash is its anchor. Equal windows have equal anchors
   at equal places, so only windows whose anchor occurs in several documents can recur. Anchors are counted with map-side sums.
2. An anchor whose surroundings are the same in all its documents settles all windows around it: the smallest document has
   them first. Windows around other anchors are counted one by one, by their hash.
3. Of the windows that a smaller document has, enough to cover the same words become passages; their text is taken from that
   smaller document.
4. Each shard of documents compiles an automaton of the passages confirmed for it and streams its documents through it. A word is removed
   where the automaton finds a passage of a smaller document, so a colliding hash never removes anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_sums, kept, text_slices, utf8

WINDOW = 50
#: Words in the phrases whose hashes are compared; a window holds WINDOW - PHRASE + 1 of them.
PHRASE = 15
SURROUND = WINDOW - PHRASE
#: Bytes of documents in a shard, and of passages in one automaton.
SHARD_BYTES = 1_000_000

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
BASE, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def mixed(values: np.ndarray) -> np.ndarray:
    """The bits of 64-bit numbers spread over all of them."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(0, size - 1), base, np.uint64)]))[:size]


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, as far as they were needed."""

    def __init__(self, base: int):
        self.base, self.inverse_base = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.zeros(0, np.uint64)

    def reach(self, size: int) -> None:
        if len(self.up) < size:
            self.up, self.down = powers(self.base, size), powers(self.inverse_base, size)


class Hasher:
    """Hashes of words, and of runs of words by differences of prefix sums."""

    def __init__(self) -> None:
        self.bytes, self.words = Powers(BASE), Powers(STEP)

    def word_hashes(self, text: bytes) -> np.ndarray:
        """One hash per word; a long text is taken in stretches that end at white space."""
        found, at = [], 0
        while at < len(text):
            end = at + SHARD_BYTES
            while end < len(text) and text[end] not in b"\t\n\v\f\r ":
                end += 1
            found.append(self._stretch(text[at:end]))
            at = end
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    def _stretch(self, text: bytes) -> np.ndarray:
        data = np.frombuffer(text, np.uint8)
        space = np.concatenate([[True], SPACES[data], [True]])
        border = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = border[::2], border[1::2]
        self.bytes.reach(len(data) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.bytes.up[: len(data)])])
        return mixed((sums[ends] - sums[starts]) * self.bytes.down[starts])

    def prefix_sums(self, hashes: np.ndarray) -> np.ndarray:
        self.words.reach(len(hashes) + 1)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self.words.up[: len(hashes)])])

    def runs(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((sums[ends] - sums[starts]) * self.words.down[starts] + (ends - starts).astype(np.uint64))


def anchors(phrases: np.ndarray) -> np.ndarray:
    """For each window the place of its phrase with the least hash, the rightmost of equal ones."""
    span, least, place = 1, phrases, np.arange(len(phrases))
    width = SURROUND + 1
    while span < width:
        step = min(span, width - span)
        right = least[step:] <= least[: len(least) - step]
        place = np.where(right, place[step:], place[: len(place) - step])
        least = np.where(right, least[step:], least[: len(least) - step])
        span += step
    return place


class Winnowed:
    """The phrases, anchors and window hashes of one text; empty for a text shorter than a window."""

    def __init__(self, text: bytes, hasher: Hasher):
        hashes = hasher.word_hashes(text)
        self.size, self.hasher = len(hashes), hasher
        if self.size < WINDOW:
            self.phrases, self.of_window, self.anchors = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            return
        self.sums = hasher.prefix_sums(hashes)
        starts = np.arange(self.size - PHRASE + 1)
        phrases = hasher.runs(self.sums, starts, starts + PHRASE)
        self.of_window = anchors(phrases)
        self.anchors = np.flatnonzero(np.bincount(self.of_window, minlength=len(phrases)))
        self.phrases = phrases.view(np.int64)

    def surroundings(self) -> np.ndarray:
        """For each anchor the hash of all words of the windows it can stand in, cut at the ends of the text."""
        left, right = np.minimum(self.anchors, SURROUND), np.minimum(self.size - self.anchors, WINDOW)
        own = self.hasher.runs(self.sums, self.anchors - left, self.anchors + right)
        return mixed(own + left.astype(np.uint64) * np.uint64(WINDOW + 1) + right.astype(np.uint64)).view(np.int64)

    def windows(self, starts: np.ndarray) -> np.ndarray:
        return self.hasher.runs(self.sums, starts, starts + WINDOW).view(np.int64)


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, schema, strict=True)], schema=schema)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def anchor_rows(texts: DataFrame) -> DataFrame:
    """(h, doc_id, q, around): the anchors of every text with an id."""
    schema = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("q", pa.int32()), ("around", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for part in text_slices(batches):
            h, ids, q, around = [], [], [], []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part.column("text")), strict=True):
                found = Winnowed(text, hasher)
                if len(found.anchors):
                    h.append(found.phrases[found.anchors])
                    ids.append(np.full(len(found.anchors), doc_id, np.int64))
                    q.append(found.anchors)
                    around.append(found.surroundings())
            yield _batch(schema, _joined(h), _joined(ids), _joined(q).astype(np.int32), _joined(around))

    return texts.where(F.col("doc_id").isNotNull()).mapInArrow(run, "h LONG, doc_id LONG, q INT, around LONG")


def recurring_anchors(texts: DataFrame) -> DataFrame:
    """(doc_id, found): for each document its anchors that several documents have, unless they settle that it has their windows first.

    `found` holds (h, first, q, same): the smallest document with the anchor, its place there, and whether its surroundings are the
    same everywhere.
    """
    rows = anchor_rows(texts)
    shared = (
        rows.groupBy("h")
        .agg(
            F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.min_by("q", "doc_id").alias("q"),
            (F.min("around") == F.max("around")).alias("same"),
        )
        .where(F.col("first") < F.col("last"))
        .drop("last")
    )
    useful = join_sums(rows.select("h", "doc_id"), shared, "h").where(~F.col("same") | (F.col("doc_id") > F.col("first")))
    return useful.groupBy("doc_id").agg(F.collect_list(F.struct("h", "first", "q", "same")).alias("found"))


def _with(texts: DataFrame, other: DataFrame, column: str) -> DataFrame:
    """Every text with a column of another table by doc_id; the texts of rows without it are not passed on.

    The side of the texts is the same in each such join of a query, so their shuffle happens once.
    """
    joined = texts.join(other.hint("shuffle_hash"), "doc_id", "left")
    return joined.select("doc_id", F.when(F.col(column).isNotNull(), F.col("text")).alias("text"), column)


def recurring_windows(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """(settled, w, doc_id, p, first, at): windows that may recur.

    A settled one starts at word `p` of doc_id and also at word `at` of the smaller document `first`; of others `w` is the hash, and `first`
    tells whether a smaller document has the anchor.
    """
    schema = pa.schema([("settled", pa.bool_()), ("w", pa.int64()), ("doc_id", pa.int64()), ("p", pa.int32()), ("first", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for part in text_slices(batch.filter(pc.is_valid(batch.column("text"))) for batch in batches):
            out = [[] for _column in schema]
            lists = part.column("found")
            flat, ends = lists.flatten(), np.cumsum([0, *lists.value_lengths().to_pylist()])
            h, first, q, same = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("h", "first", "q", "same"))
            for number, (doc_id, text) in enumerate(zip(part.column("doc_id").to_pylist(), utf8(part.column("text")), strict=True)):
                mine = slice(ends[number], ends[number + 1])
                order = np.argsort(h[mine], kind="stable")
                known = h[mine][order]
                found = Winnowed(text, hasher)
                anchor = found.phrases[found.of_window]
                slot = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
                starts = np.flatnonzero(known[slot] == anchor)
                row = order[slot[starts]] + mine.start
                settled = same[row].astype(bool)
                w = np.where(settled, 0, found.windows(starts))
                at = np.where(settled, q[row] + starts - found.of_window[starts], -1)
                chosen = np.ones(len(starts), bool)
                chosen[settled] = _cover(starts[settled], first[row][settled], at[settled])
                for column, values in zip(out, (settled, w, np.full(len(starts), doc_id), starts, first[row], at), strict=True):
                    column.append(values[chosen])
            columns = [_joined(c) for c in out]
            yield _batch(schema, columns[0].astype(bool), columns[1], columns[2], columns[3].astype(np.int32), columns[4], columns[5].astype(np.int32))

    return _with(texts, shared, "found").mapInArrow(run, "settled BOOLEAN, w LONG, doc_id LONG, p INT, first LONG, at INT")


def _cover(starts: np.ndarray, first: np.ndarray, at: np.ndarray, doc: np.ndarray | None = None) -> np.ndarray:
    """Which of some windows, in order of place, to keep so that they cover the same words: of a run every WINDOW-th and its last."""
    if not len(starts):
        return np.zeros(0, bool)
    breaks = np.diff(starts) != 1
    if doc is not None:
        breaks |= np.diff(doc) != 0
    head = np.flatnonzero(np.concatenate([[True], breaks]))
    run = np.diff(np.append(head, len(starts)))
    within = np.arange(len(starts)) - np.repeat(head, run)
    return (within % WINDOW == 0) | np.concatenate([breaks, [True]])


def passages(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """(doc_id, first, at): windows of smaller documents that cover what recurs in doc_id."""
    windows = recurring_windows(texts, shared)
    open_ones = windows.where(~F.col("settled"))
    counted = (
        open_ones.groupBy("w")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.min_by("p", "doc_id").alias("place"))
        .where(F.col("least") < F.col("most"))
        .select("w", "least", "place")
    )
    later = open_ones.where(F.col("doc_id") > F.col("first")).select("w", "doc_id", "p")
    again = join_sums(later, counted, "w").where(F.col("doc_id") > F.col("least"))

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, p = batch.column("doc_id").to_numpy(), batch.column("p").to_numpy()
            first, at = batch.column("least").to_numpy(), batch.column("place").to_numpy()
            chosen = _cover(p, first, at, doc)
            yield pa.RecordBatch.from_arrays([pa.array(x[chosen]) for x in (doc, first, at)], ["doc_id", "first", "at"])

    ordered = again.repartition("doc_id").sortWithinPartitions("doc_id", "p").select("doc_id", "p", "least", "place")
    covering = ordered.mapInArrow(cover, "doc_id LONG, first LONG, at INT")
    settled = windows.where("settled").select("doc_id", "first", "at")
    return settled.unionByName(covering)


def passage_texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(first, at, passage): the words of each wanted window, joined by one space."""
    schema = pa.schema([("first", pa.int64()), ("at", pa.int32()), ("passage", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batch.filter(pc.is_valid(batch.column("text"))) for batch in batches):
            ids, places, found = [], [], []
            for doc_id, text, starts in zip(part.column("doc_id").to_pylist(), utf8(part.column("text")), part.column("places").to_pylist(), strict=True):
                words = text.split()
                ids += [doc_id] * len(starts)
                places += starts
                found += [b" ".join(words[at : at + WINDOW]).decode() for at in starts]
            yield _batch(schema, ids, places, found)

    by_document = wanted.groupBy(F.col("first").alias("doc_id")).agg(F.collect_set("at").alias("places"))
    return _with(texts, by_document, "places").mapInArrow(run, "first LONG, at INT, passage STRING")


def automata(found: dict[str, int]) -> Iterator[ahocorasick.Automaton]:
    """Automata of passages, each of a bounded number of characters; the value is the passage's smallest document."""
    words, size = ahocorasick.Automaton(), 0
    for passage, first in found.items():
        words.add_word(f" {passage} ", (first, len(passage)))
        size += len(passage)
        if size >= SHARD_BYTES:
            words.make_automaton()
            yield words
            words, size = ahocorasick.Automaton(), 0
    if size:
        words.make_automaton()
        yield words


def covered(words: list[str], doc_id: int, shard: list[ahocorasick.Automaton]) -> np.ndarray:
    """Which words of a document passages of smaller documents cover."""
    text = f" {' '.join(words)} "
    ends = np.cumsum([0, *(len(w) + 1 for w in words)])
    marks = np.zeros(len(words) + 1, np.int64)
    for automaton in shard:
        hits = [(last, length) for last, (first, length) in automaton.iter(text) if first < doc_id]
        if hits:
            last, length = np.array(hits).T
            np.add.at(marks, np.searchsorted(ends, last - length - 1), 1)
            np.add.at(marks, np.searchsorted(ends, last), -1)
    return np.cumsum(marks[:-1]) > 0


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), keep_spacing: bool = False
) -> DataFrame:
    """(doc_id, kept, n_words, n_removed, removed) for every row, and a struct `rest` of the columns `carry` if any are named.

    Words end at ASCII white space. A word is removed if it is in a window whose words also stand in a document with a smaller id, in
    the input as it is. `kept` joins the other words by one space, or with `keep_spacing` is the text itself where nothing is removed; `removed` holds (start, end) in words. A null or empty text has
    no words; a row with a null id keeps everything and takes nothing from others; rows with the same id do not remove from each
    other; an empty table gives an empty result.
    """
    rest = [F.struct(*[docs[c] for c in carry]).alias("rest")] if carry else []
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), *rest)
    shared = kept(recurring_anchors(texts))
    wanted = passages(texts, shared)
    found = wanted.join(passage_texts(texts, wanted), ["first", "at"])
    by_document = found.groupBy("doc_id").agg(F.collect_list(F.struct("passage", "first")).alias("passages"))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("kept", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
        ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, SHARD_BYTES):
            lists = part.column("passages").to_pylist()
            least: dict[str, int] = {}
            for passage in (x for own in lists if own for x in own):
                least[passage["passage"]] = min(passage["first"], least.get(passage["passage"], passage["first"]))
            shard = list(automata(least))
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part.column("text")), strict=True):
                words = text.split()
                gone = np.zeros(len(words), bool)
                if shard and doc_id is not None:
                    strings = b" ".join(words).decode().split(" ") if words else []
                    gone = covered(strings, doc_id, shard)
                border = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                if gone.any():
                    left = b" ".join(words[i] for i in np.flatnonzero(~gone))
                else:
                    left = text if keep_spacing else b" ".join(words)
                spans = [{"start": a, "end": b} for a, b in border.reshape(-1, 2).tolist()]
                rows.append((doc_id, left.decode(), len(words), int(gone.sum()), spans))
            out = _batch(schema, *(list(zip(*rows, strict=True)) if rows else [[] for _field in schema]))
            yield out.append_column("rest", part.column("rest")) if carry else out

    columns = "doc_id LONG, kept STRING, n_words LONG, n_removed LONG, removed ARRAY<STRUCT<start: LONG, end: LONG>>"
    if carry:
        columns += ", rest " + texts.schema["rest"].dataType.simpleString()
    return texts.join(by_document.hint("shuffle_hash"), "doc_id", "left").mapInArrow(run, columns)
