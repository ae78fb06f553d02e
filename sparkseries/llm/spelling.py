"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols. Every word of the vocabulary yields the full one-edit neighbourhood of its reduced form, which is
joined with the reduced vocabulary; what meets there is verified on the original strings. Words that differ by one edit have reduced
forms that differ by one edit or none, so no pair is lost.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, join_sums, kept, text_slices, utf8

LEAST_LENGTH = 5
LEAST_TIMES = 3
SYMBOLS = 8
#: Bits of the map of reduced words, whatever the size of the vocabulary: 16 MB. Spark's bitmap functions hold 2^15 bits a row.
MAP_BITS = 27
ROW_BITS = 15
#: Variants that are made at once, and distinct words that a task counts before it passes them on.
AT_ONCE = 1 << 20
COUNTED = 200_000
MOST_STEPS = 64

WORDS = re.compile("[a-zÀ-ÿ]+")
#: Base of the polynomials over symbols, modulo 2^64.
BASE = 0x9E3779B97F4A7C15
WHOLE = (1 << 64) - 1


def words_of(text: bytes, doc_id: int | None, drop_every: int | None) -> Counter:
    """How often each word occurs in a text: maximal runs of letters, only A-Z lower-cased.

    With `drop_every`, a run whose crc32 of `<doc_id>:<run>` is a multiple of it loses the code point at that crc32 modulo its length.
    """
    runs = Counter(WORDS.findall(text.lower().decode("utf-8", "replace")))
    if drop_every is None:
        return runs
    before, found = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), Counter()
    for run, times in runs.items():
        h = zlib.crc32(run.encode(), before)
        if h % drop_every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        found[run] += times
    return found


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES,
    drop_every: int | None = None,
) -> DataFrame:
    """(word, n): the words of all whole texts with at least so many code points and occurrences. Null texts have no words.

    Tasks add up what they read before anything is shuffled, so a frequent word is a row for each of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        total: Counter = Counter()
        for part in text_slices(batches):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part.column("text")), strict=True):
                for word, times in words_of(text, doc_id, drop_every).items():
                    if len(word) >= least_length:
                        total[word] += times
            if len(total) >= COUNTED:
                yield rows()
                total = Counter()
        yield rows()

    found = id_and_text(docs, id_col, text_col).mapInArrow(run, "word STRING, n LONG")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_times)


def symbols_of(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """The symbols 1, 2, … of words of one length, a row for each word."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "replace"), "<u4").reshape(len(words), -1)
    return ((codes * np.uint32(0x9E3779B1)) >> np.uint32(16)) % np.uint32(symbols) + np.uint32(1)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spreads polynomials over all 64 bits."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class Reduced:
    """Polynomials of reduced words of one length: the whole word's, and those of its one-edit neighbourhood a stretch of places at a time."""

    def __init__(self, words: list[str], symbols: int = SYMBOLS):
        self.symbols, self.codes = symbols, symbols_of(words, symbols).astype(np.uint64)
        number, self.length = self.codes.shape
        # The value of the first i symbols, and that of the symbols from i on, which stand before nothing.
        self.heads = np.zeros((number, self.length + 1), np.uint64)
        self.tails = np.zeros((number, self.length + 1), np.uint64)
        powers, base = [1], np.uint64(BASE)
        for _i in range(self.length + 1):
            powers.append(powers[-1] * BASE & WHOLE)
        self.powers = np.array(powers, np.uint64)
        for i in range(self.length):
            self.heads[:, i + 1] = self.heads[:, i] * base + self.codes[:, i]
            back = self.length - 1 - i
            self.tails[:, back] = self.codes[:, back] * self.powers[i] + self.tails[:, back + 1]

    def keys(self) -> np.ndarray:
        return _mixed(self.heads[:, -1])

    def stretches(self) -> Iterator[np.ndarray]:
        """The keys of all neighbours, a row for each word; a key may stand more than once in a row."""
        number, symbols = self.heads.shape[0], np.arange(1, self.symbols + 1, dtype=np.uint64)
        yield self.keys()[:, None]
        step = max(1, AT_ONCE // max(1, number * (2 * self.symbols + 1)))
        for at in range(0, self.length + 1, step):
            places = np.arange(at, min(at + step, self.length + 1))
            inner = places[places < self.length]
            heads, tails = self.heads[:, inner], self.tails[:, inner + 1]
            left = self.length - 1 - inner
            gone = heads * self.powers[left] + tails
            other = ((heads * np.uint64(BASE))[:, :, None] + symbols) * self.powers[left][None, :, None] + tails[:, :, None]
            # A replacement by the same symbol is the word itself, which has been given.
            left = self.length - places
            more = ((self.heads[:, places] * np.uint64(BASE))[:, :, None] + symbols) * self.powers[left][None, :, None] + self.tails[:, places][:, :, None]
            yield _mixed(np.concatenate([gone, other.reshape(number, -1), more.reshape(number, -1)], axis=1))


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    """The numbers of words of the same length, as many at once as keep their neighbourhoods small."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        mine = np.flatnonzero(lengths == length)
        each = max(1, AT_ONCE // (20 * (length + 1)))
        for at in range(0, len(mine), each):
            yield mine[at : at + each]


def reduced_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(id, key): the key of each word's reduced form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("word").to_pylist()
            keys = np.zeros(len(texts), np.uint64)
            for mine in _by_length(texts):
                keys[mine] = Reduced([texts[i] for i in mine.tolist()], symbols).keys()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(keys.view(np.int64))], ["id", "key"])

    return words.select("id", "word").mapInArrow(run, "id LONG, key LONG")


def reduced_map(reduced: DataFrame, bits: int = MAP_BITS) -> np.ndarray:
    """A map with a bit set for each key of the reduced vocabulary (its lowest `bits` bits); 2^bits / 8 bytes, however many words there are."""
    place = F.col("key").bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    rows = reduced.select(F.shiftright(place, ROW_BITS).alias("row"), place.bitwiseAND(F.lit((1 << ROW_BITS) - 1).cast("long")).alias("bit"))
    found = np.zeros((1 << max(0, bits - ROW_BITS), 1 << (ROW_BITS - 3)), np.uint8)
    for row in rows.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        found[row["row"]] = np.frombuffer(row["bits"], np.uint8)
    return found.reshape(-1)


def neighbourhoods(words: DataFrame, known: np.ndarray, symbols: int = SYMBOLS) -> DataFrame:
    """(id, key): the one-edit neighbourhood of each word's reduced form, itself included, without the keys that the map tells to be no word's."""
    last = np.uint64(len(known) * 8 - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("word").to_pylist(), batch.column("id").to_numpy()
            for mine in _by_length(texts):
                found_rows, found_keys = [], []
                for keys in Reduced([texts[i] for i in mine.tolist()], symbols).stretches():
                    place = keys & last
                    row, column = np.nonzero((known[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1)
                    found_rows.append(row)
                    found_keys.append(keys[row, column])
                rows, keys = np.concatenate(found_rows), np.concatenate(found_keys)
                order = np.lexsort((keys, rows))
                rows, keys = rows[order], keys[order]
                first = np.ones(len(rows), bool)
                first[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(ids[mine[rows[first]]]), pa.array(keys[first].view(np.int64))], ["id", "key"])

    return words.select("id", "word").mapInArrow(run, "id LONG, key LONG")


def near_words(words: DataFrame, symbols: int = SYMBOLS, bits: int = MAP_BITS) -> DataFrame:
    """(id, word, near_id, near_word, near_n): the ordered pairs of words of `words(id, word, n)` that exactly one edit parts.

    An edit inserts, deletes or replaces one code point. A pair meets once, at the key of the near word's reduced form. Ids travel instead of
    strings until a pair has met.
    """
    reduced = kept(reduced_words(words, symbols))
    met = neighbourhoods(words, reduced_map(reduced, bits), symbols).join(reduced.select(F.col("id").alias("near_id"), "key"), "key")
    met = met.where(F.col("id") != F.col("near_id")).select("id", "near_id")
    left = met.join(words.select("id", "word"), "id")
    right = words.select(F.col("id").alias("near_id"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    pairs = left.join(right, "near_id").where(F.abs(F.length("word") - F.length("near_word")) <= 1)
    return pairs.where(F.levenshtein("word", "near_word", 1) == 1).select("id", "word", "near_id", "near_word", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(id, root_id) for `forms(id, form_id)`: the end of the chain of forms from each id that has one.

    Each step doubles the distance; forms are more frequent by a factor, so chains are short and have no cycle.
    """
    reached = kept(forms.select("id", F.col("form_id").alias("root_id")))
    for _step in range(MOST_STEPS):
        onward = reached.select(F.col("id").alias("root_id"), F.col("root_id").alias("next_id"))
        ends = reached.join(forms.select(F.col("id").alias("root_id")), "root_id", "left_anti")
        moved = kept(join_sums(reached, onward, "root_id").select("id", F.col("next_id").alias("root_id")))
        if moved.isEmpty():
            return reached
        reached = kept(ends.select("id", "root_id").unionByName(moved))
    raise RuntimeError(f"forms of words did not end in {MOST_STEPS} steps")


def group_spellings(words: DataFrame, least_ratio: int = 2, symbols: int = SYMBOLS, bits: int = MAP_BITS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of `words(word, n)`, whose words are distinct.

    The form of a word is its most frequent near word, ties to the first in code-point order, if that is at least `least_ratio` (2 or more) times
    as frequent as the word; else it and `form_n` are null. The root is the end of the chain of forms, the word itself if it has none.
    """
    if least_ratio < 2:
        raise ValueError("with a ratio below 2 forms could go in circles")
    words = kept(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near_word").alias("word"), F.col("near_id").alias("id")))
    near = kept(near_words(words, symbols, bits).groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")))
    told = words.join(near, "id", "left")
    has_form = F.coalesce(-F.col("best.less") >= least_ratio * F.col("n"), F.lit(False))
    told = told.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has_form, F.col("best.word")).alias("form"),
        F.when(has_form, -F.col("best.less")).alias("form_n"), F.when(has_form, F.col("best.id")).alias("form_id"),
    )
    told = kept(told)
    ends = roots(told.where(F.col("form_id").isNotNull()).select("id", "form_id"))
    named = join_sums(ends, words.select(F.col("id").alias("root_id"), F.col("word").alias("root")), "root_id")
    return told.join(named.select("id", "root"), "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES,
    drop_every: int | None = None, symbols: int = SYMBOLS,
) -> DataFrame:
    """`group_spellings` of the words of all whole texts, one row for each word.

    Null and empty texts have no words, a null id counts as an empty one where `drop_every` needs it, repeated rows count as often as they
    occur, other columns are not looked at, an empty table gives an empty result.
    """
    return group_spellings(word_counts(docs, id_col, text_col, least_length, least_times, drop_every), symbols=symbols)
