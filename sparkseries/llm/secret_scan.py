"""Secret scans: an Aho-Corasick keyword prefilter, anchored expressions near its hits only, then embedded checksums."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, text_slices

# The kinds in the order in which their spans are listed, and the words and prefixes that open them.
KINDS = ("assign", "access", "hex", "checked")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS_PREFIX = "AKIA"
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

SPANS = "array<struct<kind:string,start:long,end:long>>"


def automaton() -> ahocorasick.Automaton:
    """All keywords in lower case; the value of each is its kind and length."""
    words = ahocorasick.Automaton()
    for kind, found in (("assign", ASSIGN_WORDS), ("access", (ACCESS_PREFIX.lower(),)), ("checked", CHECKED_PREFIXES)):
        for word in found:
            words.add_word(word, (kind, len(word)))
    words.make_automaton()
    return words


def lowered(text: str) -> str:
    """The text in lower case with every code point at its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c.isascii() else c for c in text)


def checksum_holds(body: str, check: str) -> bool:
    """Whether the last six characters of a token are the base-62 CRC-32 of the thirty before them."""
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0") == check


def hex_runs(text: str) -> Iterator[tuple[int, int]]:
    """Maximal runs of 24 or more lower-case hex digits.

    Such a run covers a multiple of 24, so only the characters there are looked at; around a hex digit the run is
    matched in full.
    """
    done = 0
    for hit in HEX.finditer(text[::LEAST_HEX]):
        for probe in range(hit.start(), hit.end()):
            at = probe * LEAST_HEX
            if at < done:
                continue
            start, floor = at, max(done, at - LEAST_HEX)
            while start > floor and text[start - 1] in "0123456789abcdef":
                start -= 1
            end = HEX.match(text, at).end()
            done = end
            if end - start >= LEAST_HEX:
                yield start, end


def scan(text: str, words: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret in a text, by start and then kind; places count code points, the end is exclusive.

    Per kind, matches are the leftmost ones that do not overlap; a match that is too short or has a wrong checksum is dropped but
    still takes up its place.
    """
    spans, done = [], dict.fromkeys(KINDS, 0)
    for last, (kind, length) in words.iter(lowered(text)):
        start = last + 1 - length
        if start < done[kind]:
            continue
        match = {"assign": ASSIGN, "access": ACCESS, "checked": CHECKED}[kind].match(text, start)
        if not match:
            continue
        done[kind] = match.end()
        if kind == "assign":
            good = len(match[2]) >= LEAST_ASSIGN
        elif kind == "access":
            good = len(match[0]) >= LEAST_ACCESS
        else:
            good = checksum_holds(match[1], match[2])
        if good:
            spans.append((kind, start, match.end()))
    spans.extend(("hex", start, end) for start, end in hex_runs(text))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str, spans: list[tuple[str, int, int]], mask: str) -> str:
    """The text with each stretch that spans cover replaced by `mask`."""
    parts, at = [], 0
    for _kind, start, end in spans:
        if end <= at:
            continue
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) for every row; `spans` is an array of (kind, start, end).

    Kinds: `assign`, a password-like word with a value; `access`, a cloud access key id; `hex`, a long hex string; `checked`, a token of a
    known prefix whose embedded CRC-32 holds. A null or empty text has no spans. Rows repeat as they do in the input, a null id stays
    null, and an empty table gives an empty result. A text is scanned whole in time that grows with its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for part in text_slices(batches):
            spans = [
                [{"kind": k, "start": a, "end": b} for k, a, b in scan(text, words)] for text in part.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id LONG, spans {SPANS}")


def redact_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every secret in the text replaced by `mask`; a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [t if t is None else redact(t, scan(t, words), mask) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, text_col, pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def spans_text(spans, kinds: tuple[str, ...] = KINDS):
    """Spans of some kinds as one text: kind:start:end, joined by commas."""
    wanted = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(wanted, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
