"""SimHash near-duplicates, found through an inverted index on byte positions with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_and_text, kept, text_slices, utf8
from .components import connected_components

BYTES = 8
HASH_SEED = 42
#: Shingles that are counted at once.
CHUNK = 1 << 15
#: The most fingerprints of a list whose pairs are tallied. What stands in a longer list is looked up in a finer index.
LONGEST_TALLIED = 256


def simhash(text: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a UTF-8 text: each bit is 1 where over half of the shingle hashes have it.

    A-Z are lower-cased, words end at ASCII white space, shingles are `shingle` words joined by a space. A text with
    fewer words is one shingle, a text without words has the fingerprint 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every text, as a signed 64-bit number. Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            values = np.array([simhash(text, shingle) for text in utf8(part.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id LONG, fp LONG")


def blocks_of_bytes(most_bits: int) -> list[list[int]]:
    """The byte positions in most_bits + 2 blocks of about the same size: fingerprints so near agree in two whole blocks at least."""
    number = most_bits + 2
    if not 0 <= most_bits <= BYTES - 2:
        raise ValueError(f"at most {BYTES - 2} differing bits can be searched for")
    return [list(range(n * BYTES // number, (n + 1) * BYTES // number)) for n in range(number)]


def _keys(prints: DataFrame, choices: list[tuple[int, ...]]) -> DataFrame:
    """(positions, shared, fp): each fingerprint under the bytes it has at each choice of positions."""
    masks = [sum(0xFF << (8 * p) for p in chosen) for chosen in choices]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return prints.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("positions", "shared"), "fp")


def postings(prints: DataFrame, most_bits: int) -> DataFrame:
    """(positions, shared, fp): the inverted index of distinct fingerprints, a list for the bytes found at each pair of blocks."""
    return _keys(prints, [(*a, *b) for a, b in combinations(blocks_of_bytes(most_bits), 2)])


def fine_postings(prints: DataFrame, most_bits: int) -> DataFrame:
    """(positions, shared, fp): a list for the bytes at each choice of all but `most_bits` positions, of 256 ** most_bits fingerprints at most."""
    return _keys(prints, list(combinations(range(BYTES), BYTES - most_bits)))


def _lists(index: DataFrame) -> DataFrame:
    return index.groupBy("positions", "shared").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")


def tallied(values: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs of a list, by place, that are near, and how many the tally has turned down.

    For each pair that meets in the list the positional bytes that it shares are counted. Pairs below the minimum that near fingerprints
    are sure to share are turned down, the others verified bit by bit.
    """
    left, right = np.triu_indices(len(values), 1)
    differing = values[left] ^ values[right]
    shared = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    enough = shared >= BYTES - most_bits
    turned_down = int(len(enough) - enough.sum())
    enough[enough] = np.bitwise_count(differing[enough]) <= most_bits
    return left[enough], right[enough], turned_down


def looked_up(values: np.ndarray, most_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a sorted list that are near: each fingerprint is looked up with up to `most_bits` of the bits changed in which the list differs."""
    free = int(np.bitwise_or.reduce(values ^ values[0]))
    places = [bit for bit in range(64) if free >> bit & 1]
    pairs = []
    for bits in range(1, most_bits + 1):
        for chosen in combinations(places, bits):
            other = values ^ np.uint64(sum(1 << bit for bit in chosen))
            at = np.minimum(np.searchsorted(values, other), len(values) - 1)
            hit = np.flatnonzero((values[at] == other) & (values < other))
            if len(hit):
                pairs.append((hit, at[hit]))
    return pairs


def near_links(fps: np.ndarray, most_bits: int, by_tally: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Links that join exactly the fingerprints of a list that chains of at most `most_bits` differing bits join, fewer than it has members."""
    values = np.sort(fps.view(np.uint64))
    pairs = [tallied(values, most_bits)[:2]] if by_tally else looked_up(values, most_bits)
    root = np.arange(len(values))
    changed = bool(pairs)
    while changed:
        before = root.copy()
        for left, right in pairs:
            low = np.minimum(root[left], root[right])
            np.minimum.at(root, left, low)
            np.minimum.at(root, right, low)
        root = root[root]
        changed = not np.array_equal(before, root)
    linked = np.flatnonzero(root != np.arange(len(root)))
    return values[linked].view(np.int64), values[root[linked]].view(np.int64)


def _links_of_lists(lists: DataFrame, most_bits: int, by_tally: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("fps")
            values = held.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(held.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            found, start = [], 0
            for end in ends:
                found.append(near_links(values[start:end], most_bits, by_tally))
                start = end
            a = np.concatenate([x for x, _y in found]) if found else np.empty(0, np.int64)
            b = np.concatenate([y for _x, y in found]) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return lists.mapInArrow(run, "a LONG, b LONG")


def links(prints: DataFrame, most_bits: int = 2, longest: int = LONGEST_TALLIED) -> DataFrame:
    """(a, b): links between distinct fingerprints, with the same connected components as all pairs within `most_bits` bits.

    Two near fingerprints meet in a list of two whole blocks of bytes. Lists are counted first; the pairs of a list are tallied if it has at most
    `longest`. Members of longer lists, whose pairs grow with the square, go to the finer index, whose lists have a bound, and are looked up there.
    """
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Spread by number, as the few bytes of a fingerprint become several rows.
    index = postings(prints.repartition(parts, "fp"), most_bits)
    keys = ["positions", "shared"]
    sizes = index.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    sizes = kept(sizes.select(*keys, (F.col("size") > longest).alias("long")))
    short = _lists(index.join(sizes.where(~F.col("long")), keys, "left_semi"))
    crowded = index.join(sizes.where("long"), keys, "left_semi").select("fp").distinct()
    found = _links_of_lists(short, most_bits, True)
    fine = _links_of_lists(_lists(fine_postings(crowded.repartition(parts, "fp"), most_bits)), most_bits, False)
    return found.unionAll(fine).distinct()


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most_bits: int = 2
) -> DataFrame:
    """(doc_id, fp, component_id) for every row: documents whose fingerprints chains of near ones join.

    `component_id` is the smallest doc_id of the component. Equal fingerprints collapse to one row before
    the index is built, so groups of copies cost nothing there. Null and empty texts share the fingerprint 0 and are linked
    like others; repeated rows stay repeated; a null doc_id takes part but names no component unless all its ids are
    null (then null); an empty table gives an empty result.
    """
    return _with_components(docs, id_col, text_col, shingle, most_bits).select("doc_id", "fp", "component_id")


def _with_components(docs: DataFrame, id_col: str, text_col: str, shingle: int, most_bits: int) -> DataFrame:
    """The rows of `simhash_components` with `component`, which also tells components apart that share their smallest id."""
    prints = kept(fingerprints(docs, id_col, text_col, shingle))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    joined = connected_components(links(distinct.select("fp"), most_bits)).withColumnRenamed("node", "fp")
    labelled = distinct.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = labelled.select("fp", "component").join(smallest, "component").select("fp", "component", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component", "component_id")


def _rows_with_prints(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(row, _fp): the rows of `docs` as structs, and the fingerprints of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            values = np.array([simhash(text, shingle) for text in utf8(part.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(values.view(np.int64))], ["row", "_fp"])

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return rows.mapInArrow(run, T.StructType([T.StructField("row", docs.schema), T.StructField("_fp", T.LongType())]))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most_bits: int = 2) -> DataFrame:
    """The rows of `docs`, with all their columns, that stand for their component: one for each, that with the smallest id.

    Of rows with that id in the component the one with the smallest text stays, nulls first, then the first by its other columns; an id
    that several rows share may so stand for several components. Rows with a null id cannot be told apart and all stay.
    """
    found = _with_components(docs, id_col, text_col, shingle, most_bits)
    stands = F.col("doc_id") == F.col("component_id")
    ids = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    chosen = kept(ids.agg(F.count(F.when(stands, 1)).alias("n"), F.count(F.lit(1)).alias("rows")).where(F.col("n") > 0))
    own = chosen.select(F.col("doc_id").alias(id_col), "rows")
    staying = docs.join(own.where(F.col("rows") == 1).drop("rows"), id_col, "left_semi")
    if chosen.where(F.col("rows") > 1).head(1):
        shared = _rows_with_prints(docs.join(own.where(F.col("rows") > 1).drop("rows"), id_col, "left_semi"), text_col, shingle)
        standing = found.where(stands).select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"), "component").distinct()
        shared = shared.withColumn("_id", F.col("row")[id_col].cast("long")).join(standing, ["_id", "_fp"])
        order = Window.partitionBy("component").orderBy(F.asc_nulls_first(F.col("row")[text_col]), F.to_json("row"))
        one = shared.withColumn("_place", F.row_number().over(order)).where(F.col("_place") == 1)
        staying = staying.unionByName(one.select(*[F.col("row")[c].alias(c) for c in docs.columns]))
    return staying.unionByName(docs.where(docs[id_col].isNull()))
