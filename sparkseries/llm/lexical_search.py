"""Ranked lexical search by pipelined term partitioning, in whole numbers.

The terms that the items ask for are dealt to owners, the weightiest first. An owner holds the postings of its terms, cut into blocks of
documents. For each block a bundle of items travels from owner to owner: it carries the items' sparse accumulators (document, score) and is
cogrouped with the owner's postings of the block, whose contributions are added. What bounds say about the terms still to come drops the
accumulators that cannot reach the best scores any more; after the last owner the best of what is left are chosen.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import id_and_text, kept, text_slices, utf8

BEST = 20
#: Through how many owners of terms a bundle goes.
OWNERS = 4
#: Documents and postings of a block, and items of a bundle, at most: they bound what a task holds.
BLOCK_DOCS, BLOCK_POSTINGS, GROUP_ITEMS = 4096, 1 << 20, 256
#: Bytes of the items' texts that are searched for at once; more of them take another pass over the documents.
BATCH_BYTES = 16_000_000
BUNDLE = "block LONG, grp INT, items ARRAY<INT>, docs ARRAY<INT>, scores ARRAY<LONG>, doc_ids ARRAY<LONG>, rest ARRAY<LONG>"
LONGS, INTS = pa.list_(pa.int64()), pa.list_(pa.int32())

#: A-Z in lower case, letters, digits and all bytes of other characters as they are, all else as a space.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in their order."""
    return text.translate(FOLDED).split()


def weight(df: int, n: int) -> int:
    """What a term in `df` of `n` documents weighs."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def length_norm(terms: int, n: int, total: int) -> int:
    """How a document of so many terms is damped, where `n` documents have `total` terms."""
    return 75 + (25 * terms * n) // total


@dataclass
class Asked:
    """The items of one pass by their place, and the terms they ask for by number."""

    ids: list[int]
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]
    times: list[np.ndarray]

    @classmethod
    def read(cls, rows: pa.Table) -> Asked:
        vocabulary: dict[bytes, int] = {}
        terms, times = [], []
        for text in utf8(rows.column("text").combine_chunks()):
            counted = Counter(terms_of(text))
            terms.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in counted], np.int64))
            times.append(np.array(list(counted.values()), np.int64))
        return cls(rows.column("item").to_pylist(), vocabulary, terms, times)

    def groups(self) -> range:
        return range(-(-len(self.ids) // GROUP_ITEMS))

    def members(self, group: int) -> range:
        return range(group * GROUP_ITEMS, min(len(self.ids), (group + 1) * GROUP_ITEMS))


def block_index(docs: DataFrame, vocabulary: dict[bytes, int], block_docs: int = BLOCK_DOCS) -> DataFrame:
    """A row for each block of documents: how many have terms, how many terms they have, and the postings of the vocabulary.

    (block, with_terms, all_terms, doc_ids, sizes, terms, docs, times): ids and sizes of the documents that hold a term of the vocabulary,
    then for each posting its term, the document's place in the block and the occurrences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        known = vocabulary.keys()
        ids, sizes, terms, places, times, seen = [], [], [], [], [], [0, 0]

        def block() -> pa.RecordBatch:
            values = [number, *seen, ids, sizes, terms, places, times]
            kinds = [pa.int64(), pa.int64(), pa.int64(), LONGS, LONGS, INTS, INTS, LONGS]
            names = ["block", "with_terms", "all_terms", "doc_ids", "sizes", "terms", "docs", "times"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for part in text_slices(batches):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part.column("text")), strict=True):
                found = terms_of(text)
                if not found:
                    continue
                seen[0] += 1
                seen[1] += len(found)
                counted = Counter(found)
                hits = counted.keys() & known
                if hits:
                    terms.extend(map(vocabulary.__getitem__, hits))
                    times.extend(map(counted.__getitem__, hits))
                    places.extend([len(ids)] * len(hits))
                    ids.append(doc_id)
                    sizes.append(len(found))
                if len(ids) >= block_docs or len(terms) >= BLOCK_POSTINGS:
                    yield block()
                    number += 1
                    ids, sizes, terms, places, times, seen = [], [], [], [], [], [0, 0]
        if seen[0]:
            yield block()

    schema = (
        "block LONG, with_terms LONG, all_terms LONG, doc_ids ARRAY<LONG>, sizes ARRAY<LONG>, terms ARRAY<INT>, docs ARRAY<INT>, times ARRAY<LONG>"
    )
    return docs.mapInArrow(run, schema)


def deal_terms(frequencies: dict[int, int], weights: dict[int, int], owners: int = OWNERS) -> dict[int, int]:
    """The owner of each term: the weightiest terms go to the first, and all owners have about as many postings."""
    total, before, owner = sum(frequencies.values()), 0, {}
    for term in sorted(frequencies, key=lambda t: (-weights[t], t)):
        owner[term] = min(owners - 1, before * owners // total)
        before += frequencies[term]
    return owner


def postings_by_owner(index: DataFrame, asked: Asked, weights: dict[int, int], owner: dict[int, int], n: int, total: int, owners: int = OWNERS) -> DataFrame:
    """A row for each block, group of items and owner: the contributions of the owner's terms that the group asks for, by term.

    Rows of owner -1 are the bundles that set out: the ids of the block's documents and `rest`, for each item and owner the most that this and
    the later owners can add to a document of the block.
    """
    number = len(asked.vocabulary)
    weighs, owned = np.zeros(number, np.int64), np.full(number, -1)
    weighs[list(weights)], owned[list(owner)] = list(weights.values()), list(owner.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["owner", "block", "grp", "terms", "docs", "adds", "doc_ids", "rest"]
        kinds = [pa.int32(), pa.int64(), pa.int32(), INTS, INTS, LONGS, LONGS, LONGS]
        nothing = np.zeros(0, np.int64)
        for batch in batches:
            for place in range(batch.num_rows):
                def column(name, place=place, batch=batch):
                    return batch.column(name)[place].values

                doc_ids, block = column("doc_ids"), batch.column("block")[place].as_py()
                terms, docs, times = (column(c).to_numpy().astype(np.int64) for c in ("terms", "docs", "times"))
                norms = np.array([length_norm(size, n, total) for size in column("sizes").to_pylist()], np.int64)
                adds = weighs[terms] * ((1_000_000_000 * times) // (1000 * times + 12 * norms[docs]))
                order = np.argsort(terms, kind="stable")
                terms, docs, adds = terms[order], docs[order], adds[order]
                tops = np.zeros(number, np.int64)
                np.maximum.at(tops, terms, adds)
                rows = []
                for group in asked.groups():
                    wanted = np.zeros(number, bool)
                    rest = np.zeros((len(asked.members(group)), owners), np.int64)
                    for row, item in enumerate(asked.members(group)):
                        mine = asked.terms[item]
                        wanted[mine] = True
                        held = owned[mine] >= 0
                        np.add.at(rest[row], owned[mine][held], (tops[mine] * asked.times[item])[held])
                    rest = np.cumsum(rest[:, ::-1], axis=1)[:, ::-1]
                    rows.append((-1, block, group, nothing, nothing, nothing, doc_ids, rest.reshape(-1)))
                    chosen = wanted[terms]
                    for one in range(owners):
                        own = chosen & (owned[terms] == one)
                        if own.any():
                            rows.append((one, block, group, terms[own], docs[own], adds[own], nothing, nothing))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "owner INT, block LONG, grp INT, terms ARRAY<INT>, docs ARRAY<INT>, adds ARRAY<LONG>, doc_ids ARRAY<LONG>, rest ARRAY<LONG>"
    return index.mapInArrow(run, schema)


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    """The numbers of a list column, all rows one after the other."""
    lists = table.column(column).combine_chunks()
    return (lists.flatten() if len(lists) else pa.array([], pa.int64())).to_numpy(zero_copy_only=False).astype(np.int64)


def visit_owner(bundles: DataFrame, postings: DataFrame, asked: Asked, stage: int, least: dict[int, int], owners: int = OWNERS) -> DataFrame:
    """The bundles after one owner has added its contributions.

    `least` has for an item (by its place) a score that its last place in the result is known to reach: accumulators that cannot come up to it, even with the
    most that later owners may add, are dropped. Equal scores stay.
    """

    def add(bundle: pa.Table, own: pa.Table) -> pa.Table:
        if bundle.num_rows == 0:
            return bundle
        block, group = bundle.column("block")[0].as_py(), bundle.column("grp")[0].as_py()
        items, docs, scores = (_numbers(bundle, c) for c in ("items", "docs", "scores"))
        doc_ids = bundle.column("doc_ids")[0].values
        rest = _numbers(bundle, "rest").reshape(-1, owners)
        terms, posted, adds = (_numbers(own, c) for c in ("terms", "docs", "adds"))
        starts, ends = (np.searchsorted(terms, np.arange(len(asked.vocabulary)), side) for side in ("left", "right"))
        members = asked.members(group)
        bounds = np.searchsorted(items, np.arange(members.start, members.stop + 1))
        found = []
        for row, item in enumerate(members):
            total = np.zeros(len(doc_ids), np.int64)
            mine = slice(bounds[row], bounds[row + 1])
            total[docs[mine]] = scores[mine]
            for term, times in zip(asked.terms[item].tolist(), asked.times[item].tolist(), strict=True):
                a, b = starts[term], ends[term]
                if a < b:
                    total[posted[a:b]] += times * adds[a:b]
            later = rest[row, stage + 1] if stage + 1 < owners else 0
            stay = np.flatnonzero((total > 0) & (total + later >= least.get(item, 0)))
            found.append((np.full(len(stay), item), stay, total[stay]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        values = [block, group, *columns, doc_ids, rest.reshape(-1)]
        kinds = [pa.int64(), pa.int32(), INTS, INTS, LONGS, LONGS, LONGS]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["block", "grp", "items", "docs", "scores", "doc_ids", "rest"])

    return bundles.groupBy("block", "grp").cogroup(postings.groupBy("block", "grp")).applyInArrow(add, BUNDLE)


def best_of_partitions(bundles: DataFrame, best: int) -> DataFrame:
    """(place, at, doc_id, score): for each item the best documents of each partition of the bundles, from `at` 0 on; equal scores by ascending id,
    null ids last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                items, docs, scores = (batch.column(c)[row].values.to_numpy() for c in ("items", "docs", "scores"))
                ids = batch.column("doc_ids")[row].values
                nameless = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                for item in np.unique(items).tolist():
                    a, b = np.searchsorted(items, [item, item + 1])
                    own = [scores[a:b], nameless[docs[a:b]], ids[docs[a:b]]]
                    if item in held:
                        own = [np.concatenate(pair) for pair in zip(held[item], own, strict=True)]
                    order = np.lexsort((own[2], own[1], -own[0]))[:best]
                    held[item] = tuple(c[order] for c in own)
        for item, (scores, nameless, ids) in held.items():
            columns = [pa.array(np.full(len(ids), item, np.int64)), pa.array(np.arange(len(ids)), pa.int32()), pa.array(ids, pa.int64(), mask=nameless)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], ["place", "at", "doc_id", "score"])

    return bundles.select("items", "docs", "scores", "doc_ids").mapInArrow(run, "place LONG, at INT, doc_id LONG, score LONG")


def surely_reached(bundles: DataFrame, best: int) -> dict[int, int]:
    """For each item the largest score that its last place in the result is known to reach: the last of the best of some partition."""
    ends = best_of_partitions(bundles, best).where(F.col("at") == best - 1)
    return {r["place"]: r["score"] for r in ends.groupBy("place").agg(F.max("score").alias("score")).collect()}


def _search(docs: DataFrame, asked: Asked, best: int, owners: int, block_docs: int) -> DataFrame | None:
    """(item, doc_id, score): candidates for the best documents of the items of one pass; None if there is none."""
    index = kept(block_index(docs, asked.vocabulary, block_docs))
    n, total = index.agg(F.coalesce(F.sum("with_terms"), F.lit(0)), F.coalesce(F.sum("all_terms"), F.lit(0))).first()
    frequencies = {r["term"]: r["df"] for r in index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}
    if not frequencies:
        return None
    weights = {t: weight(df, n) for t, df in frequencies.items()}
    owner = deal_terms(frequencies, weights, owners)
    path = scratch_path(docs.sparkSession, "postings")
    postings_by_owner(index, asked, weights, owner, n, total, owners).write.partitionBy("owner").parquet(path)
    stored = docs.sparkSession.read.schema(
        "block LONG, grp INT, terms ARRAY<INT>, docs ARRAY<INT>, adds ARRAY<LONG>, doc_ids ARRAY<LONG>, rest ARRAY<LONG>, owner INT"
    ).parquet(path)
    none_yet = [F.array().cast(kind).alias(c) for c, kind in (("items", "array<int>"), ("docs", "array<int>"), ("scores", "array<bigint>"))]
    bundles = stored.where(F.col("owner") == -1).select("block", "grp", *none_yet, "doc_ids", "rest")
    least: dict[int, int] = {}
    for stage in range(owners):
        own = stored.where(F.col("owner") == stage).select("block", "grp", "terms", "docs", "adds")
        bundles = visit_owner(bundles, own, asked, stage, least, owners)
        if stage + 1 < owners:
            bundles = kept(bundles)
            for item, score in surely_reached(bundles, best).items():
                least[item] = max(score, least.get(item, 0))
    names = F.split(F.lit(",".join(map(str, asked.ids))), ",").cast("array<long>")
    found = best_of_partitions(bundles, best)
    return found.select(F.get(names, F.col("place").cast("int")).alias("item"), "doc_id", "score")


def search_documents(
    docs: DataFrame, items: DataFrame, best: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", owners: int = OWNERS, batch_bytes: int = BATCH_BYTES, block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `best` documents of each item with a score above 0, all if there are fewer.

    Every row of `items` is an item, so repeated rows have the same result each, and an item without terms (a null or empty text) has none. Every
    row of `docs` is a document: null and empty texts have no terms and are not counted, rows of the same id are ranked one by one, equal scores
    are ordered by id, null ids last. Empty tables give an empty result; other columns are not looked at. The items' texts are
    held in tasks about `batch_bytes` at a time, with a pass over the documents for each batch; nothing else that tasks hold grows with the input.
    """
    rows = items.select(items[item_id_col].alias("item_id"), F.coalesce(items[item_text_col], F.lit("")).alias("text"))
    rows = kept(rows.withColumn("item", F.monotonically_increasing_id()))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    texts, passes = id_and_text(docs, id_col, text_col), max(1, -(-size // batch_bytes))
    found = []
    for number in range(passes):
        own = rows.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == number).select("item", "text")
        asked = Asked.read(own.toArrow())
        candidates = _search(texts, asked, best, owners, block_docs) if asked.vocabulary else None
        if candidates is not None:
            found.append(candidates)
    if not found:
        none = rows.select("item_id", *[F.lit(None).cast(k).alias(c) for c, k in (("rank", "int"), ("doc_id", "bigint"), ("score", "bigint"))])
        return none.limit(0)
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(rows.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
