"""Exact top-k inner products: vectors by descending length, partial sums after an SVD rotation, Cauchy-Schwarz bounds on the rest."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept

#: Vectors per block; a task holds one block of queries and one of candidates.
BLOCK = 2048
#: Rotated components of the first and second partial sum, as shares of all.
LEADS = (4, 2)
#: From this share of pairs on, a block is multiplied as a whole instead of pair by pair.
MANY = 0.02
LONGS = (-(1 << 63), (1 << 63) - 1)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(vec_id, v): each component x as floor(scale * x); vectors that are null or hold a null or non-finite component are left out."""
    parts = vectors[vec_col].cast("array<double>")
    whole = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ints = F.transform(parts, lambda x: F.floor(F.lit(float(scale)) * x))
    return vectors.where(parts.isNotNull() & whole).select(vectors[id_col].cast("long").alias("vec_id"), ints.alias("v"))


def blocks(rows: DataFrame, width: int, label: str) -> DataFrame:
    """(number, most, ids, rows, values): `rows(vec_id, row, v)` by descending length in blocks numbered from 0; `most` is the greatest length.

    Shorter vectors are filled up with zeros to `width` components.
    """
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    sized = rows.withColumn("square", square)
    # No more parts than blocks are needed: every pair of blocks is looked at.
    parts = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), max(1, -(-rows.count() // BLOCK)))
    dealt = sized.repartitionByRange(parts, F.desc("square"), F.col("vec_id")).sortWithinPartitions(F.desc("square"), F.col("vec_id"))

    def packed(ids: list, at: list, values: list[np.ndarray], part: int, place: int) -> pa.RecordBatch:
        v = np.zeros((len(ids), width), np.int64)
        for number, own in enumerate(values):
            v[number, : len(own)] = own
        most = float(np.sqrt((v.astype(float) ** 2).sum(axis=1).max(initial=0)))
        first = (part << 33) + place * BLOCK
        numbers = np.arange(first, first + len(ids)) if at[0] is None else np.array(at, np.int64)
        columns = [part, place, most, np.array([i is None for i in ids]).tobytes(), np.array([i or 0 for i in ids], np.int64).tobytes(), numbers.tobytes(), v.tobytes()]
        names = ["part", "place", "most", "no_id", "ids", "rows", "v"]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        ids, at, values = [], [], []
        for batch in batches:
            lists = batch.column("v")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum([0, *lists.value_lengths().to_pylist()])
            ids += batch.column("vec_id").to_pylist()
            at += batch.column("row").to_pylist()
            values += [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            while len(ids) >= BLOCK:
                yield packed(ids[:BLOCK], at[:BLOCK], values[:BLOCK], part, place)
                ids, at, values, place = ids[BLOCK:], at[BLOCK:], values[BLOCK:], place + 1
        if ids:
            yield packed(ids, at, values, part, place)

    schema = "part INT, place INT, most DOUBLE, no_id BINARY, ids BINARY, rows BINARY, v BINARY"
    made = kept(dealt.select("vec_id", "row", "v").mapInArrow(run, schema))
    # One row per partition.
    counts = made.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part")) - F.col("n")
    firsts = counts.select("part", before.alias("first"))
    return made.join(F.broadcast(firsts), "part").withColumn(label, F.col("first") + F.col("place")).drop("first", "part", "place")


class Block:
    """A block of vectors with what the bounds need: rotated components, longest first, and the lengths of what follows each lead."""

    def __init__(self, row: dict, prefix: str, rotation: np.ndarray):
        width = len(rotation)
        self.ids = np.frombuffer(row[f"{prefix}ids"], np.int64)
        self.no_id = np.frombuffer(row[f"{prefix}no_id"], bool)
        self.rows = np.frombuffer(row[f"{prefix}rows"], np.int64)
        self.v = np.frombuffer(row[f"{prefix}v"], np.int64).reshape(-1, width)
        self.turned = self.v.astype(float) @ rotation
        squares = np.cumsum(self.turned[:, ::-1] ** 2, axis=1)[:, ::-1]
        self.lengths = np.sqrt(squares[:, 0]) if width else np.zeros(len(self.v))
        self.rest = {lead: np.sqrt(squares[:, lead]) if lead < width else np.zeros(len(self.v)) for lead in leads(width)}


def leads(width: int) -> list[int]:
    return sorted({max(1, width // share) for share in LEADS}) if width else []


def exact_products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of rows, as whole numbers; beyond 64 bits the nearest such number."""
    if small_enough(queries, candidates, 2.0**62):
        return np.einsum("ij,ij->i", queries, candidates)
    exact = (queries.astype(object) * candidates.astype(object)).sum(axis=1)
    return np.array([min(max(x, LONGS[0]), LONGS[1]) for x in exact], np.int64)


def pairs_above(q: Block, c: Block, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of all pairs whose score reaches the query's `least`; a query is not paired with its own row.

    Partial sums of the leading components plus the product of the remaining lengths bound a score from above; pairs whose bound stays below
    are dropped, first candidates as a whole by length, then by each lead. What is left is computed exactly.
    """
    slack = 1e-9 * np.outer(q.lengths, np.array([c.lengths.max(initial=0)])).ravel() + 1e-6
    floor = least - slack
    near = int(np.searchsorted(-c.lengths, -np.min(np.divide(floor, q.lengths, out=np.where(floor <= 0, -np.inf, np.inf), where=q.lengths > 0), initial=np.inf), side="right"))
    width, done = q.v.shape[1], 0
    partial = np.zeros((len(q.v), near))
    alive = np.ones(partial.shape, bool)
    for lead in leads(width):
        partial += q.turned[:, done:lead] @ c.turned[:near, done:lead].T
        done = lead
        np.logical_and(alive, partial + np.outer(q.rest[lead], c.rest[lead][:near]) >= floor[:, None], out=alive)
        if np.count_nonzero(alive) > MANY * alive.size:
            break  # the bound tells little here, so the next leads would cost more than the exact products
    rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
    if np.count_nonzero(alive) > MANY * max(1, len(rows) * len(columns)) and small_enough(q.v, c.v):
        # Products of whole numbers below 2**53 are exact in floating point.
        scores = q.v[rows].astype(float) @ c.v[columns].astype(float).T
        scores[q.rows[rows][:, None] == c.rows[columns][None, :]] = -np.inf
        left, right = np.nonzero(scores >= least[rows][:, None])
        return rows[left], columns[right], scores[left, right].astype(np.int64)
    alive &= q.rows[:, None] != c.rows[None, :near]
    left, right = np.nonzero(alive)
    found = [np.zeros(0, np.int64)]
    for at in range(0, len(left), 1 << 17):
        found.append(exact_products(q.v[left[at : at + (1 << 17)]], c.v[right[at : at + (1 << 17)]]))
    scores = np.concatenate(found)
    good = scores >= least[left]
    return left[good], right[good], scores[good]


def kth_scores(q: Block, blocks: list[Block], k: int) -> np.ndarray:
    """For each query the k-th highest score in some blocks, without its own row; the least number if there are fewer."""
    parts = []
    for c in blocks:
        if small_enough(q.v, c.v):
            scores = q.v.astype(float) @ c.v.astype(float).T
        else:
            scores = np.array([exact_products(np.broadcast_to(v, c.v.shape), c.v) for v in q.v]).astype(float)
            scores = np.nextafter(scores, -np.inf)  # rounding may not raise a bound
        scores[q.rows[:, None] == c.rows[None, :]] = -np.inf
        parts.append(scores)
    scores = np.hstack(parts) if parts else np.zeros((len(q.v), 0))
    if scores.shape[1] < k:
        return np.full(len(q.v), float(LONGS[0]))
    return np.maximum(-np.partition(-scores, k - 1, axis=1)[:, k - 1], float(LONGS[0]))


def small_enough(queries: np.ndarray, candidates: np.ndarray, limit: float = 2.0**53) -> bool:
    """Whether every inner product, and every part of its sum, stays below the limit."""
    return float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, queries.shape[1]) < limit


def best(left: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query: the highest scores, ties to the smaller id."""
    order = np.lexsort((ids, -scores.astype(float), left)) if np.abs(scores).max(initial=0) < 1 << 53 else np.array(sorted(range(len(left)), key=lambda i: (left[i], -int(scores[i]), ids[i])), int)
    own = left[order]
    start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, int)
    rank = np.arange(len(own)) - np.repeat(start, np.diff(np.append(start, len(own))))
    return order[rank < k]


def rotation_of(candidates: DataFrame, width: int) -> np.ndarray:
    """The right singular vectors of all candidates, the largest first, from the sum of v vᵀ over partitions."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for v in batch.column("v").to_pylist():
                x = np.frombuffer(v, np.int64).reshape(-1, width).astype(float)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def merge(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(s) for s in table.column("sums").to_pylist()], axis=0)
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})

    parts = candidates.select("v").mapInArrow(partial, "sums BINARY")
    groups = max(1, math.isqrt(int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    merged = parts.withColumn("part", F.spark_partition_id() % groups).groupBy("part").applyInArrow(
        lambda table: merge(table.select(["sums"])), "sums BINARY"
    )
    total = np.zeros((width, width))
    for row in merged.toLocalIterator():
        total += np.frombuffer(row["sums"]).reshape(width, width)
    if not np.isfinite(total).all():
        return np.eye(width)
    return np.linalg.eigh(total)[1][:, ::-1].copy()


def top_products(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its k candidates with the highest inner products of whole components.

    `is_query` is a condition on `vec_id`. Every row but the query's own is a candidate, also a repeated one; all candidates are
    returned if there are fewer than k; ties go to the smaller id. Vectors that are null or hold a null or non-finite component take no part;
    shorter vectors count as filled up with zeros; a null id is never a query. An empty table gives an empty result.
    """
    chosen = kept(quantised(vectors, id_col, vec_col, scale).withColumn("row", F.lit(None).cast("long")))
    width = chosen.agg(F.max(F.size("v"))).first()[0] or 0
    candidates = blocks(chosen, width, "c")
    queries = blocks(_with_rows(candidates, width).where(is_query), width, "q")
    rotation = rotation_of(candidates, width)
    # Two blocks, the longest vectors, give every query a first bound.
    head = [row.asDict() for row in candidates.where(F.col("c") < 2).orderBy("c").collect()]

    def first_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = [Block(row, "", rotation) for row in head]
        for batch in batches:
            for row in batch.to_pylist():
                q = Block(row, "", rotation)
                least = kth_scores(q, longest, k)
                need = np.min(np.where(least <= 0, -np.inf, least / np.maximum(q.lengths, 1e-300)), initial=np.inf)
                yield pa.RecordBatch.from_arrays([pa.array([row["q"]]), pa.array([least.tobytes()], pa.binary()), pa.array([float(need)])], ["q", "least", "need"])

    bounds = kept(queries.mapInArrow(first_bounds, "q LONG, least BINARY, need DOUBLE"))
    held = queries.select(*[F.col(c).alias(f"q{c}") if c != "q" else F.col(c) for c in queries.columns]).join(bounds, "q")
    number = candidates.count()
    if not number:
        pairs = held.withColumn("c", F.lit(None).cast("long"))
    else:
        short = candidates.select("c", "most")
        pairs = bounds.select("q", "need", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long"))).alias("c"))
        pairs = pairs.join(short, "c").where(F.col("most") * (1 + 1e-9) + 1e-6 >= F.col("need")).select("q", "c").join(held.drop("need"), "q")
    both = pairs.join(candidates, "c").drop("most", "qmost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries_held, candidates_held = {}, {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["q"] not in queries_held:
                    queries_held = {row["q"]: Block(row, "q", rotation)}
                if row["c"] not in candidates_held:
                    candidates_held = {row["c"]: Block(row, "", rotation)}
                q, c = queries_held[row["q"]], candidates_held[row["c"]]
                left, right, scores = pairs_above(q, c, np.frombuffer(row["least"]))
                chosen_at = best(left, c.ids[right], scores, k)
                left, right, scores = left[chosen_at], right[chosen_at], scores[chosen_at]
                ids = pa.array(c.ids[right], mask=c.no_id[right])
                yield pa.RecordBatch.from_arrays([pa.array(q.ids[left]), pa.array(q.rows[left]), ids, pa.array(scores)], ["query_id", "query_row", "vec_id", "score"])

    scored = both.mapInArrow(run, "query_id LONG, query_row LONG, vec_id LONG, score LONG")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _with_rows(candidates: DataFrame, width: int) -> DataFrame:
    """(vec_id, row, v): the vectors of the blocks, one a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                ids, no_id, rows = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["no_id"], bool), np.frombuffer(block["rows"], np.int64)
                flat = np.frombuffer(block["v"], np.int64)
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * width, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=no_id), pa.array(rows), values], ["vec_id", "row", "v"])

    return candidates.select("ids", "no_id", "rows", "v").mapInArrow(run, "vec_id LONG, row LONG, v ARRAY<LONG>")
