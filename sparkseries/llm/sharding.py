"""Shards by a keyed permutation of global row numbers, with DataFrame functions only.

Rows are numbered 0 to n - 1 in a total order that depends on their content alone. A Feistel network over pairs of remainders, the
product of whose moduli is the least found at or above n, permutes those numbers; a number that leaves the range walks on along its
cycle until it is back. The permuted number says the place of the row: remainder and quotient by the number of shards are its shard and slot.
So the row at a place can be computed as well, without looking at any other row.
"""

from __future__ import annotations

import math

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept

SHARDS = 16
SEED = 2024
ROUNDS = 8
#: Moduli that are tried for the one that leaves the fewest numbers outside the range.
TRIED = 1024
#: Spark's hash functions start from this seed.
HASH_SEED = 42


def moduli(n: int) -> tuple[int, int]:
    """(a, b) near the root of n with a * b >= n and as few numbers beyond n as found; fewer than a in any case."""
    root = max(1, math.isqrt(max(1, n)))
    return min(((a, -(-n // a) or 1) for a in range(max(1, root - TRIED + 1), root + 1)), key=lambda p: (p[0] * p[1] - n, -p[0]))


def round_keys(seed: int) -> list[int]:
    """The keys of the rounds, below 2^62."""
    return [xxhash.xxh64_intdigest(f"{seed}:{number}".encode()) >> 2 for number in range(ROUNDS)]


def _rounds(n: int, seed: int, back: bool = False) -> Column:
    """An array of (key, modulus) of each round in the order of use."""
    a, b = moduli(n)
    used = [(key, b if number % 2 else a) for number, key in enumerate(round_keys(seed))]
    columns = [F.struct(F.lit(k).cast("long").alias("key"), F.lit(m).cast("long").alias("m")) for k, m in (reversed(used) if back else used)]
    return F.array(*columns)


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("long"))


def _network(value: Column, n: int, seed: int, back: bool) -> Column:
    """One pass of the network, or of its inverse, over numbers below the product of the moduli."""
    a, _b = moduli(n)

    def mixed(half: Column, step: Column) -> Column:
        return F.pmod(F.xxhash64(half, step["key"]), step["m"])

    def forth(held: Column, step: Column) -> Column:
        return F.struct(held["r"].alias("l"), ((held["l"] + mixed(held["r"], step)) % step["m"]).alias("r"))

    def undone(held: Column, step: Column) -> Column:
        return F.struct(F.pmod(held["r"] - mixed(held["l"], step), step["m"]).alias("l"), held["l"].alias("r"))

    halves = F.struct((value % a).alias("l"), _div(value, a).alias("r"))
    return F.aggregate(_rounds(n, seed, back), halves, undone if back else forth, lambda held: held["r"] * a + held["l"])


def permuted(number: Column, n: int, seed: int = SEED, back: bool = False) -> Column:
    """The place of row `number` of `n` in the shuffle, or with `back` the row at that place; null outside 0 to n - 1.

    Only as many numbers lie outside the range as the product of the moduli exceeds n, and a walk meets each of them once at most: that is
    its bound. Walks are looked at only where the first pass has left the range.
    """
    a, b = moduli(n)
    spare = a * b - n
    number = number.cast("long")

    def walked(first: Column) -> Column:
        steps = F.sequence(F.lit(1), F.lit(spare))
        return F.when(first < n, first).otherwise(
            F.aggregate(steps, first, lambda at, _step: F.when(at < n, at).otherwise(_network(at, n, seed, back)))
        )

    once = _network(number, n, seed, back)
    found = F.transform(F.array(once), walked)[0] if spare else once
    return F.when((number >= 0) & (number < n), found)


def place_of(number: Column, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[Column, Column]:
    """(shard, slot) of row `number` of `n`."""
    place = permuted(number, n, seed)
    return (place % shards).cast("int"), _div(place, shards)


def row_at(shard: Column, slot: Column, n: int, shards: int = SHARDS, seed: int = SEED) -> Column:
    """The number of the row in a slot of a shard; null where there is none."""
    return permuted(F.when((shard >= 0) & (shard < shards), slot.cast("long") * shards + shard), n, seed, back=True)


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """(rows with `number` from 0, how many there are), in ascending order of the columns `order`, nulls first.

    Rows that are equal in all of `order` follow each other as they are read, which also lets a range end between them: a value that a
    third of the rows share is spread over tasks. The checkpoint fixes what lies where, so a lost executor cannot renumber rows. One
    count for each partition reaches the driver and returns as one constant.
    """
    placed = rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*order, "_read").sortWithinPartitions(*order, "_read")
    placed = kept(placed.drop("_read").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = {r["part"]: r["rows"] for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    before, firsts = 0, []
    for number in range(max(counts, default=-1) + 1):
        firsts.append(before)
        before += counts.get(number, 0)
    first = F.get(F.split(F.lit(",".join(map(str, firsts or [0]))), ",").cast("array<long>"), part.cast("int"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    return placed.withColumn("number", first + inside).drop("_at"), before


def _with_place(rows: DataFrame, order: list[str], shards: int, seed: int) -> DataFrame:
    rows, n = numbered(rows, order)
    shard, slot = place_of(F.col("number"), n, shards, seed)
    return rows.withColumns({"shard": shard, "slot": slot})


def shard_digests(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, number, shard, slot) for every row; only these few bytes of a row are shuffled.

    Counts of shards differ by one at most, slots of a shard have no gaps. Row numbers follow the ids, nulls first, then a hash of the
    text, so the result is the same however the table is cut into files. A null text is empty; rows that are equal in id and text take
    their places in any order, which cannot be told apart here; an empty table gives an empty result.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("hash"),
    )
    return _with_place(rows, ["doc_id", "hash"], shards, seed).drop("hash")


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, number, shard, slot): the rows of `docs` as structs, so that columns of any name stay as they are, and their places.

    The order of rows is that of `shard_digests`; rows equal in id and text follow a hash of all their columns.
    """
    whole = F.struct(*[docs[c] for c in docs.columns])
    rows = docs.select(
        whole.alias("row"), docs[id_col].cast("long").alias("_id"), F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("_hash"),
        F.xxhash64(F.to_json(whole)).alias("_all"),
    )
    return _with_place(rows, ["_id", "_hash", "_all"], shards, seed).select("row", "number", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the rows below `path`, a folder for each shard, files in the order of slots, each with `row` and `slot`.

    Ranges of (shard, slot) are as many as the session has shuffle partitions, so a shard is as large as it likes without making a task large.
    """
    placed = shard_rows(docs, shards, seed, id_col, text_col).select("shard", "slot", "row")
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
