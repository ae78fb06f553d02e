"""Constraint discovery and verification, declared schema checks, and write permission."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .project import nan_as_null
from .snapshot import first_per_group

CONSTRAINT_SCHEMA = "column STRING, kind STRING, value STRING"


class ConstraintViolation(AssertionError):
    """Raised when a verified frame breaks a constraint."""


def general_type(spark_type: str) -> str:
    if spark_type == "boolean":
        return "bool"
    if spark_type in ("tinyint", "smallint", "int", "bigint"):
        return "int"
    if spark_type in ("float", "double") or spark_type.startswith("decimal"):
        return "real"
    if spark_type in ("date", "timestamp", "timestamp_ntz"):
        return "date"
    if spark_type == "string":
        return "string"
    return "other"


def _kinds(df: DataFrame) -> dict[str, str]:
    return {name: kind for name, kind in ((n, general_type(t)) for n, t in df.dtypes) if kind != "other"}


def _constraint(column: str, kind: str, value: Column) -> Column:
    return F.struct(
        F.lit(column).alias("column"), F.lit(kind).alias("kind"), value.cast("string").alias("value")
    )


def _sign(low: Column, high: Column) -> Column:
    return (
        F.when((low == 0) & (high == 0), "zero")
        .when(low > 0, "positive")
        .when(low == 0, "non-negative")
        .when(high < 0, "negative")
        .when(high == 0, "non-positive")
    )


def _value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, rows) of the non-null values; hot values collapse before the shuffle."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _could_be_unique(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Null every integer column that has more values than its range has numbers: it must hold duplicates.

    The test is a scalar subquery per column (merged into one scan), and it keeps foreign keys and small codes
    out of the distinct shuffle.
    """
    checked = {}
    for c in columns:
        low, high = F.min(F.col(c)).cast("decimal(38,0)"), F.max(F.col(c)).cast("decimal(38,0)")
        possible = df.agg((high - low + 1 >= F.count(F.col(c))).alias("possible")).scalar()
        checked[c] = F.when(possible, F.col(c))
    return df.withColumns(checked) if checked else df


def discover(df: DataFrame, max_allowed_values: int = 20, max_recorded_nulls: int = 1) -> DataFrame:
    """Constraints of every column as (column, kind, value) rows.

    Kinds: type, min, max, sign, min_length, max_length, max_nulls (when at most `max_recorded_nulls` are null), no_duplicates, and
    allowed_values (a JSON list, for text with at most `max_allowed_values` different values; these numbers define the kinds). One pass finds the bounds; only text
    and possibly unique integer columns go through the distinct count.
    """
    df = nan_as_null(df)
    kinds = _kinds(df)
    measures, entries = [], []
    for name, kind in kinds.items():
        c = F.col(f"`{name}`")
        measures.append(F.count(F.when(c.isNull(), 1)).alias(f"nulls {name}"))
        nulls = F.col(f"`nulls {name}`")
        entries.append(_constraint(name, "type", F.lit(kind)))
        entries.append(_constraint(name, "max_nulls", F.when(nulls <= max_recorded_nulls, nulls)))
        measured = F.length(c) if kind == "string" else c
        measures += [F.min(measured).alias(f"low {name}"), F.max(measured).alias(f"high {name}")]
        low, high = F.col(f"`low {name}`"), F.col(f"`high {name}`")
        suffix = "_length" if kind == "string" else ""
        if kind != "bool":
            entries.append(_constraint(name, f"min{suffix}", low))
            entries.append(_constraint(name, f"max{suffix}", high))
        if kind in ("int", "real"):
            entries.append(_constraint(name, "sign", _sign(low, high)))
    bounds = df.agg(*measures).select(F.inline(F.array(*entries))).where(F.col("value").isNotNull())

    texts = [n for n, k in kinds.items() if k == "string"]
    whole = [n for n, k in kinds.items() if k == "int"]
    if not texts + whole:
        return bounds
    counts = _value_counts(_could_be_unique(df.select(*texts, *whole), whole), texts + whole)
    unique = (
        counts.groupBy("column")
        .agg(F.count(F.lit(1)).alias("distinct"), F.max("rows").alias("most"))
        .where((F.col("most") == 1) & (F.col("distinct") > 1))
        .select("column", F.lit("no_duplicates").alias("kind"), F.lit("true").alias("value"))
    )
    listed = first_per_group(
        counts.where(F.col("column").isin(texts)).select("column", "value"),
        ["column"], [F.asc("value")], max_allowed_values + 1,
    )
    allowed = (
        listed.groupBy("column")
        .agg(F.array_sort(F.collect_list("value")).alias("values"))
        .where(F.size("values") <= max_allowed_values)
        .select("column", F.lit("allowed_values").alias("kind"), F.to_json("values").alias("value"))
    )
    return bounds.unionAll(unique).unionAll(allowed)


def _violations(name: str, kind: str, value: str, spark_type: str) -> Column | None:
    """Number of rows (or surplus nulls) that break one constraint, as an aggregate."""
    c = F.col(f"`{name}`")
    if kind == "type":
        return F.lit(0 if general_type(spark_type) == value else 1).cast("bigint")
    if kind == "max_nulls":
        return F.greatest(F.count_if(c.isNull()) - int(value), F.lit(0)).cast("bigint")
    tests = {
        "min": lambda: c < F.lit(value).cast(spark_type),
        "max": lambda: c > F.lit(value).cast(spark_type),
        "min_length": lambda: F.length(c) < int(value),
        "max_length": lambda: F.length(c) > int(value),
        "allowed_values": lambda: ~c.isin(json.loads(value)),
        "sign": lambda: {
            "zero": c != 0, "positive": c <= 0, "non-negative": c < 0, "negative": c >= 0, "non-positive": c > 0,
        }[value],
    }
    return F.count_if(tests[kind]()) if kind in tests else None


def verify(df: DataFrame, constraints: Iterable[Row] | DataFrame) -> DataFrame:
    """(column, kind, value, violations, passed) for every constraint.

    The constraints are metadata, a few per column, and become one aggregate over the frame. Uniqueness is checked
    through value counts of just those columns.
    """
    if isinstance(constraints, DataFrame):
        constraints = constraints.collect()
    df = nan_as_null(df)
    types = dict(df.dtypes)
    measures, entries, unique = [], [], []
    for number, (name, kind, value) in enumerate((r["column"], r["kind"], r["value"]) for r in constraints):
        if name not in types:
            measures.append(F.count(F.lit(1)).alias(f"v{number}"))
        elif kind == "no_duplicates":
            unique.append(name)
            continue
        else:
            measures.append(_violations(name, kind, value, types[name]).alias(f"v{number}"))
        entries.append(
            F.struct(
                F.lit(name).alias("column"), F.lit(kind).alias("kind"), F.lit(value).alias("value"),
                F.col(f"v{number}").alias("violations"),
            )
        )
    # The constant makes this a real aggregate even when only types are checked.
    report = df.agg(F.count(F.lit(1)).alias("rows"), *measures).select(F.inline(F.array(*entries)))
    if unique:
        names = df.sparkSession.createDataFrame([(n,) for n in unique], "column STRING")
        surplus = _value_counts(df, unique).groupBy("column").agg((F.sum(F.col("rows") - 1)).alias("violations"))
        # One row per checked column on both sides.
        report = report.unionAll(
            names.join(surplus, "column", "left").select(
                "column", F.lit("no_duplicates"), F.lit("true"), F.coalesce("violations", F.lit(0).cast("bigint"))
            )
        )
    return report.withColumn("passed", F.col("violations") == 0)


def assert_verified(report: DataFrame) -> None:
    broken = report.where(~F.col("passed")).count()
    if broken:
        raise ConstraintViolation(f"{broken} constraints are broken")


def save_constraints(constraints: DataFrame, path: str) -> None:
    constraints.coalesce(1).write.mode("overwrite").json(path)


def load_constraints(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONSTRAINT_SCHEMA).json(path)


def copy_constraints(spark: SparkSession, source: str, path: str) -> None:
    """Use the constraints stored at `source` for another frame."""
    save_constraints(load_constraints(spark, source), path)


def verify_stored(df: DataFrame, path: str) -> DataFrame:
    """Verify against the constraints stored at `path`, after discovering and storing them when there are none."""
    from ..sources.files import path_exists

    spark = df.sparkSession
    if not path_exists(spark, path):
        save_constraints(discover(df), path)
    return verify(df, load_constraints(spark, path))


#: Bits of the map of keys that may be repeated: a quarter of a million words of 64, whatever the number of rows.
SUSPECT_BITS = 24


def _word_and_bit(hash_of: Column, bits: int) -> tuple[Column, Column]:
    place = hash_of.bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
    return F.shiftright(place, 6), place.bitwiseAND(F.lit(63).cast("bigint")).cast("int")


def _suspect_map(hashes: DataFrame, bits: int) -> DataFrame:
    """(_word, _bits): a map with a bit set for each of some hashes, by their lowest `bits` bits; words without any are left out."""
    word, bit = _word_and_bit(F.col("hash"), bits)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return hashes.select(word.alias("_word"), one.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))


def schema_check(
    df: DataFrame, primary_key: list[str], not_null: Iterable[str] = (), exact_length: dict[str, int] | None = None, bits: int = SUSPECT_BITS
) -> DataFrame:
    """Every row with the first declared rule it breaks in `reason`, null for good rows.

    Keys are counted by their hash first, which shuffles eight bytes for each key of a task, a frequent one once. Those that occur twice become a map of
    fixed size; a row whose bit is not set has a key of its own and is not shuffled. The others are suspects: their keys are counted exactly. Keys that hold more
    than a small share of the rows are few by that, and are broadcast; the rest meets in a join without a hot key.
    """
    broken = F.lit(None).cast("string")
    for name, size in (exact_length or {}).items():
        broken = F.coalesce(broken, F.when(F.length(name) != size, F.lit(f"length of {name}")))
    for name in [*primary_key, *not_null]:
        broken = F.coalesce(F.when(F.col(name).isNull(), F.lit(f"null {name}")), broken)
    spark = df.sparkSession
    whole = functools.reduce(Column.__and__, [F.col(k).isNotNull() for k in primary_key])
    hash_of = F.xxhash64(*primary_key)
    counted = df.where(whole).select(hash_of.alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("copies"))
    ensure_checkpoint_dir(spark)
    known = _suspect_map(counted.where(F.col("copies") > 1), bits).checkpoint()
    word, bit = _word_and_bit(hash_of, bits)
    # The map has at most 2^bits / 64 rows.
    looked = df.withColumns({"_broken": broken, "_word": F.when(whole, word)}).join(F.broadcast(known), "_word", "left")
    looked = looked.withColumn("_look", F.coalesce(F.bit_get("_bits", bit) == 1, F.lit(False)))
    repeated = looked.where("_look").groupBy(*primary_key).agg(F.count(F.lit(1)).alias("_copies")).where(F.col("_copies") > 1).checkpoint()
    # At most this many keys can each hold so large a share of the suspects.
    most = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = repeated.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]
    hot = repeated.where(F.col("_copies") * most > total)
    cold = repeated.where(F.col("_copies") * most <= total)
    marked = looked.join(F.broadcast(hot.withColumnRenamed("_copies", "_hot")), primary_key, "left")
    told = F.coalesce("_broken", F.when(F.coalesce("_hot", "_copies") > 1, F.lit("repeated key"))).alias("reason")
    among = F.col("_look") & F.col("_hot").isNull()
    alone = marked.where(~among).withColumn("_copies", F.lit(None).cast("bigint"))
    met = marked.where(among).join(cold, primary_key, "left")
    return alone.select(*df.columns, told).unionAll(met.select(*df.columns, told))


def writer_gate(batch: DataFrame, admins: DataFrame, writer: str = "writer", wallet: str = "wallet") -> DataFrame:
    """Rows whose writer may not write: no admin has that wallet."""
    known = admins.select(F.col(wallet).alias(writer)).distinct()
    return batch.join(known, writer, "left_anti").select(*batch.columns)


def require_writer(batch: DataFrame, admins: DataFrame, writer: str = "writer", wallet: str = "wallet") -> DataFrame:
    """The batch itself, or an error when any of its writers may not write."""
    rejected = writer_gate(batch, admins, writer, wallet).select(writer).first()
    if rejected is not None:
        raise PermissionError(f"{rejected[0]} is not an admin")
    return batch
