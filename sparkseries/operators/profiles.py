"""Constraints from profiles that are kept beside the data and merged, so that an append reads its own rows only.

A profile has a row for each column of a batch: how many values and nulls, the bounds, the least texts, whether the batch itself repeats a value,
and an HLL sketch of the values. All of it merges. Only a column that has been without repetition so far, and whose bounds and sketches do
not settle whether it still is, is looked up in the stored rows, within the bounds that overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..sources.targets import read_version, write_version
from .constraints import _constraint, _could_be_unique, _kinds, _sign, _value_counts
from .project import nan_as_null
from .snapshot import first_per_group

#: `low` and `high` bound values, or the lengths of texts; `first` and `last` bound the values of columns that could be without repetition.
PROFILE = (
    "batch STRING, column STRING, kind STRING, spark_type STRING, rows BIGINT, nulls BIGINT, low STRING, high STRING, first STRING, last STRING, "
    "least ARRAY<STRING>, unique BOOLEAN, sketch BINARY"
)
#: A sketch of 2^12 registers errs by 1.6 %; with fewer distinct values than this share, eight times that below, a column surely repeats some.
LG_REGISTERS, SURELY_FEWER = 12, 1 - 8 * 0.016
MOST_LISTED, MOST_NULLS = 20, 1


def profile(df: DataFrame, batch: str, most_listed: int = MOST_LISTED) -> DataFrame:
    """One row for each column of a batch. `least` has up to one text more than may be listed, so it tells whether there are more."""
    df = nan_as_null(df)
    kinds, types = _kinds(df), dict(df.dtypes)
    measures, entries = [F.count(F.lit(1)).alias("rows")], []
    for number, (name, kind) in enumerate(kinds.items()):
        c = F.col(f"`{name}`")
        measured = F.length(c) if kind == "string" else c
        measures += [
            F.count_if(c.isNull()).alias(f"n{number}"), F.min(measured).cast("string").alias(f"l{number}"), F.max(measured).cast("string").alias(f"h{number}"),
            F.min(c).cast("string").alias(f"f{number}"), F.max(c).cast("string").alias(f"t{number}"),
            F.hll_sketch_agg(c.cast("bigint") if kind == "int" else c.cast("string"), LG_REGISTERS).alias(f"s{number}"),
        ]
        entries.append(F.struct(
            F.lit(batch).alias("batch"), F.lit(name).alias("column"), F.lit(kind).alias("kind"), F.lit(types[name]).alias("spark_type"), F.col("rows"),
            F.col(f"n{number}").alias("nulls"), F.col(f"l{number}").alias("low"), F.col(f"h{number}").alias("high"),
            F.col(f"f{number}").alias("first"), F.col(f"t{number}").alias("last"), F.col(f"s{number}").alias("sketch"),
        ))
    found = df.agg(*measures).select(F.inline(F.array(*entries)))
    texts, whole = ([n for n, k in kinds.items() if k == wanted] for wanted in ("string", "int"))
    once, least = F.lit(None).cast("boolean"), F.lit(None).cast("array<string>")
    if texts + whole:
        counts = _value_counts(_could_be_unique(df.select(*texts, *whole), whole), texts + whole)
        unique = counts.groupBy("column").agg((F.max("rows") == 1).alias("once"))
        listed = first_per_group(counts.where(F.col("column").isin(texts)).select("column", "value"), ["column"], [F.asc("value")], most_listed + 1)
        found = found.join(unique, "column", "left").join(
            listed.groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("least")), "column", "left"
        )
        once, least = F.col("once"), F.col("least")
    could = F.when(F.col("kind").isin("int", "string"), F.coalesce(once, F.col("rows") == F.col("nulls")))
    names = [c.split()[0] for c in PROFILE.split(", ")]
    return found.withColumns({"unique": could, "least": least}).select(*names)


def _overlap(a: Row, b: Row) -> bool:
    """Whether two batches can share a value of a column, by their bounds."""
    if a["first"] is None or b["first"] is None:
        return False
    value = int if a["kind"] == "int" else str.encode
    return value(a["first"]) <= value(b["last"]) and value(b["first"]) <= value(a["last"])


def _surely_repeats(profiles: DataFrame, column: str) -> bool:
    """Whether the merged sketches have far fewer distinct values than there are values."""
    found = profiles.where(F.col("column") == column).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"), F.sum(F.col("rows") - F.col("nulls")).alias("values")
    ).first()
    return found["distinct"] < SURELY_FEWER * found["values"]


def _shares_value(rows: DataFrame, stored: DataFrame, told: Row) -> bool:
    """Whether a value of a column in new rows is stored already; the bounds of the new rows reach the scan of the stored ones."""
    c = F.col(f"`{told['column']}`")
    within = (c >= F.lit(told["first"]).cast(told["spark_type"])) & (c <= F.lit(told["last"]).cast(told["spark_type"]))
    return not rows.select(c.alias("v")).join(stored.where(within).select(c.alias("v")), "v", "left_semi").isEmpty()


def append_profile(spark: SparkSession, path: str, batch: str, rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Profiles a batch, adds it to the profiles at `path` and returns the constraints of all batches, as `constraints.discover` tells them.

    `stored` are the rows of the batches before. It is read only for columns that may have lost their uniqueness; without it, those count as
    repeating. A batch that is profiled already is left as it is. One writer at a time may append.
    """
    old = read_version(spark, path)
    known: dict[str, list[Row]] = {}
    if old is not None:
        for line in old.drop("sketch", "least").collect():  # columns times batches
            known.setdefault(line["column"], []).append(line)
        if any(line["batch"] == batch for lines in known.values() for line in lines):
            return merged_constraints(spark, path)
    fresh = profile(rows, batch).persist()
    try:
        every = fresh if old is None else old.unionByName(fresh)
        settled = []
        for told in fresh.drop("sketch", "least").collect():
            before, unique = known.get(told["column"], []), told["unique"]
            if unique and before:
                unique = all(line["unique"] for line in before)
                if unique and any(_overlap(line, told) for line in before):
                    unique = stored is not None and not _surely_repeats(every, told["column"]) and not _shares_value(rows, stored, told)
            settled.append((told["column"], unique))
        verdicts = spark.createDataFrame(settled, "column STRING, settled BOOLEAN")
        fresh = fresh.join(verdicts, "column").withColumn("unique", F.col("settled")).select(*fresh.columns)
        write_version(fresh if old is None else old.unionByName(fresh), path)
    finally:
        fresh.unpersist()
    return merged_constraints(spark, path)


def merged_constraints(spark: SparkSession, path: str, most_listed: int = MOST_LISTED, most_nulls: int = MOST_NULLS) -> DataFrame:
    """(column, kind, value) from the profiles alone; no row of the data is read."""
    profiles = read_version(spark, path)
    measures, entries = [], []
    for number, line in enumerate(profiles.select("column", "kind", "spark_type").distinct().collect()):
        name, kind = line["column"], line["kind"]
        measured = "int" if kind == "string" else line["spark_type"]

        def own(value: Column, name=name) -> Column:
            return F.when(F.col("column") == name, value)

        texts = F.collect_list(own(F.coalesce("least", F.array().cast("array<string>"))))
        merged = {
            "nulls": F.sum(own(F.col("nulls"))), "low": F.min(own(F.col("low").cast(measured))), "high": F.max(own(F.col("high").cast(measured))),
            "unique": F.bool_and(own(F.col("unique"))), "values": F.sum(own(F.col("rows") - F.col("nulls"))),
            "least": F.array_sort(F.array_distinct(F.flatten(texts))),
        }
        measures += [value.alias(f"{key}{number}") for key, value in merged.items()]
        nulls, low, high, unique, values, least = (F.col(f"{key}{number}") for key in merged)
        suffix = "_length" if kind == "string" else ""
        entries += [_constraint(name, "type", F.lit(kind)), _constraint(name, "max_nulls", F.when(nulls <= most_nulls, nulls))]
        if kind != "bool":
            entries += [_constraint(name, f"min{suffix}", low), _constraint(name, f"max{suffix}", high)]
        if kind in ("int", "real"):
            entries.append(_constraint(name, "sign", _sign(low, high)))
        if kind in ("int", "string"):
            entries.append(_constraint(name, "no_duplicates", F.when(unique & (values > 1), F.lit("true"))))
        if kind == "string":
            entries.append(_constraint(name, "allowed_values", F.when(F.size(least).between(1, most_listed), F.to_json(least))))
    return profiles.agg(*measures).select(F.inline(F.array(*entries))).where(F.col("value").isNotNull())
