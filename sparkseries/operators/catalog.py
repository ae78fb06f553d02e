"""The two catalogues: typed key/value metadata, and facts about every series in long form."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, times
from ..functions.payload import unnest
from . import project, snapshot

METADATA_SCHEMA = (
    "table STRING, key STRING, valuei BIGINT, valued TIMESTAMP_NTZ, valuef DOUBLE, values STRING, "
    "created_at TIMESTAMP_NTZ"
)
CATALOGUE_SCHEMA = (
    "table_name STRING, _key STRING, value STRING, value_type STRING, created_at TIMESTAMP_NTZ, "
    "updated_at TIMESTAMP_NTZ"
)
RULE_SCHEMA = "index STRING, frequency STRING, other STRING, exact INT"


def metadata_rows(spark: SparkSession, table: str, values: dict, as_of) -> DataFrame:
    """Key/values of one table as typed rows; values of other types are left out."""
    rows = []
    for key, value in values.items():
        typed = [None, None, None, None]
        if isinstance(value, int):
            typed[0] = int(value)
        elif isinstance(value, dt.datetime):
            typed[1] = value
        elif isinstance(value, float):
            typed[2] = value
        elif isinstance(value, str):
            typed[3] = value
        else:
            continue
        rows.append((table, key, *typed))
    schema = METADATA_SCHEMA.rsplit(",", 1)[0]
    return spark.createDataFrame(rows, schema).withColumn("created_at", times.as_timestamp(as_of))


def upsert_metadata(old: DataFrame, new: DataFrame) -> DataFrame:
    """New rows take the place of old ones with the same table and key, whole rows at a time."""
    return new.unionByName(old.join(new.select("table", "key"), ["table", "key"], "left_anti"))


def metadata_value() -> Column:
    """The stored value as text, whichever typed column holds it."""
    return F.coalesce(
        F.col("valuei").cast("string"), F.col("valuef").cast("string"), F.col("valued").cast("string"), F.col("values")
    )


def metadata_of_table(df: DataFrame, table: str) -> DataFrame:
    """Key and value of one table, one row per key."""
    return df.where(F.col("table") == table).select("key", metadata_value().alias("value"))


def metadata_by_key(df: DataFrame, key: str) -> DataFrame:
    """Table and value of one key, one row per table; tables may be many, so the result stays long."""
    return df.where(F.col("key") == key).select("table", metadata_value().alias("value"))


def load_rules(spark: SparkSession, path: str | None) -> DataFrame:
    """Frequency rules of a JSON list, numbered in list order; no rows when the file is absent."""
    from ..sources.files import path_exists

    if path is None or not path_exists(spark, path):
        return spark.createDataFrame([], RULE_SCHEMA + ", position INT")
    listed = spark.read.text(path, wholetext=True).select(
        F.posexplode(F.from_json("value", f"ARRAY<STRUCT<{RULE_SCHEMA}>>")).alias("position", "rule")
    )
    return listed.select("rule.*", "position")


def with_first_rule(rows: DataFrame, rules: DataFrame, name: str = "table_name") -> DataFrame:
    """Rows, one per name, with the frequency and the `other` text of the first rule that fits; null when none does.

    An exact rule must equal the name, a prefix rule must start it. Each name offers itself and its prefixes of the lengths that
    rules have as keys, so the match is an equi-join (no nested loop however many rules there are), Spark broadcasts the rules
    only when they are small, and the rows are read once. The lengths, no more than a name has characters, come from a job over the rules.
    """
    whole = F.col(name)
    lengths = sorted(r[0] for r in rules.where("exact = 0 AND index IS NOT NULL").select(F.length("index")).distinct().collect())
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length(name)),
        lambda n: F.struct(F.substring(whole, F.lit(1), n).alias("_index"), F.lit(0).alias("_exact")),
    )
    keys = F.concat(prefixes, F.array(F.struct(whole.alias("_index"), F.lit(1).alias("_exact"))))
    other = [c for c in rows.columns if c != name]
    offered = unnest(rows, rows.columns, keys)
    keyed = rules.select(
        F.col("index").alias("_index"), F.col("exact").alias("_exact"), F.struct("position", "frequency", "other").alias("_rule")
    )
    matched = offered.join(keyed, ["_index", "_exact"], "left").groupBy(name).agg(
        F.min("_rule").alias("_rule"), *[F.any_value(c).alias(c) for c in other]
    )
    return matched.select(name, *other, F.col("_rule.frequency").alias("frequency"), F.col("_rule.other").alias("other"))


def first_rule(names: DataFrame, rules: DataFrame, name: str = "table_name") -> DataFrame:
    """Every distinct name with its first rule."""
    return with_first_rule(names.select(name).distinct(), rules, name)


def catalogue_rows(df: DataFrame, rules: DataFrame, as_of, series: str = "series") -> DataFrame:
    """Long catalogue rows of all series at once: category, name, latest date, last update, and the rule's values.

    The facts need one aggregation over the rows; everything after it has one row per series.
    """
    facts = snapshot.latest_facts(df.select(series, "date", "created_at"), series)
    return fact_rows(facts.withColumnRenamed(series, "table_name"), rules, as_of)


def newest_facts(facts: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Facts of new rows merged with the ones the catalogue holds for the same tables: the later row counts.

    Rows are only ever appended, so this equals the facts over all rows without reading them again.
    """
    held = catalogue.groupBy("table_name").agg(
        *[F.max(F.when(F.col("_key") == key, F.col("value"))).alias(f"_{key}") for key in ("latest_date", "last_update")]
    )
    new = F.struct(F.col("latest_date").cast("date").alias("d"), F.col("last_update").cast("timestamp_ntz").alias("u"))
    old = F.struct(F.col("_latest_date").try_cast("date").alias("d"), F.col("_last_update").try_cast("timestamp_ntz").alias("u"))
    return facts.join(held, "table_name", "left").select("table_name", F.greatest(new, old).alias("_f")).select(
        "table_name", F.col("_f.d").alias("latest_date"), F.col("_f.u").alias("last_update")
    )


def fact_rows(facts: DataFrame, rules: DataFrame, as_of) -> DataFrame:
    """Long catalogue rows from one row of facts per table."""
    facts = project.exclude_prefixes(facts, "table_name")
    ruled = with_first_rule(facts, rules)
    table = F.col("table_name")
    entries = F.array(
        _entry("category", text.category_of(table), "string"),
        _entry("name", text.name_of(table), "string"),
        _entry("latest_date", times.date_text(F.col("latest_date")), "date"),
        _entry("last_update", times.datetime_text(F.col("last_update")), "datetime"),
        _entry("frequency", F.col("frequency"), "string"),
        _entry("other", F.col("other"), "string"),
    )
    now = times.as_timestamp(as_of)
    return (
        ruled.select("table_name", F.inline(entries))
        .where(F.col("value").isNotNull())
        .withColumns({"created_at": now, "updated_at": now})
    )


def _entry(key: str, value: Column, kind: str) -> Column:
    return F.struct(F.lit(key).alias("_key"), value.alias("value"), F.lit(kind).alias("value_type"))


def upsert_catalogue(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both by (table_name, _key): new value, type and update time win, the first creation time stays."""
    keys = ["table_name", "_key"]
    o = old.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in old.columns if c not in keys])
    joined = new.withColumn("_is_new", F.lit(True)).join(o, keys, "full")
    fresh = F.col("_is_new").isNotNull()

    def pick(column: str) -> Column:
        return F.when(fresh, F.col(column)).otherwise(F.col(f"_old_{column}")).alias(column)

    return joined.select(
        *keys,
        pick("value"),
        pick("value_type"),
        F.coalesce("_old_created_at", "created_at").alias("created_at"),
        pick("updated_at"),
    )


def empty_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CATALOGUE_SCHEMA)


def wide_catalogue(df: DataFrame) -> DataFrame:
    """One row per table with its six known facts as columns."""
    keys = ["category", "name", "latest_date", "last_update", "frequency", "other"]
    return df.groupBy("table_name").agg(*[F.max(F.when(F.col("_key") == k, F.col("value"))).alias(k) for k in keys])
