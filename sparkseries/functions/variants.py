"""JSON payloads of any shape, without a schema: records as VARIANT, and the columns that they have in common."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LISTS = "map<string,array<variant>>"
RECORDS = "array<variant>"
FIELDS = "map<string,variant>"
#: Types of the merged schema that columns keep as they are; others stay VARIANT.
PLAIN = re.compile(r"(BIGINT|DOUBLE|BOOLEAN|STRING|DATE|TIMESTAMP|TIMESTAMP_NTZ|FLOAT|DECIMAL\(\d+,\d+\))$")


def records_of(value: Column, under: str | None = None) -> Column:
    """The records of a payload as an array of maps from field to VARIANT.

    A payload is a list of records, an object of lists only (the n-th record has the n-th value of each), or one record. `under` names a field that holds the
    payload, as in `{"data": [...]}`. What is none of these has no records. In an object of lists a list that is too short leaves its
    field out of the later records.
    """
    value = F.try_variant_get(value, f"$.{under}", "variant") if under else value
    listed = F.transform(F.try_variant_get(value, "$", RECORDS), lambda record: F.try_variant_get(record, "$", FIELDS))
    columns = F.try_variant_get(value, "$", LISTS)
    longest = F.array_max(F.transform(F.map_values(columns), F.size))
    rows = F.transform(
        F.sequence(F.lit(0), longest - 1),
        lambda at: F.map_filter(F.transform_values(columns, lambda _name, values: F.get(values, at.cast("int"))), lambda _name, v: v.isNotNull()),
    )
    one = F.try_variant_get(value, "$", FIELDS)
    # A field that is no list is null among the lists.
    all_lists = (F.size(columns) > 0) & F.forall(F.map_values(columns), lambda values: values.isNotNull())
    none = F.array().cast("array<map<string,variant>>")
    found = F.when(listed.isNotNull(), listed).when(all_lists, F.when(longest > 0, rows).otherwise(none)).when(one.isNotNull(), F.array(one))
    return F.filter(found, lambda record: record.isNotNull())


def variant_records(payloads: DataFrame, body: str = "body", under: str | None = None) -> DataFrame:
    """A row for each record of every payload, with the other columns and `record`, a map from field to VARIANT; a body that is no JSON has none."""
    others = [c for c in payloads.columns if c != body]
    parsed = payloads.select(*others, F.try_parse_json(F.col(body).cast("string")).alias("_value"))
    return parsed.select(*others, F.explode(records_of(F.col("_value"), under)).alias("record"))


def fields_in_common(records: DataFrame, record: str = "record") -> dict[str, str]:
    """The fields of all records and the type that holds all their values, by one aggregation with partial results per task.

    There are as many rows as fields. Whole and fractional numbers become fractional, other mixtures stay VARIANT.
    """
    fields = records.select(F.explode(record).alias("field", "value")).where(~F.is_variant_null("value"))
    found = fields.groupBy("field").agg(F.schema_of_variant_agg("value").alias("type")).orderBy("field").collect()
    return {r["field"]: r["type"] if PLAIN.match(r["type"]) else "VARIANT" for r in found}


def typed_records(records: DataFrame, record: str = "record", fields: dict[str, str] | None = None) -> DataFrame:
    """The records with a column for each field, of the type that fits all records, unless `fields` gives the types.

    Numbers of mixed kinds are DOUBLE or DECIMAL, a field whose values have nothing in common is VARIANT, a field that a record lacks is null.
    """
    fields = fields if fields is not None else fields_in_common(records, record)
    others = [c for c in records.columns if c != record]
    columns = [
        (F.try_element_at(record, F.lit(name)) if kind == "VARIANT" else F.try_variant_get(F.try_element_at(record, F.lit(name)), "$", kind)).alias(name)
        for name, kind in fields.items()
    ]
    return records.select(*others, *columns)
