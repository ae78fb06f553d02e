"""Expressions over text payloads: JSON shapes of the supported feeds, HTML rows, text that holds JSON twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The shapes of the supported feeds.
OBSERVATION_SCHEMA = (
    "CompactData STRUCT<DataSet: STRUCT<Series: STRUCT<Obs: ARRAY<STRUCT<"
    "`@TIME_PERIOD`: STRING, `@OBS_VALUE`: STRING>>>>>"
)
CHART_SCHEMA = "data ARRAY<ARRAY<DOUBLE>>"
NESTED_ROUND_SCHEMA = "MAP<STRING, MAP<STRING, MAP<STRING, DOUBLE>>>"


def unnest(df: DataFrame, keep: list, array: Column) -> DataFrame:
    """One row per element of `array` (structs become columns, other elements `item`), next to the `keep` columns.

    The array is computed once per row. A plain `inline` of a parsed payload would parse it three times, because
    the optimizer puts tests for null and size on the same expression below it.
    """
    items = df.select(*keep, F.posexplode_outer(array).alias("_position", "item")).where(
        F.col("_position").isNotNull()
    )
    kept = [c for c in items.columns if c not in ("_position", "item")]
    struct = dict(items.dtypes)["item"].startswith("struct")
    return items.select(*kept, "item.*" if struct else "item")


def observation_points(body: Column) -> Column:
    """`CompactData.DataSet.Series.Obs` as an array of (date, value)."""
    observations = F.from_json(body, OBSERVATION_SCHEMA)["CompactData"]["DataSet"]["Series"]["Obs"]
    return F.transform(
        observations,
        lambda o: F.struct(
            o["@TIME_PERIOD"].try_cast("date").alias("date"), o["@OBS_VALUE"].try_cast("double").alias("value")
        ),
    )


def chart_points(body: Column) -> Column:
    """`data` rows as (ts, value) from element 0 (epoch ms) and element 4; a payload without `data` is an error."""
    data = F.from_json(body, CHART_SCHEMA)["data"]
    checked = F.when(data.isNull(), F.raise_error(F.lit("payload has no data"))).otherwise(data)
    return F.transform(
        checked,
        lambda point: F.struct(
            F.timestamp_millis(F.get(point, F.lit(0)).cast("bigint")).cast("timestamp_ntz").alias("ts"),
            F.get(point, F.lit(4)).alias("value"),
        ),
    )


def indicator_points(body: Column) -> Column:
    """`[header, rows]` as (date, value) of the rows; missing or empty rows are an error."""
    rows = F.from_json(F.get_json_object(body, "$[1]"), "ARRAY<STRUCT<date: STRING, value: DOUBLE>>")
    checked = F.when(F.coalesce(F.size(rows), F.lit(0)) < 1, F.raise_error(F.lit("payload has no rows"))).otherwise(
        rows
    )
    return F.transform(
        checked, lambda row: F.struct(row["date"].try_cast("date").alias("date"), row["value"].alias("value"))
    )


def records(body: Column, schema: str) -> Column:
    """A JSON list of records as an array of structs; `schema` names the record's fields."""
    return F.from_json(body, f"ARRAY<STRUCT<{schema}>>")


def columns_to_records(body: Column, fields: dict[str, str]) -> Column:
    """A JSON object of equally long lists as an array of structs."""
    schema = ", ".join(f"`{name}`: ARRAY<{kind}>" for name, kind in fields.items())
    parsed = F.from_json(body, f"STRUCT<{schema}>")
    return F.arrays_zip(*[parsed[name].alias(name) for name in fields])


def twice_encoded(text: Column, schema: str) -> Column:
    """JSON inside a JSON string."""
    inner = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v STRING")["v"]
    return F.from_json(inner, schema)


def table_rows(html: Column, row_pattern: str, cell_patterns: dict[str, str]) -> Column:
    """Every match of `row_pattern` as a struct of trimmed texts, one field per cell pattern (group 1)."""
    rows = F.regexp_extract_all(html, F.lit(row_pattern), F.lit(0))
    return F.transform(
        rows,
        lambda row: F.struct(
            *[F.trim(F.regexp_extract(row, pattern, 1)).alias(name) for name, pattern in cell_patterns.items()]
        ),
    )


def first_zero_key(amounts: Column) -> Column:
    """A key of the map whose value is zero, null when there is none."""
    return F.get(F.map_keys(F.map_filter(amounts, lambda _key, value: value == 0)), F.lit(0))


def explode_rounds(df: DataFrame, payload: str, first_only: bool = True) -> DataFrame:
    """`{round: {city: {category: price}}}` text as one row per price; `first_only` keeps the first round key."""
    other = [c for c in df.columns if c != payload]
    entries = F.map_entries(F.from_json(F.col(payload), NESTED_ROUND_SCHEMA))
    if first_only:
        entries = F.slice(entries, 1, 1)
    rounds = unnest(df, other, entries).withColumnRenamed("key", "round")
    cities = rounds.select(*other, "round", F.explode("value").alias("city", "_prices"))
    return cities.select(*other, "round", "city", F.explode("_prices").alias("category", "price"))
