"""Text expressions: composite names, record ids, report lines, file names, key-value lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def category_of(table_name: Column) -> Column:
    """First two underscore-separated tokens."""
    return F.substring_index(table_name, "_", 2)


def name_of(table_name: Column) -> Column:
    """All tokens after the second underscore, empty when there are at most two."""
    tokens = F.split(table_name, "_")
    return F.array_join(F.slice(tokens, 3, F.greatest(F.size(tokens), F.lit(1))), "_")


def composite_split(name: Column, separator: str = ":", parts: int = 2) -> Column:
    """`a:b` as an array; a different number of parts is an error."""
    tokens = F.split(name, "\\" + separator)
    return F.when(F.size(tokens) == parts, tokens).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {parts} parts separated by '{separator}': "), name))
    )


def owner_and_db(name: Column) -> Column:
    """`owner@db` as a struct; the owner is null when not given."""
    has_owner = name.contains("@")
    return F.struct(
        F.when(has_owner, F.substring_index(name, "@", 1)).alias("owner"),
        F.when(has_owner, F.substring_index(name, "@", -1)).otherwise(name).alias("db"),
    )


def key_value_lines(text: Column) -> Column:
    """`Key: value` lines as a map with trimmed keys and values; other lines are ignored, the last of equal keys counts."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda line: line.rlike(r"^[\w\s/]+:\s+\S"))
    pairs = F.transform(
        lines,
        lambda line: F.struct(
            F.trim(F.regexp_extract(line, r"^([^:]+):", 1)), F.trim(F.regexp_extract(line, r"^[^:]+:\s+(.*)$", 1))
        ),
    )
    # Of a key that occurs several times the last line counts.
    last = F.aggregate(
        F.reverse(pairs), F.slice(pairs, 1, 0),
        lambda kept, pair: F.when(F.exists(kept, lambda k: k["col1"] == pair["col1"]), kept).otherwise(F.concat(F.array(pair), kept)),
    )
    return F.map_from_entries(last)


def left_justify(text: Column, width: int) -> Column:
    """Pad with blanks on the right; longer text is kept whole."""
    return F.rpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))


def report_line(*cells: tuple[Column, int]) -> Column:
    padded = [left_justify(F.coalesce(cell.cast("string"), F.lit("")), width) for cell, width in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *padded), F.lit(" |"))


def record_id(kind: str, *keys: Column) -> Column:
    return F.concat_ws(":", F.lit(kind), *[key.cast("string") for key in keys])


def valid_file_name(name: Column) -> Column:
    return name.rlike(r"^[A-Za-z][A-Za-z0-9_.]*$")


def file_type(name: Column) -> Column:
    return F.when(name.endswith(".csv"), "csv").when(name.endswith(".json"), "json").otherwise("unknown")


def text_before_nul(data: Column) -> Column:
    """Bytes as UTF-8 text up to the first NUL."""
    return F.substring_index(F.decode(data, "UTF-8"), "\x00", 1)
