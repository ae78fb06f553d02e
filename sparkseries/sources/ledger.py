"""The fixed-point price ledger: `db:table` addresses, encoding, decoding, checked appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric, times
from ..operators.constraints import require_writer, schema_check
from ..operators.reconcile import delete_by_key
from .files import path_exists

# The ledger's declared columns and lengths.
LEDGER_SCHEMA = "id STRING, date_value STRING, value BIGINT, created_at BIGINT"
LEDGER_LENGTHS = {"id": 36, "date_value": 10}
LEDGER_NOT_NULL = ["date_value", "value", "created_at"]


def split_address(address: str) -> tuple[str | None, str, str]:
    """`db:table` or `owner@db:table` as (owner, db, table)."""
    parts = address.split(":")
    if len(parts) != 2:
        raise ValueError(f"need db and table: {address!r}")
    owner, _, db = parts[0].rpartition("@")
    return owner or None, db, parts[1]


def encode(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Series rows as ledger rows. Ids derive from `keys` (random without), so a repeated run writes the same ids."""
    row_id = numeric.key_uuid(*[F.col(k) for k in keys]) if keys else F.uuid()
    other = [c for c in df.columns if c not in ("date", "value", "created_at")]
    return df.select(
        row_id.alias("id"),
        times.date_text(F.col("date")).alias("date_value"),
        numeric.fixed_point_encode(F.col("value")).alias("value"),
        times.to_epoch_nanos(F.col("created_at")).alias("created_at"),
        *other,
    )


def decode(df: DataFrame) -> DataFrame:
    other = [c for c in df.columns if c not in ("id", "date_value", "value", "created_at")]
    return df.select(
        F.col("date_value").try_cast("date").alias("date"),
        numeric.fixed_point_decode(F.col("value")).alias("value"),
        times.from_epoch_nanos(F.col("created_at")).alias("created_at"),
        *other,
    )


def _location(address: str, root: str | None) -> str:
    _owner, db, table = split_address(address)
    return f"{root.rstrip('/')}/{db}/{table}" if root else f"{db}.{table}"


def read_ledger(spark: SparkSession, address: str, root: str | None = None, raw: bool = False) -> DataFrame | None:
    """All rows of a ledger table, decoded unless `raw`; None when there is no such table."""
    location = _location(address, root)
    if root:
        if not path_exists(spark, location):
            return None
        stored = spark.read.parquet(location)
    elif spark.catalog.tableExists(location):
        stored = spark.table(location)
    else:
        return None
    return stored if raw else decode(stored)


def append_ledger(
    df: DataFrame, address: str, root: str | None = None, keys: list[str] | None = None,
    admins: DataFrame | None = None, writer: str = "writer",
) -> None:
    """Encode and append; a writer outside `admins` or a row that breaks the declared schema stops the batch.

    Ids that the table holds already are left out, so with `keys` a repeated run adds nothing.
    """
    if admins is not None:
        df = require_writer(df, admins, writer).drop(writer)
    rows = encode(df, keys)
    held = read_ledger(df.sparkSession, address, root, raw=True) if keys else None
    if held is not None:
        rows = delete_by_key(rows, held, ["id"])
    checked = schema_check(rows, ["id"], LEDGER_NOT_NULL, LEDGER_LENGTHS)
    reject = F.raise_error(F.concat(F.lit("ledger row refused: "), F.col("reason")))
    valid = checked.withColumn("id", F.when(F.col("reason").isNotNull(), reject).otherwise(F.col("id"))).drop("reason")
    writer_ = valid.write.mode("append")
    if root:
        writer_.parquet(_location(address, root))
    else:
        writer_.format("parquet").saveAsTable(_location(address, root))
