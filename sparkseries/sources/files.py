"""File scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators.project import rename_date


class SourceError(Exception):
    """A source that cannot be read."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of its file system without listing it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in location.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(location)]


def delete_folder(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def join_path(root: str | None, path: str) -> str:
    if not root or "://" in path or path.startswith("/"):
        return path
    return f"{root.rstrip('/')}/{path}"


def read_csv(spark: SparkSession, path: str, schema: str | None = None, **options) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which costs a second pass."""
    reader = spark.read.option("header", True).options(**options)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = True, **options) -> DataFrame:
    """JSON documents; `multi_line=False` reads line-delimited files, which split across tasks."""
    reader = spark.read.option("multiLine", multi_line).options(**options)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    """Whole documents as text, for shapes that a payload expression decodes."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("body"))


def read_parquet(spark: SparkSession, path: str, schema: str | None = None, **options) -> DataFrame:
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_economic_csv(spark: SparkSession, path: str, value_type: str = "DOUBLE") -> DataFrame:
    """CSV of `Date` and numbers; a missing, an empty and a badly formed file give different errors."""
    try:
        columns = spark.read.option("header", True).csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceError(f"The file {path} was not found.") from error
        raise SourceError(f"An error occurred while reading the file: {error}") from error
    if not columns:
        raise SourceError("No data found in the file.")
    if "Date" not in columns:
        raise SourceError(f"An error occurred while reading the file: no column Date in {columns}")
    schema = ", ".join(f"`{c}` {'DATE' if c == 'Date' else value_type}" for c in columns)
    return read_csv(spark, path, schema, mode="FAILFAST", enforceSchema=False)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder with an allowed name: path, name, type and size; the content is not read."""
    name = F.substring_index("path", "/", -1)
    files = spark.read.format("binaryFile").load(path).select("path", name.alias("name"), F.col("length").alias("size"))
    return files.where(text.valid_file_name(F.col("name"))).withColumn("type", text.file_type(F.col("name")))


def spreadsheet_frame(df: DataFrame) -> DataFrame:
    """A spreadsheet export as a series: the second column is the value, `Date` becomes `date`."""
    columns = list(df.columns)
    columns[1] = "value"
    return rename_date(df.toDF(*columns))
