"""Database scans and writes through Spark's JDBC source."""

from __future__ import annotations

import os
import re
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

# URL schemes of databases, the insert chunk, and the column types of versioned rows.
SQL_SCHEMES = ["sqlite", "postgresql", "mysql", "mariadb", "oracle", "mssql", "sqlalchemy", "pybigquery", "jdbc"]
INSERT_CHUNK = 1000
VERSIONED_TYPES = {"date": "DATE", "created_at": "TIMESTAMP"}
#: JDBC URLs by scheme; schemes without a driver of their own are refused.
JDBC_URLS = {
    "postgresql": "jdbc:postgresql://{host}/{name}", "mysql": "jdbc:mysql://{host}/{name}", "mariadb": "jdbc:mariadb://{host}/{name}",
    "mssql": "jdbc:sqlserver://{host};databaseName={name}", "oracle": "jdbc:oracle:thin:@//{host}/{name}", "sqlite": "jdbc:sqlite:{name}",
}


def database_url(db_type: str = "mariadb+pymysql", env: dict[str, str] | None = None) -> str:
    """A database URL from DB_USER, DB_PASSWORD, DB_HOST, DB_PORT and DB_NAME."""
    env = os.environ if env is None else env
    host = env.get("DB_HOST", "127.0.0.1")
    return f"{db_type}://{env.get('DB_USER')}:{env.get('DB_PASSWORD')}@{host}:{int(env['DB_PORT'])}/{env.get('DB_NAME')}"


def jdbc_options(url: str) -> dict[str, str]:
    """JDBC options of a database URL; user and password leave the URL so they do not show in plans."""
    if url.startswith("jdbc:"):
        return {"url": url}
    parts = urlsplit(url)
    scheme = parts.scheme.split("+")[0]
    host = parts.hostname or ""
    if parts.port:
        host += f":{parts.port}"
    if scheme not in JDBC_URLS:
        raise ValueError(f"no JDBC driver for {scheme!r}; give a jdbc: URL, or one of {sorted(JDBC_URLS)}")
    # After three slashes a SQLite path is relative, after four absolute; elsewhere the path is the database's name.
    name = parts.path.removeprefix("/")
    target = JDBC_URLS[scheme].format(host=host, name=name)
    if parts.query:
        first, between = (";", ";") if scheme == "mssql" else ("?", "&")
        target += first + between.join(parts.query.split("&"))
    options = {"url": target}
    if parts.username:
        options["user"] = unquote(parts.username)
    if parts.password:
        options["password"] = unquote(parts.password)
    return options


def is_query(text: str) -> bool:
    return re.match(r"\s*(select|with)\b", text, re.IGNORECASE) is not None


def read_options(url: str, query_or_table: str, partition: dict | None = None, fetch_size: int = 10_000) -> dict:
    """Reader options. `partition` gives column, lower, upper and number, so the scan runs in parallel."""
    options = {**jdbc_options(url), "fetchsize": str(fetch_size)}
    if partition:
        source = f"({query_or_table}) AS q" if is_query(query_or_table) else query_or_table
        options.update(
            dbtable=source,
            partitionColumn=partition["column"],
            lowerBound=str(partition["lower"]),
            upperBound=str(partition["upper"]),
            numPartitions=str(partition["number"]),
        )
    else:
        options["query" if is_query(query_or_table) else "dbtable"] = query_or_table
    return options


def write_options(url: str, table: str, columns: list[str]) -> dict:
    types = ", ".join(f"{c} {t}" for c, t in VERSIONED_TYPES.items() if c in columns)
    options = {**jdbc_options(url), "dbtable": table, "batchsize": str(INSERT_CHUNK)}
    if types:
        options["createTableColumnTypes"] = types
    return options


def read_jdbc(spark: SparkSession, url: str, query_or_table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, query_or_table, **kwargs)).load()


def write_jdbc(df: DataFrame, url: str, table: str, replace: bool = False) -> None:
    writer = df.write.format("jdbc").options(**write_options(url, table, df.columns))
    writer.mode("overwrite" if replace else "append").save()
