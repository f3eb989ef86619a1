"""Query extraction from a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

DEFAULT_FETCH_SIZE = 50_000
DEFAULT_PORT = "1521"


def jdbc_url(database: Mapping[str, object]) -> str:
    """The address. A ready ``url`` wins; otherwise it is put together from ``dsn``.

    ``host:port/service`` and a ``service_name`` key name a service, ``host:port:sid`` and a ``sid``
    key name an instance.
    """
    if database.get("url"):
        return str(database["url"])
    dsn = str(database.get("dsn", ""))
    address, _, service = dsn.partition("/")
    host, port, sid = (address.split(":") + ["", ""])[:3]
    at = f"{host}:{port or DEFAULT_PORT}"
    if "sid" in database:
        return f"jdbc:oracle:thin:@{at}:{database['sid']}"
    service = database.get("service_name") or service
    if service:
        return f"jdbc:oracle:thin:@//{at}/{service}"
    if sid:
        return f"jdbc:oracle:thin:@{at}:{sid}"
    return f"jdbc:oracle:thin:@{dsn}"


def query_options(spark: SparkSession, database: Mapping[str, object], month: str) -> dict[str, str]:
    """Reader options of one extraction.

    The month is filled into the query. ``partition`` (column, lower, upper, parts) makes Spark read
    slices in parallel; rows outside the bounds still belong to the first and last slice.
    """
    if "sql_file" in database:
        query = read_text(spark, str(database["sql_file"]))
    else:
        query = str(database["sql"])
    query = query.replace("{yyyymm}", month).strip().rstrip(";")
    options = {
        "url": jdbc_url(database),
        "dbtable": f"({query}\n) q",
        "fetchsize": str(database.get("fetch_size", DEFAULT_FETCH_SIZE)),
    }
    for key in ("user", "password", "driver"):
        if database.get(key):
            options[key] = str(database[key])
    if database.get("partition"):
        column, lower, upper, parts = database["partition"]
        options |= {
            "partitionColumn": str(column),
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return options


def read_query(spark: SparkSession, database: Mapping[str, object], month: str) -> DataFrame:
    """Rows of the query, as a DataFrame read by the executors."""
    return spark.read.format("jdbc").options(**query_options(spark, database, month)).load()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file (a query) as one string."""
    return spark.read.text(path, wholetext=True).head()["value"]
