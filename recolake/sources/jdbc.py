"""Relational database tables through JDBC.

Connection settings come from the caller (or environment variables), never
from source code.  Reads can be split over ``num_partitions`` ranges of a
numeric column so that a large table is not read by a single task.  Not
exercised in this repository's tests: no database is available here.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def connection_from_env(prefix: str = "RECOLAKE_DB_") -> dict:
    """url, user, password, driver from ``<prefix>URL`` etc. (unset ones omitted)."""
    out = {}
    for k in ("url", "user", "password", "driver"):
        v = os.environ.get(prefix + k.upper())
        if v:
            out[k] = v
    return out


def read_jdbc(spark: SparkSession, table: str, url: str, properties: dict | None = None,
              column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None, fetch_size: int = 10000) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if column is not None:
        r = (r.option("partitionColumn", column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 1))
    return r.load()


def _flatten_complex(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs become JSON text: JDBC has no such types."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_jdbc(df: DataFrame, table: str, url: str, properties: dict | None = None,
               mode: str = "errorifexists", batch_size: int = 1000) -> None:
    """Write a frame to a database table (default: fail if it exists).
    Every task writes its own partition in batches."""
    w = _flatten_complex(df).write.format("jdbc").option("url", url).option("dbtable", table) \
        .option("batchsize", batch_size).mode(mode)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def _connection(spark: SparkSession, url: str, properties: dict | None):
    """A driver-side connection for single statements."""
    props = spark._jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    if props.getProperty("driver"):
        spark._jvm.java.lang.Class.forName(props.getProperty("driver"))
    return spark._jvm.java.sql.DriverManager.getConnection(url, props)


def table_exists(spark: SparkSession, table: str, url: str, properties: dict | None = None) -> bool:
    """Whether the database's catalog lists the table (in any letter case)."""
    connection = _connection(spark, url, properties)
    try:
        names = connection.getMetaData().getTables(None, None, "%", None)
        while names.next():
            if names.getString("TABLE_NAME").lower() == table.split(".")[-1].lower():
                return True
        return False
    finally:
        connection.close()


def execute(spark: SparkSession, statement: str, url: str, properties: dict | None = None) -> int:
    """Run one statement from the driver; the rows it changed."""
    connection = _connection(spark, url, properties)
    try:
        return connection.createStatement().executeUpdate(statement)
    finally:
        connection.close()


def export_table(lakehouse, layer_name: str, source: str, sink: str, url: str,
                 properties: dict | None = None, mode: str = "errorifexists", date: str | None = None) -> None:
    """Copy a lakehouse table (optionally one date) to a database table."""
    write_jdbc(lakehouse.read(layer_name, source, date), sink, url, properties, mode)
