"""Batch readers: dimension tables, one day of a table, SQL over a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillstream.operators.dims import CHANGED, changes_schema
from tillstream.sinks.tables import read_keyed


def query_table(spark: SparkSession, sql: str, jdbc: dict[str, str] | None = None) -> DataFrame:
    """Rows of a SQL text, columns named and typed by its result: over registered tables, or
    pushed whole to a database when connection options are given. ``jdbc`` may name
    ``partitionColumn``, bounds and ``numPartitions`` to read in parallel."""
    if jdbc is None:
        return spark.sql(sql)
    options = dict(jdbc)
    if "partitionColumn" in options:
        options["dbtable"] = f"({sql}) q"
    else:
        options["query"] = sql
    return spark.read.format("jdbc").options(**options).load()


def rows_as_json(rows: DataFrame) -> DataFrame:
    """Each row as JSON text, column name to value."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("row"))


def read_dim(spark: SparkSession, path: str, schema: T.StructType,
             keys: tuple[str, ...] = ("id",), only: DataFrame | None = None) -> DataFrame:
    """Current rows of a keyed dimension table, or of the keys in ``only``. Call it inside
    ``foreachBatch``: a DataFrame made before the stream started would not see later rows."""
    return read_keyed(spark, path, schema, keys, only)


def read_changed_dim(spark: SparkSession, path: str, schema: T.StructType,
                     keys: tuple[str, ...] = ("id",), only: DataFrame | None = None) -> DataFrame:
    """Live rows of a dimension table that knows deletes: per key the last change, unless that deletes."""
    rows = read_keyed(spark, path, changes_schema(schema), keys, only, latest=CHANGED)
    return rows.where(~F.col("deleted")).select(*schema.names)


def read_day(table: DataFrame, date: str) -> DataFrame:
    """One day of a table partitioned by ``dt``; only its folders are listed and read."""
    return table.where(F.col("dt") == date)
