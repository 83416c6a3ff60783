"""Ingestion layer: read a curated table, clean its column names, stamp the
date of its last WRITE from its commit log, store it in the first layer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outletlab.functions.scalar import clean_column_name

UPDATED_DATE_COLUMN = "DATA_UPDATED_DATE"


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_column_name(c) for c in df.columns])


def last_write_time(log: DataFrame, write_operation: str = "WRITE", operation: str = "operation",
                    timestamp: str = "timestamp") -> DataFrame:
    """One row per operation with its newest timestamp, restricted to the
    write operation (a map-side-combined group-by over the log)."""
    per_op = log.groupBy(operation).agg(F.max(timestamp).alias("last_time"))
    return per_op.filter(F.col(operation) == write_operation)


def last_write_date(log: DataFrame, write_operation: str = "WRITE", **kw) -> Column:
    """Date of the last write as a scalar-subquery column (no driver trip)."""
    return last_write_time(log, write_operation, **kw).select(F.to_date("last_time")).scalar()


def load_stamped(table: DataFrame, log: DataFrame, write_operation: str = "WRITE",
                 column: str = UPDATED_DATE_COLUMN, **kw) -> DataFrame:
    """Curated table with clean column names and the date of its last write
    (in ``column``)."""
    return clean_column_names(table).withColumn(column, last_write_date(log, write_operation, **kw))


def bulk_load(loader: Callable[[str], DataFrame], names, log: DataFrame, write_operation: str = "WRITE",
              **kw) -> dict:
    """Lazy DataFrames for a list of objects, each loaded in full: clean
    column names and the date of the last write."""
    return {name: load_stamped(loader(name), log, write_operation, **kw) for name in names}


def layer_database_name(country: str, app: str, owner: str, layer: str) -> str:
    return f"{country}_db_prod_{app.lower()}_{owner}_{layer}"


def layer_path(mount: str, org: str, env: str, area: str, country: str) -> str:
    return f"{mount.rstrip('/')}/{org}/{env}/{area.strip('/')}/{country}/"


def write_layer(df: DataFrame, root: str, database: str, table: str, mode: str = "overwrite") -> DataFrame:
    """Store ``df`` under ``root`` as a table registered in ``database`` (made
    if it isn't there) and return the table."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    name = f"`{database}`.`{table}`"
    df.write.mode(mode).option("path", f"{root.rstrip('/')}/{database}/{table}").saveAsTable(name)
    return spark.table(name)
