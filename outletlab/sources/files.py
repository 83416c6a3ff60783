"""File sources and sinks.

* partitioned Parquet scans where the partition values come from the
  country dimension (static list or a join -> dynamic partition pruning);
* delimited CSV with header and an explicit schema (no inference);
* newest file under a directory tree, listed by Spark (``binaryFile`` with the
  content column pruned), and loading the data set that file belongs to;
* CSV / Parquet / table sinks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def string_schema(columns) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_partitioned(spark: SparkSession, root: str, partition_column: str, values=None,
                     schema: StructType | None = None) -> DataFrame:
    """Read a ``column=value`` partitioned Parquet tree. A value list becomes a
    partition filter (only those directories are listed and read). Give a
    schema whose partition column is a string to keep codes such as '0526'
    intact (type inference would turn them into 526)."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(root)
    if values is not None:
        df = df.filter(F.col(partition_column).isin(list(values)))
    return df


def read_partitioned_by_dimension(spark: SparkSession, root: str, partition_column: str,
                                  dimension: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Rows of the partitions named by ``dimension`` (one column named
    ``partition_column``): a left-semi join on the partition column, which
    Spark turns into dynamic partition pruning of the scan."""
    from outletlab.plans.joins import BROADCAST_ROWS

    df = read_partitioned(spark, root, partition_column, schema=schema)
    keys = dimension.select(partition_column).distinct()
    if dimension.count() <= BROADCAST_ROWS:  # codes of countries
        keys = F.broadcast(keys)
    return df.join(keys, partition_column, "left_semi")


def read_paths(spark: SparkSession, paths, schema: StructType | None = None) -> DataFrame:
    """Several directories read as one relation (positional union of the
    original, done by the file source)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",",
             header: bool = True) -> DataFrame:
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("mode", "PERMISSIVE").csv(path))


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "errorifexists") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)
    return path


def file_listing(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, modificationTime, length) of every file under ``root``,
    recursively. Only file metadata is read (the content column is pruned)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "modificationTime", "length")


def latest_file(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """One row: the most recently modified file under ``root`` (ties: the
    greatest path) and its directory."""
    best = file_listing(spark, root, glob).agg(
        F.max(F.struct("modificationTime", "path")).alias("m"))
    return best.select(F.col("m.path").alias("path"),
                       F.col("m.modificationTime").alias("modificationTime"),
                       F.regexp_replace(F.col("m.path"), "/[^/]*$", "").alias("directory"))


def latest_dataset_directory(spark: SparkSession, root: str, glob: str | None = None) -> str:
    """Directory of the newest file: a one-row result needed on the driver
    because a reader takes a path."""
    try:
        row = latest_file(spark, root, glob).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    if row is None or row["path"] is None:
        raise FileNotFoundError(f"no file under {root}")
    return row["directory"]


def save_table(df: DataFrame, name: str, path: str, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as an external table at ``path`` (shared storage) and return
    the table read back, i.e. a plan with no lineage before it."""
    df.write.mode(mode).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int | None = None, mode: str = "overwrite") -> DataFrame:
    """``save_table`` dealt to ``buckets`` files by ``key`` (as many as the
    session's shuffles have partitions, if not given). Tables of one number of
    buckets are joined and grouped on the key without moving their rows."""
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(buckets, key).write.mode(mode).option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def load_latest_csv(spark: SparkSession, root: str, sep: str = ",") -> DataFrame:
    """The data set the newest file under ``root`` belongs to, read as CSV.
    Columns are strings named by the header, whatever their order, and a file
    whose header differs from the first one's is an error."""
    path = latest_dataset_directory(spark, root)
    named = spark.read.option("header", True).option("sep", sep).csv(path)  # reads one header, infers nothing
    return (spark.read.schema(string_schema(named.columns)).option("header", True).option("sep", sep)
            .option("enforceSchema", False).csv(path))
