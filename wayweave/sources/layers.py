"""Parquet layers: one file or a folder of parts, parts of unlike columns, resumable writes."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_layer(spark: SparkSession, path: str, columns: list[str] | None = None, **equal: str) -> DataFrame:
    """A layer with the columns asked for; keyword filters reach the scan or prune partitions."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    for name, value in equal.items():
        df = df.filter(F.col(name) == value)
    return df.select(*columns) if columns else df


def concat(parts: list[DataFrame]) -> DataFrame | None:
    """Rows of all parts by column name; missing columns are null. None without parts."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def write_layer(df: DataFrame, path: str, by: list[str], version: int | None = None) -> None:
    """Write partitioned; partitions that occur in ``df`` are replaced, others stay.

    Without ``by`` the whole layer is replaced. Files appear when the job commits; a job that
    fails in its commit can leave some partitions new and some old, so a key counts as done only
    by the manifest (``plans.manifest``). With ``version`` results of another version live under another folder.
    """
    where = path if version is None else f"{path}/version={version}"
    out = df.write.mode("overwrite")
    (out.option("partitionOverwriteMode", "dynamic").partitionBy(*by) if by else out).parquet(where)


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _files(spark, path)
    return files.exists(at)


def _folders(spark: SparkSession, path: str, column: str) -> dict[str, list[str]]:
    """Folders of each value of a partition column, the first or the second of the layer."""
    found: dict[str, list[str]] = {}
    for pattern in (f"{path}/{column}=*", f"{path}/*=*/{column}=*"):
        at, files = _files(spark, pattern)
        for status in files.globStatus(at) or []:
            folder = status.getPath().toString()
            found.setdefault(unquote(folder.rsplit(f"{column}=", 1)[1]), []).append(folder)
    return found


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from the names of the folders; no file is opened."""
    return sorted(_folders(spark, path, column))


def read_parts(spark: SparkSession, path: str, column: str, values: list) -> DataFrame:
    """A layer's partitions of the given values; other partitions are not listed or opened.

    Without any the layer is empty, with its columns.
    """
    folders = [f for v, fs in _folders(spark, path, column).items() if v in {str(x) for x in values} for f in fs]
    if not folders:
        return read_layer(spark, path).filter("false")
    return spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*folders)


def done_keys(spark: SparkSession, path: str, by: list[str], version: int | None = None) -> DataFrame | None:
    """Partition keys that have rows; None if nothing is written. ``plans.manifest`` also knows keys without rows."""
    where = path if version is None else f"{path}/version={version}"
    return spark.read.parquet(where).select(*by).distinct() if exists(spark, where) else None


def not_done(df: DataFrame, done: DataFrame | None, by: list[str]) -> DataFrame:
    """Rows whose key is not written yet."""
    if done is None:
        return df
    done = done.select(*[F.col(c).cast(dict(df.dtypes)[c]).alias(c) for c in by])
    return df.join(done, by, "left_anti")


def partition_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows by partition; no other column is read."""
    return df.groupBy(*by).agg(F.count("*").alias("n"))
