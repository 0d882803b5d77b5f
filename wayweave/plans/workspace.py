"""Intermediate tables in the cluster's shared folder.

A table saved here cuts lineage and survives lost executors, since every executor sees the
folder that ``spark.checkpoint.dir`` names. A folder of our own is used only where the
setting is missing, as in local tests.
"""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="wayweave-")
    return _own[app]


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Hand rows to Python in Arrow batches of at most ``rows``, as whole texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Workspace:
    """Saves tables under one folder; ``drop`` removes those that are no longer read."""

    def __init__(self, spark: SparkSession, what: str, release: bool = True):
        self.spark, self.release = spark, release
        self.root = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a reader of what was written.

        Spark removes the shuffle files of a plan when the driver's JVM finds it unreferenced, which
        may never happen in a small job. With ``release`` the JVM is asked to look, so that disk
        holds one step's; rounds of small tables do without. It is asked before the write, as Spark
        holds a plan for a moment after its end.
        """
        path = f"{self.root}/{name}"
        if self.release:
            self.spark._jvm.System.gc()
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def settle(self, seconds: float = 1.5) -> None:
        """Let Spark remove the shuffle files of a large save before the next one."""
        time.sleep(seconds)
        self.spark._jvm.System.gc()
        time.sleep(seconds)

    def save_and_tell(self, df: DataFrame, name: str, **what: Column) -> tuple[DataFrame, dict]:
        """``save``, and the values of aggregates over the rows, taken while they are written."""
        told = Observation()
        saved = self.save(df.observe(told, *[c.alias(k) for k, c in what.items()]), name)
        return saved, told.get

    def all_of(self, pattern: str, like: DataFrame) -> DataFrame:
        """The rows of all saved tables whose names match, in one scan; their columns are those of ``like``."""
        return self.spark.read.schema(like.schema).parquet(f"{self.root}/{pattern}")

    def drop(self, *names: str) -> None:
        """Remove saved tables."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            fs.delete(path, True)
