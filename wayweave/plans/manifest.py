"""Which keys a stage has finished, so that a second run leaves them unread.

A key is logged after its results are committed, also when it had none. The log is a small table of
its own, one appended file a run; what it says is applied to the list of keys before any input is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayweave.sources import layers

SHAPE = "stage string, tag int, key array<string>, at timestamp"


class Manifest:
    """Finished keys, tuples of texts, by stage and version tag under ``root``."""

    def __init__(self, spark: SparkSession, root: str, tag: int | None = None):
        self.spark, self.path, self.tag = spark, f"{root}/_finished", -1 if tag is None else tag

    def log(self) -> DataFrame:
        return self.spark.read.schema(SHAPE).parquet(self.path) if layers.exists(self.spark, self.path) else self.spark.createDataFrame([], SHAPE)

    def finished(self, stage: str) -> set[tuple[str, ...]]:
        """Keys of a stage: partition names, so few enough for the driver."""
        rows = self.log().filter((F.col("stage") == stage) & (F.col("tag") == self.tag)).select("key").distinct().collect()
        return {tuple(r.key) for r in rows}

    def pending(self, stage: str, keys: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
        done = self.finished(stage)
        return [k for k in keys if k not in done]

    def finish(self, stage: str, keys: list[tuple[str, ...]]) -> None:
        if keys:
            rows = self.spark.createDataFrame([(stage, self.tag, list(k)) for k in keys], "stage string, tag int, key array<string>")
            rows.coalesce(1).withColumn("at", F.current_timestamp()).write.mode("append").parquet(self.path)
