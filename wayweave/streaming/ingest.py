"""Resumable ingest: new archives of a folder become features, once each.

A file stream with ``availableNow`` reads what has not been read; the checkpoint remembers it,
so a run that stops is taken up where it was. A batch that is stored again replaces what it has
stored before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayweave.sources import archives


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, item: list[str] | None = None) -> None:
    """Parse all new archives under ``folder`` into ``out``, partitioned by batch, ftype and mesh.

    Batches without any matching archive store nothing.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.zip").option("maxFilesPerTrigger", 64).load(folder)

    def store(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]  # 64 at most
        if not paths:
            return
        found = archives.select_members(archives.discover(spark, *paths, required=False), item=item)
        parsed = archives.parse_features(archives.read_members(spark, found, *paths))
        mesh = F.regexp_extract("member", archives.VECTOR_PARTS, 1)
        told = parsed.withColumns({"batch": F.lit(number), "mesh": mesh})
        told.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "ftype", "mesh").parquet(out)

    query = files.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
