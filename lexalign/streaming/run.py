"""Streams over what there is now, as tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder where the session's checkpoints go; on one machine without such a setting a temporary one, and on a cluster an
    error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="lexalign-")
    return f"{root}/stream-{uuid.uuid4().hex}"


def drained(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    """The rows that a stream gives for all there is now, written by its sink and read back."""
    root = folder(spark)
    stream.writeStream.format("parquet").outputMode(mode).option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")
