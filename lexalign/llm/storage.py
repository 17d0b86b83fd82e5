"""Where intermediate tables go: the shared folder that the session names, never a machine's own disk."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if its measured size is at most this; beyond it the join shuffles.
BROADCAST_BYTES = 48 << 20


#: Texts vary in length, so what goes to a Python worker at once is bounded by bytes and not by rows.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's bound on the bytes of an Arrow batch, unless it is lower already."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(name).rstrip("b"))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset and there is one machine only, as in tests, a temporary folder,
    set once; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="lexalign-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


class Scratch:
    """Written tables of one run. ``cut`` writes a DataFrame as Parquet and reads it back, which ends its lineage;
    ``drop`` deletes a table that no lazy result needs any more."""

    def __init__(self, spark: SparkSession, name: str):
        bounded_batches(spark)
        self.spark, self.root = spark, f"{shared_folder(spark)}/lexalign-{name}-{uuid.uuid4().hex}"
        self.count = 0

    def cut(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:03d}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            path = getattr(df, "_scratch_path", None)
            if path:
                jvm = self.spark._jvm
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def maybe_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df``, a table that was cut, with a broadcast hint if its counted rows, at ``row_bytes`` each, fit the limit, else
    unchanged for a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
