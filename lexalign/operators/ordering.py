"""Numbers over a whole table without a window over all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Ranges of the ordering column that are counted first.
RANGES = 1024


def numbered(rows: DataFrame, by: str, name: str) -> DataFrame:
    """Adds ``name``: 1, 2, … in the order of the numeric column ``by``, whose values must be distinct and not null.

    The column's span is cut into ranges; rows are numbered within a range, and the ranges' counts, a row for each, tell where
    each range begins. Values that lie very unevenly make ranges of unequal size, never a wrong number."""
    low, high = rows.agg(F.min(by)).scalar(), rows.agg(F.max(by)).scalar()
    place = F.floor((F.col(by) - low) * RANGES / (high - low + 1)).cast("int")
    cut = rows.withColumn("_range", place)
    counts = cut.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_range", before.alias("_before"))  # RANGES rows at most
    inside = F.row_number().over(W.partitionBy("_range").orderBy(by))
    return cut.withColumn("_inside", inside).join(F.broadcast(counts), "_range").withColumn(name, F.col("_before") + F.col("_inside")).drop("_range", "_before", "_inside")
