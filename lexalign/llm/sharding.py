"""Sharding by extendible hashing.

A document's hash is read from its first bit; a shard is a node of the directory, named by the bits that lead to it. A bucket
over its byte limit splits on the next bit and any other stays, so that a document's depth is the smallest at which the
documents that share its bits fit. Sizes are first summed in cells of a few bits more than an even spread would need, and
each turn carries on with the cells of oversized buckets only. Where even a cell is too large, its documents alone are cut
into finer cells. Behind the bits of the key come those of the row's number, so that a key with any number of rows splits as
well; a bucket that is too large behind all bits is one document, and is marked.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.llm.storage import Scratch

#: Bytes of text in a shard: what one reader takes in a moment, and few enough for small tables to split.
LIMIT = 1 << 20
BITS = 60
#: Bits of a cell beyond those that an even spread needs, and bits by which oversized cells are cut finer.
SPARE, FINER = 3, 10


def key_bits(key: Column) -> Column:
    """60 bits of the key's MD5, as a number; a null key's are those of the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def row_bits(row: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(row), 64 - BITS)


def _depths(rows: DataFrame, group: str, bits: str, first: int, limit: int, scratch: Scratch) -> DataFrame:
    """(group, depth, prefix) of the shards: buckets that fit ``limit`` while the one above doesn't; at depth 60 all."""
    done: list[DataFrame] = []
    at, cell = 0, min(first, BITS)
    open_ = rows
    while True:
        cells = open_.groupBy(group, F.shiftright(bits, BITS - cell).alias("cell")).agg(F.sum("bytes").alias("bytes"))
        cells = scratch.cut(cells)
        depth = at
        while True:
            prefix = F.shiftright("cell", cell - depth)
            sizes = cells.groupBy(group, prefix.alias("prefix")).agg(F.sum("bytes").alias("bytes"))
            fits = F.col("bytes") <= limit if depth < BITS else F.lit(True)
            level = scratch.cut(sizes.select(group, F.lit(depth).alias("depth"), "prefix", "bytes", fits.alias("fits")))
            done.append(level.where("fits").select(group, "depth", "prefix", "bytes"))
            over = level.where("NOT fits").select(group, "prefix")
            left = over.count()
            if not left or depth == cell:
                break
            cells = cells.withColumn("prefix", prefix).join(over, [group, "prefix"], "left_semi").drop("prefix")
            depth += 1
        if not left or depth == BITS:
            return reduce(DataFrame.unionByName, done)
        # what is left are whole cells: their rows get finer ones
        over = over.withColumnRenamed("prefix", "cell")
        open_ = open_.withColumn("cell", F.shiftright(bits, BITS - cell)).join(over, [group, "cell"], "left_semi").drop("cell")
        at, cell = depth + 1, min(BITS, cell + FINER)


def _assign(rows: DataFrame, leaves: DataFrame, group: str, bits: str) -> DataFrame:
    """Rows with the depth and prefix of their shard. Joins by each depth at once: a row meets one leaf only."""
    depths = sorted(r.depth for r in leaves.select("depth").distinct().collect())  # 61 at most
    tries = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), F.shiftright(bits, BITS - d).alias("prefix")) for d in depths])) if depths else F.explode(F.array().cast("array<struct<depth:int,prefix:bigint>>"))
    return rows.withColumn("try", tries).select("*", "try.depth", "try.prefix").drop("try").join(leaves.withColumnRenamed("bytes", "shard_bytes"), [group, "depth", "prefix"])


def shard(spark: SparkSession, docs: DataFrame, limit: int = LIMIT, key: str = "doc_id") -> DataFrame:
    """(doc_id, shard, depth, n_bytes, oversize): each row's shard, named by its bits, and the bytes of its text.

    Rows of a shard have ``limit`` bytes of UTF-8 text together at most, but for a row that alone has more (``oversize``). A
    null or empty text has none. Rows with a null key share the hash of an empty one. Rows of one key, repeated rows among
    them, share 60 bits and split on those of their number if they must. Other columns are ignored. An empty table gives an
    empty result; with no bytes at all there is one shard with an empty name.
    """
    scratch = Scratch(spark, "sharding")
    rows = docs.select(F.col(key).alias(key), F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("bytes"))
    rows = scratch.cut(rows.withColumn("bits", key_bits(F.col(key))).withColumn("zero", F.lit(0).cast("long")))
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    first = max(0, ceil(log2(max(1, total / limit)))) + SPARE
    leaves = _depths(rows, "zero", "bits", first, limit, scratch)
    placed = _assign(rows, leaves, "zero", "bits")
    name = lambda depth, prefix: F.when(depth > 0, F.lpad(F.bin(prefix), depth, "0")).otherwise(F.lit(""))
    small = placed.where(F.col("shard_bytes") <= limit).select(F.col(key).alias("doc_id"), name(F.col("depth"), F.col("prefix")).alias("shard"), F.col("depth").cast("int").alias("depth"), F.col("bytes").alias("n_bytes"), F.lit(False).alias("oversize"))
    if not leaves.where(F.col("bytes") > limit).limit(1).count():
        return small
    # one key has more than a shard holds: the bits of the row's number in a written table follow
    large = scratch.cut(placed.where(F.col("shard_bytes") > limit).select(key, "bytes", "bits"))
    large = scratch.cut(large.withColumn("more", row_bits(F.monotonically_increasing_id())))
    leaves = _depths(large, "bits", "more", first, limit, scratch)
    placed = _assign(large, leaves, "bits", "more")
    long_name = F.concat(F.lpad(F.bin("bits"), BITS, "0"), name(F.col("depth"), F.col("prefix")))
    return small.unionByName(placed.select(F.col(key).alias("doc_id"), long_name.alias("shard"), (F.col("depth") + BITS).cast("int").alias("depth"), F.col("bytes").alias("n_bytes"), (F.col("shard_bytes") > limit).alias("oversize")))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def sql(limit: int = LIMIT) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
level AS (SELECT unnest(generate_series(0, 40)) AS depth),
size AS (SELECT depth, h >> (60 - depth) AS prefix, sum(n_bytes) AS bytes FROM d, level GROUP BY 1, 2),
leaf AS (
  SELECT h, doc_id, n_bytes, min(size.depth) AS depth FROM d, size
  WHERE h >> (60 - size.depth) = prefix AND bytes <= {limit} GROUP BY 1, 2, 3)
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> (60 - depth)), CAST(depth AS INTEGER), '0') END AS shard, CAST(depth AS INTEGER) AS depth, CAST(n_bytes AS BIGINT) AS n_bytes, false AS oversize
FROM leaf
"""
