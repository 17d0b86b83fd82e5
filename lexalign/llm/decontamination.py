"""Benchmark decontamination: a prefix-filtered set join of documents with item-sized windows. DataFrame operations only.

A window is a run of words of an item. It occurs in a document only if all its shingles do, so one shingle of each window is
prefix enough: the rarest in the documents, counted over all of them. Documents meet windows by that shingle; the offset of
the shingle in the window and the lengths of both bound the place, and the words are then compared one by one. Windows whose
rarest shingle occurs nowhere never reach the join.

The windows are broadcast in blocks of a checked size, and documents are read once for each block, so a document's words are
never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.llm.storage import Scratch, maybe_broadcast

WINDOW = 10
SHINGLE = 5
#: Windows broadcast at once at most; one has WINDOW words, a few numbers and the ids of its items.
BLOCK = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, letters and non-ASCII characters after A-Z are lower-cased; none for null."""
    text = F.coalesce(text, F.lit(""))
    lower = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lower, SEPARATORS), "")


def shingle(words: Column, at: Column, k: int) -> Column:
    """Key of the k words from ``at``, null where there are fewer."""
    return F.when(at + k <= F.size(words), F.xxhash64(F.lit(k), *[F.get(words, at + i) for i in range(k)]))


def windows(items: DataFrame, length: int, k: int) -> DataFrame:
    """(window, words, k, items): distinct windows with the ids of their items; a shorter item is one window."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text").cast("string")).alias("w")).where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - length, F.lit(0))))
    rows = rows.select("item_id", "w", starts.alias("s")).select("item_id", F.slice("w", F.col("s") + 1, length).alias("words"))
    rows = rows.groupBy("words").agg(F.collect_set("item_id").alias("items"))
    return rows.select(F.monotonically_increasing_id().alias("window"), "words", F.least(F.size("words"), F.lit(k)).alias("k"), "items")


def _each_shingle(wins: DataFrame, ks: list[int]) -> DataFrame:
    """(window, offset, key) of all shingles of windows."""
    out = []
    for k in ks:
        part = wins.where(F.col("k") == k).select("window", "words", F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("offset"))
        out.append(part.select("window", "offset", shingle(F.col("words"), F.col("offset"), k).alias("key")))
    return reduce(DataFrame.unionByName, out)


def _positions(docs: DataFrame, ks: list[int], columns: list[str]) -> DataFrame:
    """A row for each place of a word and shingle size, and one behind the last word, with a null key."""
    rows = docs.select(*columns, words(F.col("text")).alias("w"))
    rows = rows.select(*columns, "w", F.posexplode(F.concat("w", F.array(F.lit(None).cast("string")))).alias("at", "_word"))
    if len(ks) == 1:
        return rows.withColumn("key", shingle(F.col("w"), F.col("at"), ks[0]))
    keys = F.array_distinct(F.array(*[shingle(F.col("w"), F.col("at"), k) for k in ks]))
    return rows.withColumn("key", F.explode(keys))


def rarest(docs: DataFrame, wins: DataFrame, ks: list[int], scratch: Scratch, block: int) -> DataFrame:
    """(window, offset, key): of each window that may occur, the shingle with the fewest occurrences in ``docs``."""
    every = scratch.cut(_each_shingle(wins, ks))
    keys = scratch.cut(every.groupBy("key").agg(F.first("key").alias("same")).select("key"))
    counts = []
    for part in _split(keys, keys.count(), 8 * block):
        counts.append(_positions(docs, ks, []).join(F.broadcast(part), "key").groupBy("key").agg(F.count("*").alias("n")))
    counts = scratch.cut(reduce(DataFrame.unionByName, counts))
    known = every.join(counts, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    least = known.groupBy("window").agg(F.min(F.struct("n", "offset", "key")).alias("least"))
    return least.where("least.n > 0").select("window", "least.offset", "least.key")


def _split(table: DataFrame, count: int, most: int) -> list[DataFrame]:
    """Parts of about ``most`` rows at most, by hash of the first column."""
    n = max(1, -(-count // most))
    part = F.pmod(F.xxhash64(table.columns[0]), F.lit(n))
    return [table.where(part == i) for i in range(n)] if n > 1 else [table]


def matches(spark: SparkSession, docs: DataFrame, items: DataFrame, length: int = WINDOW, k: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """(row, doc_id, n_words, spans, items): per document row the distinct places (start, length) where windows occur, and
    the ids of their items."""
    scratch = Scratch(spark, "decontamination")
    docs = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wins = scratch.cut(windows(items, length, k))
    ks = sorted(r.k for r in wins.select("k").distinct().collect()) or [k]  # k of them at most
    prefix = scratch.cut(rarest(docs, wins, ks, scratch, block).join(wins, "window").select("key", "offset", "words", "items"))
    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    start, size = F.col("at") - F.col("offset"), F.size("words")
    found = F.col("offset").isNotNull() & (start >= 0) & (start + size <= F.size("w")) & (F.slice("w", F.greatest(start, F.lit(0)) + 1, size) == F.col("words"))
    rows = []
    for i, part in enumerate(_split(prefix, prefix.count(), block)):
        end = F.col("at") == F.size("w")
        at = _positions(numbered, ks, ["row", "doc_id"]).join(F.broadcast(part), "key", "left" if i == 0 else "inner")
        at = at.where(end | found) if i == 0 else at.where(found)
        rows.append(at.select("row", "doc_id", F.when(end, F.col("at")).alias("n"), F.when(found, F.struct(start.alias("start"), size.alias("size"))).alias("span"), F.when(found, F.col("items")).alias("items")))
    rows = reduce(DataFrame.unionByName, rows)
    return rows.groupBy("row", "doc_id").agg(F.max("n").cast("long").alias("n_words"), F.collect_set("span").alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame, length: int = WINDOW, k: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated), a row for each row of ``docs``.

    A word is hit if it lies in any occurrence of a window of ``length`` item words; an item of fewer words, but not none,
    is one window. Null and wordless texts have no words and are clean. Items without words have no windows; items with a
    null id hit words but are not listed; rows of one id are one item. Repeated rows each get their result. Other columns
    are ignored. Without items all documents are clean; without documents the result is empty.
    """
    rows = matches(spark, docs, items, length, k, block)
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    end = lambda x: x["start"] + x["size"]
    step = lambda acc, x: F.struct(F.greatest(acc["end"], end(x)).alias("end"), (acc["n"] + F.greatest(F.lit(0), end(x) - F.greatest(acc["end"], x["start"]))).cast("long").alias("n"))
    rows = rows.withColumn("n_hit", F.aggregate(F.array_sort("spans"), zero, step)["n"]).withColumn("items", F.array_sort("items"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))


def keep_clean(spark: SparkSession, docs: DataFrame, items: DataFrame, length: int = WINDOW, k: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """``docs`` without the rows that :func:`decontaminate` finds contaminated. Rows are told apart by doc_id and text; null
    and wordless texts stay. An empty table gives an empty result. All columns stay, whatever their names."""
    scratch = Scratch(spark, "clean")
    key = F.xxhash64("doc_id", "text")
    found = decontaminate(spark, docs.select(key.alias("doc_id"), "text"), items, length, k, block)
    name = "key"
    while name in docs.columns:
        name = f"_{name}"
    gone = scratch.cut(found.where("contaminated").select(F.col("doc_id").alias(name)).distinct())
    return docs.withColumn(name, key).join(maybe_broadcast(gone, 24), name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[s:s + 9], ' ') AS win
  FROM (SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS s FROM b WHERE len(words) > 0)),
place AS (
  SELECT doc_id, s, n, array_to_string(words[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS s FROM w, (SELECT DISTINCT n FROM win) WHERE len(words) >= n)),
occ AS (SELECT doc_id, s, place.n, item_id FROM place JOIN win ON place.win = win.win AND place.n = win.n),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS pos FROM occ) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
