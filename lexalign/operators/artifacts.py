"""Annotated paragraphs by content: features, scores, reuse by hash, and editions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.operators import tokens as K

FEATURES = ("translation", "zh_ruby", "ja_ruby", "grammar")


def digest(c: Column) -> Column:
    """SHA-256 of a text without blanks."""
    return F.sha2(X.compact(c), 256)


def combined_digest(rows: DataFrame, keys: list[str], text: str, ord: str) -> DataFrame:
    """(keys, sha256): digest of the digests in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(ord).alias("o"), F.sha2(X.empty(F.col(text)), 256).alias("s")))), lambda x: x["s"])
    return rows.groupBy(*keys).agg(F.sha2(F.array_join(parts, "\n"), 256).alias("sha256"))


def han_read(tokens: Column) -> Column:
    """Whether each token with Chinese characters has a reading."""
    return F.forall(tokens, lambda x: ~X.has_han(x["t"]) | (X.empty(x["r"]) != ""))


def features(paragraphs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, translation, zh_ruby, ja_ruby, grammar, token_total, grammar_total, unit_count) of paragraphs with ``units``. All
    of nothing is false."""
    units = F.col("units")
    zh = F.transform(units, lambda u: u["zh"])
    ja = F.flatten(F.transform(units, lambda u: u["ja"]))
    every = F.filter(F.flatten(F.concat(zh, ja)), lambda x: X.strip(x["t"]) != "")
    with_role = F.size(F.filter(every, lambda x: X.empty(x["g"]) != ""))
    some = lambda a, test: (F.size(a) > 0) & F.forall(a, test)
    return paragraphs.select(
        *keys, some(units, lambda u: X.compact(K.lines_text(u["ja"])) != "").alias("translation"), some(zh, han_read).alias("zh_ruby"), some(ja, han_read).alias("ja_ruby"),
        ((F.size(every) > 0) & (F.size(every) == with_role)).alias("grammar"), F.size(every).alias("token_total"), with_role.alias("grammar_total"), F.size(units).alias("unit_count"),
    )


def score() -> Column:
    return sum((F.when(F.col(f), 1000).otherwise(0) for f in FEATURES), F.lit(0)) + F.coalesce(F.col("token_total"), F.lit(0))


def has_features(required: list[str]) -> Column:
    out = F.lit(True)
    for f in required:
        out = out & F.coalesce(F.col(f), F.lit(False))
    return out


def upsert(old: DataFrame, new: DataFrame, key: str = "para_id", sha: str = "sha", points: str = "score") -> DataFrame:
    """Artifacts after an export: an old one stays only if it has the same content and a higher score."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    fresh = F.max(F.when(F.col("_new") == 1, F.col(sha))).over(W.partitionBy(key))
    both = both.withColumn("_sha", fresh).withColumn("_same", (F.col("_sha").isNull() | (F.col(sha) == F.col("_sha"))).cast("int"))
    place = F.row_number().over(W.partitionBy(key).orderBy(F.desc("_same"), F.desc(points), F.desc("_new")))
    return both.withColumn("_place", place).where("_place = 1").drop("_new", "_sha", "_same", "_place")


def best(rows: DataFrame, keys: list[str], points: str = "score", newest: str = "ord") -> DataFrame:
    """Of each key the row with the most points, the newest if several have them."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(points), F.desc(newest)))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def hydrated(tasks: DataFrame, artifacts: DataFrame, required: list[str] | None = None) -> DataFrame:
    """(chunk_id, paragraphs, matched, state) for tasks (chunk_id, para_id, sha): full if all paragraphs have an artifact of
    the same content with the required features, none or partial otherwise."""
    good = artifacts.where(has_features(required)) if required else artifacts
    rows = tasks.join(good.select("para_id", "sha", F.lit(1).alias("_hit")).distinct(), ["para_id", "sha"], "left")
    out = rows.groupBy("chunk_id").agg(F.count("*").alias("paragraphs"), F.count("_hit").alias("matched"))
    return out.withColumn("state", F.when(F.col("matched") == F.col("paragraphs"), "full").when(F.col("matched") == 0, "none").otherwise("partial"))


def by_priority(tables: list[DataFrame], key: str, usable: Column | None = None) -> DataFrame:
    """For each key the row of the first table that has a usable one."""
    rows = None
    for i, table in enumerate(tables):
        table = (table if usable is None else table.where(usable)).withColumn("priority", F.lit(i))
        rows = table if rows is None else rows.unionByName(table)
    place = F.row_number().over(W.partitionBy(key).orderBy("priority"))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def editions(items: DataFrame, direction: str, variant: str) -> DataFrame:
    """One edition of each book: the wanted direction and variant, else a colour one, else the first in order."""
    place = F.row_number().over(W.partitionBy("book_id").orderBy(
        F.when((F.col("direction") == direction) & (F.col("variant") == variant), 0).otherwise(1), F.when(F.col("variant") == variant, 0).when(F.col("variant") == "color", 1).otherwise(2),
        F.when(F.col("direction") == direction, 0).otherwise(1), "direction", "variant", "title",
    ))
    return items.withColumn("_place", place).where("_place = 1").drop("_place")


def edition(items: DataFrame, book: str, direction: str, variant: str) -> DataFrame:
    return items.where((F.col("book_id") == book) & (F.col("direction") == direction) & (F.col("variant") == variant)).orderBy("title").limit(1)


def catalogue(items: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Items that are wanted, and wanted keys that no item has."""
    return items.join(wanted.select(key).distinct(), key, "left_semi"), wanted.select(key).distinct().join(items, key, "left_anti")


def unique_names(items: DataFrame, path: str, book: str, order: list[str]) -> DataFrame:
    """Adds ``name``: the path for the first item that has it; later ones add their book, and a number from 2 on where that book
    was added before."""
    rows = items.withColumn("_first", F.row_number().over(W.partitionBy(path).orderBy(*order)) == 1)
    rows = rows.withColumn("_again", F.row_number().over(W.partitionBy(path, book, "_first").orderBy(*order)))
    stem, suffix = F.regexp_replace(path, r"\.[^./]*$", ""), F.regexp_extract(path, r"(\.[^./]*)$", 1)
    number = F.when(F.col("_again") > 1, F.concat(F.lit("-"), F.col("_again").cast("string"))).otherwise("")
    return rows.withColumn("name", F.when(F.col("_first"), F.col(path)).otherwise(F.concat(stem, F.lit(" - "), F.col(book), number, suffix))).drop("_first", "_again")


def book_text_statistics(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, chapters, chars): headings of the second level, and characters without blanks and marks of Markdown."""
    plain = F.regexp_replace(X.compact(F.col(text)), r"[#\-*_>`|]+", "")
    return docs.select(key, F.regexp_count(X.empty(F.col(text)), F.lit(r"(?m)^## ")).alias("chapters"), F.length(plain).alias("chars"))
