"""Paragraphs to chunks within a size, and oversized paragraphs to parts that join to the same text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.operators.kernels import pack_islands

PATH = ("section_id", "subsection_id", "story_id")


def islands(rows: DataFrame, doc: str, ord: str, *path: str) -> DataFrame:
    """Adds ``island``: a number that rises whenever a row's path differs from the row's before."""
    order = W.partitionBy(doc).orderBy(ord)
    changed = ~F.coalesce(F.struct(*path) == F.lag(F.struct(*path)).over(order), F.lit(False))
    return rows.withColumn("island", F.sum(changed.cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))


def chunks(paragraphs: DataFrame, max_chars: int, mode: str = "size", path: tuple[str, ...] = PATH) -> DataFrame:
    """(doc, chunk, chunk_id, paragraph, size) for a table (doc, paragraph, text, path).

    ``size``: a chunk closes when the path changes or the next paragraph would pass ``max_chars``; one larger than that
    stands alone. ``paragraph``: each is a chunk.
    """
    if mode not in ("size", "paragraph"):
        raise ValueError(f"unknown chunk mode: {mode}")
    rows = paragraphs.withColumn("size", F.length("text").cast("long"))
    if mode == "paragraph":
        packed = rows.select("doc", "size", F.col("paragraph").alias("first"), "paragraph")
    else:
        rows = islands(rows, "doc", "paragraph", *path).withColumn("ord", F.col("paragraph"))
        packed = pack_islands(rows, ["doc", "island"], max_chars)
        packed = packed.select("doc", "size", F.min("ord").over(W.partitionBy("doc", "island", "pack")).alias("first"), F.col("ord").alias("paragraph"))
    packed = packed.withColumn("chunk", F.dense_rank().over(W.partitionBy("doc").orderBy("first")))
    return packed.select("doc", "chunk", F.format_string("%s-chunk-%04d", F.col("doc").cast("string"), F.col("chunk")).alias("chunk_id"), "paragraph", "size")


def chunk_table(paragraphs: DataFrame, dealt: DataFrame) -> DataFrame:
    """A row for each chunk: the path of its first paragraph, and its paragraphs in order."""
    rows = dealt.drop("size").join(paragraphs, ["doc", "paragraph"])
    names = ["id", "section_id", "section_title", "subsection_id", "subsection_title", "story_id", "story_title", "story_index", "text"]
    nested = F.transform(F.array_sort(F.collect_list(F.struct("paragraph", *names))), lambda x: F.struct(*[x[n].alias(n) for n in names]))
    out = rows.groupBy("doc", "chunk", "chunk_id").agg(nested.alias("paragraphs"))
    return out.select("doc", "chunk", "chunk_id", *[F.col("paragraphs")[0][n].alias(n) for n in names[1:8]], "paragraphs")


def with_metadata(chunks: DataFrame, metadata: dict) -> DataFrame:
    """Book metadata as columns, empty values left out."""
    return chunks.withColumns({k: F.lit(v) for k, v in metadata.items() if v})


def packed(pieces: Column, most: int) -> Column:
    """Pieces joined as long as ``most`` characters hold them."""
    last = lambda acc: F.element_at(acc, -1)

    def step(acc: Column, x: Column) -> Column:
        fits = (F.size(acc) > 0) & (F.length(last(acc)) + F.length(x) <= most)
        fits = fits | ((F.size(acc) > 0) & (last(acc) == ""))
        return F.when(fits, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.concat(last(acc), x)))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(pieces, F.array().cast("array<string>"), step)


def pieces(c: Column, ends: str) -> Column:
    """Text cut behind each of the characters ``ends``; a text without any is one piece."""
    found = F.regexp_extract_all(c, F.lit(rf"(?s).+?(?:[{ends}]|\z)"), F.lit(0))
    return F.when(F.size(found) > 0, found).otherwise(F.array(c))


def split_text(c: Column, most: int) -> Column:
    """Parts of ``most`` characters at most: whole sentences if they fit, else clauses, else cuts. A closing bracket that
    would begin a part goes back to the one before."""
    hard = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.length(x) - 1) / most).cast("int")), lambda i: F.substring(x, i * most + 1, F.lit(most)))
    soft = lambda x: F.flatten(F.transform(packed(pieces(x, "，、,"), most), lambda y: F.when(F.length(y) <= most, F.array(y)).otherwise(hard(y))))
    parts = F.flatten(F.transform(packed(pieces(c, "。！？；;"), most), lambda x: F.when(F.length(x) <= most, F.array(x)).otherwise(soft(x))))
    parts = F.filter(parts, lambda x: x != "")
    lead = lambda x: F.regexp_extract(x, r"(?U)^(\s*〉\s*)", 1)
    own = lambda x, i: F.when(i == 0, x).otherwise(F.substring(x, F.length(lead(x)) + 1, F.length(x)))
    moved = F.transform(parts, lambda x, i: F.concat(own(x, i), F.coalesce(lead(F.get(parts, i + 1)), F.lit(""))))
    return F.filter(moved, lambda x: x != "")


def split_oversized(chunks: DataFrame, most: int) -> DataFrame:
    """Chunks (chunk_id, paragraph_id, text) of one paragraph, those over ``most`` characters in parts. The first part keeps
    the chunk's id, all parts number their paragraph. Parts that wouldn't join to the text leave the chunk whole."""
    parts = split_text(F.col("text"), most)
    rows = chunks.withColumn("_parts", F.when(F.length("text") > most, parts))
    good = (F.size("_parts") > 1) & (F.array_join("_parts", "") == F.col("text"))
    rows = rows.withColumn("_cut", F.coalesce(good, F.lit(False))).withColumn("_parts", F.when(F.col("_cut"), F.col("_parts")).otherwise(F.array("text")))
    rows = rows.select("*", F.posexplode("_parts").alias("_at", "_part"))
    suffix = F.format_string("-part-%02d", F.col("_at") + 1)
    return rows.select(
        F.when(F.col("_cut") & (F.col("_at") > 0), F.concat("chunk_id", suffix)).otherwise(F.col("chunk_id")).alias("chunk_id"),
        F.when(F.col("_cut"), F.concat("paragraph_id", suffix)).otherwise(F.col("paragraph_id")).alias("paragraph_id"), F.col("_part").alias("text"),
        F.when(F.col("_cut"), F.col("chunk_id")).alias("split_from_chunk_id"), F.when(F.col("_cut"), F.col("_at") + 1).alias("split_part"), F.when(F.col("_cut"), F.size("_parts")).alias("split_part_count"),
        *[c for c in chunks.columns if c not in ("chunk_id", "paragraph_id", "text", "split_from_chunk_id", "split_part", "split_part_count")],
    )


def merge_parts(chunks: DataFrame, doc: str = "doc", ord: str = "ord") -> DataFrame:
    """(doc, chunk_id, paragraph_id, text, ord): parts of one origin that follow each other in a document are one chunk again."""
    rows = chunks.withColumn("_key", F.coalesce("split_from_chunk_id", F.concat(F.lit("#"), F.col(ord).cast("string"))))
    rows = islands(rows, doc, ord, "_key")
    first = F.min_by(F.struct("paragraph_id", "chunk_id"), F.col(ord))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("split_part", F.lit(0)).alias("p"), F.col(ord).alias("o"), F.col("text").alias("text")))), lambda x: x["text"]), "")
    out = rows.groupBy(doc, "island", "_key").agg(F.min(ord).alias("ord"), first.alias("_first"), F.max("split_from_chunk_id").alias("_from"), text.alias("text"))
    part = F.col("_from").isNotNull()
    return out.select(doc, F.when(part, F.col("_from")).otherwise(F.col("_first.chunk_id")).alias("chunk_id"), F.when(part, X.strip_part(F.col("_first.paragraph_id"))).otherwise(F.col("_first.paragraph_id")).alias("paragraph_id"), "text", "ord")


def selected(chunks: DataFrame, first: int = 1, last: int | None = None, most: int | None = None) -> DataFrame:
    """Chunks by ordinal from 1, at most ``most`` of them."""
    rows = chunks.where(F.col("ord") >= first)
    rows = rows.where(F.col("ord") <= last) if last is not None else rows
    return rows.orderBy("ord").limit(most) if most is not None else rows


def shard(chunks: DataFrame, index: int, count: int) -> DataFrame:
    return chunks.where(F.pmod("ord", F.lit(count)) == index)


def prune(chunks: DataFrame, patterns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Chunks that match none of the patterns, and those that match any."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.coalesce(F.col("text").rlike(p), F.lit(False))
    return chunks.where(~hit), chunks.where(hit)


def pruned_bases(kept: DataFrame, gone: DataFrame) -> DataFrame:
    """Paragraphs, parts taken together, of which nothing is kept."""
    base = lambda df: df.select(X.strip_part(F.col("paragraph_id")).alias("base")).distinct()
    return base(gone).join(base(kept), "base", "left_anti")


def context(chunks: DataFrame, group: list[str], width: int = 2) -> DataFrame:
    """Adds ``before`` and ``after``: the texts of up to ``width`` neighbours of the group, in order."""
    order = W.partitionBy(*group).orderBy("ord")
    return chunks.withColumn("before", F.collect_list("text").over(order.rowsBetween(-width, -1))).withColumn("after", F.collect_list("text").over(order.rowsBetween(1, width)))
