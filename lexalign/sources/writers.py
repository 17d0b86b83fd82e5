"""Tables to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.operators.artifacts import unique_names, upsert

__all__ = ["bundle", "export_flat", "export_list", "export_plan", "manifest", "markdown_lines", "upsert_artifacts", "write_json_lines", "write_lines", "write_version"]


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, path: str, ord: str = "ord", line: str = "line") -> None:
    """Lines in their order, as a folder of parts: a task writes each, and they follow each other by number."""
    df.repartitionByRange(ord).sortWithinPartitions(ord).select(F.col(line).alias("value")).write.mode("overwrite").text(path)


def write_version(df: DataFrame, root: str, stamp: str) -> str:
    """A new version beside the old ones, whole or not at all; returns its path."""
    path = f"{root.rstrip('/')}/version={stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path


def upsert_artifacts(old: DataFrame, new: DataFrame, path: str) -> None:
    upsert(old, new).write.mode("overwrite").parquet(path)


def manifest(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of a book (doc, paragraph_count, chunk_count, sha256), and its chunks in order (doc, ord, chunk_id, story_id,
    paragraph_ids) for chunks (doc, chunk, chunk_id, story_id, paragraphs)."""
    ids = F.transform("paragraphs", lambda p: p["id"])
    rows = chunks.select("doc", F.col("chunk").alias("ord"), "chunk_id", "story_id", ids.alias("paragraph_ids"), F.array_join(F.transform("paragraphs", lambda p: p["text"]), "\n").alias("_text"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("ord", F.sha2("_text", 256).alias("s")))), lambda x: x["s"])
    meta = rows.groupBy("doc").agg(F.sum(F.size("paragraph_ids")).alias("paragraph_count"), F.count("*").alias("chunk_count"), F.sha2(F.array_join(texts, "\n"), 256).alias("sha256"))
    return meta, rows.drop("_text")


def markdown_lines(paragraphs: DataFrame, level: int = 2) -> DataFrame:
    """(doc, ord, line): a heading where the story changes, and each paragraph with a blank line behind."""
    from pyspark.sql import Window as W

    order = W.partitionBy("doc").orderBy("paragraph")
    new = ~F.coalesce(F.col("story_id") == F.lag("story_id").over(order), F.lit(False))
    paragraphs = paragraphs.withColumn("_new", new)
    lines = F.concat(F.when(F.col("_new") & (X.empty(F.col("story_title")) != ""), F.array(F.concat(F.lit("#" * level + " "), "story_title"), F.lit(""))).otherwise(F.array().cast("array<string>")), F.array("text", F.lit("")))
    return paragraphs.select("doc", "paragraph", F.posexplode(lines).alias("at", "line")).select("doc", F.struct("paragraph", "at").alias("ord"), "line")


# Folders of the editions in a grouped export.
EDITION_FOLDERS = {("zh-main", "color"): "zh-main-color", ("zh-main", "blackwhite"): "zh-main-blackwhite", ("jp-main", "color"): "jp-main-color", ("jp-main", "blackwhite"): "jp-main-blackwhite"}


def export_plan(items: DataFrame, layout: str) -> DataFrame:
    """Items (book_id, direction, variant, title, path, size) with ``output_path``, where each goes in a target folder: ``flat``
    has all parts in the name, ``grouped`` a folder for each edition. Equal names are told apart by their book."""
    if layout not in ("flat", "grouped"):
        raise ValueError(f"unsupported layout: {layout}")
    if layout == "flat":
        path = X.file_name(F.col("book_id"), F.col("direction"), F.col("variant"), F.col("title"))
    else:
        folders = F.create_map(*[x for (d, v), name in EDITION_FOLDERS.items() for x in (F.lit(f"{d}/{v}"), F.lit(name))])
        path = F.concat(F.element_at(folders, F.concat_ws("/", "direction", "variant")), F.lit("/"), X.file_name(F.col("title")))
    rows = unique_names(items.withColumn("_path", path), "_path", "book_id", ["book_id", "direction", "variant", "title"])
    return rows.withColumnRenamed("name", "output_path").drop("_path")


def export_flat(items: DataFrame, targets: dict[str, str]) -> None:
    """Writes manifest and list of an export for each target (folder, layout). Copying the files is left to the caller, by ``path``
    and ``output_path``."""
    for folder, layout in targets.items():
        plan = export_plan(items, layout)
        plan.write.mode("overwrite").json(f"{folder}/manifest")
        write_lines(export_list(plan), f"{folder}/list")


def export_list(plan: DataFrame) -> DataFrame:
    """(ord, line): the items of an export as a table in Markdown."""
    row = F.format_string("| `%s` | `%s` | `%s` | `%s` |", "book_id", "direction", "variant", "output_path")
    rows = plan.select(F.struct(F.lit(1).alias("part"), "book_id", "direction", "variant", "title").alias("ord"), row.alias("line"))
    none = F.lit("")
    heads = [plan.sparkSession.range(1).select(F.struct(F.lit(0).alias("part"), F.lit(str(i)).alias("book_id"), none.alias("direction"), none.alias("variant"), none.alias("title")).alias("ord"), F.lit(x).alias("line")) for i, x in enumerate(("| Book | Direction | Variant | File |", "| --- | --- | --- | --- |"))]
    return heads[0].unionByName(heads[1]).unionByName(rows)


def bundle(sources: DataFrame, key: str = "book_id") -> DataFrame:
    """(book_id, sources): roles of a book's sources with language, hash, status and sizes, as one map."""
    entry = F.struct(*[c for c in sources.columns if c not in (key, "role")])
    return sources.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("role", entry.alias("entry"))))).alias("sources"))
