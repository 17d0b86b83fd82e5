"""Chunks back to a nested book, in order of first appearance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.operators import tokens as K

LEVELS = ("section", "subsection", "story")


def outline(paragraphs: DataFrame) -> DataFrame:
    """(doc, level, id, title, first, paragraphs): nodes of all levels by first appearance, with the title first seen.

    ``paragraphs``: (doc, ord, section_id, section_title, subsection_id, subsection_title, story_id, story_title).
    """
    nodes = [F.struct(F.lit(i).alias("level"), F.concat_ws("/", *[f"{n}_id" for n in LEVELS[: i + 1]]).alias("id"), F.col(f"{level}_title").alias("title")) for i, level in enumerate(LEVELS)]
    rows = paragraphs.select("doc", "ord", F.explode(F.array(*nodes)).alias("n")).select("doc", "ord", "n.level", "n.id", "n.title")
    return rows.groupBy("doc", "level", "id").agg(F.min_by("title", "ord").alias("title"), F.min("ord").alias("first"), F.count("*").alias("paragraphs"))


def _nest(rows: DataFrame, keys: list[str], id: str, title: str, child: str) -> DataFrame:
    return rows.groupBy(*keys, id).agg(F.min("ord").alias("ord"), F.min_by(title, "ord").alias("title"), F.transform(F.array_sort(F.collect_list(F.struct("ord", "item"))), lambda x: x["item"]).alias(child)).withColumn("item", F.struct(F.col(id).alias("id"), "title", child))


def book(paragraphs: DataFrame, payload: str = "paragraph") -> DataFrame:
    """(doc, sections): paragraphs nested into stories, subsections and sections. A story that comes again later is continued
    where it first stood."""
    rows = paragraphs.withColumn("item", F.col(payload))
    keys = ["doc", "section_id", "subsection_id"]
    titles = paragraphs.groupBy("doc", "section_id").agg(F.min_by("section_title", "ord").alias("section_title"))
    subtitles = paragraphs.groupBy("doc", "section_id", "subsection_id").agg(F.min_by("subsection_title", "ord").alias("subsection_title"))
    rows = _nest(rows, keys, "story_id", "story_title", "paragraphs").drop("title", "paragraphs").join(subtitles, keys)
    rows = _nest(rows, ["doc", "section_id"], "subsection_id", "subsection_title", "stories").drop("title", "stories").join(titles, ["doc", "section_id"])
    rows = _nest(rows, ["doc"], "section_id", "section_title", "subsections")
    return rows.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "item"))), lambda x: x["item"]).alias("sections"))


def filtered(books: DataFrame, titles: list[str] | None = None, drop_notes: bool = False) -> DataFrame:
    """Books (…, sections) with the sections of the given Chinese titles only (all, if none is given), and without units that are
    an editor's note or blank if ``drop_notes``. Paragraphs, stories, subsections and sections of which nothing is left go as
    well, and a paragraph's source is that of its units."""
    from lexalign.operators.validate import note_unit

    def kept(u: Column) -> Column:
        zh, ja = K.surface(u["zh"]), K.lines_text(u["ja"])
        return ~note_unit(zh, ja, u["source_text"], u["corrected_text"]) & ((X.strip(zh) != "") | (X.strip(ja) != ""))

    def paragraph(p: Column) -> Column:
        units = F.coalesce(p["units"], F.array().cast(units_type))
        units = F.filter(units, kept) if drop_notes else units
        text = F.array_join(F.transform(units, lambda u: K.surface(u["zh"])), "")
        source = lambda name: F.when(text != "", text).otherwise(p[name])
        return p.withField("units", units).withField("source_text", source("source_text")).withField("corrected_text", source("corrected_text"))

    def pruned(node: Column, child: str, below) -> Column:
        return node.withField(child, F.filter(F.transform(node[child], below), lambda x: F.size(x[_CHILD[child]]) > 0))

    story = lambda y: pruned(y, "paragraphs", paragraph)
    subsection = lambda u: pruned(u, "stories", story)
    section = lambda s: pruned(s, "subsections", subsection)
    sections = books.schema["sections"].dataType.elementType
    units_type = sections["subsections"].dataType.elementType["stories"].dataType.elementType["paragraphs"].dataType.elementType["units"].dataType.simpleString()
    rows = F.col("sections")
    if titles:
        rows = F.filter(rows, lambda s: X.strip(K.surface(s["title_zh"])).isin(*titles))
    return books.withColumn("sections", F.filter(F.transform(rows, section), lambda s: F.size(s["subsections"]) > 0))


_CHILD = {"paragraphs": "units", "stories": "paragraphs", "subsections": "stories"}


def strict_order(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """Chunks that hold up an assembly: those without a result of the manifest's paragraphs."""
    from lexalign.operators.progress import status

    return status(manifest, results).where("status <> 'valid'")
