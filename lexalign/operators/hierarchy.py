"""Lines of a document to its hierarchy: headings carried forward, blocks, sections and slices.

A table of lines is (doc, ord, line). Windows are partitioned by document, so a document is the largest group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexalign.functions import text as X

HEADING = r"^(#{1,6})(?U)\s+(.*)$"
#: Position in front of any heading.
FRONT, FRONT_TITLE = "front", "前言"


def document_lines(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, ord, line): the lines of each text from 0."""
    return docs.select(F.col(doc).alias("doc"), F.posexplode(X.lines(F.col(text))).alias("ord", "line"))


def by_order(*keys: str) -> W:
    return W.partitionBy(*(keys or ("doc",))).orderBy("ord")


def so_far(*keys: str) -> W:
    return by_order(*keys).rowsBetween(W.unboundedPreceding, 0)


def with_headings(lines: DataFrame) -> DataFrame:
    """Adds ``level`` (null for no heading) and ``title``."""
    level = F.length(F.regexp_extract("line", HEADING, 1))
    return lines.withColumn("level", F.when(level > 0, level)).withColumn("title", F.when(level > 0, X.strip(F.regexp_extract("line", HEADING, 2))))


def blocks(lines: DataFrame, boundary: Column) -> DataFrame:
    """Lines that are no boundary, with the number of their block in the document from 1."""
    marked = lines.withColumn("_cut", boundary)
    first = ~F.col("_cut") & F.coalesce(F.lag("_cut").over(by_order()), F.lit(True))
    return marked.withColumn("block", F.sum(first.cast("int")).over(so_far())).where("NOT _cut").drop("_cut")


def joined_blocks(lines: DataFrame, boundary: Column, glue: str = "\n") -> DataFrame:
    """(doc, block, text): the text of each block in order."""
    rows = F.array_sort(F.collect_list(F.struct("ord", "line")))
    return blocks(lines, boundary).groupBy("doc", "block").agg(F.array_join(F.transform(rows, lambda x: x["line"]), glue).alias("text"))


def paragraphs(lines: DataFrame) -> DataFrame:
    """(doc, paragraph, id, section_id, section_title, subsection_id, subsection_title, story_id, story_title, story_index,
    text): paragraphs of Markdown with the headings above them.

    H1 starts a section and drops the subsection, H2 starts a subsection, and every heading starts a story. Blank lines and
    headings end a paragraph; its lines are joined by a space. Text before any heading is front matter.
    """
    rows = with_headings(lines).withColumn("body", F.col("level").isNull() & (X.strip(F.col("line")) != ""))
    starts = F.col("body") & ~F.coalesce(F.lag("body").over(by_order()), F.lit(False))
    rows = rows.withColumn("paragraph", F.sum(starts.cast("int")).over(so_far()))
    rows = rows.withColumn("story_index", F.count("level").over(so_far()).cast("int"))
    follows = (F.col("paragraph") + 1).cast("string")
    section = F.when(F.col("level") == 1, F.struct(X.slug(F.col("title"), F.concat(F.lit("section-"), follows)).alias("id"), F.col("title")))
    none = F.struct(F.lit(FRONT).alias("id"), F.lit(FRONT_TITLE).alias("title"))
    rows = rows.withColumn("section", F.coalesce(F.last(section, True).over(so_far()), none))
    subsection = F.when(F.col("level") == 1, F.struct(F.lit("main").alias("id"), F.lit("").alias("title"))).when(F.col("level") == 2, F.struct(X.slug(F.col("title"), F.concat(F.lit("subsection-"), follows)).alias("id"), F.col("title")))
    rows = rows.withColumn("subsection", F.coalesce(F.last(subsection, True).over(so_far()), F.struct(F.lit(FRONT).alias("id"), F.lit("").alias("title"))))
    own = X.slug(F.col("title"), F.concat(F.lit("chapter-"), F.col("story_index").cast("string")))
    path = F.when(F.col("level") == 1, F.concat_ws("-", "section.id", F.lit("intro"))).when(F.col("level") == 2, F.concat_ws("-", "section.id", "subsection.id", F.lit("intro"))).otherwise(F.concat_ws("-", "section.id", "subsection.id", own))
    story = F.when(F.col("level").isNotNull(), F.struct(path.alias("id"), F.col("title")))
    rows = rows.withColumn("story", F.coalesce(F.last(story, True).over(so_far()), none)).where("body")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", X.strip(F.col("line")).alias("line")))), lambda x: x["line"]), " ")
    first = lambda c: F.first(c)  # noqa: E731  the same in all lines of a paragraph
    out = rows.groupBy("doc", "paragraph").agg(first("section").alias("section"), first("subsection").alias("subsection"), first("story").alias("story"), first("story_index").alias("story_index"), text.alias("text"))
    return out.select(
        "doc", F.col("paragraph").cast("int").alias("paragraph"), F.format_string("%s-p%05d", F.col("doc").cast("string"), F.col("paragraph")).alias("id"),
        F.col("section.id").alias("section_id"), F.col("section.title").alias("section_title"), F.col("subsection.id").alias("subsection_id"), F.col("subsection.title").alias("subsection_title"),
        F.col("story.id").alias("story_id"), F.col("story.title").alias("story_title"), "story_index", "text",
    )


def collapse_blanks(lines: DataFrame) -> DataFrame:
    """One blank line for several, and none at the ends of a document."""
    rows = lines.withColumn("_blank", X.strip(F.col("line")) == "")
    before = F.sum((~F.col("_blank")).cast("int")).over(so_far())
    after = F.sum((~F.col("_blank")).cast("int")).over(W.partitionBy("doc").orderBy(F.desc("ord")).rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("_again", F.coalesce(F.lag("_blank").over(by_order()), F.lit(False))).withColumn("_inside", (before > 0) & (after > 0))
    return rows.where("NOT _blank OR (NOT _again AND _inside)").drop("_blank", "_again", "_inside")


def section_slice(lines: DataFrame, start: str, end: str | None = None, start_prefix: bool = False, end_prefix: bool = False) -> DataFrame:
    """Lines from the first heading ``start`` to the heading ``end``, or else to the next one as high; blanks at the end go.
    Documents without the heading have no rows."""
    matches = lambda title, wanted, prefix: F.startswith(title, F.lit(wanted)) if prefix else title == wanted
    rows = with_headings(lines)
    here = F.min(F.when(F.col("level").isNotNull() & matches(F.col("title"), start, start_prefix), F.struct("ord", "level"))).over(W.partitionBy("doc"))
    rows = rows.withColumn("_start", here).where("ord >= _start.ord")
    stops = matches(F.col("title"), end, end_prefix) if end else F.col("level") <= F.col("_start.level")
    stop = F.min(F.when(F.col("level").isNotNull() & stops & (F.col("ord") > F.col("_start.ord")), F.col("ord"))).over(W.partitionBy("doc"))
    rows = rows.withColumn("_stop", stop).where("_stop IS NULL OR ord < _stop")
    last = F.max(F.when(X.strip(F.col("line")) != "", F.col("ord"))).over(W.partitionBy("doc"))
    return rows.withColumn("_last", last).where("ord <= _last").select(*lines.columns)


def from_first(lines: DataFrame, match: Column) -> DataFrame:
    """Lines from the first that matches on; all where none does."""
    rows = lines.withColumn("_first", F.min(F.when(match, F.col("ord"))).over(W.partitionBy("doc")))
    return rows.where("_first IS NULL OR ord >= _first").drop("_first")


def before_first(lines: DataFrame, match: Column) -> DataFrame:
    """Lines before the first that matches; all where none does."""
    rows = lines.withColumn("_first", F.min(F.when(match, F.col("ord"))).over(W.partitionBy("doc")))
    return rows.where("_first IS NULL OR ord < _first").drop("_first")


def captured(lines: DataFrame, start: Column, stop: Column, occurrence: int = -1) -> DataFrame:
    """Lines behind an occurrence of ``start`` (the last, by default), up to the next ``stop``."""
    rows = lines.withColumn("_n", F.when(start, F.row_number().over(W.partitionBy("doc", start).orderBy("ord")))).withColumn("_all", F.max("_n").over(W.partitionBy("doc")))
    wanted = F.col("_all") + 1 + occurrence if occurrence < 0 else F.least(F.col("_all"), F.lit(occurrence))
    rows = rows.withColumn("_at", F.max(F.when(F.col("_n") == wanted, F.col("ord"))).over(W.partitionBy("doc"))).where("ord > _at")
    rows = rows.withColumn("_stop", F.min(F.when(stop, F.col("ord"))).over(W.partitionBy("doc")))
    return rows.where("_stop IS NULL OR ord < _stop").select(*lines.columns)


def flushed(lines: DataFrame, ends: Column, most: int = 420) -> DataFrame:
    """(doc, block, text): lines joined until one ends a sentence, a blank comes, or ``most`` characters are reached."""
    from lexalign.operators.kernels import pack_islands

    rows = lines.withColumn("_blank", X.strip(F.col("line")) == "").withColumn("_ends", ends | F.col("_blank"))
    closed = F.coalesce(F.lag("_ends").over(by_order()), F.lit(False))
    rows = rows.withColumn("island", F.sum(closed.cast("int")).over(so_far())).where("NOT _blank")
    rows = pack_islands(rows.select("doc", "island", "ord", F.length("line").cast("long").alias("size"), "line"), ["doc", "island"], most, "reached", ["line"])
    text = X.join_cjk(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda x: x["line"]))
    rows = rows.groupBy("doc", "island", "pack").agg(F.min("ord").alias("ord"), text.alias("text"))
    return rows.select("doc", F.row_number().over(by_order()).alias("block"), "text")


def paged(lines: DataFrame, page: Column, start_page: int) -> DataFrame:
    """Lines from a page on; a line that is a page's number sets it for those behind and goes itself."""
    rows = lines.withColumn("_set", page).withColumn("page", F.last("_set", True).over(so_far()))
    return rows.where(F.col("_set").isNull() & (F.coalesce(F.col("page"), F.lit(0)) >= start_page)).drop("_set")
