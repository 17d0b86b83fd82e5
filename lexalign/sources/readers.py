"""Files and text columns to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexalign import schema as S
from lexalign.functions import text as X
from lexalign.operators import hierarchy as H

__all__ = [
    "aozora", "book_json", "chunk_tasks", "epub_lines", "export_items", "html_blocks", "log_texts", "log_values", "page_numbers", "pair_blocks", "pdf_paragraphs", "read_markdown", "report", "result_chunks", "source_kind", "spine", "state_or_default",
]


def chunk_tasks(spark: SparkSession, path: str) -> DataFrame:
    """Tasks of a JSONL file, with ``ord`` from their ids. Blank lines don't count."""
    return spark.read.schema(S.CHUNK_TASK).json(path).withColumn("ord", X.chunk_number(F.regexp_replace("chunk_id", r"-part-\d+$", "")))


def book_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested books, one a file; a broken one has its text in ``_corrupt_record``."""
    return spark.read.schema(S.BOOK).option("multiLine", True).json(path).withColumn("book_id", _stem())


def result_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Result chunks of a folder and those below it, with their file's stem, place and time; both shapes in one schema."""
    rows = spark.read.schema(S.CHUNK).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return rows.withColumns({"stem": _stem(), "path": F.col("_metadata.file_path"), "modified": F.col("_metadata.file_modification_time")})


def _stem() -> Column:
    return F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")


#: Folder, number and number behind it of a part in a folder that Spark wrote; what ends a line beside a line feed.
_PART = r"^(.*)/part-(\d+)-[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}(?:[._-]c(\d+))?[^/]*$"
_SEPARATORS = r"[\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def read_markdown(spark: SparkSession, path: str, feeds: bool = False) -> DataFrame:
    """(doc, ord, line): lines of Markdown files, by stem; with ``feeds`` only line feeds end them.

    A folder of parts, as Spark's writers make it, is one file by the folder's name: its parts follow each other by number. A file of
    any size is read in the splits that Spark makes of it, by records that end with a line feed and are cut at the other
    separators. The splits' counts of lines, a row for each, tell where each begins."""
    rows = spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.col("_metadata.file_block_length").alias("_length"), F.col("_metadata.file_size").alias("_size"), F.monotonically_increasing_id().alias("_at"))
    cut = lambda c, end="": F.array(c) if feeds else F.when(F.col("value").rlike(_SEPARATORS), X.lines(F.concat(c, F.lit(end)))).otherwise(F.array(c))
    rows = rows.withColumn("_count", F.size(cut(F.col("value"), "\n")))
    splits = rows.groupBy("_file", "_start", "_length").agg(F.sum("_count").alias("_n"), F.sum(F.octet_length("value") + 1).alias("_bytes"), F.max("_size").alias("_size"), F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    number = lambda i: F.regexp_extract("_file", _PART, i).try_cast("int")
    splits = splits.withColumns({"_book": F.when(F.col("_file").rlike(_PART), F.regexp_extract("_file", _PART, 1)).otherwise(F.col("_file")), "_part": F.struct(number(2), number(3))})
    of, parts = W.partitionBy("_file"), W.partitionBy("_book").orderBy("_part", "_file", "_start")
    before = F.coalesce(F.sum("_n").over(parts.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # the reader drops a byte order mark, three bytes; a file that ends without a line feed has one byte less than its records
    missing = F.col("_size") - F.sum("_bytes").over(of)
    mark = F.when(missing.isin(2, 3) & (F.col("_start") == F.min("_start").over(of)), F.col("_first"))
    rest = F.when(missing.isin(-1, 2) & (F.col("_start") == F.max("_start").over(of)), F.col("_last"))
    doc = F.regexp_replace(F.substring_index("_book", "/", -1), r"\.[^.]*$", "")
    splits = splits.select("_file", "_start", "_length", doc.alias("doc"), before.alias("_before"), "_first", mark.alias("_mark"), rest.alias("_rest"))
    # rows without their split must not get lost: both readings are cut alike, else the query stops
    rows = rows.drop("_size").join(F.broadcast(splits), ["_file", "_start", "_length"], "left")
    begin = F.coalesce("_before", F.raise_error(F.lit("the files were cut in other splits when they were read again")).cast("long"))
    # records of a split come one after the other; where one may be several lines they are summed up
    done = F.col("_at") - F.col("_first") if feeds else F.sum("_count").over(W.partitionBy("_file", "_start").orderBy("_at")) - F.col("_count")
    text = F.when(F.col("_at") == F.col("_mark"), F.concat(F.lit("\ufeff"), "value")).otherwise(F.col("value"))
    lines = F.when(F.col("_at") == F.col("_rest"), cut(text)).otherwise(cut(text, "\n"))
    rows = rows.withColumn("_done", begin + done)  # before the lines are rows, as a window beside an explode comes after it
    if feeds:
        return rows.select("doc", F.col("_done").cast("int").alias("ord"), text.alias("line"))
    rows = rows.select("doc", "_done", F.posexplode(lines).alias("_i", "line"))
    return rows.select("doc", (F.col("_done") + F.col("_i")).cast("int").alias("ord"), "line")


def epub_lines(lines: DataFrame, start_heading: str | None = None, start_text: str | None = None) -> DataFrame:
    """Cleaned lines of converted books, from the given heading or line on, else from the first heading of the top level;
    pictures go, blank lines come singly."""
    rows = lines.withColumn("line", X.clean_line(F.col("line")))
    heading = F.col("line").rlike(r"^#{1,6}\s+")
    title = X.strip(F.regexp_replace("line", "^#+", ""))
    first = (F.col("line") == start_text.strip()) if start_text else heading & (title == start_heading.strip()) if start_heading else F.startswith("line", F.lit("# "))
    rows = H.from_first(rows, first).where(~F.startswith("line", F.lit("![](")))
    return H.collapse_blanks(rows)


def html_blocks(pages: DataFrame, id: str, html: str) -> DataFrame:
    """(doc, ord, tag, text): headings, paragraphs and list items of HTML in order, without scripts, styles and navigation."""
    bare = F.regexp_replace(X.empty(F.col(html)), r"(?is)<(script|style|nav|footer|template)\b.*?</\1\s*>|<!--.*?-->", " ")
    found = F.regexp_extract_all(bare, F.lit(r"(?is)<(?:h[1-6]|p|li)\b[^>]*>.*?(?=</(?:h[1-6]|p|li)\s*>|<(?:h[1-6]|p|li|ul|ol|div|table)\b|\z)"), F.lit(0))
    rows = pages.select(F.col(id).alias("doc"), F.posexplode(found).alias("ord", "raw"))
    text = X.clean_text(X.unescape(F.regexp_replace(F.regexp_replace("raw", r"(?is)<rt>.*?</rt>", ""), r"<[^>]*>", " ")))
    return rows.select("doc", "ord", F.lower(F.regexp_extract("raw", r"(?i)^<([a-z0-9]+)", 1)).alias("tag"), text.alias("text")).where("text <> ''")


def pdf_paragraphs(lines: DataFrame, most: int = 420) -> DataFrame:
    """(doc, block, text): lines of a text layer as paragraphs, which end with a sentence, a blank line or ``most`` characters."""
    return H.flushed(lines, X.strip(F.col("line")).rlike("[。！？!?.][」』”’）)]*$"), most)


def aozora(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(doc, ord, line) of Aozora texts: ruby and marks dropped, cut at the colophon, numbered parts as headings."""
    rows = H.document_lines(docs.withColumn(text, X.aozora_text(F.col(text))), id, text).withColumn("line", X.strip(F.col("line")))
    rows = H.before_first(rows, F.col("line").rlike("^(?:底本：|入力：|青空文庫作成ファイル：)"))
    rows = rows.withColumn("line", F.when(F.col("line").rlike("^[一二三四五六七八九十]+、"), F.concat(F.lit("## "), "line")).otherwise(F.col("line")))
    return H.collapse_blanks(rows)


def pair_blocks(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks of paired text: (doc, block, zh, jp, zh_comment, jp_comment), and issues (doc, block, rule) for blocks that lack
    a field, aren't closed or have text before the first field."""
    open_, close = X.strip(F.col("line")) == "::: pair", X.strip(F.col("line")) == ":::"
    field = F.nullif(F.regexp_extract("line", r"^(zh|jp|zh_comment|jp_comment):", 1), F.lit(""))
    rows = lines.withColumn("_open", open_).withColumn("_close", close)
    rows = rows.withColumn("block", F.sum(F.col("_open").cast("int")).over(H.so_far())).withColumn("_after", F.sum(F.col("_close").cast("int")).over(H.so_far("doc", "block")))
    inside = rows.where("block > 0 AND NOT _open AND (_after = 0 OR (_close AND _after = 1))")
    body = inside.where("NOT _close").withColumn("_own", field).withColumn("field", F.last("_own", True).over(H.so_far("doc", "block")))
    value = F.when(F.col("_own").isNotNull(), X.strip(F.regexp_replace("line", r"^[a-z_]+:", ""))).otherwise(F.regexp_replace("line", r"\s+$", ""))
    rows_of = body.where("field IS NOT NULL").withColumn("value", value).groupBy("doc", "block", "field").agg(F.array_sort(F.collect_list(F.struct("ord", "value"))).alias("v"))
    joined = F.array_join(F.filter(F.transform("v", lambda x, i: F.when((i > 0) | (x["value"] != ""), x["value"])), lambda x: x.isNotNull()), "\n")
    blocks = rows_of.withColumn("text", joined).groupBy("doc", "block").pivot("field", ["zh", "jp", "zh_comment", "jp_comment"]).agg(F.first("text"))
    blocks = blocks.na.fill("", ["zh", "jp", "zh_comment", "jp_comment"])
    missing = blocks.where((X.strip(F.col("zh")) == "") | (X.strip(F.col("jp")) == "")).select("doc", "block", F.lit("missing_field").alias("rule"))
    unclosed = inside.groupBy("doc", "block").agg(F.max("_close").alias("c")).where("NOT c").select("doc", "block", F.lit("unclosed").alias("rule"))
    orphan = body.where(F.col("field").isNull() & (X.strip(F.col("line")) != "")).select("doc", "block", F.lit("orphan_text").alias("rule")).distinct()
    return blocks, missing.unionByName(unclosed).unionByName(orphan)


def log_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("log"), F.col("value").alias("text"))


def log_values(logs: DataFrame) -> DataFrame:
    """(log, box, value): widths and heights of overfull boxes."""
    kinds = {"hbox": r"Overfull \\hbox \(([-0-9.]+)pt too wide\)", "vbox": r"Overfull \\vbox \(([-0-9.]+)pt too high\)"}
    rows = [logs.select("log", F.lit(k).alias("box"), F.explode(F.regexp_extract_all("text", F.lit(p), F.lit(1))).alias("value")) for k, p in kinds.items()]
    return rows[0].unionByName(rows[1]).select("log", "box", F.col("value").try_cast("double").alias("value")).where("value IS NOT NULL")


def report(c: Column) -> Column:
    """Map of a report's ``key=value`` lines; the last of a key wins."""
    pairs = F.filter(X.lines(c), lambda x: F.contains(x, F.lit("=")))
    keys = F.transform(pairs, lambda x: F.substring_index(x, "=", 1))
    last = F.filter(F.transform(pairs, lambda x, i: F.struct(i.alias("i"), F.substring_index(x, "=", 1).alias("k"), F.substring(x, F.length(F.substring_index(x, "=", 1)) + 2, F.length(x)).alias("v"))), lambda p: ~F.array_contains(F.slice(keys, p["i"] + 2, F.size(keys)), p["k"]))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["k"], p["v"])))


def export_items(paths: DataFrame, directions: list[str], variants: list[str], skip: list[str] | None = None) -> DataFrame:
    """(book_id, direction, variant, title, path, size) for (path, size) of files ``book/direction/variant/title.pdf``."""
    parts = F.split(F.regexp_replace("path", r"^[a-z]+:/*|^/+|/+$", ""), "/")
    rows = paths.withColumn("_p", parts).where((F.size("_p") == 4) & F.endswith("path", F.lit(".pdf")))
    rows = rows.select(F.col("_p")[0].alias("book_id"), F.col("_p")[1].alias("direction"), F.col("_p")[2].alias("variant"), F.regexp_replace(F.col("_p")[3], r"\.pdf$", "").alias("title"), "path", "size")
    rows = rows.where(F.col("direction").isin(directions) & F.col("variant").isin(variants))
    return rows.where(~F.col("book_id").isin(skip)) if skip else rows


def source_kind(path: Column, content: Column) -> Column:
    """Kind of a source by its suffix, and for JSON by what it holds."""
    suffix, mode = F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1)), F.get_json_object(content, "$.mode")
    json = F.when(mode.isin("wikisource-book", "wikisource-html"), "html_json").when(mode == "iiif-pdf", "iiif_json").when(F.get_json_object(content, "$.html").isNotNull(), "html_json").otherwise("unknown_json")
    return F.when(suffix == ".json", json).when(suffix == ".pdf", "pdf").when(suffix == ".epub", "epub").otherwise("unknown")


def spine(itemrefs: DataFrame, items: DataFrame) -> DataFrame:
    """Files of a package in reading order: references (ord, idref) to items (id, href)."""
    return itemrefs.join(items, itemrefs["idref"] == items["id"]).select("ord", "href").orderBy("ord")


def state_or_default(keys: DataFrame, states: DataFrame, key: str, defaults: dict) -> DataFrame:
    """States by key, with defaults where there is none."""
    return keys.select(key).join(states, key, "left").select(key, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()])


def page_numbers(spark: SparkSession, spec: str, total: int) -> DataFrame:
    return spark.createDataFrame([(p,) for p in X.pages(spec, total)], "page int")
