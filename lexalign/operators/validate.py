"""Rules on tokens, units, paragraphs and chunks. Each rule yields rows of issues, so that rules union and count like data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.operators import roles as R
from lexalign.schema import CONTENT, HAN, LINE_ROLES, PLACEHOLDERS, ROLES

SENTENCE_END = "[。！？!?]"


def issues(rows: DataFrame, where: list[str], rules: dict[str, Column]) -> DataFrame:
    """(where, rule): a row for each rule that holds."""
    found = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()]), lambda x: x.isNotNull())
    return rows.select(*where, F.explode(found).alias("rule"))


def token_rules(strict: bool = False) -> dict[str, Column]:
    """Rules on rows (lang, t, r, g, role, syntax). ``strict``: content needs a role."""
    t, r, g = F.col("t"), X.empty(F.col("r")), X.empty(F.col("g"))
    han, single, zh = X.has_han(t), X.is_single_han(t), F.col("lang") == "zh"
    rules = {
        "C01": t.isNull(),
        "C02": F.col("role").isNotNull() | F.col("syntax").isNotNull(),
        "C03": (g != "") & ~g.isin(*ROLES),
        "C04.one": zh & han & ~single,
        "C04.missing": zh & single & (r == ""),
        "C04.extra": zh & (r != "") & ~single,
        "C05.one": ~zh & han & ~single,
        "C05.missing": ~zh & single & (r == ""),
        "C05.extra": ~zh & (r != "") & ~single,
    }
    return rules | ({"C11": X.empty(t).rlike(f"[{CONTENT}]") & (X.strip(g) == "")} if strict else {})


def reading_rules() -> dict[str, Column]:
    """Readings of a review: no Chinese characters in furigana, none and no tone digits in pinyin."""
    r, zh = X.empty(F.col("r")), F.col("lang") == "zh"
    return {"C14.furigana": ~zh & r.rlike(f"[{HAN}]"), "C14.pinyin": zh & r.rlike(rf"[{HAN}]|\d")}


def unit_rules() -> dict[str, Column]:
    """Rules on units (zh, ja as array of line texts, target)."""
    zh, ja = F.col("zh"), F.col("ja")
    text = X.compact(F.array_join(ja, ""))
    long = F.length(X.empty(zh))
    ends = F.regexp_count(X.empty(zh), F.lit(SENTENCE_END))
    return {
        "C07.lines": F.coalesce(F.size(ja), F.lit(-1)) != 2,
        "C07.empty": (F.size(ja) == 2) & (text == ""),
        "C07.placeholder": (F.size(ja) == 2) & X.is_placeholder(text),
        "C08": (X.empty(F.col("target")) != "") & (X.compact(zh) != X.compact(F.col("target"))),
        "C12.zh": (long > 128) | ((long > 82) & (ends >= 2)),
        "C12.ja": F.exists(F.coalesce(ja, F.array().cast("array<string>")), lambda x: F.length(X.compact(x)) > 54),
        "C14.short": (F.length(X.compact(zh)) >= 14) & (F.length(text) < F.greatest(F.lit(6), F.floor(F.length(X.compact(zh)) * 0.16))),
    }


def line_rules() -> dict[str, Column]:
    """Rules of the quick review on units (source, ja as array of two line texts)."""
    lines = F.transform(F.col("ja"), X.compact)
    first, second = F.get(lines, F.lit(0)), F.get(lines, F.lit(1))
    source = F.length(X.compact(F.col("source")))
    two = F.size(F.col("ja")) == 2
    return {
        "C15.empty": two & F.exists(lines, lambda x: x == ""),
        "C15.placeholder": two & F.exists(lines, lambda x: x.isin("。", "注。", "説明。", "訳。")),
        "C15.kana": two & F.exists(lines, lambda x: (F.length(x) >= 4) & ~X.has_han(x)),
        "C15.long": two & (source > 0) & F.exists(lines, lambda x: F.length(x) > F.greatest(F.lit(42), source * 4)),
        "C15.same": two & (first != "") & (first == second),
        "C15.within": two & (first != second) & (F.length(first) >= 8) & F.contains(second, first),
    }


def line_role_rule(roles: Column) -> Column:
    return ~F.coalesce(roles == F.array(*[F.lit(x) for x in LINE_ROLES]), F.lit(False))


def paragraph_rules(units: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rule) for units (keys, unit, zh, target): units that don't join to the paragraph's target, or are too few for
    its sentences."""
    rows = units.groupBy(*keys).agg(F.count("zh").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit", "zh"))), lambda x: x["zh"]), "").alias("built"), F.first("paragraph_target").alias("target"))
    ends = F.regexp_count(X.empty(F.col("target")), F.lit(SENTENCE_END))
    return issues(rows, keys, {
        "C09.none": F.col("n") == 0,
        "C09.built": (F.col("n") > 0) & (X.empty(F.col("target")) != "") & (X.compact(F.col("built")) != X.compact(F.col("target"))),
        "A22": (ends >= 4) & (F.col("n") < F.greatest(F.lit(2), F.ceil(ends * 0.45))),
    })


def chunk_rules(sources: DataFrame, results: DataFrame) -> DataFrame:
    """(chunk_id, rule) for sources (chunk_id, para_ids, texts, ocr) and results (chunk_id, para_ids, texts, corrected)."""
    got = results.select("chunk_id", F.col("para_ids").alias("got_ids"), F.col("texts").alias("got_texts"), F.col("corrected"), F.lit(True).alias("there"))
    rows = sources.join(got, "chunk_id", "left").where("there")
    plain = lambda a: F.transform(a, lambda x: X.compact(X.strip_note_references(x)))
    return issues(rows, ["chunk_id"], {
        "C10.order": ~F.col("got_ids").eqNullSafe(F.col("para_ids")),
        "C10.changed": F.col("got_ids").eqNullSafe(F.col("para_ids")) & (plain(F.col("got_texts")) != plain(F.col("texts"))),
        "C10.ocr": F.col("ocr") & F.exists("corrected", lambda x: x.isNull()),
    })


def coverage_rule(units: DataFrame, keys: list[str], zh: str = "zh", ja: str = "ja") -> DataFrame:
    """(keys, rule): chunks of 120 Chinese characters or more with fewer than 0.18 Japanese ones for each, blanks left out."""
    rows = units.groupBy(*keys).agg(F.sum(F.length(X.compact(F.col(zh)))).alias("a"), F.sum(F.length(X.compact(F.col(ja)))).alias("b"))
    return issues(rows, keys, {"A21": (F.col("a") >= 120) & (F.col("b") / F.col("a") < 0.18)})


def repeated_comments(units: DataFrame, keys: list[str], text: str = "ja") -> DataFrame:
    """(keys, text, n): comments of ten characters or more that a chunk has three times."""
    rows = units.select(*keys, X.compact(F.col(text)).alias("text")).where(F.length("text") >= 10)
    return rows.groupBy(*keys, "text").agg(F.count("*").alias("n")).where("n >= 3")


def coverage(units: DataFrame, keys: list[str], zh: str = "zh", ja: str = "ja") -> DataFrame:
    """(keys, units, zh_chars, ja_chars, ratio, empty_units, placeholder_units, short_units, failed): how much of the main text
    the other language covers."""
    a, b = F.length(F.col(zh)), F.length(F.col(ja))
    short = b < F.greatest(F.lit(3), F.floor(a / 8))
    out = units.groupBy(*keys).agg(F.count("*").alias("units"), F.sum(a).alias("zh_chars"), F.sum(b).alias("ja_chars"), F.count_if(F.col(ja) == "").alias("empty_units"), F.count_if(F.col(ja).isin(*PLACEHOLDERS)).alias("placeholder_units"), F.count_if(short).alias("short_units"))
    ratio = F.coalesce(F.try_divide("ja_chars", "zh_chars"), F.lit(0.0))
    failed = (F.col("empty_units") > 0) | (F.col("placeholder_units") > 0) | ((F.col("zh_chars") >= 120) & (ratio < 0.18))
    return out.select(*keys, "units", "zh_chars", "ja_chars", ratio.alias("ratio"), "empty_units", "placeholder_units", "short_units", failed.alias("failed"))


def first_issues(found: DataFrame, keys: list[str], by: list[str], most: int = 80) -> DataFrame:
    """(keys, issues, omitted): the first ``most`` issues of each key by ``by``, and how many more there are. Issues are numbered
    before they are gathered, so that no array is longer."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*by))
    entry = F.struct("_place", *by)
    rows = found.withColumn("_place", place).groupBy(*keys).agg(F.collect_list(F.when(F.col("_place") <= most, entry)).alias("_all"), F.count("*").alias("_n"))
    issues = F.transform(F.array_sort("_all"), lambda x: F.struct(*[x[c].alias(c) for c in by]))
    return rows.select(*keys, issues.alias("issues"), F.greatest(F.col("_n") - most, F.lit(0)).alias("omitted"))


def missing_references(chunks: DataFrame) -> DataFrame:
    return issues(chunks, ["chunk_id"], {"C17": F.size("refs") == 0})


def valid(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Rows without an issue."""
    return rows.join(found.select(key).distinct(), key, "left_anti")


def note_unit(zh: Column, ja: Column, source: Column, corrected: Column) -> Column:
    """Whether a unit is nothing but an editor's note."""
    # How notes begin.
    prefix = r"^(?U)\s*(?:[\[［〔【(（]\s*(?:注|註)?\s*[0-9０-９]+\s*[\]］〕】)）]|[\[［〔【(（]\s*注\s*[0-9０-９]*\s*[\]］〕】)）]|(?:注|註|译注|譯注|注释|註釋|訳注|脚注|注釈|注記)\s*(?:[0-9０-９]+)?\s*[:：\[]?)"
    marked = [X.strip(c).rlike(p) for c in (zh, ja, source, corrected) for p in (prefix, X.SHORT_NOTE)]
    bare = [(X.strip(c) != "") & (X.strip(X.strip_note_references(c)) == "") & (X.strip(zh) == "") for c in (source, corrected)]
    return reduce(Column.__or__, marked + bare)


def editorial_note(c: Column) -> Column:
    """Whether a text looks like an editor's note."""
    text = X.compact(c)
    # Numbered and bracketed notes, and words for them.
    return text.rlike(r"^(?:[（(]?\d+[.．、)]|[［\[]\d+[］\]])") | text.rlike(r"[［\[].{4,}?[］\]]") | text.rlike("译者|译注|注释|注：")


def noise_line(c: Column) -> Column:
    """Lines that carry no text of the work: blank, page numbers, navigation, sources, date headers."""
    # What navigation and sources look like.
    exact = ("←", "→", "◄", "►", "版本", "目錄", "目录", "目次")
    prefixes = ("Source:", "https://", "http://", "Generated from", "Root source:", "姊妹计划", "姉妹プロジェクト", "作者：", "file://")
    text = X.clean_text(c)
    begins = reduce(Column.__or__, [F.startswith(text, F.lit(p)) for p in prefixes])
    dated = text.rlike(r"^\d{1,2}/\d{1,2}/\d{2,4},?\s*\d{1,2}:\d{2}\s*[AP]M$")
    return (text == "") | text.isin(*exact) | text.rlike(r"^\d{1,4}$") | dated | begins | ((F.length(text) <= 18) & text.rlike("[←→◄►]"))


def collapsed(tokens: DataFrame, keys: list[str], thresholds: dict[str, tuple[int, float, int]]) -> DataFrame:
    """See :func:`lexalign.operators.roles.collapse`."""
    return R.collapse(tokens, keys, thresholds)
