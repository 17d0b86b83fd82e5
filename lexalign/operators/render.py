"""Units to TeX lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.operators import tokens as K

# Roles of lines that count as comments, and marks that end or join sentences.
COMMENT_ROLES = ("comment", "explanatory_comment", "explanatory-comment", "explanation", "note", "annotation", "zhu", "注")
FINAL = "。！？!?；;"
OPENING = "「『“‘（【《〈〔〖〘〚"
CLOSING = "」』”’）】》〉〕〗〙〛"
OTHER = "，、：:,.…—-"
PALETTE = {"subject": "13795B", "predicate": "B23A48", "object": "286DA8", "attributive": "7C58A5", "adverbial": "A96523", "complement": "1D7F91", "topic": "13795B", "function": "000000"}


def tokens(line: Column, ruby: str, breakable: bool = False) -> Column:
    """Tokens with ruby and role macros; ``breakable`` allows a line break between any two characters."""

    def one(x: Column) -> Column:
        text, reading, role = X.tex_escape(x["t"]), X.tex_escape(x["r"]), X.empty(x["g"])
        plain = F.array_join(X.tex_characters(x["t"]), X.BREAK) if breakable else text
        out = F.when(reading != "", F.concat(F.lit(f"\\{ruby}{{"), text, F.lit("}{"), reading, F.lit("}"))).otherwise(plain)
        return F.when(role != "", F.concat(F.lit("\\Gram{"), X.tex_escape(role), F.lit("}{"), out, F.lit("}"))).otherwise(out)

    parts = F.transform(line, lambda x: F.concat(one(x), F.lit(X.BREAK)) if breakable else one(x))
    return F.coalesce(F.array_join(parts, ""), F.lit(""))


def unit(zh: Column, ja: Column, roles: Column, mode: str = "auto") -> Column:
    """Lines of one unit. ``auto``: lines whose role is a comment's come second; ``comment``: the second line does; ``hide``: it
    is left out; ``merge``: all lines come first."""
    if mode not in ("auto", "comment", "hide", "merge"):
        raise ValueError(f"unknown mode: {mode}")
    role = lambda i: F.lower(X.strip(F.get(roles, i)))
    marked = F.transform(F.filter(ja, lambda x: x.isNotNull()), lambda x, i: F.struct(i.alias("i"), tokens(x, "jpruby", True).alias("s"), ((i > 0) & role(i).isin(*COMMENT_ROLES)).alias("c")))
    pick = lambda test: F.array_join(F.transform(F.filter(marked, test), lambda x: x["s"]), "")
    first, second = {
        "auto": (pick(lambda x: ~x["c"]), pick(lambda x: x["c"])), "merge": (pick(lambda x: F.lit(True)), F.lit("")),
        "comment": (pick(lambda x: x["i"] == 0), pick(lambda x: x["i"] == 1)), "hide": (pick(lambda x: x["i"] == 0), F.lit("")),
    }[mode]
    return F.concat(F.lit("\\InterUnit\n{"), tokens(zh, "zhpy", True), F.lit("}\n{"), first, F.lit("}\n{"), second, F.lit("}\n"))


def document(units: DataFrame, mode: str = "auto") -> DataFrame:
    """(doc, ord, line) for units (doc, ord, section, subsection, story, paragraph, titles, zh, ja, ja_line_roles): headings
    where a node begins, and a page break before all but the first story of a subsection."""
    order = W.partitionBy("doc").orderBy("ord")
    new = lambda *keys: ~F.coalesce(F.struct(*keys) == F.lag(F.struct(*keys)).over(order), F.lit(False))
    ends = ~F.coalesce(F.struct("section", "subsection", "story", "paragraph") == F.lead(F.struct("section", "subsection", "story", "paragraph")).over(order), F.lit(False))
    heading = lambda macro, column: F.concat(F.lit(f"\\{macro}{{"), X.tex_escape(F.col(column)), F.lit("}"))
    rows = units.withColumn("_section", new("section")).withColumn("_subsection", new("section", "subsection")).withColumn("_story", new("section", "subsection", "story")).withColumn("_para", new("section", "subsection", "story", "paragraph")).withColumn("_ends", ends)
    lines = F.array(
        F.when(F.col("_section"), heading("InterSection", "section_title")),
        F.when(F.col("_subsection") & (X.empty(F.col("subsection_title")) != ""), heading("InterSubsection", "subsection_title")),
        F.when(F.col("_story") & ~F.col("_subsection"), F.lit("\\InterStoryPageBreak")), F.when(F.col("_story"), heading("InterStory", "story_title")),
        F.when(F.col("_para"), F.lit("\\InterParagraphStart")), unit(F.col("zh"), F.col("ja"), F.col("ja_line_roles"), mode), F.when(F.col("_ends"), F.lit("\\InterParagraphEnd\n")),
    )
    return rows.select("doc", F.col("ord").alias("unit"), F.posexplode(F.filter(lines, lambda x: x.isNotNull())).alias("at", "line")).select("doc", F.struct("unit", "at").alias("ord"), "line")


def ends_sentence(text: Column) -> Column:
    """Whether a text ends a sentence, closing brackets left out."""
    return X.strip(text).rlike(rf"(?U)[{FINAL}][{CLOSING}\s]*\z")


def needs_comma(left: Column, right: Column) -> Column:
    left, right = X.strip(left), X.strip(right)
    none = "[" + FINAL + OPENING + CLOSING + OTHER.replace("-", "") + "-]"
    return (left != "") & (right != "") & ~F.right(left, F.lit(1)).rlike(none) & ~F.left(right, F.lit(1)).rlike(none)


def continued(units: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``group``: units that carry on a sentence share the group of the one before. Units without text stand alone."""
    order = W.partitionBy(*keys).orderBy("ord")
    some = X.strip(F.col("zh")) != ""
    joins = some & F.lag(some & ~ends_sentence(F.col("zh"))).over(order)
    return units.withColumn("group", F.sum(F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).over(order.rowsBetween(W.unboundedPreceding, 0)))


def merged(units: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, group, ord, zh, ja, n) for units (keys, ord, zh, ja as texts): sentences joined, with a comma where neither side
    has a mark."""
    rows = continued(units, keys)
    order = W.partitionBy(*keys, "group").orderBy("ord")
    rows = rows.withColumn("_zh", F.concat(F.when(F.coalesce(needs_comma(F.lag("zh").over(order), F.col("zh")), F.lit(False)), "，").otherwise(""), X.empty(F.col("zh"))))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.col(c).alias("x")))), lambda y: y["x"]), "")
    return rows.groupBy(*keys, "group").agg(F.min("ord").alias("ord"), joined("_zh").alias("zh"), joined("ja").alias("ja"), F.count("*").alias("n"))


def trilingual(units: DataFrame, main: str, comment: str) -> DataFrame:
    """(doc, ord, line) for long rows (doc, ord, lang, tokens): the main language above the comment's; Chinese and Japanese
    with readings."""
    ruby = {"zh": "zhpy", "ja": "jpruby"}
    bare = lambda c: F.transform(c, lambda x: F.struct(x["t"].alias("t"), F.lit("").alias("r"), x["g"].alias("g")))
    text = F.when(F.col("lang") == "zh", tokens(F.col("tokens"), ruby["zh"])).when(F.col("lang") == "ja", tokens(F.col("tokens"), ruby["ja"])).otherwise(tokens(bare(F.col("tokens")), "plain"))
    rows = units.withColumn("_s", text).groupBy("doc", "ord").agg(F.max(F.when(F.col("lang") == main, F.col("_s"))).alias("a"), F.max(F.when(F.col("lang") == comment, F.col("_s"))).alias("b"))
    return rows.select("doc", "ord", F.concat(F.lit("\\TriPair{"), X.empty(F.col("a")), F.lit("}{"), X.empty(F.col("b")), F.lit("}")).alias("line"))


def palette(spark: SparkSession, black: bool = False) -> DataFrame:
    """(role, color): colours of the roles as hexadecimal numbers, all black for print."""
    return spark.createDataFrame([(role, "000000" if black else color) for role, color in PALETTE.items()], "role string, color string")


def plain(units: DataFrame) -> DataFrame:
    """Units with their plain texts, for searching and checks."""
    return units.withColumn("zh_text", K.surface(F.col("zh"))).withColumn("ja_text", K.lines_text(F.col("ja")))
