"""Types of tokens and units, and the fixed vocabularies of the format."""

from __future__ import annotations

from pyspark.sql import types as T

TOKEN = T.StructType([T.StructField("t", T.StringType()), T.StructField("r", T.StringType()), T.StructField("g", T.StringType())])
#: Legacy keys are read, so that they can be reported and moved.
RAW_TOKEN = T.StructType([*TOKEN.fields, T.StructField("role", T.StringType()), T.StructField("syntax", T.StringType())])


def unit(token: T.StructType = TOKEN) -> T.StructType:
    line = T.ArrayType(token)
    return T.StructType([
        T.StructField("source_text", T.StringType()), T.StructField("corrected_text", T.StringType()), T.StructField("zh", line),
        T.StructField("ja", T.ArrayType(line)), T.StructField("ja_line_roles", T.ArrayType(T.StringType())),
    ])


def _node(*children: T.StructField) -> T.StructType:
    names = ("title_zh", "title_ja", "place_zh", "place_ja")
    return T.StructType([T.StructField("id", T.StringType()), *(T.StructField(n, T.ArrayType(RAW_TOKEN)) for n in names), *children])


PARAGRAPH = T.StructType([T.StructField("id", T.StringType()), T.StructField("source_text", T.StringType()), T.StructField("corrected_text", T.StringType()), T.StructField("units", T.ArrayType(unit(RAW_TOKEN)))])
STORY = _node(T.StructField("paragraphs", T.ArrayType(PARAGRAPH)))
SUBSECTION = _node(T.StructField("stories", T.ArrayType(STORY)))
SECTION = _node(T.StructField("subsections", T.ArrayType(SUBSECTION)))
BOOK = T.StructType([
    T.StructField("schema_version", T.StringType()), T.StructField("mode", T.StringType()),
    T.StructField("title", T.StructType([T.StructField("zh", T.ArrayType(RAW_TOKEN)), T.StructField("ja", T.ArrayType(RAW_TOKEN))])),
    T.StructField("sections", T.ArrayType(SECTION)), T.StructField("_corrupt_record", T.StringType()),
])
CHUNK = T.StructType([
    T.StructField("chunk_id", T.StringType()), T.StructField("section", _node()), T.StructField("subsection", _node()), T.StructField("story", _node()),
    T.StructField("paragraphs", T.ArrayType(PARAGRAPH)), T.StructField("units", T.ArrayType(unit(RAW_TOKEN))), T.StructField("mode", T.StringType()), T.StructField("_corrupt_record", T.StringType()),
])
SOURCE_PARAGRAPH = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "section_id", "section_title", "subsection_id", "subsection_title", "story_id", "story_title")] + [T.StructField("story_index", T.IntegerType()), T.StructField("text", T.StringType())])
REFERENCE = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "section_title", "subsection_title", "story_title", "text")])
CHUNK_TASK = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("chunk_id", "section_id", "section_title", "subsection_id", "subsection_title", "story_id", "story_title")]
    + [T.StructField("story_index", T.IntegerType()), T.StructField("paragraphs", T.ArrayType(SOURCE_PARAGRAPH)), T.StructField("requires_ocr_correction", T.BooleanType())]
    + [T.StructField(n, T.StringType()) for n in ("paired_story_key", "paired_reference_key", "resolved_jp_reference_key", "jp_reference_scope")]
    + [T.StructField("jp_reference", T.ArrayType(REFERENCE)), T.StructField("jp_reference_char_count", T.LongType()), T.StructField("split_from_chunk_id", T.StringType()), T.StructField("split_part", T.IntegerType()), T.StructField("split_part_count", T.IntegerType())]
)
MODE = "zh_main_ja_comment"

# Fixed values of the format: grammar roles, their older names, and placeholders.
ROLES = ("subject", "predicate", "object", "attributive", "adverbial", "complement", "topic", "function")
ROLE_ALIASES = {
    "zhu": "subject", "wei": "predicate", "verb": "predicate", "bin": "object", "ding": "attributive", "zhuang": "adverbial", "bu": "complement", "particle": "function",
}
PLACEHOLDERS = ("注", "注。", "。")
LINE_ROLES = ("gloss", "explanatory_comment")

# Character classes, as ranges for regular expressions.
HAN = r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}"
KATAKANA = r"\x{30a1}-\x{30ff}"
KANA = r"\x{3041}-\x{309f}\x{30a0}-\x{30ff}"
ALNUM = "A-Za-z0-9"
CONTENT = HAN + KANA + ALNUM
SKELETON = HAN + KATAKANA + ALNUM
