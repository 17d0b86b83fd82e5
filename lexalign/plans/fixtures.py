"""Queries on inline fixtures: forms that the driver's tables don't have, such as Markdown headings and tokens with readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.operators import hierarchy as H
from lexalign.operators import roles as R
from lexalign.operators import tokens as K
from lexalign.operators import validate as C
from lexalign.plans.adapt import registry

QUERIES, SQL, query = registry()

MARKDOWN = ["序文一。", "序文二。", "", "# 卷一", "段落甲。", "## 章一", "段落乙一", "段落乙二。", "", "", "### 节一", "段落丙。", "#### 小节", "段落丁。", "# 卷二", "段落戊。"]


def _values(rows: list[tuple]) -> str:
    one = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


@query(f"""
WITH l(ord, line) AS (VALUES {_values(list(enumerate(MARKDOWN)))}),
h AS (SELECT *, length(regexp_extract(line, '^(#{{1,6}})\\s+(.*)$', 1)) AS level, regexp_extract(line, '^(#{{1,6}})\\s+(.*)$', 2) AS title FROM l),
b AS (SELECT *, level = 0 AND line <> '' AS body FROM h),
s AS (SELECT *, body AND NOT coalesce(lag(body) OVER (ORDER BY ord), false) AS starts FROM b),
p AS (SELECT *, sum(starts::INT) OVER w AS paragraph, count(*) FILTER (WHERE level > 0) OVER w AS story_index,
  last_value(CASE WHEN level = 1 THEN title END IGNORE NULLS) OVER w AS section, last_value(CASE WHEN level = 1 THEN 'main' WHEN level = 2 THEN title END IGNORE NULLS) OVER w AS subsection, last_value(CASE WHEN level > 0 THEN title END IGNORE NULLS) OVER w AS story
  FROM s WINDOW w AS (ORDER BY ord))
SELECT 'book-p' || lpad(CAST(paragraph AS VARCHAR), 5, '0') AS id, coalesce(section, 'front') AS section_id, coalesce(subsection, 'front') AS subsection_id, coalesce(story, '前言') AS story_title, CAST(story_index AS INTEGER) AS story_index, string_agg(line, ' ' ORDER BY ord) AS text
FROM p WHERE body GROUP BY ALL""")
def markdown_hierarchy_fixture(spark, sf_dir):
    rows = spark.createDataFrame([("book", i, x) for i, x in enumerate(MARKDOWN)], "doc string, ord int, line string")
    return H.paragraphs(rows).select("id", "section_id", "subsection_id", "story_title", "story_index", "text")


TOKENS = [
    ("zh", 0, None, "x", None, None, None), ("zh", 1, "天", "tiān", None, "subject", None), ("zh", 2, "天", "tiān", "noun", None, None), ("zh", 3, "先生", "", "subject", None, None), ("zh", 4, "天", "", "subject", None, None),
    ("zh", 5, "，", "x", None, None, None), ("ja", 6, "先生", "せんせい", "subject", None, None), ("ja", 7, "山", None, "subject", None, None), ("ja", 8, "は", "は", "topic", None, None), ("ja", 9, "静か", "", None, None, None),
    ("zh", 10, "地", "dì", "object", None, None), ("ja", 11, "山", "やま", "object", None, "zhu"), ("zh", 12, "a1", "", "", None, None), ("ja", 13, "。", "", "", None, None),
]
_HAN = "[\\x{3400}-\\x{4dbf}\\x{4e00}-\\x{9fff}\\x{f900}-\\x{faff}]"


@query(f"""
WITH k(lang, id, t, r, g, role, syntax) AS (VALUES {_values(TOKENS)}),
c AS (SELECT *, regexp_matches(coalesce(t, ''), '{_HAN}') AS han, regexp_full_match(coalesce(t, ''), '{_HAN}') AS single, coalesce(r, '') AS rd, coalesce(g, '') AS gr FROM k),
x AS (SELECT id, unnest([CASE WHEN t IS NULL THEN 'C01' END, CASE WHEN role IS NOT NULL OR syntax IS NOT NULL THEN 'C02' END, CASE WHEN gr NOT IN ('', 'subject','predicate','object','attributive','adverbial','complement','topic','function') THEN 'C03' END,
  CASE WHEN han AND NOT single THEN CASE lang WHEN 'zh' THEN 'C04.one' ELSE 'C05.one' END END, CASE WHEN single AND rd = '' THEN CASE lang WHEN 'zh' THEN 'C04.missing' ELSE 'C05.missing' END END, CASE WHEN rd <> '' AND NOT single THEN CASE lang WHEN 'zh' THEN 'C04.extra' ELSE 'C05.extra' END END,
  CASE WHEN regexp_matches(coalesce(t, ''), '[\\x{{3400}}-\\x{{4dbf}}\\x{{4e00}}-\\x{{9fff}}\\x{{f900}}-\\x{{faff}}\\x{{3041}}-\\x{{309f}}\\x{{30a0}}-\\x{{30ff}}A-Za-z0-9]') AND gr = '' THEN 'C11' END]) AS rule FROM c)
SELECT id, rule FROM x WHERE rule IS NOT NULL""")
def token_validators_fixture(spark, sf_dir):
    rows = spark.createDataFrame(TOKENS, "lang string, id int, t string, r string, g string, role string, syntax string")
    return C.issues(rows, ["id"], C.token_rules(strict=True))


UNITS = [
    (0, "天地", "注。", "", "天地"), (1, "天", "てんのこと", "注釈です", "天地"), (2, "天地", "", "", "天 地"), (3, "天" * 129, "あ" * 40, "い" * 10, ""), (4, "天。地。" * 21, "あ" * 55, "い", ""), (5, "春天来了风很轻我在小径上慢慢走", "花", "", ""), (6, "花", "花は", "静か", None),
]


@query(f"""
WITH u(id, zh, a, b, target) AS (VALUES {_values(UNITS)}),
c AS (SELECT *, regexp_replace(a || b, '\\s+', '', 'g') AS ja, length(zh) AS n, len(regexp_extract_all(zh, '[。！？!?]')) AS ends FROM u),
x AS (SELECT id, unnest([CASE WHEN ja = '' THEN 'C07.empty' END, CASE WHEN ja IN ('注', '注。', '。') THEN 'C07.placeholder' END, CASE WHEN coalesce(target, '') <> '' AND regexp_replace(zh, '\\s+', '', 'g') <> regexp_replace(target, '\\s+', '', 'g') THEN 'C08' END,
  CASE WHEN n > 128 OR (n > 82 AND ends >= 2) THEN 'C12.zh' END, CASE WHEN length(a) > 54 OR length(b) > 54 THEN 'C12.ja' END, CASE WHEN n >= 14 AND length(ja) < greatest(6, CAST(floor(n * 0.16) AS BIGINT)) THEN 'C14.short' END]) AS rule FROM c)
SELECT id, rule FROM x WHERE rule IS NOT NULL""")
def unit_validators_fixture(spark, sf_dir):
    rows = spark.createDataFrame(UNITS, "id int, zh string, a string, b string, target string")
    return C.issues(rows.withColumn("ja", F.array("a", "b")), ["id"], C.unit_rules())


REVIEWS = [(0, "天地", "てんち天", "てんち天"), (1, "天地", "ひらがな", "天"), (2, "天地", "あ" * 43, "天地"), (3, "天地", "天と地のことを言う", "天と地のことを言う語"), (4, "天地", "訳。", "天"), (5, "天地", "天は天である", "地は地である")]


@query()
def review_rules_fixture(spark, sf_dir):
    """Rules of the quick review; the expected issues are in the tests."""
    rows = spark.createDataFrame(REVIEWS, "id int, source string, a string, b string")
    return C.issues(rows.withColumn("ja", F.array("a", "b")), ["id"], C.line_rules())


NOTES = ["天地[12]玄黄", "天地（参看注①）玄黄", "见第三页注②。天地", "天地①②", "正文［注3］", "（1737）年", "[注1](part3.html#a7)天地", "天地"]


_STRIPPED = "text"
for _form in X.NOTE_REFERENCES:
    _STRIPPED = f"regexp_replace({_STRIPPED}, '{_form}', '', 'g')"


@query(f"SELECT id, {_STRIPPED} AS text FROM (VALUES {_values(list(enumerate(NOTES)))}) t(id, text)")
def note_strip_fixture(spark, sf_dir):
    rows = spark.createDataFrame(list(enumerate(NOTES)), "id int, text string")
    return rows.select("id", X.strip_note_references(F.col("text")).alias("text"))


READINGS = [("zh", 0, "天地", "tiān dì", "subject"), ("zh", 1, "，", "x", ""), ("zh", 2, "天a", "tiān", "object"), ("ja", 3, "食べる", "た", "predicate"), ("ja", 4, "山川", "", "subject"), ("ja", 5, "は", "は", "topic"), ("ja", 6, "山川", "やまかわ", "subject")]


#: By the rules: ruby stays on single Chinese characters, and words are cut for that where readings and characters agree.
READ = [(0, 0, "天", "tiān", "subject"), (0, 1, "地", "dì", "subject"), (1, 0, "，", "", ""), (2, 0, "天", "tiān", "object"), (2, 1, "a", "", "object"), (3, 0, "食", "た", "predicate"), (3, 1, "べる", "", "predicate"), (4, 0, "山", "", "subject"), (4, 1, "川", "", "subject"), (5, 0, "は", "", "topic"), (6, 0, "山川", "やまかわ", "subject")]


@query(f"SELECT * FROM (VALUES {_values(READ)}) x(id, \"at\", t, r, g)")
def reading_split_fixture(spark, sf_dir):
    rows = spark.createDataFrame(READINGS, "lang string, id int, t string, r string, g string")
    parts = F.when(F.col("lang") == "zh", K.split_reading(F.col("t"), F.col("r"), F.col("g"), "zh")).otherwise(K.split_reading(F.col("t"), F.col("r"), F.col("g"), "ja"))
    return rows.select("id", F.posexplode(parts).alias("at", "x")).select("id", "at", "x.t", "x.r", "x.g")


LOOKAHEAD = "大学之道在明明德"


@query(f"""
WITH c AS (SELECT i - 1 AS ord, substr('{LOOKAHEAD}', i, 1) AS t FROM (SELECT unnest(generate_series(1, {len(LOOKAHEAD)})) AS i)),
o AS (SELECT *, CASE WHEN contains('{R.ZH_FUNCTION}', t) THEN 'function' WHEN contains('{R.ZH_ADVERBIAL}', t) THEN 'adverbial' WHEN contains('{R.ZH_PREDICATE}', t) THEN 'predicate' END AS own FROM c)
SELECT CAST(ord AS INTEGER) AS ord, t, coalesce(own, CASE WHEN coalesce(bool_or(own = 'predicate') OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN 'object' ELSE 'subject' END) AS g FROM o""")
def role_lookahead(spark, sf_dir):
    rows = spark.createDataFrame([(0, i, c, "") for i, c in enumerate(LOOKAHEAD)], "line int, ord int, t string, g string")
    return R.infer_zh(rows, ["line"]).select("ord", "t", "g")
