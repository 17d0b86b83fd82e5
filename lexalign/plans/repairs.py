"""Queries on tokens and their repairs. Tokens with readings come from inline rows, as the driver's tables have none; each has SQL
that follows the rule by itself, or the result that the rule gives by hand."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.operators import artifacts as A
from lexalign.operators import assemble as B
from lexalign.operators import kernels
from lexalign.operators import render as V
from lexalign.operators import repair as R
from lexalign.operators import roles as G
from lexalign.operators import token_kernels as TK
from lexalign.operators import tokens as K
from lexalign.operators import validate as C
from lexalign.plans.adapt import TOKENS, registry, table, tokens, values
from lexalign.schema import BOOK

QUERIES, SQL, query = registry()
_HAN = "[一-鿿]"


def _token(t: str, r: str = "", g: str = "", **other: str) -> dict:
    return {"t": t, "r": r, "g": g, **other}


def _text(s: str) -> list[dict]:
    return [_token(c) for c in s]


def _unit(zh: str, ja: list[str], source: str | None = None, corrected: str | None = None) -> dict:
    return {"source_text": zh if source is None else source, "corrected_text": corrected, "zh": _text(zh), "ja": [_text(x) for x in ja]}


def _paragraph(id: str, *units: dict) -> dict:
    return {"id": id, "source_text": "".join(u["source_text"] for u in units), "units": list(units)}


def _story(id: str, *paragraphs: dict) -> dict:
    return {"id": id, "title_zh": _text(id), "paragraphs": list(paragraphs)}


def _section(id: str, title: str, *stories: dict) -> dict:
    return {"id": id, "title_zh": _text(title), "subsections": [{"id": "main", "title_zh": [], "stories": list(stories)}]}


BOOKS = {
    "a": [_section("s1", "卷一", _story("y1", _paragraph("p1", _unit("天地", ["てんち", "注"]), _unit("［1］注", ["", ""])), _paragraph("p2", _unit("注：x", ["", ""]))), _story("y2")), _section("s2", "卷二", _story("y3", _paragraph("p3", _unit("玄黄。", ["げん", ""], corrected="玄 黄。"))))],
    "b": [_section("s1", "卷一", _story("y1", _paragraph("p1", _unit(" ", ["", ""]))))],
}


def _books(spark):
    rows = spark.createDataFrame([(k, json.dumps({"sections": v}, ensure_ascii=False)) for k, v in BOOKS.items()], "book_id string, body string")
    return rows.select("book_id", F.from_json("body", BOOK).alias("b")).select("book_id", "b.sections")


_UNITS = [(book, s["id"], i, j, p["id"], k, u) for book, sections in BOOKS.items() for i, s in enumerate(sections) for y in s["subsections"][0]["stories"] for j, p in enumerate(y["paragraphs"]) for k, u in enumerate(p["units"])]


@query(f"""
SELECT * FROM (VALUES {values([(book, sid, pid, k, "zh" if line < 0 else "ja", max(line, 0), n, x["t"]) for book, sid, _, _, pid, k, u in _UNITS for line, row in enumerate([u["zh"], *u["ja"]], -1) for n, x in enumerate(row)])}) t(book_id, section_id, para_id, unit, lang, line, tok, t)""")
def book_tokens(spark, sf_dir):
    """Nested books to a row for each token."""
    rows = K.book_paragraphs(_books(spark)).withColumn("section_id", F.element_at(F.array(F.lit("s1"), F.lit("s2")), F.col("section") + 1))
    return K.unit_tokens(K.paragraph_units(rows)).select("book_id", "section_id", "para_id", "unit", "lang", "line", "tok", "t")


@query(f"""
WITH u(book_id, para_id, unit, source, corrected, ja) AS (VALUES {values([(book, pid, k, u["source_text"], u["corrected_text"], "".join(x["t"] for row in u["ja"] for x in row)) for book, _, _, _, pid, k, u in _UNITS])})
SELECT book_id, para_id, unit, coalesce(nullif(trim(corrected), ''), source) AS target, ja FROM u""")
def unit_targets(spark, sf_dir):
    """What each unit must reconstruct, and its Japanese text."""
    rows = K.paragraph_units(K.book_paragraphs(_books(spark)))
    return rows.select("book_id", "para_id", "unit", K.target(F.col("u.corrected_text"), F.col("u.source_text")).alias("target"), K.lines_text(F.col("u.ja")).alias("ja"))


@query(f"""
SELECT * FROM (VALUES {values([("one", "a", "s1/main/y1/p1", "天地［1］注"), ("one", "a", "s1/main/y1/p2", "注：x"), ("one", "b", "s1/main/y1/p1", " "), ("clean", "a", "s1/main/y1/p1", "天地"), ("clean", "a", "s2/main/y3/p3", "玄黄。")])}) t(form, book_id, path, source)""")
def included_sections(spark, sf_dir):
    """Books of the sections named 卷一, and books without notes; what becomes empty goes, up to its section."""
    forms = {"one": B.filtered(_books(spark), ["卷一"]), "clean": B.filtered(_books(spark), drop_notes=True)}
    out = None
    for form, books in forms.items():
        rows = books.select(F.lit(form).alias("form"), "book_id", F.explode("sections").alias("s")).select("form", "book_id", "s.id", F.explode("s.subsections").alias("u"))
        rows = rows.select("form", "book_id", F.concat_ws("/", "id", "u.id").alias("path"), F.explode("u.stories").alias("y")).select("form", "book_id", F.concat_ws("/", "path", "y.id").alias("path"), F.explode("y.paragraphs").alias("p"))
        rows = rows.select("form", "book_id", F.concat_ws("/", "path", "p.id").alias("path"), F.col("p.source_text").alias("source"))
        out = rows if out is None else out.unionByName(rows)
    return out


LEGACY = [(0, "天", "tiān", "Zhu", None, None), (1, "地", None, None, "wei", None), (2, "玄", "", None, None, "verb"), (3, "黄", "huáng", "object", "zhu", None), (4, "x", "", "noun", None, None), (5, "y", "", None, None, None)]


@query(f"""
WITH k(id, t, r, g, role, syntax) AS (VALUES {values(LEGACY)}), x AS (SELECT *, lower(trim(coalesce(g, role, syntax, ''))) AS o FROM k)
SELECT id, t, coalesce(r, '') AS r, CASE o WHEN 'zhu' THEN 'subject' WHEN 'wei' THEN 'predicate' WHEN 'verb' THEN 'predicate' WHEN 'bin' THEN 'object' WHEN 'ding' THEN 'attributive' WHEN 'zhuang' THEN 'adverbial' WHEN 'bu' THEN 'complement' WHEN 'particle' THEN 'function' ELSE o END AS g FROM x""")
def legacy_roles(spark, sf_dir):
    """Older keys and names of roles to the present ones."""
    return R.normal_roles(spark.createDataFrame(LEGACY, "id int, t string, r string, g string, role string, syntax string"))


@query(f"""
WITH k(id, t, r, g, role, syntax) AS (VALUES {values(LEGACY)}), x AS (SELECT *, lower(trim(coalesce(g, role, syntax, ''))) AS o FROM k)
SELECT id, t, coalesce(r, '') AS r, CASE o WHEN 'zhu' THEN 'subject' WHEN 'wei' THEN 'predicate' WHEN 'verb' THEN 'predicate' ELSE o END AS g FROM x""")
def plain_tokens(spark, sf_dir):
    """The same on nested tokens."""
    rows = spark.createDataFrame(LEGACY, "id int, t string, r string, g string, role string, syntax string")
    return rows.select("id", K.plain_token(F.struct("t", "r", "g", "role", "syntax")).alias("x")).select("id", "x.t", "x.r", "x.g")


@query(f"""
WITH {TOKENS}
SELECT doc, CAST(line AS INTEGER) AS line, CAST(ord AS INTEGER) AS ord, '/doc/' || doc || '/line/' || line || '/ord/' || ord AS path FROM tokens""")
def token_paths(spark, sf_dir):
    return tokens(spark, sf_dir).select("doc", "line", "ord", K.token_path(["doc", "line", "ord"]).alias("path"))


@query(f"""
WITH {TOKENS},
e AS (SELECT doc, line, ord, CASE WHEN ord % 2 = 0 THEN t ELSE 'other' END AS t, 'topic' AS g FROM tokens WHERE ord < 6)
SELECT k.doc, CAST(k.line AS INTEGER) AS line, sha256(string_agg(CASE WHEN e.t = k.t THEN e.g ELSE k.g END, ',' ORDER BY k.ord)) AS roles, CAST(count(*) FILTER (WHERE e.t <> k.t) AS BIGINT) AS stale
FROM tokens k LEFT JOIN e ON e.doc = k.doc AND e.line = k.line AND e.ord = k.ord GROUP BY 1, 2""")
def applied_edits(spark, sf_dir):
    """Roles set by path where the text is still the same; the others are told."""
    rows = tokens(spark, sf_dir)
    edits = rows.where("ord < 6").select("doc", "line", "ord", F.when(F.col("ord") % 2 == 0, F.col("t")).otherwise("other").alias("t"), F.lit("topic").alias("g"))
    out, stale = K.apply_edits(rows, edits, ["doc", "line", "ord"])
    g = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "g"))), lambda x: x["g"]), ",")
    gone = stale.groupBy("doc", "line").agg(F.count("*").alias("stale"))
    return out.groupBy("doc", "line").agg(F.sha2(g, 256).alias("roles")).join(gone, ["doc", "line"], "left").withColumn("stale", F.coalesce("stale", F.lit(0).cast("long")))


TITLES = [("春天来了", "はる てん/く", "x"), ("天a地", "tiān・dì", ""), ("山は川", "やま は かわ", "")]
#: Readings go to the Chinese characters in turn; a character that is the next reading itself uses it up.
SPELLED = [("春", "はる"), ("天", "てん"), ("来", "く"), ("了", "")], [("天", "tiān"), ("a", ""), ("地", "dì")], [("山", "やま"), ("は", ""), ("川", "かわ")]


@query(f"SELECT * FROM (VALUES {values([(i, j, *x) for i, row in enumerate(SPELLED) for j, x in enumerate(row)])}) t(id, \"at\", t, r)")
def spelled_titles(spark, sf_dir):
    rows = spark.createDataFrame([(i, *x) for i, x in enumerate(TITLES)], "id int, text string, reading string, rest string")
    return rows.select("id", F.posexplode(K.tokens_with_readings(F.col("text"), F.col("reading"))).alias("at", "x")).select("id", "at", "x.t", "x.r")


@query(f"""
WITH p(id, text) AS (VALUES {values([(i, x[0]) for i, x in enumerate(TITLES)])}),
c AS (SELECT id, unnest(string_split(text, '')) AS t, generate_subscripts(string_split(text, ''), 1) - 1 AS place FROM p)
SELECT id, CAST(place AS INTEGER) AS "at", t, CASE t WHEN '天' THEN 'てん' WHEN '山' THEN 'やま' ELSE '' END AS r FROM c""")
def title_readings(spark, sf_dir):
    """Titles with readings of single characters from a map."""
    known = F.create_map(F.lit("天"), F.lit("てん"), F.lit("山"), F.lit("やま"))
    rows = spark.createDataFrame([(i, x[0]) for i, x in enumerate(TITLES)], "id int, text string")
    return rows.select("id", F.posexplode(K.title_tokens(F.col("text"), known)).alias("at", "x")).select("id", "at", "x.t", "x.r")


RUBY = [("zh", 0, 0, 0, "天地", "tiān dì", "subject"), ("zh", 0, 0, 1, "，", "x", ""), ("zh", 0, 0, 2, "天a", "tiān", "object"), ("ja", 0, 0, 0, "食べる", "た", "predicate"), ("ja", 0, 0, 1, "山川", "", "subject"), ("ja", 0, 1, 0, "は", "は", "topic")]
#: Ruby stands on single Chinese characters only; words are cut for that, and tokens numbered anew.
RUBY_DONE = [("zh", 0, 0, "天", "tiān", "subject"), ("zh", 0, 1, "地", "dì", "subject"), ("zh", 0, 2, "，", "", ""), ("zh", 0, 3, "天", "tiān", "object"), ("zh", 0, 4, "a", "", "object"), ("ja", 0, 0, "食", "た", "predicate"), ("ja", 0, 1, "べる", "", "predicate"), ("ja", 0, 2, "山", "", "subject"), ("ja", 0, 3, "川", "", "subject"), ("ja", 1, 0, "は", "", "topic")]


@query(f"SELECT * FROM (VALUES {values(RUBY_DONE)}) t(lang, line, tok, t, r, g)")
def ruby_shapes(spark, sf_dir):
    rows = spark.createDataFrame(RUBY, "lang string, unit int, line int, tok int, t string, r string, g string")
    return R.normal_ruby(rows, ["unit"]).select("lang", "line", "tok", "t", "r", "g")


def _lists(spark, rows: list[tuple], *names: str):
    kind = "array<struct<t:string,r:string,g:string>>"
    return spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "id int, " + ", ".join(f"{n} {kind}" if n.startswith("tokens") else f"{n} array<{kind}>" if n == "lines" else f"{n} string" for n in names))


def _shown(tokens_: str):
    return F.array_join(F.transform(tokens_, lambda x: F.concat_ws("|", x["t"], F.coalesce(x["r"], F.lit("")), F.coalesce(x["g"], F.lit("")))), " ")


def _words(*rows: str) -> list[dict]:
    return [_token(*x.split("|")) for x in rows]


STRIPPED = [
    (_words("天||subject", "［1］", "地||object"), "天||subject 地||object"), (_words("天", " ", "[", "12", "]", " ", " ", "地"), "天|| 地||"), (_words("天（参看注①）", "地"), "天|| 地||"), (_words("（", "1737", "）", "年"), "年||"), (_words("天", "地"), "天|| 地||"),
]


@query(f"SELECT * FROM (VALUES {values([(i, x[1]) for i, x in enumerate(STRIPPED)])}) t(id, tokens)")
def stripped_tokens(spark, sf_dir):
    """Tokens without references to notes, within one or across several."""
    return _lists(spark, [(x[0],) for x in STRIPPED], "tokens").select("id", _shown(TK.strip_note_tokens("tokens")).alias("tokens"))


SYNCED = [
    ("天地。", _words("天|tiān|subject", "地|dì|object"), "天|tiān|subject 地|dì|object 。||"), ("天玄地", _words("天|tiān|subject", "地|dì|object"), "天|tiān|subject 玄|xuán| 地|dì|object"), ("地", _words("一", "二", "三", "四", "五", "六", "地|dì|object"), "地|de|"), ("a天", [], "a|| 天|tiān|"),
]


@query(f"SELECT * FROM (VALUES {values([(i, x[2]) for i, x in enumerate(SYNCED)])}) t(id, tokens)")
def canonical_tokens(spark, sf_dir):
    """A token for each character of the source, with what the given ones know of it, five ahead."""
    known = F.create_map(*[F.lit(x) for x in ("天", "tiān", "玄", "xuán", "地", "de")])
    return _lists(spark, [x[:2] for x in SYNCED], "source", "tokens").select("id", _shown(TK.canonical("source", "tokens", known)).alias("tokens"))


REPAIRED = [("天，地。", _words("天||subject", "地||object"), "天||subject ，|| 地||object 。||"), ("天地", _words("天。", "地"), "天|| 地||"), ("天地", _words("天", "玄", "地"), None), ("天地", _words("天地||object"), "天地||object")]


@query(f"SELECT * FROM (VALUES {values([(i, x[2]) for i, x in enumerate(REPAIRED)])}) t(id, tokens)")
def reconciled_tokens(spark, sf_dir):
    """Tokens that differ from the source by a few marks, put right; any other difference gives null."""
    done = TK.reconcile("source", "tokens")
    return _lists(spark, [x[:2] for x in REPAIRED], "source", "tokens").select("id", done.alias("x")).select("id", F.when(F.col("x").isNotNull(), _shown("x")).alias("tokens"))


LINES = [(60, 10, 54, 16), (10, 60, 16, 54), (60, 60, 60, 60), (54, 54, 54, 54), (55, 0, 54, 1)]


@query(f"SELECT * FROM (VALUES {values([(i, *x[2:]) for i, x in enumerate(LINES)])}) t(id, first, second)")
def balanced_lines(spark, sf_dir):
    """Two lines of 54 characters at most, where both together allow it."""
    rows = _lists(spark, [([_text("x" * a), _text("y" * b)],) for a, b, _, _ in LINES], "lines")
    return rows.select("id", TK.rebalance_lines("lines").alias("l")).select("id", F.size(F.col("l")[0]).alias("first"), F.size(F.col("l")[1]).alias("second"))


UNITS = [("天地", "天地。"), ("天地", "天地玄"), ("天地。，！？", "天地"), ("天", "地"), ("天 地", "天地")]


@query(f"""
WITH u(id, zh, source) AS (VALUES {values([(i, *x) for i, x in enumerate(UNITS)])}), c AS (SELECT *, regexp_replace(zh, '\\s+', '', 'g') AS a, regexp_replace(source, '\\s+', '', 'g') AS b FROM u)
SELECT id, CASE WHEN starts_with(b, a) AND length(b) > length(a) AND NOT regexp_matches(substr(b, length(a) + 1), '{_HAN}') THEN zh || substr(b, length(a) + 1) ELSE zh END AS restored,
  CASE WHEN abs(length(a) - length(b)) <= 3 AND (starts_with(a, b) OR starts_with(b, a)) THEN zh ELSE source END AS source FROM c""")
def restored_endings(spark, sf_dir):
    """Marks at the end that tokens lack, and sources that follow their tokens."""
    rows = spark.createDataFrame([(i, *x) for i, x in enumerate(UNITS)], "id int, zh_text string, source_text string")
    restored = rows.withColumn("restored", R.restored_ending(F.col("zh_text"), F.col("source_text")))
    return R.aligned_sources(restored).select("id", "restored", F.col("source_text").alias("source"))


@query(f"""
WITH {TOKENS},
p AS (SELECT doc, line, ord, t, sum(length(t)) OVER (PARTITION BY doc, line ORDER BY ord) AS stop, 40 + line % 9 AS size FROM tokens)
SELECT doc, CAST(line AS INTEGER) AS line, sha256(string_agg(left(t, CAST(least(length(t), size - stop + length(t)) AS BIGINT)), '' ORDER BY ord)) AS text FROM p WHERE stop - length(t) < size GROUP BY doc, line""")
def cut_tails(spark, sf_dir):
    """Lines of words cut to a length."""
    rows = tokens(spark, sf_dir).select("doc", "line", "ord", "t")
    targets = rows.select("doc", "line", (F.lit(40) + F.col("line") % 9).alias("size")).distinct()
    kept = R.cut_tail(rows, ["doc", "line"], targets)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "t"))), lambda x: x["t"]), "")
    return kept.groupBy("doc", "line").agg(F.sha2(text, 256).alias("text"))


READ = [("zh", "天", ""), ("zh", "天", "x"), ("zh", "地", ""), ("ja", "天", None), ("zh", "天地", ""), ("zh", "a", "")]


@query(f"""
WITH k(id, lang, t, r) AS (VALUES {values([(i, *x) for i, x in enumerate(READ)])}), d(lang, t, reading) AS (VALUES ('zh', '天', 'tiān'), ('ja', '天', 'てん'), ('zh', '天地', 'no'))
SELECT id, CASE WHEN length(k.t) = 1 AND regexp_matches(k.t, '{_HAN}') AND coalesce(r, '') = '' THEN coalesce(reading, '') ELSE r END AS r FROM k LEFT JOIN d ON d.lang = k.lang AND d.t = k.t""")
def backfilled(spark, sf_dir):
    """Readings of single characters from a table."""
    known = spark.createDataFrame([("zh", "天", "tiān"), ("ja", "天", "てん"), ("zh", "天地", "no")], "lang string, t string, reading string")
    rows = spark.createDataFrame([(i, *x) for i, x in enumerate(READ)], "id int, lang string, t string, r string")
    return R.backfilled_readings(rows, known).select("id", "r")


COMMENTS = [("天地", "a" * 42), ("天地", "a" * 43), ("天地玄黄宇宙洪荒日月盈昃", "a" * 48), ("天地玄黄宇宙洪荒日月盈昃", "a" * 49), ("", "a" * 90)]


@query(f"""
WITH u(id, source, ja) AS (VALUES {values([(i, *x) for i, x in enumerate(COMMENTS)])})
SELECT id, CASE WHEN source <> '' AND length(ja) > greatest(42, 4 * length(source)) THEN 'stock' ELSE ja END AS comment FROM u""")
def short_comments(spark, sf_dir):
    rows = spark.createDataFrame([(i, s, [_text("x"), _text(c)]) for i, (s, c) in enumerate(COMMENTS)], "id int, source_text string, ja array<array<struct<t:string,r:string,g:string>>>")
    stock = F.array(F.struct(F.lit("stock").alias("t"), F.lit("").alias("r"), F.lit("").alias("g")))
    return R.shortened_comments(rows, stock).select("id", K.surface(F.col("ja")[1]).alias("comment"))


@query("""
WITH i AS (SELECT doc_id, count(*) AS errors FROM (SELECT doc_id, unnest([CASE WHEN n_chars > 2000 THEN 'long' END, CASE WHEN lang = 'de' THEN 'lang' END]) AS rule FROM documents) WHERE rule IS NOT NULL GROUP BY doc_id)
SELECT doc_id, coalesce(errors, 0) AS errors, CASE WHEN errors IS NULL THEN 'reviewed' ELSE 'quarantined' END AS state FROM documents LEFT JOIN i USING (doc_id)""")
def promoted_outputs(spark, sf_dir):
    """Outputs by the issues that rules find."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    found = C.issues(docs, ["doc_id"], {"long": F.col("n_chars") > 2000, "lang": F.col("lang") == "de"})
    return R.promoted(docs, found, "doc_id").select("doc_id", "errors", "state")


@query(f"""
WITH {TOKENS},
i AS (SELECT doc, line, ord, row_number() OVER (PARTITION BY doc ORDER BY line, ord) AS rn FROM tokens WHERE g = '')
SELECT doc, string_agg(line || ':' || ord, ',' ORDER BY rn) FILTER (WHERE rn <= 12) AS first, CAST(greatest(count(*) - 12, 0) AS BIGINT) AS omitted FROM i GROUP BY doc""")
def first_issues(spark, sf_dir):
    """The first twelve words without a role of each document, and how many more there are."""
    found = tokens(spark, sf_dir).where("g = ''")
    out = C.first_issues(found, ["doc"], ["line", "ord"], 12)
    return out.select("doc", F.array_join(F.transform("issues", lambda x: F.concat_ws(":", x["line"].cast("string"), x["ord"].cast("string"))), ",").alias("first"), "omitted")


JA = ["山", "は", "川", "を", "見", "る", "之", "の", "石", "からx", "。", "ab", "行", "く"]
#: By the rules: particles tell, a character takes the role of the particle or ending behind it, marks and other text have none.
JA_ROLES = ["topic", "topic", "object", "object", "predicate", "", "function", "attributive", "adverbial", "adverbial", "", "", "predicate", ""]


@query(f"SELECT * FROM (VALUES {values([(i, *x) for i, x in enumerate(zip(JA, JA_ROLES, strict=True))])}) t(ord, t, g)")
def japanese_roles(spark, sf_dir):
    rows = spark.createDataFrame([(0, i, t, "") for i, t in enumerate(JA)], "line int, ord int, t string, g string")
    return R.inferred_ja(rows, ["line"]).select("ord", "t", "g")


PIPELINE = [("zh", 0, 0, 0, "天地", "tiān dì", None, "zhu", None), ("zh", 0, 0, 1, "的", "", "function", None, None), ("zh", 0, 0, 2, "玄", "xuán", "", None, None), ("zh", 0, 0, 3, "黄", "huáng", "bin", None, None), ("ja", 0, 0, 0, "天", "てん", "subject", None, None), ("ja", 0, 0, 1, "は", "", "function", None, None)]
_PIPELINE_KIND = "lang string, unit int, line int, tok int, t string, r string, g string, role string, syntax string"
#: Names put right, markers with the role before them; the whole repair also cuts ruby and fills what is missing.
NORMALIZED = [("zh", 0, "天地", "tiān dì", "subject"), ("zh", 1, "的", "", "subject"), ("zh", 2, "玄", "xuán", ""), ("zh", 3, "黄", "huáng", "object"), ("ja", 0, "天", "てん", "subject"), ("ja", 1, "は", "", "subject")]
MECHANICAL = [("zh", 0, "天", "tiān", "subject"), ("zh", 1, "地", "dì", "subject"), ("zh", 2, "的", "", "subject"), ("zh", 3, "玄", "xuán", "object"), ("zh", 4, "黄", "huáng", "object"), ("ja", 0, "天", "てん", "subject"), ("ja", 1, "は", "", "subject")]


@query(f"SELECT * FROM (VALUES {values([('normalized', *x) for x in NORMALIZED] + [('mechanical', *x) for x in MECHANICAL])}) t(form, lang, tok, t, r, g)")
def repair_pipelines(spark, sf_dir):
    rows = spark.createDataFrame(PIPELINE, _PIPELINE_KIND)
    out = [f(rows, ["unit"]).select(F.lit(name).alias("form"), "lang", "tok", "t", "r", "g") for name, f in (("normalized", R.normalized), ("mechanical", R.mechanical))]
    return out[0].unionByName(out[1])


@query(f"SELECT * FROM (VALUES {values([('zh', 0, '天', 'tiān', 'subject'), ('zh', 1, '地', '', 'subject'), ('zh', 2, '曰', '', 'predicate'), ('ja', 0, '山', 'やま', 'topic'), ('ja', 1, 'は', '', 'topic')])}) t(lang, tok, t, r, g)")
def compact_repair(spark, sf_dir):
    """Tokens cut to three characters, then readings and roles."""
    rows = spark.createDataFrame([("zh", 0, 0, 0, "天", "", ""), ("zh", 0, 0, 1, "地", "", ""), ("zh", 0, 0, 2, "曰", "", ""), ("zh", 0, 0, 3, "，", "", ""), ("ja", 0, 0, 0, "山", "", ""), ("ja", 0, 0, 1, "は", "", "")], "lang string, unit int, line int, tok int, t string, r string, g string")
    known = spark.createDataFrame([("zh", "天", "tiān"), ("ja", "山", "やま")], "lang string, t string, reading string")
    return R.compacted(rows, ["unit"], spark.createDataFrame([(0, 3)], "unit int, size int"), known).select("lang", "tok", "t", "r", "g")


PLACES = [("天地玄黄", "天地"), ("宇宙", "玄黄"), ("", "宇宙"), ("", "天地"), ("", "無")]
_REFERENCE = "天地玄黄" + "洪" * 500 + "宇宙荒"


@query(f"SELECT * FROM (VALUES {values([('c', 0, 0, 'ok'), ('c', 1, 2, 'ok'), ('c', 2, 504, 'ok'), ('c', 3, -1, 'missing'), ('c', 4, -1, 'missing')])}) t(chunk_id, ord, position, verdict)")
def reference_positions(spark, sf_dir):
    """Places of texts in a reference, in order; one far behind the furthest doesn't count."""
    rows = spark.createDataFrame([("c", i, x[1], _REFERENCE) for i, x in enumerate(PLACES)], "chunk_id string, ord int, text string, reference string")
    return kernels.match_references(rows)


@query(r"""
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE '{"id":' || doc_id || ',"n":[1,2],"s":"}{"}' END AS body FROM documents""")
def json_answers(spark, sf_dir):
    """The object in an answer, with stray commas repaired; answers without one give null."""
    body = F.concat(F.lit('Here: {"s": "}{", "n": [1,, 2], "id": '), F.col("doc_id").cast("string"), F.lit(",} and {more}"))
    return table(spark, sf_dir, "documents").select("doc_id", kernels.extract_json(F.when(F.col("doc_id") % 5 == 0, F.lit("no object")).otherwise(body)).alias("body"))


FEATURES = [("full", [_unit("天", ["てん", "注"])], "tiān", "subject"), ("bare", [_unit("天", ["", ""])], "", ""), ("none", [], "", "")]
#: Translation needs text in every unit, ruby a reading on every token with Chinese characters, grammar a role on every token.
FEATURE_ROWS = [("full", True, True, True, True, 4, 4, 1, 4004), ("bare", False, False, True, False, 1, 0, 1, 1001), ("none", False, False, False, False, 0, 0, 0, 0)]


@query(f"SELECT * FROM (VALUES {values(FEATURE_ROWS)}) t(id, translation, zh_ruby, ja_ruby, grammar, token_total, grammar_total, unit_count, score)")
def paragraph_features(spark, sf_dir):
    rows = []
    for id, units, r, g in FEATURES:
        units = json.loads(json.dumps(units))
        for x in [x for u in units for row in [u["zh"], *u["ja"]] for x in row]:
            x["r"], x["g"] = r if x["t"] == "天" else "ちゅう" if x["t"] == "注" else "", g
        rows.append((id, json.dumps(units, ensure_ascii=False)))
    from lexalign.schema import unit

    kind = f"array<{unit().simpleString()}>"
    df = spark.createDataFrame(rows, "id string, body string").select("id", F.from_json("body", kind).alias("units"))
    return A.features(df, ["id"]).withColumn("score", A.score()).select("id", "translation", "zh_ruby", "ja_ruby", "grammar", "token_total", "grammar_total", "unit_count", "score")


_BREAK = X.BREAK


def _tex(ruby: str, s: str, reading: str = "", role: str = "") -> str:
    plain = f"\\{ruby}{{{s}}}{{{reading}}}" if reading else s
    return (f"\\Gram{{{role}}}{{{plain}}}" if role else plain) + _BREAK


_ZH = _tex("zhpy", "天", "tiān", "subject") + _tex("zhpy", "\\&")
_JA = _tex("jpruby", "天", "てん"), _tex("jpruby", "注")
UNIT_MODES = [("auto", _ZH, _JA[0], _JA[1]), ("comment", _ZH, _JA[0], _JA[1]), ("hide", _ZH, _JA[0], ""), ("merge", _ZH, _JA[0] + _JA[1], "")]


@query(f"SELECT * FROM (VALUES {values([(m, f'{chr(92)}InterUnit{chr(10)}{{{a}}}{chr(10)}{{{b}}}{chr(10)}{{{c}}}{chr(10)}') for m, a, b, c in UNIT_MODES])}) t(mode, line)")
def rendered_units(spark, sf_dir):
    """A unit in the four layouts."""
    kind = "zh array<struct<t:string,r:string,g:string>>, ja array<array<struct<t:string,r:string,g:string>>>, roles array<string>"
    rows = spark.createDataFrame([([_token("天", "tiān", "subject"), _token("&")], [[_token("天", "てん")], [_token("注")]], ["gloss", "Comment"])], kind)
    out = None
    for mode in ("auto", "comment", "hide", "merge"):
        one = rows.select(F.lit(mode).alias("mode"), V.unit(F.col("zh"), F.col("ja"), F.col("roles"), mode).alias("line"))
        out = one if out is None else out.unionByName(one)
    return out


#: Headings where a node begins, a page break before any but the first story of a subsection, and marks around paragraphs.
DOCUMENT = [(0, "\\InterSection{卷一}"), (0, "\\InterSubsection{章}"), (0, "\\InterStory{y1}"), (0, "\\InterParagraphStart"), (0, "U"), (1, "U"), (1, "\\InterParagraphEnd\n"), (2, "\\InterStoryPageBreak"), (2, "\\InterStory{y2}"), (2, "\\InterParagraphStart"), (2, "U"), (2, "\\InterParagraphEnd\n"), (3, "\\InterSection{卷二}"), (3, "\\InterStory{y3}"), (3, "\\InterParagraphStart"), (3, "U"), (3, "\\InterParagraphEnd\n")]


@query(f"SELECT unit, CAST(row_number() OVER (PARTITION BY unit ORDER BY n) AS INTEGER) AS \"at\", line FROM (VALUES {values([(n, *x) for n, x in enumerate(DOCUMENT)])}) t(n, unit, line)")
def rendered_document(spark, sf_dir):
    """Lines of a document around its units, which are shown as U."""
    rows = [("d", 0, "s1", "u1", "y1", "p1", "卷一", "章", "y1"), ("d", 1, "s1", "u1", "y1", "p1", "卷一", "章", "y1"), ("d", 2, "s1", "u1", "y2", "p1", "卷一", "章", "y2"), ("d", 3, "s2", "u1", "y3", "p1", "卷二", "", "y3")]
    units = spark.createDataFrame(rows, "doc string, ord int, section string, subsection string, story string, paragraph string, section_title string, subsection_title string, story_title string")
    empty = F.array().cast("array<struct<t:string,r:string,g:string>>")
    units = units.withColumns({"zh": empty, "ja": F.array(empty, empty), "ja_line_roles": F.array(F.lit("gloss"), F.lit("note"))})
    lines = V.document(units).select(F.col("ord.unit").alias("unit"), F.col("ord.at").alias("at"), F.when(F.startswith("line", F.lit("\\InterUnit")), "U").otherwise(F.col("line")).alias("line"))
    place = F.row_number().over(V.W.partitionBy("unit").orderBy("at"))
    return lines.select("unit", place.alias("at"), "line")


TRILINGUAL = [("d", 0, "en", [("a_b", "x", "")]), ("d", 0, "zh", [("天", "tiān", "")]), ("d", 0, "ja", [("天", "てん", "topic")]), ("d", 1, "zh", [("地", "", "")])]


@query(f"SELECT * FROM (VALUES {values([('zh/ja', 0, chr(92) + 'TriPair{' + chr(92) + 'zhpy{天}{tiān}}{' + chr(92) + 'Gram{topic}{' + chr(92) + 'jpruby{天}{てん}}}'), ('zh/ja', 1, chr(92) + 'TriPair{地}{}'), ('en/zh', 0, chr(92) + 'TriPair{a' + chr(92) + '_b}{' + chr(92) + 'zhpy{天}{tiān}}'), ('en/zh', 1, chr(92) + 'TriPair{}{地}')])}) t(pair, ord, line)")
def rendered_pairs(spark, sf_dir):
    """Two of three languages, one above the other; only Chinese and Japanese have readings."""
    rows = spark.createDataFrame([(d, o, lang, [_token(*x) for x in ts]) for d, o, lang, ts in TRILINGUAL], "doc string, ord int, lang string, tokens array<struct<t:string,r:string,g:string>>")
    out = [V.trilingual(rows, *pair.split("/")).select(F.lit(pair).alias("pair"), "ord", "line") for pair in ("zh/ja", "en/zh")]
    return out[0].unionByName(out[1])


@query(f"SELECT role, '000000' AS color, true AS black FROM (VALUES {values([(r,) for r in V.PALETTE])}) t(role) UNION ALL SELECT * FROM (VALUES {values([(r, c, False) for r, c in (('subject', '13795B'), ('predicate', 'B23A48'), ('object', '286DA8'), ('attributive', '7C58A5'), ('adverbial', 'A96523'), ('complement', '1D7F91'), ('topic', '13795B'), ('function', '000000'))])}) u(role, color, black)")
def role_palette(spark, sf_dir):
    return V.palette(spark, True).withColumn("black", F.lit(True)).unionByName(V.palette(spark).withColumn("black", F.lit(False)))


@query(f"SELECT * FROM (VALUES {values([(0, 'gloss,explanatory_comment'), (1, 'a,b'), (2, None), (3, 'gloss,explanatory_comment')])}) t(id, roles)")
def line_roles(spark, sf_dir):
    """The usual roles of two lines where none, or not two, are given."""
    rows = spark.createDataFrame([(0, 2, None), (1, 2, ["a", "b"]), (2, 1, None), (3, 2, ["a"])], "id int, n int, roles array<string>")
    line = F.array().cast("array<struct<t:string,r:string,g:string>>")
    ja = F.array_repeat(line, F.col("n"))
    return rows.select("id", F.array_join(K.with_line_roles(ja, F.col("roles")), ",").alias("roles"))


@query(f"""
WITH {TOKENS}, c AS (SELECT doc, line, ord, t, CASE WHEN regexp_matches(t, '[A-Za-z0-9]') THEN 1 ELSE 0 END AS content, g FROM tokens)
SELECT doc, CAST(count(*) FILTER (WHERE g = '' AND content = 1) AS BIGINT) AS missing FROM c GROUP BY doc""")
def missing_roles(spark, sf_dir):
    """Content without a role, by the strict rule."""
    rows = tokens(spark, sf_dir).withColumns({"lang": F.lit("en"), "r": F.lit(""), "role": F.lit(None).cast("string"), "syntax": F.lit(None).cast("string")})
    found = C.issues(rows, ["doc"], {"C11": C.token_rules(strict=True)["C11"]})
    return rows.select("doc").distinct().join(found.groupBy("doc").agg(F.count("*").alias("missing")), "doc", "left").select("doc", F.coalesce("missing", F.lit(0).cast("long")).alias("missing"))


@query(f"""
WITH {TOKENS},
c AS (SELECT doc, lang, g, count(*) AS n FROM (SELECT doc, CASE WHEN line % 2 = 0 THEN 'zh' ELSE 'ja' END AS lang, CASE WHEN doc % 4 = 0 THEN 'subject' ELSE g END AS g, t FROM tokens) WHERE regexp_matches(t, '[A-Za-z0-9]') AND g NOT IN ('', 'function') GROUP BY 1, 2, 3),
s AS (SELECT doc, lang, g, n FROM c UNION ALL SELECT doc, 'both', g, sum(n) FROM c GROUP BY doc, g),
a AS (SELECT doc, lang, sum(n) AS total, count(*) AS roles, max(n) AS top FROM s GROUP BY doc, lang),
i AS (SELECT *, unnest([CASE WHEN (lang IN ('zh', 'ja') AND total >= 90 AND top / total >= 0.82) OR (lang = 'both' AND total >= 160 AND top / total >= 0.78) THEN 'collapse' END, CASE WHEN (lang IN ('zh', 'ja') AND total >= 90 AND roles < 4) OR (lang = 'both' AND total >= 160 AND roles < 4) THEN 'variety' END]) AS issue FROM a)
SELECT doc, lang, CAST(total AS BIGINT) AS total, issue FROM i WHERE issue IS NOT NULL""")
def collapsed_chunks(spark, sf_dir):
    """Documents whose roles are too uniform by the library's own bounds; a fourth of them has one role only."""
    rows = tokens(spark, sf_dir).withColumn("lang", F.when(F.col("line") % 2 == 0, "zh").otherwise("ja")).withColumn("g", F.when(F.col("doc") % 4 == 0, "subject").otherwise(F.col("g")))
    return C.collapsed(rows, ["doc"], G.CHUNK).select("doc", "lang", "total", "issue")
