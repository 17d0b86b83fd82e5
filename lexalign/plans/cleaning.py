"""Queries on cleaning, headings, slices and folds over the lines of documents."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.operators import chunking as C
from lexalign.operators import hierarchy as H
from lexalign.operators import tokens as K
from lexalign.operators import validate as R
from lexalign.plans.adapt import LINES, lines, paragraphs, registry, table, values
from lexalign.sources import readers as S

QUERIES, SQL, query = registry()
_SQUEEZE = r"trim(regexp_replace({}, '[\s\x{{3000}}\x{{00a0}}]+', ' ', 'g'))".format
_NORMAL = r"trim(regexp_replace(regexp_replace(translate({}, '〈〉()．', '（）（）.'), '[“”\"''`]+', '', 'g'), '\s*([，。！？；：、,.!?;:])\s*', '\1', 'g'))".format


@query(f"""
WITH {LINES}, n AS (SELECT doc, ord, {_NORMAL(_SQUEEZE("line"))} AS line FROM paragraphs)
SELECT doc, CAST(ord AS INTEGER) AS ord, sha256(line) AS line, sha256(regexp_replace(regexp_replace(line, '[，。！？；：、,.!?;:]+$', ''), '\\s+', '', 'g')) AS heading FROM n""")
def normalized_lines(spark, sf_dir):
    """Lines with marks put right, and as headings."""
    return paragraphs(spark, sf_dir).select("doc", "ord", F.sha2(X.normalize_line(F.col("line")), 256).alias("line"), F.sha2(X.compact_heading(F.col("line")), 256).alias("heading"))


HEADINGS = ["神话", " 传 说 。", "动物故事", "很长很长很长很长很长很长很长很长很长的故事", "０１２．来了 一个 人", "123、 天地", "12. 短", "第十二章", " 第 3章 ", "春天 〈来〉 了 ， “风”", "ａｂ１９３５年", "故事会"]
_HEADS = values(list(enumerate(HEADINGS)))


@query(f"""
WITH h(id, line) AS (VALUES {_HEADS}),
n AS (SELECT id, line, {_NORMAL("regexp_replace(regexp_replace(trim(regexp_replace(line, '\\s+', ' ', 'g')), '([一-鿿]) ([一-鿿])', '\\1\\2', 'g'), '([一-鿿]) ([一-鿿])', '\\1\\2', 'g')")} AS norm FROM h),
c AS (SELECT *, regexp_replace(regexp_replace(norm, '[，。！？；：、,.!?;:]+$', ''), '\\s+', '', 'g') AS head FROM n)
SELECT id, norm, head, head IN ('神话', '传说', '故事', '笑话', '寓言') AS major, length(head) <= 18 AND regexp_matches(head, '(神话|传说|故事|笑话|寓言)$') AS sub,
  CASE WHEN regexp_matches(norm, '^[0-9０-９]{{3}}\\s*[.．、]\\s*.+$') THEN translate(substr(norm, 1, 3), '０１２３４５６７８９', '0123456789') || '. ' || trim(regexp_extract(norm, '^[0-9０-９]{{3}}\\s*[.．、]\\s*(.+)$', 1)) END AS story,
  translate(line, '０１２３４５６７８９', '0123456789') AS digits, CASE WHEN regexp_matches(trim(line), '^第[一二三四五六七八九十百千〇零0-9]+章$') THEN '# ' || trim(line) ELSE line END AS chapter FROM c""")
def heading_classes(spark, sf_dir):
    """Kinds of headings."""
    line = F.col("line")
    rows = spark.createDataFrame(list(enumerate(HEADINGS)), "id int, line string")
    return rows.select("id", X.normalize_line(line).alias("norm"), X.compact_heading(line).alias("head"), X.is_major_title(line).alias("major"), X.is_subsection_title(line).alias("sub"), X.story_heading(line).alias("story"), X.fold_digits(line).alias("digits"), X.promote_chapter(line).alias("chapter"))


_JOIN = r"regexp_replace(regexp_replace(regexp_replace(array_to_string(list_filter(list_transform({}, lambda x: trim(regexp_replace(x, '[ \t]+', ' ', 'g'), ' ' || chr(9) || chr(13) || chr(10))), lambda x: x <> ''), chr(10)), '([A-Za-z0-9])\n([A-Za-z0-9])', '\1 \2', 'g'), '([A-Za-z0-9])\n([A-Za-z0-9])', '\1 \2', 'g'), '\n', '', 'g')".format


@query(f"""SELECT doc_id, sha256({_JOIN("string_split(text, chr(10))")}) AS joined FROM documents""")
def joined_lines(spark, sf_dir):
    """Lines of a document as one, a space only between two letters or digits."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(X.join_cjk(F.split("text", "\n")), 256).alias("joined"))


_NUMBERS = r"'((^|\n)[ \t]*[0-9]{1,4}[ \t]*)+$'"


@query(rf"""
WITH p AS (SELECT doc_id, trim(regexp_replace(trim(regexp_replace(text || chr(10) || chr(10) || doc_id, '[ \t\x{{3000}}\x{{a0}}]+(\n|$)', '\1', 'g'), chr(10) || ' ' || chr(9)), {_NUMBERS}, ''), chr(10) || ' ' || chr(9)) AS t FROM documents),
b AS (SELECT doc_id, list_filter(list_transform(string_split_regex(t, '\n\s*\n'), lambda b: {_JOIN(f"string_split(regexp_replace(b, {_NUMBERS}, ''), chr(10))")}), lambda x: x <> '') AS blocks FROM p)
SELECT doc_id, sha256(array_to_string(blocks, chr(10) || chr(10))) AS page FROM b""")
def cleaned_pages(spark, sf_dir):
    """Documents as recognised pages with a page number below."""
    page = F.concat("text", F.lit("\n\n"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(X.clean_page(page), 256).alias("page"))


@query(rf"""
WITH t AS (SELECT doc_id, regexp_replace(text || CASE WHEN doc_id % 3 = 0 THEN chr(10) || '{X.PUBLIC_DOMAIN} x' || chr(10) || chr(10) || 'Public domain Public domain false false' || chr(10) || chr(10) || chr(10) || chr(10) ELSE '' END || 'end', '\n{X.PUBLIC_DOMAIN}[^\n]*\n\nPublic domain Public domain false false\n', chr(10), 'g') AS t FROM documents),
l AS (SELECT doc_id, string_split(regexp_replace(t, '\n{{4,}}', repeat(chr(10), 3), 'g'), chr(10)) AS l FROM t)
SELECT doc_id, sha256(array_to_string(list_transform(l, lambda x: rtrim(x, ' ' || chr(9) || chr(13))), chr(10)) || chr(10)) AS text, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS removed FROM l""")
def boilerplate(spark, sf_dir):
    """Documents, a third of them with a notice behind."""
    notice = F.when(F.col("doc_id") % 3 == 0, F.lit(f"\n{X.PUBLIC_DOMAIN} x\n\nPublic domain Public domain false false\n\n\n\n")).otherwise("")
    rows = table(spark, sf_dir, "documents").select("doc_id", X.strip_boilerplate(F.concat("text", notice, F.lit("end"))).alias("x"))
    return rows.select("doc_id", F.sha2("x.text", 256).alias("text"), "x.removed")


PAIRS = [("天 地 。", "地。"), ("天地。", "地。"), ("天地", ""), ("天地", "玄"), ("a b c", "bc")]
SWAPS = [("天", "subject", "tiān"), ("天地", "subject", ""), ("天", "subject", ""), ("天", "tiān", "subject"), ("天", "", "noun"), ("，", "object", "")]
RUBY = [("軒のき端ば", "軒端"), ("氷柱つらら", "氷柱"), ("山川", "川山"), ("a.b", "a.b"), ("axb", "a.b")]
AUTHORS = [("川端康成", "かわばた やすなり"), ("夏目", "なつ め"), ("魯迅", "ろじん"), ("a_b", ""), ("一二三四五", "a b c")]
#: By the rules: two readings halve the name, as many as characters go one each, one covers all, any other number too.
AUTHOR_TEX = ["\\jpruby{川端}{かわばた}\\jpruby{康成}{やすなり}", "\\jpruby{夏}{なつ}\\jpruby{目}{め}", "\\jpruby{魯迅}{ろじん}", "a\\_b", "\\jpruby{一二三四五}{a b c}"]


@query(f"""
WITH p(id, a, b) AS (VALUES {values([(i, *x) for i, x in enumerate(PAIRS)])}), c AS (SELECT *, regexp_replace(a, '\\s+', '', 'g') AS bare FROM p)
SELECT id, CASE WHEN b = '' THEN a WHEN suffix(a, b) THEN left(a, length(a) - length(b)) WHEN suffix(bare, b) THEN left(bare, length(bare) - length(b)) ELSE a END AS trimmed FROM c""")
def suffix_trims(spark, sf_dir):
    rows = spark.createDataFrame([(i, *x) for i, x in enumerate(PAIRS)], "id int, a string, b string")
    return rows.select("id", X.trim_suffix(F.col("a"), F.col("b")).alias("trimmed"))


_ROLE = "({} IN ('subject','predicate','object','attributive','adverbial','complement','topic','function'))".format


@query(f"""
WITH s(id, t, r, g) AS (VALUES {values([(i, *x) for i, x in enumerate(SWAPS)])}),
c AS (SELECT *, {_ROLE("r")} AND g <> '' AND NOT {_ROLE("g")} AS moved, {_ROLE("r")} AND g = '' AND length(t) > 1 AS alone FROM s)
SELECT id, CASE WHEN moved THEN g WHEN alone THEN '' ELSE r END AS r, CASE WHEN moved OR alone THEN r WHEN g <> '' AND NOT {_ROLE("g")} THEN '' ELSE g END AS g FROM c""")
def swapped_readings(spark, sf_dir):
    """Readings and roles that were exchanged; a role alone stays with a character or a mark, as it may be a reading there."""
    rows = spark.createDataFrame([(i, *x) for i, x in enumerate(SWAPS)], "id int, t string, r string, g string")
    return rows.select("id", X.swapped(F.col("t"), F.col("r"), F.col("g")).alias("x")).select("id", "x.r", "x.g")


_KANA = "[ぁ-ゟァ-ヿ]*"


@query(f"""
WITH p(id, a, b) AS (VALUES {values([(i, *x) for i, x in enumerate(RUBY)])})
SELECT id, regexp_matches(a, array_to_string(list_transform(string_split(b, ''), lambda c: CASE WHEN regexp_matches(c, '[一-鿿]') THEN '{_KANA}' || c || '{_KANA}' ELSE regexp_escape(c) END), '')) AS found FROM p""")
def ruby_matches(spark, sf_dir):
    rows = spark.createDataFrame([(i, *x) for i, x in enumerate(RUBY)], "id int, a string, b string")
    return rows.select("id", F.rlike(F.col("a"), X.ruby_pattern(F.col("b"))).alias("found"))


@query(f"SELECT * FROM (VALUES {values([(i, x) for i, x in enumerate(AUTHOR_TEX)])}) t(id, tex)")
def author_ruby(spark, sf_dir):
    return spark.createDataFrame([(i, X.tex_author(*x)) for i, x in enumerate(AUTHORS)], "id int, tex string")


@query(f"""
WITH {LINES}, c AS (SELECT doc, ord, length(regexp_replace(line, '\\s+', '', 'g')) AS n, regexp_replace(line, '\\s+', '', 'g') AS t, line FROM paragraphs)
SELECT doc, CAST(ord AS INTEGER) AS ord, regexp_matches(t, '^([（(]?\\d+[.．、)]|[［\\[]\\d+[］\\]])') OR regexp_matches(t, '[［\\[].{{4,}}?[］\\]]') OR regexp_matches(t, '译者|译注|注释|注：') AS editorial,
  regexp_matches(lower(line), 'usage limit|rate limit|quota exceeded|too many requests') AS limited, CASE WHEN regexp_matches(t, '[A-Za-z0-9]') THEN true ELSE regexp_matches(t, '[\\x{{3400}}-\\x{{4dbf}}\\x{{4e00}}-\\x{{9fff}}\\x{{f900}}-\\x{{faff}}\\x{{3041}}-\\x{{309f}}\\x{{30a0}}-\\x{{30ff}}]') END AS content FROM c""")
def line_flags(spark, sf_dir):
    """Lines that look like an editor's note, tell of a limit, or have content."""
    from lexalign.operators.progress import usage_limited

    return paragraphs(spark, sf_dir).select("doc", "ord", R.editorial_note(F.col("line")).alias("editorial"), usage_limited(F.col("line")).alias("limited"), X.is_content(F.col("line")).alias("content"))


NOTE_UNITS = [("［1］说明", "", "", ""), ("注：天地", "", "", ""), ("天地", "てんち", "天地", ""), ("", "", "①", ""), ("", "", "天①", ""), ("参看第三页注①。", "", "", ""), ("天地玄黄宇宙洪荒参看注①", "", "", ""), ("天", "（注2）", "", ""), ("译注 3：x", "", "", "")]
_BEGINS = r"^\s*([\[［〔【(（]\s*(注|註)?\s*[0-9０-９]+\s*[\]］〕】)）]|[\[［〔【(（]\s*注\s*[0-9０-９]*\s*[\]］〕】)）]|(注|註|译注|譯注|注释|註釋|訳注|脚注|注釈|注記)\s*([0-9０-９]+)?\s*[:：\[]?)"
_STRIPPED = "c"
for _form in X.NOTE_REFERENCES:
    _STRIPPED = f"regexp_replace({_STRIPPED}, '{_form}', '', 'g')"


@query(f"""
WITH u(id, zh, ja, source, corrected) AS (VALUES {values([(i, *x) for i, x in enumerate(NOTE_UNITS)])}),
l AS (SELECT id, zh, unnest([zh, ja, source, corrected]) AS c, unnest([1, 2, 3, 4]) AS k FROM u),
m AS (SELECT id, bool_or(regexp_matches(trim(c), '{_BEGINS}') OR regexp_matches(trim(c), '{X.SHORT_NOTE}') OR (k > 2 AND trim(c) <> '' AND trim(zh) = '' AND trim({_STRIPPED}) = '')) AS note FROM l GROUP BY id)
SELECT id, note FROM m""")
def note_units(spark, sf_dir):
    """Units that are nothing but an editor's note."""
    rows = spark.createDataFrame([(i, *x) for i, x in enumerate(NOTE_UNITS)], "id int, zh string, ja string, source string, corrected string")
    return rows.select("id", R.note_unit(*[F.col(c) for c in ("zh", "ja", "source", "corrected")]).alias("note"))


_FIRST = "regexp_matches(line, '^[D-F]')"


@query(f"""
WITH {LINES}, m AS (SELECT doc, min(ord) FILTER (WHERE {_FIRST}) AS first FROM lines GROUP BY doc)
SELECT l.doc, CAST(count(*) FILTER (WHERE first IS NULL OR ord >= first) AS BIGINT) AS behind, CAST(count(*) FILTER (WHERE first IS NULL OR ord < first) AS BIGINT) AS before FROM lines l JOIN m USING (doc) GROUP BY l.doc""")
def line_slices(spark, sf_dir):
    """Lines from the first that begins with D, E or F, and those before."""
    rows = lines(spark, sf_dir)
    match = F.col("line").rlike("^[D-F]")
    both = H.from_first(rows, match).select("doc", F.lit(1).alias("behind"), F.lit(0).alias("before")).unionByName(H.before_first(rows, match).select("doc", F.lit(0).alias("behind"), F.lit(1).alias("before")))
    return both.groupBy("doc").agg(F.sum("behind").alias("behind"), F.sum("before").alias("before"))


@query(f"""
WITH {LINES},
s AS (SELECT doc, max(ord) AS start FROM lines WHERE regexp_matches(line, '^[A-F]') GROUP BY doc),
b AS (SELECT l.*, start FROM lines l JOIN s USING (doc) WHERE ord > start),
e AS (SELECT doc, min(ord) AS stop FROM b WHERE regexp_matches(line, '^[T-Z]') GROUP BY doc)
SELECT b.doc, CAST(ord AS INTEGER) AS ord FROM b LEFT JOIN e ON b.doc = e.doc WHERE stop IS NULL OR ord < stop""")
def captured_lines(spark, sf_dir):
    """Lines behind the last one that begins with A to F, up to one that begins with T to Z."""
    return H.captured(lines(spark, sf_dir), F.col("line").rlike("^[A-F]"), F.col("line").rlike("^[T-Z]")).select("doc", "ord")


@query(f"""
WITH {LINES},
p AS (SELECT doc, ord, CASE WHEN length(line) % 7 = 0 THEN length(line) % 50 END AS page FROM lines),
f AS (SELECT doc, ord, page, last_value(page IGNORE NULLS) OVER (PARTITION BY doc ORDER BY ord) AS now FROM p)
SELECT doc, CAST(ord AS INTEGER) AS ord, CAST(now AS INTEGER) AS page FROM f WHERE page IS NULL AND coalesce(now, 0) >= 10""")
def paged_lines(spark, sf_dir):
    """Lines with the page before them, from page 10 on; lines of some lengths stand for page numbers."""
    page = F.when(F.length("line") % 7 == 0, F.length("line") % 50)
    return H.paged(lines(spark, sf_dir), page, 10).select("doc", "ord", "page")


@query(f"""
WITH {LINES},
m AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) = '' AS blank FROM lines),
w AS (SELECT *, coalesce(lag(blank) OVER (PARTITION BY doc ORDER BY ord), false) AS again, min(CASE WHEN NOT blank THEN ord END) OVER (PARTITION BY doc) AS first, max(CASE WHEN NOT blank THEN ord END) OVER (PARTITION BY doc) AS last FROM m)
SELECT doc, CAST(ord AS INTEGER) AS ord FROM w WHERE NOT blank OR (NOT again AND ord > first AND ord < last)""")
def collapsed_blanks(spark, sf_dir):
    return H.collapse_blanks(lines(spark, sf_dir)).select("doc", "ord")


@query(f"""
WITH RECURSIVE {LINES},
e AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) = '' AS blank, regexp_matches(line, '[。！？!?.][」』”’）)]*\\s*$') AS ends FROM lines),
i AS (SELECT *, sum(CASE WHEN closed THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY ord) AS island FROM (SELECT *, coalesce(lag(ends OR blank) OVER (PARTITION BY doc ORDER BY ord), false) AS closed FROM e)),
n AS (SELECT doc, island, line, length(line) AS size, row_number() OVER (PARTITION BY doc, island ORDER BY ord) AS rn, ord FROM i WHERE NOT blank),
fold AS (
  SELECT doc, island, rn, ord, CAST(size AS BIGINT) AS held, 1 AS pack FROM n WHERE rn = 1
  UNION ALL
  SELECT n.doc, n.island, n.rn, n.ord, CASE WHEN f.held >= 120 THEN n.size ELSE f.held + n.size END, CASE WHEN f.held >= 120 THEN f.pack + 1 ELSE f.pack END
  FROM fold f JOIN n ON n.doc = f.doc AND n.island = f.island AND n.rn = f.rn + 1),
b AS (SELECT doc, island, pack, min(ord) AS first, count(*) AS lines FROM fold GROUP BY 1, 2, 3)
SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY first) AS INTEGER) AS block, CAST(lines AS BIGINT) AS lines FROM b""")
def flushed_lines(spark, sf_dir):
    """Lines joined until one ends a sentence or 120 characters are reached; the blocks are counted by their lines."""
    marked = lines(spark, sf_dir).withColumn("line", F.col("line"))
    blocks = S.pdf_paragraphs(marked, 120)
    # the number of a block's lines: how many lines its text was joined from
    sizes = F.length(F.regexp_replace("text", r"\s+", ""))
    rows = marked.where(X.strip(F.col("line")) != "").withColumn("end", F.sum(F.length(F.regexp_replace("line", r"\s+", ""))).over(H.so_far()))
    ends = blocks.withColumn("end", F.sum(sizes).over(W.partitionBy("doc").orderBy("block").rowsBetween(W.unboundedPreceding, 0))).withColumn("start", F.col("end") - sizes)
    met = ends.alias("b").join(rows.alias("l"), (F.col("b.doc") == F.col("l.doc")) & (F.col("l.end") > F.col("b.start")) & (F.col("l.end") <= F.col("b.end")))
    return met.groupBy("b.doc", "b.block").agg(F.count("*").alias("lines"))


@query(r"""
WITH RECURSIVE s AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^。！？!?]*[。！？!?]+[」』”’）)\]】]*|[^。！？!?]+$')) AS x FROM documents),
t AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id) AS raw, trim(x, ' ' || chr(10) || chr(9) || chr(13)) AS x FROM s),
n AS (SELECT doc_id, length(x) AS size, row_number() OVER (PARTITION BY doc_id ORDER BY raw) AS rn FROM t WHERE x <> ''),
fold AS (
  SELECT doc_id, rn, CAST(size AS BIGINT) AS held, 1 AS pack FROM n WHERE rn = 1
  UNION ALL
  SELECT n.doc_id, n.rn, CASE WHEN f.held + n.size <= 300 THEN f.held + n.size ELSE n.size END, CASE WHEN f.held + n.size <= 300 THEN f.pack ELSE f.pack + 1 END FROM fold f JOIN n ON n.doc_id = f.doc_id AND n.rn = f.rn + 1),
g AS (SELECT doc_id, pack, max(held) AS size FROM fold GROUP BY 1, 2)
SELECT doc_id, CAST(count(*) AS BIGINT) AS groups, CAST(max(size) AS BIGINT) AS longest FROM g GROUP BY doc_id""")
def grouped_sentences(spark, sf_dir):
    """Sentences joined as long as 300 characters hold them."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(C.packed(X.sentences(F.col("text")), 300)).alias("x"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("groups"), F.max(F.length("x")).cast("long").alias("longest"))


@query(f"""
WITH {LINES}, b AS (SELECT doc, lag(line) OVER (PARTITION BY doc ORDER BY ord) AS before, line, ord FROM paragraphs),
p AS (SELECT doc, ord, before, line, list_filter(generate_series(1, least(length(before), length(line))), lambda i: substr(before, i, 1) <> substr(line, i, 1)) AS d FROM b WHERE before IS NOT NULL),
a AS (SELECT *, coalesce(d[1] - 1, least(length(before), length(line))) AS n FROM p)
SELECT doc, CAST(ord AS INTEGER) AS ord, CAST(n AS INTEGER) AS "at", substr(before, greatest(n - 19, 1), 40) AS expected, substr(line, greatest(n - 19, 1), 40) AS got FROM a""")
def line_mismatches(spark, sf_dir):
    """Where a line begins to differ from the one before."""
    rows = paragraphs(spark, sf_dir).withColumn("before", F.lag("line").over(W.partitionBy("doc").orderBy("ord"))).where("before IS NOT NULL")
    return rows.select("doc", "ord", K.mismatch(F.col("before"), F.col("line")).alias("x")).select("doc", "ord", F.col("x.at").cast("int").alias("at"), "x.expected", "x.got")
