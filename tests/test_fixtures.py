"""Behaviour on inline fixtures, kernels against plain specifications, and properties."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.operators import align as L
from lexalign.operators import artifacts as A
from lexalign.operators import assemble as B
from lexalign.operators import chunking as C
from lexalign.operators import hierarchy as H
from lexalign.operators import kernels as K
from lexalign.operators import progress as P
from lexalign.operators import render as V
from lexalign.operators import repair as R
from lexalign.operators import token_kernels as TK
from lexalign.operators import tokens as T
from lexalign.operators import validate as Y
from lexalign.plans import fixtures as Q
from lexalign.schema import MODE
from lexalign.sources import readers as S
from lexalign.sources import writers as W


def one(spark, **columns):
    """Values of expressions over a single row."""
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    return row.asDict(recursive=True)


def lines(spark, text, doc="d"):
    return spark.createDataFrame([(doc, i, x) for i, x in enumerate(text)], "doc string, ord int, line string")


def text(df):
    return [r.line for r in df.orderBy("ord").collect()]


def test_text_functions(spark):
    lit = F.lit
    got = one(
        spark, compact=X.compact(lit("a　b c\x1cd\n")), strip=X.strip(lit("　 a b ")), clean=X.clean_text(lit("天[12] 地[３]  x ")), line=X.clean_line(lit("[文](x.html)<ruby>漢<rt>かん</rt></ruby>&amp;lt;　 z")),
        notes=X.strip_note_references(lit("天[12]地（参看注①）玄")), norm=X.normalize_line(lit("春 天 〈来〉 了 ， “风”")), head=X.compact_heading(lit("第 一 章 。")), join=X.join_cjk(F.array(lit("春天"), lit("来 了"), lit("abc"), lit("def"), lit(""))),
        sents=X.sentences(lit("春天来了。「风？」很轻！走")), role=X.role(lit(" Zhu ")), noise=X.ocr_noise(lit("天||地 abcdef_g")), tex=X.tex_escape(lit("a\\b_{c}&")), trim=X.trim_suffix(lit("天 地 。"), lit("地。")),
        swap=X.swapped(lit("天"), lit("subject"), lit("tiān")), title=X.display_title(lit("本紀/五帝"), "本紀"), none=X.display_title(lit(" ")), part=X.part_number(lit("上卷")), page=X.clean_page(lit("春天\n来了\n\nabc \ndef\n12\n")),
        chunk=X.chunk_number(lit("b-chunk-0042")), slug=X.slug(lit(" 卷 一：x "), lit("f")), bare=X.slug(lit("：："), lit("f")), promoted=X.promote_chapter(lit(" 第十二章 ")), digits=X.fold_digits(lit("１９３５")), split=X.lines(lit("a\r\nb\x0bc\n")),
    )
    assert got["compact"] == "abcd" and got["strip"] == "a b" and got["clean"] == "天 地 x" and got["line"] == "文漢&lt; z"
    assert got["notes"] == "天地玄" and got["norm"] == "春天 （来） 了，风" and got["head"] == "第一章" and got["join"] == "春天来 了abc def"
    assert got["sents"] == ["春天来了。", "「风？」", "很轻！", "走"] and got["role"] == "subject" and got["noise"] == ["debris", "ascii_run"]
    assert got["tex"] == r"a\textbackslash{}b\_\{c\}\&" and got["trim"] == "天" and got["swap"] == {"r": "tiān", "g": "subject"}
    assert got["title"] == "五帝" and got["none"] == "未題" and got["part"] == 1 and got["page"] == "春天来了\n\nabc def"
    assert got["chunk"] == 42 and got["slug"] == "卷-一x" and got["bare"] == "f" and got["promoted"] == "# 第十二章" and got["digits"] == "1935" and got["split"] == ["a", "b", "c"]


def test_boilerplate(spark):
    notice = "x\n此作品在全世界都属于 公有领域 abc\n\nPublic domain Public domain false false\ny  \n\n\n\n\nz"
    assert one(spark, a=X.strip_boilerplate(F.lit(notice)))["a"] == {"text": "x\ny\n\n\nz\n", "removed": 1}


def test_ruby_pattern(spark):
    rows = spark.createDataFrame([("軒のき端ば", "軒端"), ("氷柱つらら", "氷柱"), ("山川", "川山")], "a string, b string")
    assert [r.ok for r in rows.select(F.rlike(F.col("a"), X.ruby_pattern(F.col("b"))).alias("ok")).collect()] == [True, True, False]


def test_pages():
    assert X.pages("1,5,9-12,10", 20) == [1, 5, 9, 10, 11, 12] and X.pages("ALL", 3) == [1, 2, 3]
    for bad in ("5-3", "0", "1-9"):
        with pytest.raises(ValueError):
            X.pages(bad, 8)


def test_author():
    assert X.tex_author("川端康成", "かわばた やすなり") == r"\jpruby{川端}{かわばた}\jpruby{康成}{やすなり}"
    assert X.tex_author("a_b", "") == r"a\_b" and X.tex_author("夏目", "なつ め") == r"\jpruby{夏}{なつ}\jpruby{目}{め}"


def test_lines(spark):
    assert text(H.collapse_blanks(lines(spark, ["", "a", "", " ", "b", ""]))) == ["a", "", "b"]
    md = lines(spark, Q.MARKDOWN)
    assert text(H.section_slice(md, "章一")) == ["## 章一", "段落乙一", "段落乙二。", "", "", "### 节一", "段落丙。", "#### 小节", "段落丁。"]
    assert text(H.section_slice(md, "卷", end="卷二", start_prefix=True))[0] == "# 卷一" and H.section_slice(md, "无").count() == 0
    assert text(H.from_first(md, F.col("line") == "# 卷二")) == ["# 卷二", "段落戊。"] and H.before_first(md, F.col("line") == "x").count() == len(Q.MARKDOWN)
    assert text(H.captured(lines(spark, ["s", "a", "s", "b", "e", "c"]), F.col("line") == "s", F.col("line") == "e")) == ["b"]
    paged = lines(spark, ["1", "a", "2", "b"])
    assert text(H.paged(paged, F.regexp_extract("line", r"^(\d+)$", 1).try_cast("int"), 2)) == ["b"]
    flushed = [r.text for r in S.pdf_paragraphs(lines(spark, ["春天", "来了。", "风", "", "很轻", "x" * 420, "走"])).orderBy("block").collect()]
    assert flushed == ["春天来了。", "风", "很轻" + "x" * 420, "走"]


def test_chunks(spark):
    def packs(sizes, budget):
        rows = spark.createDataFrame([("d", i, "x" * n, "a", "b", "c") for i, n in enumerate(sizes)], "doc string, paragraph int, text string, section_id string, subsection_id string, story_id string")
        got = C.chunks(rows, budget).groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("paragraph", "size"))).alias("p")).orderBy("chunk").collect()
        return [[x["size"] for x in r.p] for r in got]

    assert packs([4, 6, 1], 10) == [[4, 6], [1]] and packs([12, 3], 10) == [[12], [3]] and packs([5, 5, 5], 10) == [[5, 5], [5]]
    with pytest.raises(ValueError):
        C.chunks(spark.range(1), 1, "other")


def test_split_is_lossless(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("天地玄黄。！，、〉ab ") for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    rows = spark.createDataFrame([(f"c{i}", f"p{i}", t, i) for i, t in enumerate(texts)], "chunk_id string, paragraph_id string, text string, ord int")
    parts = C.split_oversized(rows, 12)
    got = parts.groupBy("ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("split_part", F.lit(0)).alias("p"), "text"))), lambda x: x["text"]), "").alias("t"), F.max(F.length("text")).alias("n")).collect()
    assert {r.ord: r.t for r in got} == dict(enumerate(texts)) and max(r.n for r in got) <= 12 + 80
    first = parts.where("split_part = 1").first()
    assert first.chunk_id == first.split_from_chunk_id and first.paragraph_id.endswith("-part-01")
    order = parts.withColumn("ord", F.col("ord") * 100 + F.coalesce("split_part", F.lit(0))).withColumn("doc", F.lit("d"))
    assert {r.chunk_id: r.text for r in C.merge_parts(order).collect()} == {f"c{i}": t for i, t in enumerate(texts)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=8), st.lists(st.integers(1, 30), min_size=1, max_size=30))
def test_proportional(a, b):
    got = K.proportional(a, b)
    assert len(got) == len(b) and got == sorted(got) and got[-1] < len(a)
    if len(b) >= len(a):
        assert set(got) == set(range(len(a)))


def test_match_in_order():
    reference = "春が来て風は軽い。私は小径をゆっくり歩く。花は静かに咲く。"
    places = K.match_in_order([("春が来て", ""), ("花は静かに", ""), ("私は小径", ""), ("なし", "")], reference, K.find_reference)
    assert [v for _, v in places] == ["ok", "ok", "ok", "missing"]
    assert K.find_reference("氷柱つららが軒のき端ばに", "氷柱が軒端に", 0) == 0 and K.find_reference("漢カナab", "漢カナab", 1) == -1


def test_json():
    assert K.parsed_object('```json\n{"a": [1,2,], "b": "}{"}\n``` tail') == '{"a":[1,2],"b":"}{"}'
    assert K.parsed_object("none") is None and K.parsed_object(None) is None and K.parsed_object('{"a": 1') is None


def test_references(spark):
    chunks = spark.createDataFrame([(f"c{i}", i, k) for i, k in enumerate(["a", "a", "b", "c", ""])], "chunk_id string, ord int, key string")
    refs = spark.createDataFrame([("a", "r2", 2), ("a", "r1", 1), ("b", "r3", 1), ("c", "r1", 1)], "key string, ref_id string, ref_ord int")
    got = {r.chunk_id: (r.ref_ids, r["keys"]) for r in L.neighbours(chunks, refs, 1).collect()}
    assert got["c0"] == (["r1", "r2", "r3"], ["a", "b"]) and got["c2"] == (["r1", "r2", "r3"], ["a", "b", "c"]) and got["c4"] == ([], [])


def book(spark):
    unit = lambda source, zh, ja: (source, None, zh, ja, None)
    tok = lambda t, r="", g="subject": (t, r, g, None, None)
    good = unit("天地，", [tok("天", "tiān"), tok("地", "dì"), tok("，", "", "")], [[tok("天", "てん")], [tok("ちのこころ")]])
    bad = unit("花", [tok("花花", "huā")], [[tok("花")]])
    story = ("s", None, None, None, None, [("p1", "天地，花", None, [good, bad])])
    rows = [("b", "0.2", MODE, None, [("x", None, None, None, None, [("u", None, None, None, None, [story])])], None)]
    from pyspark.sql import types as Types

    from lexalign.schema import BOOK

    return spark.createDataFrame(rows, Types.StructType([Types.StructField("book_id", Types.StringType()), *BOOK.fields]))


def test_book_tokens_and_rules(spark):
    units = T.paragraph_units(T.book_paragraphs(book(spark)))
    tokens = T.unit_tokens(units)
    assert tokens.count() == 7
    found = Y.issues(tokens, ["unit", "lang"], Y.token_rules())
    assert sorted((r.unit, r.rule) for r in found.collect()) == [(1, "C04.extra"), (1, "C04.one"), (1, "C05.missing")]
    plain = units.select("book_id", "para_id", "unit", T.surface(F.col("u.zh")).alias("zh"), F.transform("u.ja", T.surface).alias("ja"), T.target(F.col("u.corrected_text"), F.col("u.source_text")).alias("target"), F.lit("天地，花").alias("paragraph_target"))
    assert sorted((r.unit, r.rule) for r in Y.issues(plain, ["unit"], Y.unit_rules()).collect()) == [(1, "C07.lines"), (1, "C08")]
    assert [r.rule for r in Y.paragraph_rules(plain, ["para_id"]).collect()] == ["C09.built"]
    keys = ["book_id", "para_id", "unit"]
    again = T.nest_units(T.nest_lines(R.normal_roles(tokens), keys), keys)
    assert {r.unit: len(r.zh) for r in again.collect()} == {0: 3, 1: 1}
    ruby = R.normal_ruby(R.normal_roles(tokens), keys)
    assert ruby.where("unit = 0 AND lang = 'zh'").count() == 3
    path = T.token_path(["section", "unit", "line", "tok"])
    assert tokens.select(path.alias("p")).distinct().count() < tokens.count() + 1


def test_review_rules(spark):
    got = {}
    for r in Q.review_rules_fixture(spark, "").collect():
        got.setdefault(r.id, set()).add(r.rule)
    assert got == {0: {"C15.same"}, 1: {"C15.kana"}, 2: {"C15.kana", "C15.long"}, 3: {"C15.within"}, 4: {"C15.placeholder"}}


def test_notes_and_readings(spark):
    assert [r.text for r in Q.note_strip_fixture(spark, "").orderBy("id").collect()] == ["天地玄黄", "天地玄黄", "天地", "天地", "正文", "（1737）年", "天地", "天地"]
    got = {}
    for r in Q.reading_split_fixture(spark, "").orderBy("id", "at").collect():
        got.setdefault(r.id, []).append((r.t, r.r))
    assert got == {0: [("天", "tiān"), ("地", "dì")], 1: [("，", "")], 2: [("天", "tiān"), ("a", "")], 3: [("食", "た"), ("べる", "")], 4: [("山", ""), ("川", "")], 5: [("は", "")], 6: [("山川", "やまかわ")]}
    row = one(spark, a=T.tokens_with_readings(F.lit("春の雪a"), F.lit("はる の ゆき")), b=T.mismatch(F.lit("天地玄"), F.lit("天人玄")))
    assert [(x["t"], x["r"]) for x in row["a"]] == [("春", "はる"), ("の", ""), ("雪", "ゆき"), ("a", "")] and row["b"]["at"] == 1


def test_token_kernels(spark):
    tok = lambda s: [{"t": c, "r": "", "g": ""} for c in s]
    joined = lambda x: "".join(y["t"] for y in x)
    assert joined(TK.without_notes(tok("天[12] 地（1737）"))) == "天地" and joined(TK.without_notes(tok("天地"))) == "天地"
    got = TK.resynced("天地，人", [{"t": "天", "r": "tiān", "g": "subject"}, {"t": "x", "r": "", "g": ""}, {"t": "人", "r": "rén", "g": "object"}], {"地": "dì"})
    assert [(x["t"], x["r"], x["g"]) for x in got] == [("天", "tiān", "subject"), ("地", "dì", ""), ("，", "", ""), ("人", "rén", "object")]
    assert joined(TK.repaired("天，地。", tok("天地"))) == "天，地。" and TK.repaired("天人", tok("天地")) is None
    a, b = TK.two_lines([{"t": "x" * 30}, {"t": "y" * 30}], [{"t": "z"}])
    assert (joined(a), joined(b)) == ("x" * 30, "y" * 30 + "z")
    rows = spark.createDataFrame([("天，地", [("天", "tiān", ""), ("地", "dì", "")])], "s string, x array<struct<t:string,r:string,g:string>>")
    assert joined(rows.select(R.reconcile("s", "x").alias("y")).first().y) == "天，地"
    assert K.source_edits("a。", "a", 8) and K.source_edits("ab", "a", 8) is None


def test_promotion_and_status(spark):
    rows = spark.createDataFrame([("b", i, s, f"c{i}") for i, s in enumerate(["valid", "candidate", "valid", "candidate", "missing", "candidate"])], "book string, ord int, state string, chunk_id string")
    assert [r.ord for r in P.promotions(rows, ["book"]).where("promoted").collect()] == [1, 3]
    assert [r.ord for r in P.promotions(rows, ["book"], 1).where("promoted").collect()] == [1] and P.waiting_for(rows, ["book"]).first().waiting_for == "c4"


def test_artifacts(spark):
    old = spark.createDataFrame([("a", "x", 5), ("b", "x", 5), ("c", "x", 5), ("d", "x", 1)], "para_id string, sha string, score int")
    new = spark.createDataFrame([("a", "x", 3), ("b", "x", 5), ("c", "y", 1), ("e", "z", 0)], "para_id string, sha string, score int")
    got = {r.para_id: (r.sha, r.score) for r in A.upsert(old, new).collect()}
    assert got == {"a": ("x", 5), "b": ("x", 5), "c": ("y", 1), "d": ("x", 1), "e": ("z", 0)}
    names = spark.createDataFrame([(f"b{i}", "o/t.pdf", i) for i in range(3)], "book string, path string, ord int")
    assert [r.name for r in A.unique_names(names, "path", "book", ["ord"]).orderBy("ord").collect()] == ["o/t.pdf", "o/t - b1.pdf", "o/t - b2.pdf"]
    names = spark.createDataFrame([("b", "o/t.pdf", i) for i in range(3)], "book string, path string, ord int")
    assert [r.name for r in A.unique_names(names, "path", "book", ["ord"]).orderBy("ord").collect()] == ["o/t.pdf", "o/t - b.pdf", "o/t - b-2.pdf"]
    units = spark.createDataFrame([("p", [([("天", "tiān", "subject")], [[("て", "", "")]])]), ("q", [])], "para_id string, units array<struct<zh:array<struct<t:string,r:string,g:string>>,ja:array<array<struct<t:string,r:string,g:string>>>>>")
    rows = {r.para_id: r for r in A.features(units, ["para_id"]).withColumn("score", A.score()).collect()}
    assert (rows["p"].zh_ruby, rows["p"].translation, rows["p"].grammar, rows["p"].score) == (True, True, False, 3002) and not rows["q"].translation


def test_assemble(spark):
    rows = spark.createDataFrame([("d", i, "s", "S", "u", "U", y, y.upper(), f"p{i}") for i, y in enumerate("aba")], "doc string, ord int, section_id string, section_title string, subsection_id string, subsection_title string, story_id string, story_title string, paragraph string")
    (section,) = B.book(rows).first().sections
    assert [(y.id, y.title, y.paragraphs) for y in section.subsections[0].stories] == [("a", "A", ["p0", "p2"]), ("b", "B", ["p1"])]


def test_render(spark):
    units = spark.createDataFrame([([("天", "tiān", "subject"), ("_", "", "")], [[("あ", "", "")], [("注", "ちゅう", "")]], ["gloss", "note"])], "zh array<struct<t:string,r:string,g:string>>, ja array<array<struct<t:string,r:string,g:string>>>, roles array<string>")
    got = units.select(V.unit(F.col("zh"), F.col("ja"), F.col("roles")).alias("a"), V.unit(F.col("zh"), F.col("ja"), F.col("roles"), "hide").alias("h"), V.tokens(F.col("zh"), "zhpy").alias("t")).first()
    assert got.t == r"\Gram{subject}{\zhpy{天}{tiān}}\_"
    assert got.a.startswith("\\InterUnit\n{\\Gram{subject}") and "{\\jpruby{注}{ちゅう}\\allowbreak{}}\n" in got.a and got.h.endswith("{}\n")
    rows = spark.createDataFrame([("d", 0, "春天", "a"), ("d", 1, "来了。", "b"), ("d", 2, "风轻", "c")], "doc string, ord int, zh string, ja string")
    assert [(r.zh, r.ja) for r in V.merged(rows, ["doc"]).orderBy("ord").collect()] == [("春天，来了。", "ab"), ("风轻", "c")]


def test_pair_blocks(spark):
    body = ["# t", "::: pair", "zh: 天", "地", "jp: てん", ":::", "x", "::: pair", "orphan", "zh: 人", ":::", "::: pair", "zh: a", "jp: b"]
    blocks, issues = S.pair_blocks(lines(spark, body))
    got = {r.block: (r.zh, r.jp, r.zh_comment) for r in blocks.collect()}
    assert got[1] == ("天\n地", "てん", "") and got[3] == ("a", "b", "")
    assert sorted((r.block, r.rule) for r in issues.collect()) == [(2, "missing_field"), (2, "orphan_text"), (3, "unclosed")]


def test_readers(spark, tmp_path):
    (tmp_path / "b.md").write_text("\n".join(Q.MARKDOWN), encoding="utf-8")
    lines_ = S.read_markdown(spark, str(tmp_path / "b.md"))
    paragraphs = H.paragraphs(lines_)
    assert paragraphs.count() == 6 and {r.doc for r in paragraphs.collect()} == {"b"}
    table = C.chunk_table(paragraphs, C.chunks(paragraphs, 10))
    meta, manifest = W.manifest(table)
    assert meta.first().paragraph_count == 6 and manifest.count() == table.count()
    W.write_json_lines(table, str(tmp_path / "chunks"))
    assert S.chunk_tasks(spark, str(tmp_path / "chunks")).count() == table.count()
    html = spark.createDataFrame([(1, "<h2>A &amp; B</h2><script>x</script><p>one <b>two</b><li>three</li>")], "id int, html string")
    assert [(r.tag, r.text) for r in S.html_blocks(html, "id", "html").orderBy("ord").collect()] == [("h2", "A & B"), ("p", "one two"), ("li", "three")]
    assert one(spark, m=S.report(F.lit("a=1\nb=x=y\na=2\nno")))["m"] == {"a": "2", "b": "x=y"}
    paths = spark.createDataFrame([("/b/zh-main/color/t.pdf", 1), ("/b/x/color/t.pdf", 1), ("/t.pdf", 1)], "path string, size int")
    assert [r.title for r in S.export_items(paths, ["zh-main"], ["color"]).collect()] == ["t"]
    zipped = spark.createDataFrame([(1, "題\n\n\n一、はじめ\n漢《かん》字［＃注］\n底本：x\ny")], "id int, text string")
    assert text(S.aozora(zipped, "id", "text")) == ["題", "", "## 一、はじめ", "漢字"]
    assert [r.value for r in S.log_values(spark.createDataFrame([("a", r"Overfull \hbox (12.5pt too wide)")], "log string, text string")).collect()] == [12.5]


def test_markdown_is_read_in_splits(spark, tmp_path):
    """Lines of files as of their whole texts, whatever ends them and wherever splits fall; several tasks read a file."""
    texts = {"a": "x\r\n\n y\x0b\nz\u2028q\r", "b": "one\n\n", "c": "tail\x0b", "d": "\ufeff# t\nend\x0c", "e": "", "f": "\n", "g": "\ufeffm\n", "h": "".join(f"{i}{' ' * (i % 50)}{chr(10) if i % 7 else chr(13)}" for i in range(3000))}
    for name, t in texts.items():
        (tmp_path / f"{name}.md").write_bytes(t.encode())
    whole = spark.read.text(str(tmp_path), wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), "^[a-z]", 0).alias("doc"), "value")
    want = sorted(map(tuple, H.document_lines(whole, "doc", "value").collect()))
    settings = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = S.read_markdown(spark, str(tmp_path))
        assert got.columns == ["doc", "ord", "line"] and sorted(map(tuple, got.collect())) == want
        assert spark.read.text(str(tmp_path / "h.md"), lineSep="\n").rdd.getNumPartitions() > 3
        assert got.where("doc = 'h'").groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_markdown_in_parts_is_one_file(spark, tmp_path):
    """Lines go on from part to part, however many tasks write them, and cut at other places than line feeds only by default."""
    rows = [f"{i}\r{i}" if i % 10 == 0 else str(i) for i in range(3000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "ord int, line string").repartition(3, "line")
    path, before = str(tmp_path / "book.md"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.files.maxRecordsPerFile", "250")
        W.write_lines(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    names = sorted(p.name[:10] for p in (tmp_path / "book.md").glob("part-*"))
    assert len(set(names)) > 2 and len(names) >= 12
    for feeds, want in ((True, rows), (False, [x for r in rows for x in r.split("\r")])):
        got = S.read_markdown(spark, path, feeds)
        assert sorted(map(tuple, got.collect())) == [("book", i, x) for i, x in enumerate(want)]


def test_markdown_files_of_odd_documents(spark, tmp_path):
    """Against the SQL: only line feeds end lines, empty texts and ends count, missing texts don't."""
    import duckdb

    from lexalign.plans import files

    texts = ["\ufeffa\r\nb", "", None, "x\n", "\n\n", "p\x0bq\u2028r\x85s", "last\r", "\n", "\ufeff", ""]
    rows = [(3_000_000_000 + 7 * i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows[::-1], schema).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(con.execute(files.SQL["markdown_files"]).fetchall())
    assert len(want) == 14
    assert sorted(map(tuple, files.QUERIES["markdown_files"](spark, str(tmp_path)).collect())) == want


def test_stream_equals_batch(spark):
    from data_folder import DATA

    from lexalign.plans import progress as Z

    stream = {(r.key, r.marker, r.n) for r in Z.stream_stall(spark, DATA).collect()}
    batch = {(str(r.user_id), r.event_type, r.n) for r in Z.stall_islands(spark, DATA).collect()}
    assert stream <= batch and len(stream) > 0.3 * len(batch)


def test_partitions_do_not_matter(spark):
    from data_folder import DATA

    from lexalign.plans import catalog

    for name in ("size_chunks", "role_inherit", "lines_blocks", "contiguous_promotion"):
        rows = set()
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            rows.add(tuple(sorted(map(str, catalog.QUERIES[name](spark, DATA).collect()))))
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert len(rows) == 1


def test_chunk_ids_beyond_four_digits(spark, tmp_path):
    """The result cuts ids as its SQL does, the number stays whole."""
    rows = [(7, "en", "a", "x"), (12345, "fr", "b", "y"), (12346, "de", "b", None)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = against_sql(spark, "chunk_lines", "documents", tmp_path)
    assert sorted((r[0], r[3]) for r in got) == [("b-chunk-0007", 7), ("b-chunk-1234", 12345), ("b-chunk-1234", 12346)]


def test_titles_as_their_sql(spark, tmp_path):
    """Entities that the SQL leaves, footnote marks, blanks of other kinds, empty titles, none, no page."""
    titles = ["a &quot;b&quot; &lt;c&gt; &amp;lt; &nbsp;&#39;", " x[12] \t y ", "", "\u3000z\xa0q\x0bw ", None]
    rows = [(i, t and f"<title>{t}</title><h1><p>") for i, t in enumerate(titles)] + [(9, "<p class='x'>no title"), (10, "<title></title>")]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = against_sql(spark, "html_titles", "pages", tmp_path)
    assert got[0][1] == "a &quot;b&quot; <c> &lt; &nbsp;&#39;"


def against_sql(spark, name, table, folder):
    """Rows of a query on one table, the same as those of its SQL."""
    import duckdb

    from lexalign.plans import catalog

    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    want = con.sql(catalog.SQL[name])
    got = sorted((tuple(r) for r in catalog.QUERIES[name](spark, str(folder)).select(*want.columns).collect()), key=str)
    assert got == sorted(want.fetchall(), key=str)
    return got
