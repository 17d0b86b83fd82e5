import math

import duckdb
import pytest

from lexalign.llm.license_texts import TEMPLATES
from lexalign.llm.licenses import forms, op2_licenses, scan, sql


def test_inheritance(spark):
    prose = "some words of prose that say nothing here " * 5
    rows = [
        (1, "LICENSE", TEMPLATES["MIT"][0]), (2, "a/b/c/x.txt", prose), (3, "a/LICENSE", "copyright notice\n" + TEMPLATES["GPL-3.0"][0]), (4, "a/b/y.txt", prose), (5, "z/q.txt", prose),
        (6, "a/b/own.txt", prose + "\nThis work is LICENSED under the GNU general public license, version 3!\n" + prose), (7, "a/b/c/d/LICENSE", TEMPLATES["Apache-2.0"][0]), (8, "a/b/c/d/e/f.txt", None), (9, None, prose), (9, None, prose), (10, "ab/c.txt", ""), (11, "a/b/c/d/COPYING", TEMPLATES["Apache-2.0"][0]),
    ]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, path string, text string, license string")
    got = scan(spark, docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.license, r.origin, r.license_dir) for r in got}
    assert by[1] == ("MIT", "header", "") and by[2] == ("GPL-3.0", "inherited", "a") and by[4] == ("GPL-3.0", "inherited", "a")
    assert by[5] == ("MIT", "inherited", "") and by[6] == ("GPL-3.0", "header", "a/b") and by[8] == ("Apache-2.0", "inherited", "a/b/c/d")
    assert by[9] == (None, "none", None) and by[10] == ("MIT", "inherited", "")


def test_every_template_is_found_by_itself(spark):
    filler = [(f"w{i} x{i} y{i} the of and", ) for i in range(50)]
    every = forms(TEMPLATES)
    # whole texts stand on several lines, below a title and a copyright notice of their own
    texts = [body if len(body) < 200 else f"Copyright 2020 Some One\n\n{body}" for _, body in every]
    docs = spark.createDataFrame([(i, f"d{i}/f", t) for i, t in enumerate([*texts, *(f[0] for f in filler)])], "doc_id long, path string, text string")
    got = {r.doc_id: (r.own_license, r.cosine) for r in scan(spark, docs).collect()}
    assert [got[i][0] for i in range(len(every))] == [name for name, _ in every]
    assert all(got[i][1] > 0.9 for i in range(len(every)))
    assert all(got[i][0] is None for i in range(len(every), len(got)))


def test_odd_tables(spark, documents):
    """Nulls, long texts, repeated rows, ties and columns of the operator's own names."""
    rows = documents.selectExpr("doc_id", "source || '/x' as path", "text", "lang as license", "node as row", "n_chars as cosine")
    got = scan(spark, rows).collect()
    assert len(got) == rows.count() and {r.origin for r in got} == {"none"}
    tie = {"B": "alpha beta gamma", "A": "gamma beta alpha"}
    found = scan(spark, spark.createDataFrame([(1, "p", "alpha beta gamma " * 20_000), (1, "p", "alpha beta gamma " * 20_000), (2, None, "beta gamma")], "doc_id long, path string, text string"), tie).collect()
    assert [(r.own_license, r.cosine) for r in found if r.doc_id == 1] == [("A", 1.0)] * 2


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_against_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{sf}/documents.parquet'")
    want = con.sql(sql())
    df = op2_licenses(spark, f"/root/testdata/{sf}")
    assert df.columns == want.columns
    got = sorted(map(tuple, df.collect()), key=str)
    assert got == sorted(want.fetchall(), key=str)


def test_empty(spark, empty):
    assert scan(spark, empty.withColumnRenamed("source", "path")).collect() == []


def test_common_words_weigh_little(spark):
    rows = ["and en prose"] * 400 + [TEMPLATES["MIT"][0]] * 100 + ["and en " + TEMPLATES["MIT"][0], "quite odd " + TEMPLATES["MIT"][0]]
    docs = spark.createDataFrame([(i, f"d{i}/f", t) for i, t in enumerate(rows)], "doc_id long, path string, text string")
    got = {r.doc_id: r for r in scan(spark, docs).collect()}
    total, df = len(rows), {"and": 401, "en": 401, "mit": 102}
    idf = {w: math.log((1 + total) / (1 + n)) + 1 for w, n in df.items()}
    inside = 5 * idf["mit"] ** 2
    assert got[500].own_license == "MIT" and math.isclose(got[500].cosine, math.sqrt(inside / (inside + idf["and"] ** 2 + idf["en"] ** 2)), abs_tol=1e-6)
    assert got[501].own_license is None and got[0].own_license is None and got[400].cosine == 1.0
