import hashlib
import random
import re

from pyspark.sql import functions as F

from lexalign.llm.decontamination import decontaminate, keep_clean


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, length):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - length + 1)) if w else ():
            wins.setdefault(tuple(w[i : i + length]), set()).add(item)
    out = []
    for r in rows:
        w, hit, found = words(r.text), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if (win := tuple(w[i : i + n])) in wins:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in wins[win] if x is not None}
        out.append((r.doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def digest(df):
    return sorted(map(tuple, df.withColumn("items", F.sha2(F.array_join("items", ","), 256)).collect()), key=str)


def bench(spark, documents):
    rng = random.Random(4)
    texts = [words(r.text) for r in documents.collect()]
    long = [w for w in texts if len(w) > 50]
    items = [(i, " ".join(w[(s := rng.randrange(len(w) - 30)) : s + rng.randrange(8, 30)])) for i, w in enumerate(long)]
    items += [(90, "w1 w2"), (91, "W3"), (92, None), (93, ""), (94, "..."), (95, " ".join(f"zz{i}" for i in range(30))), (95, " ".join(long[0][:12])), (None, " ".join(long[1][:12])), (96, "Straße, ÜNÏ? çödé"), (97, "a b a b a b a b a b a b")]
    return items, spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(spark, documents):
    items, table = bench(spark, documents)
    for length in (10, 3):
        assert digest(decontaminate(spark, documents, table, length)) == brute(documents.collect(), items, length)


def test_blocks_of_windows(spark, documents):
    items, table = bench(spark, documents)
    assert digest(decontaminate(spark, documents, table, block=7)) == brute(documents.collect(), items, 10)


def test_keep_clean(spark, documents):
    items, table = bench(spark, documents)
    want = sorted((r[0] for r in brute(documents.collect(), items, 10) if not r[5]), key=str)
    kept = keep_clean(spark, documents, table)
    assert kept.columns == documents.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == want


def test_empty(spark, documents, empty):
    _, table = bench(spark, documents)
    assert decontaminate(spark, empty, table).collect() == []
    assert not any(r.contaminated for r in decontaminate(spark, documents, table.limit(0)).collect())


def test_no_python(spark, documents):
    _, table = bench(spark, documents)
    plan = decontaminate(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), table)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("EvalPython", "MapInArrow", "MapInPandas", "PythonUDF"))
