import re

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.withColumn("node", F.lit("kept")).cache()
    before = {r.doc_id: r for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "packing":
            break
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema).cache()
        kept[name] = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i, r in labels.items() if r.quality]
    assert sum(i in kept["quality"] for i in good) >= 0.97 * len(good)
    assert len({r.text for r in kept["near_duplicates"].values()}) == len(kept["near_duplicates"]) < len(kept["quality"])
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    passages = {tuple(w[i : i + 10]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for w in [words(r.text)] for i in range(max(1, len(w) - 9))}
    hit = {i for i, r in kept["near_duplicates"].items() for w in [words(r.text)] if any(tuple(w[j : j + 10]) in passages for j in range(len(w)))}
    assert hit and set(kept["decontamination"]) == set(kept["near_duplicates"]) - hit
    assert not any(re.search(r"\S@\S+\.", r.text) for r in kept["pii"].values())
    changed = [i for i, r in kept["pii"].items() if r.text != before[i].text]
    assert changed and all(re.search("<(EMAIL|IP|CARD|PHONE)>", kept["pii"][i].text) for i in changed)
    assert all(r.n_chars == len(r.text) for r in kept["pii"].values())
    pieces = out.collect()
    assert {r.doc_id for r in pieces} == set(kept["pii"])
    for i in list(kept["pii"])[:20]:
        assert sum(r.length for r in pieces if r.doc_id == i) == next(r.doc_tokens for r in pieces if r.doc_id == i)


def test_run_is_all_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "packing"]
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"] and rows.count() > 0


def test_odd_tables(spark, documents, empty):
    """Nulls, empty and long texts, repeated rows, a clashing column, and no rows at all."""
    for docs in (documents.withColumnRenamed("node", "key"), empty):
        kept = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = spark.createDataFrame((done := stage(spark, docs, SF)).collect(), done.schema)
            if name != "packing":
                assert out.columns == docs.columns and out.count() <= kept
                kept, docs = out.count(), out
        assert (out.count() > 0) == (kept > 0)
        assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
