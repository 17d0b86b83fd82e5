import hashlib
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from lexalign.llm.sharding import op9_sharding, shard, sql


def brute(rows, limit):
    bits = [bin(int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16))[2:].zfill(60) for r in rows]
    sizes = [len((r.text or "").encode()) for r in rows]
    total = Counter()
    for b, n in zip(bits, sizes, strict=True):
        for d in range(61):
            total[b[:d]] += n
    return [(r.doc_id, b[: next((d for d in range(61) if total[b[:d]] <= limit), 60)], n) for r, b, n in zip(rows, bits, sizes, strict=True)]


def test_against_brute_force(spark, documents):
    rows = documents.collect()
    for limit in (100_000, 25_000, 21_000):
        got = shard(spark, documents, limit).collect()
        assert sorted((r.doc_id, r.shard, r.n_bytes) for r in got if r.depth < 60 and r.doc_id is not None) == sorted(x for x in brute(rows, limit) if len(x[1]) < 60 and x[0] is not None)
        assert all(r.depth == len(r.shard) for r in got)


def test_every_shard_fits(spark, documents):
    """Rows of one key, equal ones too, split behind the bits of the key; a row over the limit stands alone."""
    hot = documents.where("doc_id = 10").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("i")
    table = documents.unionByName(hot)
    got = shard(spark, table, 5000).collect()
    assert len(got) == table.count()
    size, count = Counter(), Counter()
    for r in got:
        size[r.shard] += r.n_bytes
        count[r.shard] += 1
    for r in got:
        assert r.oversize == (r.n_bytes > 5000)
        assert size[r.shard] <= 5000 or sum(x.n_bytes > 0 for x in got if x.shard == r.shard) == 1
    names = sorted(size)
    assert not any(b != a and b.startswith(a) for a, b in zip(names, names[1:], strict=False))


def test_empty(spark, documents, empty):
    assert shard(spark, empty).collect() == []
    assert {r.shard for r in shard(spark, documents.withColumn("text", F.lit(None).cast("string"))).collect()} == {""}


def test_sql(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    assert sorted(map(tuple, op9_sharding(spark, "/root/testdata/sf0.001").collect())) == sorted(con.sql(sql()).fetchall())
