import random
import re

from data_folder import DATA
from pyspark.sql import functions as F

from lexalign.operators.align import contained, containments, resolve
from lexalign.operators.ordering import numbered
from lexalign.operators.progress import admission
from lexalign.plans import catalog



def test_every_pair_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcé𝒳漢") for _ in range(rng.randint(1, 6)))
    units = [" ".join(word() for _ in range(n)) for n in (1, 2, 5, 8, 9, 12, 60, 400)] + ["", " \n", "a" * 40, "q" * 23]
    units += [units[5], None]
    texts = [" ".join([*(word() for _ in range(rng.randint(0, 50))), u or "", *(word() for _ in range(9)), u or ""]) for u in units for _ in range(4)]
    texts += [" ".join(word() for _ in range(300)), None, "", "a" * 39, "a" * 200, units[7][:-1], "𝒳 " * 3 + units[6]]
    texts += [texts[20], texts[20]]
    a = spark.createDataFrame(list(enumerate(units)), "item_id long, text string")
    b = spark.createDataFrame(list(enumerate(texts)), "doc_id long, reference string").repartition(3)
    want = contained(a.withColumn("k", F.lit(1)), b.withColumn("k", F.lit(1)), ["k"]).where("position >= 0")
    want = sorted((r.doc_id, r.item_id, r.position) for r in want.collect())
    assert len({(d % 40, i % 40) for d, i, _ in want if d % 40 != i % 40}) > 20  # pairs of unlike residues
    for block in (10_000, 3):
        assert sorted((r.doc_id, r.item_id, r.position) for r in containments(a, b, block=block).collect()) == want


def test_queries_find_all_places(spark):
    items, docs = (spark.read.parquet(f"{DATA}/{t}.parquet").collect() for t in ("benchmark", "documents"))
    bare = lambda x: re.sub(r"\s+", "", x or "")
    texts = [(d.doc_id, bare(d.text)) for d in docs]
    want = sorted((d, i.item_id, t.find(u)) for i in items for u in [bare(i.text)] for d, t in texts if u in t)
    got = sorted(map(tuple, catalog.QUERIES["reference_containment"](spark, DATA).collect()))
    assert got == want and any(d % 40 != i % 40 for d, i, _ in got)


def test_fallbacks_in_order(spark):
    """The own key if it has references, else the first fallback that has, else the own key."""
    chunks = spark.createDataFrame([("a", "k1", "t1"), ("b", "k2", "t1"), ("c", "k2", "t2"), ("d", "k2", "t3"), ("e", "", "t1")], "chunk_id string, key string, title string")
    keys = spark.createDataFrame([("k1",), ("k1",), ("f2",), ("f3",)], "key string")
    fallbacks = spark.createDataFrame([("t1", 2, "f2"), ("t1", 1, "f3"), ("t1", 0, "f1"), ("t2", 0, "f9")], "title string, prio int, key string")
    assert {r.chunk_id: r.resolved for r in resolve(chunks, keys, fallbacks).collect()} == {"a": "k1", "b": "f3", "c": "k2", "d": "k2", "e": "f3"}


def test_numbers_over_a_whole_table(spark):
    rng = random.Random(3)
    values = sorted({rng.randrange(10**rng.randrange(1, 12)) for _ in range(400)})
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i int").repartition(5)
    assert all(r.n == r.i + 1 for r in numbered(rows, "v", "n").collect())
    assert numbered(rows.limit(0), "v", "n").collect() == [] and [r.n for r in numbered(rows.where("i = 3"), "v", "n").collect()] == [1]


def test_admission_takes_the_first(spark):
    rng = random.Random(2)
    rows = [(i, f"q{i}", rng.random() < 0.2, rng.random() < 0.2) for i in range(60)]
    want, running = {}, sum(a and not c for _, _, c, a in rows)
    for _, name, complete, active in rows:
        want[name] = "skip" if complete else "active" if active else "start" if running < 20 else "defer"
        running += want[name] == "start"
    queue = spark.createDataFrame(rows, "ord int, id string, complete boolean, active boolean").repartition(4)
    assert {r.id: r.decision for r in admission(queue, 20).collect()} == want
