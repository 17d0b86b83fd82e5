import numpy as np
import pytest

from lexalign.llm.embeddings import near_vectors

DIM = 24


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    rows = []
    for label in (0, 1, None):
        for _ in range(12):
            base = rng.standard_normal(DIM)
            rows += [(base + rng.standard_normal(DIM) * rng.uniform(0.02, 0.35), label) for _ in range(rng.integers(1, 14))]
    base = rng.standard_normal(DIM)
    rows += [(base + rng.standard_normal(DIM) * 0.02, 1) for _ in range(150)]  # a hot group
    rows += [(rng.standard_normal(DIM), 0) for _ in range(80)]
    rows = [([float(np.float32(x)) for x in v], label) for v, label in rows]
    rows += [rows[3]] * 3 + [([x * 7 for x in rows[3][0]], 0), ([0.0] * DIM, 0), ([0.0] * DIM, 0), ([], 0), ([], 0), (None, 0), (rows[3][0], 1), (rows[0][0], None)]
    rows += [([float("nan"), *rows[0][0][1:]], 0), ([None, *rows[0][0][1:]], 0), ([float("inf"), *rows[0][0][1:]], 0), ([1.0, 2.0], 0), ([1.0, 2.0], 0)]
    data = [(1000 - i, v, label, i) for i, (v, label) in enumerate(rows)]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, node long")


def brute(rows, least):
    unit = []
    for r in rows:
        v = None if r.embedding is None or None in r.embedding else np.array(r.embedding, float)
        good = v is not None and len(v) and np.isfinite(v).all() and v.any() and r.label is not None
        unit.append(v / np.linalg.norm(v) if good else None)
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and rows[i].label == rows[j].label and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        low[find(i)] = min(low.get(find(i), r.vec_id), r.vec_id)
    return {r.vec_id: (links[i], low[find(i)], r.vec_id == low[find(i)]) for i, r in enumerate(rows)}


@pytest.mark.parametrize("block", [2048, 16])
def test_against_brute_force(spark, table, block):
    want = brute(table.collect(), 0.93)
    got = {r.vec_id: tuple(r)[1:] for r in near_vectors(spark, table, block=block).collect()}
    assert got.keys() == want.keys()
    found, there = sum(x[0] for x in got.values()), sum(x[0] for x in want.values())
    assert all(got[i][0] <= want[i][0] for i in got)
    assert found >= 0.99 * there
    assert np.mean([got[i] == want[i] for i in got]) > 0.95


def test_recall_at_the_threshold(spark):
    """Clusters whose cosines lie just above the threshold, where buckets are missed most."""
    rng = np.random.default_rng(8)
    rows = []
    for c in range(60):
        centre = rng.standard_normal(64)
        for _ in range(20):
            x = centre + rng.standard_normal(64) * np.linalg.norm(centre) / 8 * 0.23
            rows.append((len(rows), [float(v) for v in x], c % 3))
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label long")
    want = brute(docs.collect(), 0.93)
    got = {r.vec_id: r.n_links for r in near_vectors(spark, docs).collect()}
    there = sum(x[0] for x in want.values())
    assert there > 1000 and all(got[i] <= want[i][0] for i in got)
    assert sum(got.values()) >= 0.98 * there


def test_empty(spark, table):
    assert near_vectors(spark, table.limit(0)).collect() == []
