import zlib

import numpy as np
from pyspark.sql import functions as F

from lexalign.llm.quality import BINS, FEATURES, FOLDS, RIDGE, Map, isotonic, keep_good, op5_quality, score_documents, statistics

SF = "/root/testdata/sf0.01"


def auc(good, score):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    values, inverse, count = np.unique(np.asarray(score)[order], return_inverse=True, return_counts=True)
    rank[order] = (np.cumsum(count) - (count - 1) / 2)[inverse]
    good = np.asarray(good, bool)
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_accuracy(spark):
    rows = op5_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert auc([r.quality for r in held], [r.score for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    good = [r for r in held if r.quality]
    assert sum(r.predicted for r in good) >= 0.97 * len(good)


def test_learns_from_no_held_out_label(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = dict(score_documents(spark, docs, labels).select("doc_id", "score").collect())
    b = dict(score_documents(spark, docs, flipped).select("doc_id", "score").collect())
    assert max(abs(a[i] - b[i]) for i in a) < 1e-9


def test_odd_rows(spark, documents, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(None, 1, 0), (3, None, 0), (4, 0, 1), (999, 1, 1)], "doc_id long, quality int, toxic int")
    rows = score_documents(spark, documents, labels).collect()
    assert len(rows) == documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert score_documents(spark, empty, labels).collect() == []
    assert {r.score for r in score_documents(spark, documents, labels.limit(0)).collect()} == {0.5}
    kept = keep_good(spark, documents, labels.limit(0))
    assert kept.columns == documents.columns and kept.count() == documents.count()


def test_statistics_do_not_depend_on_neighbours():
    texts = [b"", b"a b a", b"X|Y|Z\n\n!!", b"one line.\none line.\n"]
    together = statistics(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    for i, t in enumerate(texts):
        assert np.allclose(statistics(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0], together[i])


def test_isotonic():
    x, y = isotonic([0.0, 1.0, 2.0, 3.0, 4.0], [1, 1, 2, 1, 1], [0, 1, 1, 1, 0.5])
    assert (np.diff(y) > 0).all() and (np.diff(x) > 0).all() and abs(np.interp(1.5, x, y) - 0.5) < 0.3


def test_isotonic_against_the_formula():
    """The fit at each place is the largest of the smallest means that runs through it have."""
    rng = np.random.default_rng(3)
    for _ in range(30):
        n = int(rng.integers(1, 40))
        at, weight = np.sort(rng.random(n)), rng.integers(1, 5, n).astype(float)
        good = np.array([rng.integers(0, w + 1) for w in weight]).astype(float)
        mean = lambda j, k: good[j : k + 1].sum() / weight[j : k + 1].sum()
        want = [max(min(mean(j, k) for k in range(i, n)) for j in range(i + 1)) for i in range(n)]
        centres, shares = isotonic(at, weight, good)
        blocks = np.searchsorted(np.append(np.unique(np.round(want, 12)), 2), np.round(want, 12))
        assert np.allclose(shares, sorted(set(np.round(want, 12)))) and len(shares) == len(set(blocks))
        assert (np.diff(centres) > 0).all()


def test_features_approximate_a_gaussian_kernel():
    rng = np.random.default_rng(1)
    to = Map(np.zeros(6), np.ones(6), 20_000)
    x = rng.uniform(-1, 1, (30, 6))
    z = to(x)[:, :-1]
    width = np.sqrt(2 * 6) / 2
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * width**2))
    assert np.abs(z @ z.T - want).max() < 0.05


def test_scores_against_a_direct_solution(spark):
    """All labelled rows in one matrix: ridge solved at once, scores out of fold, bins and curve without Spark."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r.score for r in score_documents(spark, docs, labels).collect()}
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = docs.select("doc_id", "text").collect()
    raw = [r.text.encode() for r in rows]
    stats = statistics(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])).astype(np.float32).astype(float)
    crc = lambda x: zlib.crc32(x.encode())
    known = [i for i, r in enumerate(rows) if crc(str(r.doc_id)) % 5 and quality.get(r.doc_id) in (0, 1)]
    x, y = stats[known], np.array([quality[rows[i].doc_id] for i in known], float)
    fold = np.array([crc(f"fold{rows[i].doc_id}") % FOLDS for i in known])
    scale = np.sqrt(np.maximum((x * x).mean(axis=0) - x.mean(axis=0) ** 2, 0))
    to = Map(x.mean(axis=0), np.where(scale > 1e-6, scale, 1), FEATURES)
    z = to(x)

    def ridge(some):
        penalty = np.eye(z.shape[1]) * max(RIDGE * some.sum(), 1e-3)
        penalty[-1, -1] = 1e-6
        return np.linalg.solve(z[some].T @ z[some] + penalty, z[some].T @ y[some])

    out = np.zeros(len(y))
    for f in range(FOLDS):
        out[fold == f] = z[fold == f] @ ridge(fold != f)
    bins = np.clip(np.floor(out * (BINS / 4)), -BINS, BINS)
    table = [(out[bins == b].mean(), (bins == b).sum(), y[bins == b].sum()) for b in np.unique(bins)]
    curve = isotonic(*np.array(table).T)
    want = np.interp(to(stats) @ ridge(np.ones(len(y), bool)), *curve)
    assert np.allclose([got[r.doc_id] for r in rows], want, atol=1e-6)
