"""Quality classifier: random Fourier features of document statistics, ridge scores and isotonic calibration.

Every text gives a row of statistics. Labelled rows outside the held-out fold are mapped to random Fourier features, whose
inner products approximate a Gaussian kernel, and each partition sums its part of the normal equations by row of the matrix;
the sums do not depend on the number of documents. Ridge scores out of fold are counted in bins, and an isotonic fit of the
bins turns scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.llm.storage import Scratch, partitions
from lexalign.llm.words import BLANKS, SMALL_CHUNK, U64, chunks, cut_words, grams

#: Fourier features, bins of scores, folds for scores out of fold, and the ridge as a share of the rows.
FEATURES, BINS, FOLDS, RIDGE = 256, 2048, 4, 1e-3
THRESHOLD = 0.3
HELD_OUT = 5
SEED = 11

_KINDS = {"lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "blank": [32, 9, 13, 11, 12], "line": [10], "stop": b".,;:", "call": b"!?", "quote": b"\"'`()", "sign": b"#$%&*@^~|<>{}[]=+_/\\", "dash": b"-", "wide": range(128, 256)}
_KIND = np.full(256, len(_KINDS), np.int64)
for _i, _members in enumerate(_KINDS.values()):
    _KIND[list(_members)] = _i
_N_KINDS = len(_KINDS) + 1
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
_WIDTH = _N_KINDS + 13


def _repeats(doc: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By document: distinct hashes, the count of the commonest, and the sum of c log c."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    count, owner = np.diff(np.append(at, len(doc))), doc[at]
    top = np.zeros(n)
    np.maximum.at(top, owner, count)
    return np.bincount(owner, minlength=n), top, np.bincount(owner, count * np.log(count), minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of statistics for each text, empty ones included."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    kinds = np.bincount(doc * _N_KINDS + _KIND[data], minlength=n * _N_KINDS).reshape(n, _N_KINDS)
    words = cut_words(data, offsets, BLANKS, True)
    count = words.counts
    some = np.maximum(count, 1)
    length = (words.ends - words.starts).astype(float)
    mean = np.bincount(words.doc, length, minlength=n) / some
    square = np.bincount(words.doc, length**2, minlength=n) / some
    longest = np.zeros(n)
    np.maximum.at(longest, words.doc, length)
    distinct, top, clogc = _repeats(words.doc, words.hashes, n)
    pairs, at = grams(words, 2)
    distinct_pairs = _repeats(words.doc[at], pairs, n)[0] if len(at) else np.zeros(n)
    mixed = np.zeros(len(data) + 1, np.int64)
    np.cumsum((_KIND[data] < 2) | (_KIND[data] == _N_KINDS - 2), out=mixed[1:])
    bare = np.bincount(words.doc, mixed[words.ends] == mixed[words.starts], minlength=n) / some
    lines = cut_words(data, offsets, _NEWLINE, False)
    n_lines = np.maximum(lines.counts, 1)
    distinct_lines = _repeats(lines.doc, lines.hashes, n)[0]
    ended = np.bincount(lines.doc, np.isin(data[lines.ends - 1], list(b".!?\"")), minlength=n) / n_lines if len(lines.doc) else np.zeros(n)
    share = lambda x: x / np.maximum(size, 1)[:, None]
    rest = [np.log1p(size), np.log1p(count), mean, np.sqrt(np.maximum(square - mean**2, 0)), np.log1p(longest), distinct / some, top / some, np.log(some) - clogc / some, distinct_pairs / some, bare, np.log1p(lines.counts), distinct_lines / n_lines, ended]
    return np.column_stack([np.sqrt(share(kinds)), *rest])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in chunks(batch, "text", SMALL_CHUNK):
            rows = statistics(data, offsets).astype(np.float32)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names if c != "text"), pa.array([r.tobytes() for r in rows], pa.binary())], names=[*(c for c in part.schema.names if c != "text"), "stats"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1).astype(np.float64)


class Map:
    """Standardised statistics to random Fourier features and a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        # a kernel as wide as the usual distance of two rows over two
        self.lines = rng.standard_normal((len(mean), features)) * 2 / np.sqrt(2 * len(mean))
        self.shift = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -4, 4)
        return np.column_stack([np.cos(z @ self.lines + self.shift) * np.sqrt(2 / len(self.shift)), np.ones(len(z))])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((3, _WIDTH))
    for batch in batches:
        x, w = _matrix(batch.column("stats")), np.asarray(batch.column("weight"))[:, None]
        total += [(w * x).sum(axis=0), (w * x * x).sum(axis=0), np.full(_WIDTH, w.sum())]
    yield pa.RecordBatch.from_arrays([pa.array(range(_WIDTH), pa.int32()), *(pa.array(t) for t in total)], names=["i", "x", "xx", "w"])


def _normal(features: Map, folds: int):
    """Rows of the normal equations of each fold: features' products, and their products with the label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            z = features(_matrix(batch.column("stats")))
            fold, w, y = (np.asarray(batch.column(c)) for c in ("fold", "weight", "good"))
            for f in np.unique(fold).tolist():
                mine = fold == f
                part = (z[mine] * w[mine, None]).T @ z[mine], z[mine].T @ y[mine]
                sums[f] = sums.get(f, 0) + np.column_stack(part)
        for f, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([f] * len(s), pa.int32()), pa.array(range(len(s)), pa.int32()), pa.array([r.tobytes() for r in s], pa.binary())], names=["fold", "i", "row"])

    return run


def _add_rows(key: tuple, table: pa.Table) -> pa.Table:
    row = sum(np.frombuffer(r.as_buffer()) for r in table["row"])
    return pa.table({"fold": pa.array([key[0].as_py()], pa.int32()), "i": pa.array([key[1].as_py()], pa.int32()), "row": pa.array([row.tobytes()], pa.binary())})


def isotonic(at: np.ndarray, weight: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres and rising shares of the blocks, for scores ``at`` in rising order."""
    blocks: list[list[float]] = []
    for x, w, g in zip(at, weight, good, strict=True):
        blocks.append([x * w, w, g])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    x, w, g = np.array(blocks).T
    return x / w, g / w


def _scores(features: Map | None, weights: np.ndarray | None, curve: tuple | None, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if features is None:
                score = np.full(batch.num_rows, share)
            else:
                raw = features(_matrix(batch.column("stats"))) @ weights
                if raw.ndim > 1:  # out of fold
                    raw = raw[np.arange(len(raw)), np.asarray(batch.column("fold"))]
                score = raw if curve is None else np.interp(raw, *curve)
            keep = [c for c in batch.schema.names if c != "stats"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(score, pa.float64())], names=[*keep, "score"])

    return run


def remainder(doc_id: Column, of: int) -> Column:
    return F.crc32(doc_id.cast("string")) % of


def learn(spark: SparkSession, measured: DataFrame, labels: DataFrame, scratch: Scratch, features: int = FEATURES):
    """The scoring function of batches, learned from ``measured`` (doc_id, held_out, stats) and ``labels``."""
    known = labels.where("quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").cast("double").alias("weight"), F.sum(F.col("quality").cast("double")).alias("good"))
    fold = (F.crc32(F.concat(F.lit("fold"), F.col("doc_id").cast("string"))) % FOLDS).cast("int")
    train = scratch.cut(measured.where("NOT held_out").select("doc_id", "stats").join(known, "doc_id").select(fold.alias("fold"), "weight", "good", "stats"))
    total, good = (float(x) for x in train.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first())
    if not 0 < good < total:
        return _scores(None, None, None, good / total if total else 0.5)
    spread = train.coalesce(partitions(spark))
    sums = spread.mapInArrow(_moments, "i int, x double, xx double, w double").groupBy("i").agg(F.sum("x"), F.sum("xx"), F.sum("w")).orderBy("i").collect()  # _WIDTH rows
    _, x, xx, w = np.array(sums).T
    scale = np.sqrt(np.maximum(xx / w - (x / w) ** 2, 0))
    to = Map(x / w, np.where(scale > 1e-6, scale, 1), features)
    parts = spread.mapInArrow(_normal(to, FOLDS), "fold int, i int, row binary")
    parts = parts.groupBy("fold", "i").applyInArrow(_add_rows, "fold int, i int, row binary").collect()  # FOLDS * (features + 1) rows
    sums = np.zeros((FOLDS, features + 1, features + 2))
    for r in parts:
        sums[r.fold, r.i] = np.frombuffer(r.row)

    def solved(s: np.ndarray) -> np.ndarray:
        ridge = np.eye(features + 1) * max(RIDGE * s[-1, -2], 1e-3)
        ridge[-1, -1] = 1e-6
        return np.linalg.solve(s[:, :-1] + ridge, s[:, -1])

    whole = solved(sums.sum(axis=0))
    held = np.column_stack([solved(sums.sum(axis=0) - sums[f]) for f in range(FOLDS)])
    raw = spread.mapInArrow(_scores(to, held, None, 0), "fold int, weight double, good double, score double")
    place = F.floor(F.col("score") * (BINS / 4))  # a ridge score lies near 0 to 1; the bins cover all
    bins = raw.groupBy(F.greatest(F.lit(-BINS), F.least(F.lit(BINS), place)).alias("bin")).agg((F.sum(F.col("score") * F.col("weight")) / F.sum("weight")).alias("at"), F.sum("weight").alias("weight"), F.sum("good").alias("good"))
    bins = np.array(bins.select("at", "weight", "good").collect())  # 2 * BINS + 1 rows at most
    return _scores(to, whole, isotonic(*bins[np.argsort(bins[:, 0])].T), 0)


def _held_out() -> Column:
    return F.coalesce(remainder(F.col("doc_id").cast("long"), HELD_OUT) == 0, F.lit(True))


def _measured(docs: DataFrame, scratch: Scratch) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return scratch.cut(rows.mapInArrow(_measure, "doc_id long, held_out boolean, stats binary"))


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, features: int = FEATURES) -> DataFrame:
    """(doc_id, held_out, score, predicted): a row for each row of ``docs``.

    Labels are ``quality`` 0 or 1 of rows whose crc32(doc_id as text) mod 5 is not 0; null ones are ignored and several of
    one doc_id weigh one row each. A null or empty text has statistics of zero and a score like any other; a null doc_id
    counts as held out. With one class or none to learn from, every score is the share of 1, or 0.5. Repeated rows get equal
    scores. Other columns are ignored. An empty table gives an empty result.
    """
    scratch = Scratch(spark, "quality")
    measured = _measured(docs, scratch)
    scored = measured.mapInArrow(learn(spark, measured, labels, scratch, features), "doc_id long, held_out boolean, score double")
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def _good(score) -> object:
    """Rows whose text reaches the threshold, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, "text", SMALL_CHUNK):
                rows = statistics(data, offsets).astype(np.float32)
                stats = pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary())], names=["stats"])
                (scored,) = score(iter([stats]))
                yield part.filter(pa.compute.greater_equal(scored.column("score"), THRESHOLD))

    return run


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, features: int = FEATURES) -> DataFrame:
    """``docs`` without the rows that :func:`score_documents` predicts as 0. All columns stay."""
    scratch = Scratch(spark, "quality")
    measured = _measured(docs, scratch)
    return docs.mapInArrow(_good(learn(spark, measured, labels, scratch, features)), docs.schema)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
