"""Near-duplicate vectors by Euclidean p-stable hashing.

Each table projects the normalised vectors on a few random Gaussian directions and quantises every projection in steps of
one width; a bucket holds the vectors of one label whose steps all agree. At cosine 0.93 two unit vectors lie 0.374 apart,
so that one of the directions agrees with probability 0.851 at a width of 2, all 14 of them with 0.104, and one of 42 tables
with 0.99; closer pairs meet more surely. Pairs in a bucket are then compared exactly.

A bucket yields a number of links for each vector and a tree for each of its components, never its pairs. A pair counts in
the first table where it meets. Large buckets are split into blocks, and every two blocks of a bucket make a task, so none
of their pairs is lost. Equal vectors are one node with a weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.llm.graph import components, roots
from lexalign.llm.storage import Scratch, partitions
from lexalign.llm.words import ODD, U64, mix

WIDTH, DIRECTIONS, TABLES = 2.0, 14, 42
#: Vectors of a block at most.
BLOCK = 2048
SEED = 7

_directions: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}


def directions(dim: int, tables: int, k: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    key = (dim, tables, k, width)
    if key not in _directions:
        rng = np.random.default_rng([SEED, dim])
        _directions[key] = rng.standard_normal((dim, tables * k)), rng.uniform(0, width, tables * k)
    return _directions[key]


def signatures(unit: np.ndarray, label: np.ndarray, tables: int, k: int, width: float) -> np.ndarray:
    """A key for each vector and table, equal where label and all steps agree."""
    lines, shift = directions(unit.shape[1], tables, k, width)
    steps = np.floor((unit @ lines + shift) / width).astype(np.int64).view(U64).reshape(len(unit), tables, k)
    keys = np.zeros((len(unit), tables), U64)
    for i in range(k):
        keys = (keys ^ steps[:, :, i]) * ODD[20 + i % 20]
        keys ^= keys >> U64(31)
    own = mix(label.astype(np.int64).view(U64) * ODD[5] + U64(unit.shape[1]))
    return mix(keys + own[:, None] + np.arange(tables, dtype=U64) * ODD[6])


def units(raw: np.ndarray) -> np.ndarray:
    """Vectors of length one, by rows, in double precision."""
    with np.errstate(all="ignore"):
        x = raw.astype(np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hashed(tables: int, k: int, width: float, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            size = np.asarray(vectors.value_lengths().fill_null(0))
            flat = vectors.flatten()
            values = np.asarray(flat.cast(pa.float64()).fill_null(np.nan))
            begin = np.cumsum(size) - size
            label = np.asarray(batch.column("label").cast(pa.int64()).fill_null(0))
            usable = np.asarray(batch.column("label").is_valid())
            for dim in np.unique(size[size > 0]).tolist():
                rows = np.flatnonzero((size == dim) & usable)
                raw = values[begin[rows][:, None] + np.arange(dim)]
                largest = np.abs(raw).max(axis=1)
                good = np.isfinite(largest) & (largest > 0)
                rows, raw = rows[good], raw[good]
                if not len(rows):
                    continue
                keys = signatures(units(raw), label[rows], tables, k, width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").take(pa.array(rows)), batch.column("weight").take(pa.array(rows)), pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())), pa.array([v.tobytes() for v in raw.astype(kind)], pa.binary())],
                    names=["node", "weight", "keys", "vector"],
                )

    return run


_FOUND = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])


def _tasks(table: pa.Table, least: float, kind: str) -> Iterator[pa.RecordBatch]:
    """Links of whole tasks, that follow each other: (node, links, other), ``links`` a weight to add and ``other`` a neighbour
    in the tree of the task or null. Tasks of one size are compared together."""
    columns = {c: np.asarray(table[c]) for c in ("table", "key", "i", "j", "node", "weight", "block")}
    lengths = np.asarray(pa.compute.binary_length(table["vector"])) // np.dtype(kind).itemsize
    new = np.ones(len(lengths), bool)
    new[1:] = np.any([columns[c][1:] != columns[c][:-1] for c in ("table", "key", "i", "j")], axis=0) | (lengths[1:] != lengths[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(new)))
    keys = np.frombuffer(b"".join(table["before"].to_pylist()), np.uint32)
    first_key = np.cumsum(columns["table"]) - columns["table"]  # a row has its keys of the tables before its own
    place = np.cumsum(lengths) - lengths
    values = np.frombuffer(b"".join(table["vector"].to_pylist()), kind)
    node, weight, side = columns["node"], columns["weight"], columns["block"]
    links, other = np.zeros(len(new), np.int64), node.copy()
    for n, length in {(int(a), int(b)) for a, b in zip(size, lengths[start], strict=True) if a > 1}:
        mine = start[(size == n) & (lengths[start] == length)]
        step = max(1, (32 << 20) // (8 * n * max(length, n)))
        for at in range(0, len(mine), step):
            rows = mine[at : at + step, None] + np.arange(n)
            x = units(values[place[rows.ravel()][:, None] + np.arange(length)]).reshape(*rows.shape, length)
            linked = x @ x.transpose(0, 2, 1) >= least
            cross = columns["i"][rows[:, 0]] != columns["j"][rows[:, 0]]
            linked &= ~cross[:, None, None] | (side[rows][:, :, None] != side[rows][:, None, :])
            linked[:, np.arange(n), np.arange(n)] = False
            some = np.flatnonzero(linked.any(axis=(1, 2)))
            for g in some.tolist():
                sub = np.flatnonzero(linked[g].any(axis=1))
                r, now = rows[g][sub], linked[g][np.ix_(sub, sub)]
                for before in range(int(columns["table"][r[0]])):
                    key = keys[first_key[r] + before]
                    now &= key[:, None] != key[None, :]
                links[r] += now @ weight[r]
                other[r] = node[r][roots(now)]
    out = np.flatnonzero(links)
    tree = pa.array(other[out], pa.int64(), mask=other[out] == node[out])
    yield pa.RecordBatch.from_arrays([pa.array(node[out], pa.int64()), pa.array(links[out], pa.int64()), tree], schema=_FOUND)


def _compare(least: float, kind: str):
    """Runs :func:`_tasks` over sorted rows; the last task of a batch waits for the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([*held, batch])
            keys = [np.asarray(whole[c]) for c in ("table", "key", "i", "j")]
            last = np.flatnonzero(np.any([k != k[-1] for k in keys], axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from _tasks(whole.slice(0, cut), least, kind)
            held = whole.slice(cut).combine_chunks().to_batches()
        if held:
            yield from _tasks(pa.Table.from_batches(held), least, kind)

    return run


def near_vectors(spark: SparkSession, vectors: DataFrame, least: float = 0.93, width: float = WIDTH, k: int = DIRECTIONS, tables: int = TABLES, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept): vectors of one label linked by a cosine of ``least`` or more.

    Null and zero vectors, those with null or infinite components or NaN, and rows without a label link with nothing and are
    their own component. Vectors of different lengths are never linked. Equal vectors of a label are linked, as are
    repeated rows. A null vec_id takes part, but names no component unless all are null. Labels of any simple type are equal
    if they look the same as text. Other columns are ignored. An empty table gives an empty result.
    """
    # single precision travels as it is, and is a unit vector in double precision where it is compared
    kind = "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    scratch = Scratch(spark, "vectors")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.when(F.col("label").isNotNull(), F.xxhash64(F.col("label").cast("string"))).alias("label"))
    rows = rows.withColumn("node", F.xxhash64("label", "embedding", F.size("embedding")))
    nodes = rows.where("label IS NOT NULL AND size(embedding) > 0").groupBy("node").agg(F.count("*").alias("weight"), F.min("vec_id").alias("low"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    nodes = scratch.cut(nodes)
    hashed = scratch.cut(nodes.select("node", "weight", "label", "embedding").mapInArrow(_hashed(tables, k, width, kind), "node long, weight long, keys array<long>, vector binary"))
    places = hashed.select("node", F.posexplode("keys").alias("table", "key"))
    buckets = places.groupBy("table", "key").agg(F.count("*").alias("size")).where("size > 1").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    members = places.join(buckets, ["table", "key"]).withColumn("block", F.pmod(F.xxhash64("node", "table"), F.col("blocks")).cast("int"))
    # each member goes to the tasks of its block with every block, its own included
    members = members.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("table", "key", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node")
    short = F.transform("keys", lambda x: F.hex(F.shiftrightunsigned(x, 32)))
    before = F.unhex(F.array_join(F.transform(short, lambda x: F.lpad(x, 8, "0")), ""))
    members = members.join(hashed.select("node", "weight", "vector", before.alias("before")), "node").withColumn("before", F.substring("before", 1, 4 * F.col("table")))
    task = ["table", "key", "i", "j"]
    members = members.repartition(partitions(spark), *task).sortWithinPartitions(*task, "node")
    found = scratch.cut(members.mapInArrow(_compare(least, kind), "node long, links long, other long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = components(spark, found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")), scratch)
    known = nodes.select("node", "weight", "low").join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lows = known.groupBy("component").agg(F.min("low").alias("component_id"))
    usable = hashed.select("node", F.lit(True).alias("usable"))
    known = known.join(lows, "component").join(links, "node", "left").join(usable, "node")
    known = scratch.cut(known.select("node", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"))
    scratch.drop(nodes, hashed, found)
    own = F.when(F.col("label").isNotNull(), F.col("node"))
    out = rows.select("vec_id", own.alias("node")).join(known, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
u AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS norm FROM v WHERE len(e) > 0),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND len(a.e) = len(b.e) AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach(vec_id, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.vec_id, link.y FROM reach JOIN link ON reach.r = link.x),
low AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT x AS vec_id, count(*) AS n FROM link GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN low USING (vec_id) LEFT JOIN n USING (vec_id)
"""
