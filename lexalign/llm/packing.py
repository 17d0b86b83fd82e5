"""Packing documents into windows of equal length, by Karmarkar-Karp multiway differencing.

A document's ids are cut at multiples of the capacity; each full piece is a window of its own. The rests are cut into even
pieces of at most a sixth of the capacity and dealt into groups of a fixed number of documents, and each group is packed
alone: every piece begins as a partition into k windows of which one is filled, and the two partitions of the largest
imbalance are merged, the fullest windows of one with the emptiest of the other, until one is left. Its windows are near
equal. While one of them exceeds the capacity, the number of windows rises; with pieces this small that costs less than a
hundredth of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.llm.storage import Scratch
from lexalign.llm.tokens import encoder
from lexalign.llm.words import SMALL_CHUNK, chunks

CAPACITY = 1024
END = 0
#: Documents packed together, and pieces that make a window at least.
GROUP, SHARE = 1024, 6


def differencing(sizes: np.ndarray, k: int) -> list[list[int]]:
    """Items in k windows. Of a partial partition only the windows in use are kept, largest first."""
    left: list[int] = []
    right: list[int] = []
    n = len(sizes)
    heap = [(-int(s), i, np.array([s], np.int64), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    ticket = n
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, sums2, nodes2 = heapq.heappop(heap)
        over = len(sums) + len(sums2) - k
        if over <= 0:
            sums, nodes = np.concatenate([sums, sums2]), np.concatenate([nodes, nodes2])
        else:  # with empty windows counted in, the last `over` of one meet the last `over` of the other in reverse
            a, b = len(sums) - over, len(sums2) - over
            joined = n + len(left) + np.arange(over)
            left += nodes[a:].tolist()
            right += nodes2[b:][::-1].tolist()
            sums = np.concatenate([sums[:a], sums2[:b], sums[a:] + sums2[b:][::-1]])
            nodes = np.concatenate([nodes[:a], nodes2[:b], joined])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        spread = sums[0] - (sums[-1] if len(sums) == k else 0)
        heapq.heappush(heap, (-int(spread), ticket, sums, nodes))
        ticket += 1
    out = []
    for node in heap[0][3].tolist() if heap else []:
        stack, items = [node], []
        while stack:
            x = stack.pop()
            if x < n:
                items.append(x)
            else:
                stack += [right[x - n], left[x - n]]
        out.append(items)
    return out


def pieces(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item, start and length of even pieces of at most ``most``, that make up the items."""
    count = -(-sizes // most)
    item = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
    start = sizes[item] * nth // count[item]
    return item, start, sizes[item] * (nth + 1) // count[item] - start


def pack(sizes: np.ndarray, capacity: int, most: int | None = None) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (item, start, length) of at most ``most``, by default uncut. Sizes are positive and, where they are
    not cut, at most the capacity."""
    sizes = np.asarray(sizes, np.int64)
    if not len(sizes):
        return []
    item, start, length = pieces(sizes, most or capacity)
    k = int(-(-length.sum() // capacity))
    windows = differencing(length, k)
    while max(int(length[w].sum()) for w in windows) > capacity:
        k += max(1, k // 256)
        windows = differencing(length, k)
    return [sorted((int(item[i]), int(start[i]), int(length[i])) for i in w) for w in windows if w]


def _encode(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path)
        for batch in batches:
            for part, data, offsets in chunks(batch, "text", SMALL_CHUNK):
                ids, at = made.encode(data, offsets)
                every = [np.append(ids[begin:end], END).astype("<u4").tobytes() for begin, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at) + 1, pa.int64()), pa.array(every, pa.binary())], names=["doc_id", "doc_tokens", "ids"])

    return run


_PIECES = pa.schema([(name, pa.int64()) for name in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())])


def _pack_group(capacity: int, most: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["doc_tokens"], r["rest"]))
        out: list[tuple] = []
        sequence = rows[0]["group"] << 32
        for window in pack([len(r["rest"]) // 4 for r in rows], capacity, most):
            offset = 0
            for i, start, length in window:
                r = rows[i]
                before = r["doc_tokens"] - len(r["rest"]) // 4
                out.append((r["doc_id"], before + start, length, r["doc_tokens"], sequence, offset, r["rest"][4 * start : 4 * (start + length)]))
                offset += length
            sequence += 1
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PIECES, strict=True)], schema=_PIECES)

    return run


def pack_documents(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP, path: str | None = None) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids): each id of each document in one piece.

    A null or empty text has the end id alone. A document of any length is cut. Repeated rows are packed each; a null
    doc_id stays null. ``ids`` has the piece's ids as little-endian unsigned 32-bit numbers. Other columns are ignored. An
    empty table gives an empty result. ``path``: the vocabulary file of a tokenizer.
    """
    scratch = Scratch(spark, "packing")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    encoded = scratch.cut(docs.mapInArrow(_encode(path), "doc_id long, doc_tokens long, ids binary"))
    groups = max(1, -(-encoded.count() // group))
    # full windows need no shuffle: only the rests meet in groups
    whole = F.floor(F.col("doc_tokens") / capacity).cast("int")
    full = F.transform(F.sequence(F.lit(0), whole - 1), lambda i: F.substring("ids", 4 * capacity * i + 1, F.lit(4 * capacity)))
    full = encoded.where(F.col("doc_tokens") >= capacity).select("doc_id", "doc_tokens", F.posexplode(full).alias("nth", "ids"))
    number = F.lit(1 << 62) + F.monotonically_increasing_id()
    full = full.select("doc_id", (F.col("nth") * F.lit(capacity).cast("long")).alias("start"), F.lit(capacity).cast("long").alias("length"), "doc_tokens", number.alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids")
    # numbers of rows of a written table, so that neither a hot doc_id nor a lost task changes the groups' sizes
    rest = encoded.where(F.col("doc_tokens") % capacity > 0)
    rest = rest.select("doc_id", "doc_tokens", F.substring("ids", 4 * capacity * whole + 1, F.lit(4 * capacity)).alias("rest"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("group"))
    packed = rest.groupBy("group").applyInArrow(_pack_group(capacity, max(1, capacity // SHARE)), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
    return full.unionByName(packed)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pack_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
