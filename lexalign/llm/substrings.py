"""Substring dedup by relative Lempel-Ziv parsing of words.

The reference is the collection itself, as an index of blocks. Blocks are cut where the content says so: each window of
``length`` consecutive words has an anchor, its smallest gram of ``gram`` words (the leftmost, if equal), and the windows
that follow each other with one anchor form a block. Equal passages have equal blocks inside, so looking blocks up by hash
finds where a passage also stands: its source, one place in one document for each block. At a passage's ends the blocks
differ though their anchor is known; there every single window is looked up. A document is then parsed from left to right:
at each place it takes the longest factor, which is the longest run of windows that one source has in the same order. The
words of all factors of ``length`` words or more go; a source is a factor of its copy in turn.

Nothing is gathered by key without bound: within a chunk of documents, equal blocks and windows settle each other and send
one row to the index, so that a key gets a row for each chunk at most, however many documents share the passage. Blocks are
equal if anchor and content are, windows if two hashes of 64 bits are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.llm.storage import Scratch, maybe_broadcast, partitions
from lexalign.llm.words import BLANKS, CHUNK_BYTES, U64, ODD, Parcels, chunks, cut_words, grams, mix, powers, ranges_hash

LENGTH = 35
GRAM = 16
DUPLICATE, ASKED, INDEX = 0, 1, 2
_MARKS = "part int, kind int, key long, start int, count int, source long, at int, data binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("key", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("source", pa.int64()), ("at", pa.int32()), ("data", pa.binary())])
#: In parcels: anchor, block, document, place, and twice the windows with a flag; and two hashes, document and place.
_BLOCK, _WINDOW = ["u8", "u8", "i8", "i4", "i4"], ["u8", "u8", "i8", "i4"]


def _rows(kind: int, key: np.ndarray, start: np.ndarray, count: np.ndarray, source: np.ndarray | None = None, at: np.ndarray | None = None) -> pa.RecordBatch:
    n = len(key)
    where = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())] if source is None else [pa.array(source.astype(np.int64)), pa.array(at.astype(np.int32))]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(key % 997, np.int32)), pa.array(np.full(n, kind, np.int32)), pa.array(key.astype(np.int64)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), *where, pa.nulls(n, pa.binary())],
        schema=_SCHEMA,
    )


def _index_rows(parcels: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for part, data in parcels:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([INDEX], pa.int32()), *(pa.nulls(1, f.type) for f in list(_SCHEMA)[2:7]), pa.array([data], pa.binary())], schema=_SCHEMA)


def anchors(hashes: np.ndarray, at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of each window of ``span`` grams and the place in ``hashes`` of its smallest one, the leftmost if equal."""
    n = len(hashes)
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, where, have = hashes, np.arange(n), 1
    while have < span:
        step = min(have, span - have)
        left, right = low[: len(low) - step], low[step:]
        take = right < left
        where = np.where(take, where[step:], where[: len(where) - step])
        low = np.where(take, right, left)
        have += step
    starts = np.flatnonzero(at[span - 1 :] - at[: n - span + 1] == span - 1)
    return starts, where[starts]


def _merged(key: np.ndarray, start: np.ndarray, count: np.ndarray, source: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Joins rows of one key and source that follow each other without a gap in both."""
    if not len(key):
        return key, start, count, source, at
    order = np.lexsort((start, at - start, source, key))
    key, start, count, source, at = (x[order] for x in (key, start, count, source, at))
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (source[1:] != source[:-1]) | (at[1:] - start[1:] != at[:-1] - start[:-1]) | (start[1:] != start[:-1] + count[:-1])
    first = np.flatnonzero(new)
    return key[first], start[first], np.add.reduceat(count, first), source[first], at[first]


def _copies(order: np.ndarray, lead: np.ndarray, size: np.ndarray, key: np.ndarray, place: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of groups of several, each with its source: the group's first one, and the first one's is the second."""
    many = np.repeat(size > 1, size)
    mine = order[many]
    first = np.repeat(order[lead], size)[many]
    second = np.repeat(order[np.minimum(lead + 1, len(order) - 1)], size)[many]
    source = np.where(mine == first, second, first)
    return _merged(key[mine], place[mine], count[mine], key[source], place[source])


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by keys (first leads), where groups begin in it, and each one's size."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    return order, at, np.diff(np.append(at, len(order)))


def _blocks(length: int, gram: int, parts: int):
    """Stage 1, on documents: blocks settled within a chunk, and one row for each other anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parcels = Parcels(_BLOCK, parts)
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                words = cut_words(data, offsets, BLANKS, False)
                hashes, at = grams(words, gram)
                starts, low = anchors(hashes, at, length - gram + 1)
                if not len(starts):
                    continue
                new = np.ones(len(starts), bool)
                new[1:] = (low[1:] != low[:-1]) | (starts[1:] != starts[:-1] + 1)
                first = np.flatnonzero(new)
                count = np.diff(np.append(first, len(starts)))
                begin, anchor = at[starts[first]], hashes[low[first]]
                doc = words.doc[begin]
                place = begin - words.first[doc]
                block = mix(ranges_hash(words.hashes, begin, begin + count + length - 1) + (low[first] - starts[first]).astype(U64) * ODD[3])
                key = np.asarray(part.column("_key"))[doc]
                order, lead, size = _groups(anchor, block)
                yield _rows(DUPLICATE, *_copies(order, lead, size, key, place, count))
                kept = order[lead]  # one for each block
                _, lead, size = _groups(anchor[kept])
                several = np.repeat(size > 1, size)  # anchors of more than one block here
                yield _rows(ASKED, key[kept][several], place[kept][several], count[kept][several])
                sent = kept[lead]
                flag = (size > 1).astype(np.int32)
                yield from _index_rows(parcels.add((anchor[sent] % U64(parts)).astype(np.int64), anchor[sent], block[sent], key[sent], place[sent], count[sent] * 2 + flag))
        yield from _index_rows(parcels.flush())

    return run


def _look_up_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stage 2, on the index: blocks that several chunks have, and blocks whose anchor has others."""
    blobs: list[bytes] = []
    for batch in batches:
        kinds = np.asarray(batch.column("kind"))
        if (rest := np.flatnonzero(kinds != INDEX)).size:
            yield batch.take(pa.array(rest))
        blobs += [x for x in batch.column("data").to_pylist() if x is not None]
    rows = Parcels(_BLOCK, 1).read(blobs)
    if not len(rows):
        return
    order, lead, size = _groups(rows["f0"], rows["f1"])
    yield _rows(DUPLICATE, *_copies(order, lead, size, rows["f2"], rows["f3"], rows["f4"] >> 1))
    rows = rows[order]
    asked_before = np.maximum.reduceat(rows["f4"] & 1, lead).astype(bool)
    kept = rows[lead]
    _, at, blocks = _groups(kept["f0"])
    other = np.repeat((blocks > 1) | np.logical_or.reduceat(asked_before, at), blocks) & ~asked_before
    yield _rows(ASKED, kept["f2"][other], kept["f3"][other], kept["f4"][other] >> 1)


def _windows(length: int, parts: int):
    """Stage 3, on documents with blocks at a factor's boundary: each window of those blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parcels = Parcels(_WINDOW, parts)
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                words = cut_words(data, offsets, BLANKS, False)
                asked = part.column("asked")
                sizes = np.asarray(pa.compute.list_value_length(asked))
                flat = asked.flatten()
                start, count = np.asarray(flat.field("start")).astype(np.int64), np.asarray(flat.field("count")).astype(np.int64)
                doc = np.repeat(np.repeat(np.arange(part.num_rows), sizes), count)
                ramp = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                place = np.repeat(start, count) + ramp
                begin = words.first[doc] + place
                hashes = ranges_hash(words.hashes, begin, begin + length)
                check = ranges_hash(mix(words.hashes ^ ODD[9]), begin, begin + length)
                key = np.asarray(part.column("_key"))[doc]
                order, lead, size = _groups(hashes, check)
                yield _rows(DUPLICATE, *_copies(order, lead, size, key, place, np.ones(len(key), np.int64)))
                sent = order[lead]
                yield from _index_rows(parcels.add((hashes[sent] % U64(parts)).astype(np.int64), hashes[sent], check[sent], key[sent], place[sent]))
        yield from _index_rows(parcels.flush())

    return run


def _look_up_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stage 4, on the index: windows that several chunks have."""
    blobs: list[bytes] = []
    for batch in batches:
        kinds = np.asarray(batch.column("kind"))
        if (rest := np.flatnonzero(kinds != INDEX)).size:
            yield batch.take(pa.array(rest))
        blobs += [x for x in batch.column("data").to_pylist() if x is not None]
    rows = Parcels(_WINDOW, 1).read(blobs)
    if len(rows):
        order, lead, size = _groups(rows["f0"], rows["f1"])
        yield _rows(DUPLICATE, *_copies(order, lead, size, rows["f2"], rows["f3"], np.ones(len(rows), np.int64)))


def parse(marks: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Greedy factors of a document, as (first window, windows, source, first window there), from marks of the same form: at
    each window the source that goes on for longest, be it over several marks."""
    runs: list[list[int]] = []
    for source, shift, start, count in sorted((m[2], m[3] - m[0], m[0], m[1]) for m in set(marks)):
        last = runs[-1] if runs else None
        if last and last[2] == source and last[3] - last[0] == shift and start <= last[0] + last[1]:
            last[1] = max(last[1], start + count - last[0])
        else:
            runs.append([start, count, source, start + shift])
    runs.sort()
    out, at, i, best = [], 0, 0, None
    while True:
        while i < len(runs) and runs[i][0] <= at:
            if best is None or runs[i][0] + runs[i][1] > best[0] + best[1]:
                best = runs[i]
            i += 1
        if best is not None and best[0] + best[1] > at:
            skip = at - best[0]
            out.append((at, best[1] - skip, best[2], best[3] + skip))
            at = best[0] + best[1]
        elif i < len(runs):
            at = runs[i][0]
        else:
            return out


def _factors(length: int):
    """Stage 5: each document's factors, and the runs of words that they cover."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("windows", pa.int32()), ("source", pa.int64()), ("at", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            factors, covered = [], []
            for marks in batch.column("marks").to_pylist():
                found = parse([(m["start"], m["count"], m["source"], m["at"]) for m in marks])
                spans: list[int] = []
                for start, windows, _, _ in found:
                    end = start + windows + length - 1
                    if spans and start <= spans[-1]:
                        spans[-1] = end
                    else:
                        spans += [start, end]
                factors.append([dict(zip(("start", "windows", "source", "at"), f, strict=True)) for f in found])
                covered.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(factors, kind), pa.array(covered, pa.list_(pa.int32()))], names=["_key", "factors", "spans"])

    return run


def parsed(spark: SparkSession, docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(_key, factors, spans): the greedy factors (start, windows, source, at) of documents that have any, and begin and end
    (exclusive) of the runs of words that they cover; ``source`` is the other document's ``_key``, ``at`` the place of the
    first word there.

    ``docs`` has ``_key`` (see :func:`keyed`) and ``text``. A factor of n windows has ``length`` + n - 1 words.
    """
    parts = partitions(spark)
    docs = docs.select("_key", "text")
    index = docs.mapInArrow(_blocks(length, gram, parts), _MARKS)
    marks = scratch.cut(index.repartition(parts, "part").mapInArrow(_look_up_blocks, _MARKS).drop("data", "part"))
    asked = scratch.cut(marks.where(F.col("kind") == ASKED).groupBy("key").agg(F.collect_list(F.struct("start", "count")).alias("asked")).withColumnRenamed("key", "_key"))
    size = asked.agg(F.coalesce(F.sum(F.size("asked") * 8 + 24), F.lit(0))).first()[0]
    at = docs.join(maybe_broadcast(asked, -(-size // max(1, asked.count()))), "_key").select("_key", "text", "asked")
    more = at.mapInArrow(_windows(length, parts), _MARKS).repartition(parts, "part").mapInArrow(_look_up_windows, _MARKS).drop("data", "part")
    found = marks.where(F.col("kind") == DUPLICATE).unionByName(more)
    grouped = found.groupBy("key").agg(F.collect_list(F.struct("start", "count", "source", "at")).alias("marks")).select(F.col("key").alias("_key"), "marks")
    out = scratch.cut(grouped.mapInArrow(_factors(length), "_key long, factors array<struct<start:int,windows:int,source:long,at:int>>, spans array<int>"))
    scratch.drop(marks, asked)
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """Adds ``_key``, by which marks find their rows again; equal rows share it and have equal marks."""
    return docs.withColumn("_key", F.xxhash64(F.col("doc_id"), F.col("text")))


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, removed words and the text that is left."""
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        spans = batch.column("spans").to_pylist()
        n_words, n_removed, kept = [], [], []
        for text, cut in zip(texts, spans, strict=True):
            words = (text.as_py() or b"").split()
            n, left, at = len(words), [], 0
            for begin, end in zip(cut[::2], cut[1::2], strict=True) if cut else ():
                left += words[at:begin]
                at = end
            left += words[at:]
            n_words.append(n)
            n_removed.append(n - len(left))
            kept.append(b" ".join(left))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.large_binary()).cast(pa.large_string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _rest(batches):
        kept = [hashlib.sha256(x.as_py().encode()).hexdigest() for x in batch.column("kept")]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _marked(spark: SparkSession, docs: DataFrame, length: int, gram: int) -> DataFrame:
    scratch = Scratch(spark, "substrings")
    docs = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    spans = parsed(spark, docs, scratch, length, gram).select("_key", "spans")
    size = spans.agg(F.coalesce(F.sum(F.size("spans") * 4 + 32), F.lit(0))).first()[0]
    spans = maybe_broadcast(spans, -(-size // max(1, spans.count())))
    return docs.join(spans, "_key", "left").select("doc_id", "text", "spans")


def remove_duplicates(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): documents without the words of windows that start elsewhere as well.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; ``kept`` joins those left by one space. Null and empty texts have no
    words. A document shorter than ``length`` words keeps them all. Repeated rows count as other places, so that both
    lose their windows. Other columns are ignored. An empty table gives an empty result.
    """
    return _marked(spark, docs, length, gram).mapInArrow(_rest, "doc_id long, n_words long, n_removed long, kept string")


def digests(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """As :func:`remove_duplicates`, with the SHA-256 of the kept text instead of it."""
    return _marked(spark, docs, length, gram).mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
starts AS (
  SELECT doc_id, s, array_to_string(words[s:s + 34], ' ') AS win
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 34)) AS s FROM w WHERE len(words) >= 35)),
again AS (SELECT win FROM starts GROUP BY win HAVING count(*) > 1),
hit AS (
  SELECT DISTINCT doc_id, s + o AS pos
  FROM starts JOIN again USING (win), (SELECT unnest(generate_series(0, 34)) AS o)),
pos AS (SELECT doc_id, unnest(generate_series(1, len(words))) AS pos, unnest(words) AS word FROM w),
kept AS (
  SELECT p.doc_id, count(*) FILTER (WHERE h.pos IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY p.pos) FILTER (WHERE h.pos IS NULL) AS kept
  FROM pos p LEFT JOIN hit h ON p.doc_id = h.doc_id AND p.pos = h.pos GROUP BY p.doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
