"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of distinct shingles; equal sets are one node, so copies meet before any join. Shingles have one
global order: those that many documents hold come last, by how many, and the rest by hash. If two sets of sizes n and m
share t shingles, then their first n - t + l and m - t + l ones share at least l. A document's l is a share of its size that
grows with the estimated number of candidates that its prefix brings in. So a document takes part only if its prefix shares
as many shingles as its size demands of any partner, all partners together; that leaves out nearly all that merely have a
passage in common.

Groups of near copies would give the square of their size in pairs, while components need a spanning tree only. So some
rounds first send every document to the pivot that most of its shingles' lists share, and whole sets are compared there, each
set travelling once; what they link is one component. Documents that still share enough of their prefixes with other components
send their whole sets as postings once. Lists within one component go, a document whose rest is less than a link needs goes
as well, and of each other one only its rarest lists are joined, as many as a partner can't all miss. A pair comes out at the
first list that it shares, and is compared on whole sets.

That holds for pairs that share a list of few nodes. Wide lists would again give the square of their size, so no pairs are made of
them: their nodes meet in packs of a fixed size, each pack of nodes of one list. A few rounds compare packs within, each time by
another list; in the end each two packs are compared that share a list and aren't of one component. All pairs of a wide list are
compared or known to be of one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexalign.llm.graph import components, roots
from lexalign.llm.storage import Scratch, maybe_broadcast, partitions
from lexalign.llm.words import BLANKS, ODD, U64, Parcels, chunks, cut_words, mix, shingle_sets

#: Entries of the table of frequent shingles at most; the frequency that counts as frequent rises with the mean set size.
HOT_ENTRIES = 1 << 18
HOT_SHARE = 1e-3
#: A shingle is reported as maybe frequent if so many documents of one chunk hold it.
HOT_IN_CHUNK = 3
#: Percent of a set's size that prefixes are longer by than one match needs: at least, and at most.
LEAST_LEVEL, MOST_LEVEL = 3, 15
STAR_ROUNDS = 3
#: Documents compared together.
BLOCK = 512
#: Nodes of a list whose pairs are made one by one, at most.
WIDE = 32


class Sets:
    """What makes a document's set: the words of a shingle, and the identities that two different sets were found to share."""

    def __init__(self, k: int, clashes: np.ndarray | None = None):
        self.k, self.clashes = k, clashes if clashes is not None else np.zeros(0, np.int64)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, shingle) pairs, sorted; and by document the set's size, its identity and a second hash of it."""
        doc, hashes = shingle_sets(cut_words(data, offsets, BLANKS, True), self.k)
        n = np.bincount(doc, minlength=len(offsets) - 1)
        ends = np.cumsum(n)

        def summed(seed: np.uint64) -> np.ndarray:
            sums = np.zeros(len(hashes) + 1, U64)
            np.cumsum(mix(hashes ^ seed), out=sums[1:])
            return mix((sums[ends] - sums[ends - n]) + n.astype(U64) * ODD[4])

        node, check = summed(ODD[2]), summed(ODD[7])
        if len(self.clashes):
            again = np.isin(node.view(np.int64), self.clashes)
            node[again] = mix(node[again] ^ check[again])
        return doc, hashes, n, node.view(np.int64), check.view(np.int64)

    def distinct(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As :meth:`of` without the last, where each set is that of one document only."""
        doc, hashes, n, node, _ = self.of(data, offsets)
        once = np.zeros(len(n), bool)
        once[np.unique(node, return_index=True)[1]] = True
        keep = once[doc]
        return doc[keep], hashes[keep], node


def _read_sets(sets: Sets):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "node", "check", "token"]
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                doc, hashes, n, node, check = sets.of(data, offsets)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(node, mask=n == 0), pa.array(check), pa.nulls(len(n), pa.int64())], names=names)
                once = np.zeros(len(n), bool)
                once[np.unique(node, return_index=True)[1]] = True
                token, held = np.unique(hashes[once[doc]], return_counts=True)
                if (many := held >= HOT_IN_CHUNK).any():
                    none = pa.nulls(many.sum(), pa.int64())
                    yield pa.RecordBatch.from_arrays([none, pa.array(held[many], pa.int64()), none, none, pa.array(token[many].view(np.int64))], names=names)

    return run


class Hot:
    """Frequent shingles, in order, and how many documents hold each."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]

    def held(self, hashes: np.ndarray) -> np.ndarray:
        """Count of each shingle, 0 for those that aren't frequent."""
        if not len(self.tokens):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, hashes), len(self.tokens) - 1)
        return np.where(self.tokens[at] == hashes, self.counts[at], 0)


#: Postings on their way: frequent shingles' as plain rows, so that no task has a whole list of them, the others' in parcels by
#: shingle, that hold token, node, nl and component (none in prefixes, where each node is its own).
_POSTING = "part int, token long, node long, nl long, component long, data binary"
_POSTING_SCHEMA = pa.schema([("part", pa.int32()), ("token", pa.int64()), ("node", pa.int64()), ("nl", pa.int64()), ("component", pa.int64()), ("data", pa.binary())])
_PREFIX, _WHOLE = ["u8", "i8", "u4"], ["u8", "i8", "u4", "i8"]
#: Postings in lists of several components, with the list's size, its commonest component and its pivot; frequent shingles have
#: none of these yet.
_LIST = "token long, node long, nl long, component long, size long, major long, pivot long, pivot_nl long"
_LIST_SCHEMA = pa.schema([(c.split()[0], pa.int64()) for c in _LIST.split(", ")])


def _rows(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    made = {name: x if isinstance(x, pa.Array) else pa.array(x, schema.field(name).type) for name, x in columns.items()}
    return pa.RecordBatch.from_arrays([made[f.name] if f.name in made else pa.nulls(n, f.type) for f in schema], schema=schema)


def _sent(parcels: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for part, data in parcels:
        yield _rows(_POSTING_SCHEMA, 1, part=[part], data=[data])


def _postings(parcels: Parcels, token: np.ndarray, often: np.ndarray, node: np.ndarray, nl: np.ndarray, *component: np.ndarray) -> Iterator[pa.RecordBatch]:
    cold = ~often
    yield from _sent(parcels.add((token[cold] % U64(parcels.parts)).astype(np.int64), token[cold], node[cold], nl[cold].astype(np.uint32), *(c[cold] for c in component)))
    if often.any():
        own = component[0] if component else node
        yield _rows(_POSTING_SCHEMA, often.sum(), part=(node[often] & 1023).astype(np.int32), token=token[often].view(np.int64), node=node[often], nl=nl[often], component=own[often])


def _prefixes(sets: Sets, percent: int, hot: Hot, parts: int):
    """Postings of the prefixes. ``nl`` has a set's size above four bits, and there the level of its prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parcels = Parcels(_PREFIX, parts)
        for batch in batches:
            for _, data, offsets in chunks(batch, "text"):
                doc, hashes, node = sets.distinct(data, offsets)
                if not len(doc):
                    continue
                held = hot.held(hashes)
                if held.any():
                    order = np.lexsort((hashes, held, doc))
                    doc, hashes, held = doc[order], hashes[order], held[order]
                begin = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                size = np.diff(np.append(begin, len(doc)))
                rank = np.arange(len(doc)) - np.repeat(begin, size)
                least = (percent * size + 99) // 100
                base = size - least + 1
                cost = np.add.reduceat(np.where(rank < np.repeat(base, size), np.maximum(held, 1), 0), begin) / base
                level = np.minimum(LEAST_LEVEL + np.floor(np.log2(np.maximum(cost, 1))).astype(np.int64), MOST_LEVEL)
                matches = np.minimum(1 + size * level // 100, least)
                take = rank < np.repeat(base - 1 + matches, size)
                yield from _postings(parcels, hashes[take], held[take] > 0, node[doc[take]], np.repeat(size * 16 + level, size)[take])
        yield from _sent(parcels.flush())

    return run


def _whole(sets: Sets, hot: Hot, parts: int):
    """Postings of whole sets of rows (text, node, component)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parcels = Parcels(_WHOLE, parts)
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                doc, hashes, n, node, _ = sets.of(data, offsets)
                mine = node == np.asarray(part.column("node"))  # another text of the same doc_id has another node
                keep = mine[doc]
                doc, hashes = doc[keep], hashes[keep]
                if len(doc):
                    yield from _postings(parcels, hashes, hot.held(hashes) > 0, node[doc], n[doc] * 16, np.asarray(part.column("component"))[doc])
        yield from _sent(parcels.flush())

    return run


def _open(kind: list[str]):
    """Lists of shingles that several components have; postings of frequent shingles as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, list[bytes]] = {}
        for batch in batches:
            if batch.column("node").null_count < batch.num_rows:
                some = batch.filter(batch.column("node").is_valid())
                yield _rows(_LIST_SCHEMA, some.num_rows, **{c: some.column(c) for c in ("token", "node", "nl", "component")})
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if data is not None:
                    blobs.setdefault(part, []).append(data)
        read = Parcels(kind, 1).read
        while blobs:
            _, mine = blobs.popitem()
            rows = read(mine)
            del mine
            token, node, nl = rows["f0"], rows["f1"], rows["f2"].astype(np.int64)
            component = rows["f3"] if "f3" in rows.dtype.names else node
            order = np.lexsort((node, component, token))
            token, node, nl, component = token[order], node[order], nl[order], component[order]
            new = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))
            token, node, nl, component = token[new], node[new], nl[new], component[new]
            # runs of a component within a list, then lists
            run_at = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (component[1:] != component[:-1])))
            run_size = np.diff(np.append(run_at, len(token)))
            list_at = np.flatnonzero(np.append(True, token[run_at][1:] != token[run_at][:-1]))
            runs = np.diff(np.append(list_at, len(run_at)))
            size = np.add.reduceat(run_size, list_at)
            first = np.lexsort((run_at, -run_size, np.repeat(np.arange(len(list_at)), runs)))[list_at]
            major = component[run_at[first]]
            owner = np.repeat(np.arange(len(list_at)), size)
            pivot = np.lexsort((mix(node.view(U64) ^ ODD[11]), owner))[np.cumsum(size) - size]
            keep = np.repeat(runs > 1, size)
            owner = owner[keep]
            yield _rows(_LIST_SCHEMA, len(owner), token=token[keep].view(np.int64), node=node[keep], nl=nl[keep], component=component[keep], size=size[owner], major=major[owner], pivot=node[pivot[owner]], pivot_nl=nl[pivot[owner]])

    return run


def _placed_sets(sets: Sets):
    """A row for each task of a document's set: (center, block, node, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                _, hashes, n, node, _ = sets.of(data, offsets)
                ends = np.cumsum(n)
                raw = hashes.tobytes()
                tasks = part.column("tasks")
                owner = np.repeat(np.arange(part.num_rows), np.asarray(tasks.value_lengths()))
                flat = tasks.flatten()
                mine = np.asarray(flat.field("node")) == node[owner]
                owner, flat = owner[mine], flat.filter(pa.array(mine))
                for at in range(0, len(owner), 1000):
                    some, rows = owner[at : at + 1000], flat.slice(at, 1000)
                    blobs = pa.array([raw[8 * (ends[o] - n[o]) : 8 * ends[o]] for o in some], pa.binary())
                    yield pa.RecordBatch.from_arrays([*(rows.field(c) for c in ("center", "block", "node")), blobs], names=["center", "block", "node", "data"])

    return run


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets with all."""
    if len(sets) == 2:
        a, b = sets
        at = np.minimum(np.searchsorted(a, b), len(a) - 1)
        both = int((a[at] == b).sum())
        return np.array([[len(a), both], [both, len(b)]])
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, token, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = held > 1
    shared = often[token]
    owner, token = owner[shared], (np.cumsum(often) - 1)[token[shared]]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = max(1, (32 << 20) // (4 * len(sets)))
    total = int(often.sum())
    for begin in range(0, total, width):
        a, b = np.searchsorted(token, [begin, begin + width])
        held_by = np.zeros((len(sets), min(width, total - begin)), np.float32)
        held_by[owner[a:b], token[a:b] - begin] = 1
        out += held_by @ held_by.T
    return out.astype(np.int64)


def _compare(percent: int):
    """Trees of the links within each task, as (a, b). Rows come sorted by task; the last of a batch waits for the next."""

    def tasks(table: pa.Table) -> Iterator[pa.RecordBatch]:
        center, block, node = (np.asarray(table[c]) for c in ("center", "block", "node"))
        blobs = table["data"].combine_chunks()
        starts = np.flatnonzero(np.append(True, (center[1:] != center[:-1]) | (block[1:] != block[:-1])))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for begin, end in zip(starts, np.append(starts[1:], len(node)), strict=True):
            rows = begin + np.unique(node[begin:end], return_index=True)[1]
            if len(rows) < 2:
                continue
            held = [np.frombuffer(blobs[int(r)].as_buffer(), U64) for r in rows]
            size = np.array([len(x) for x in held])
            both = _overlaps(held)
            linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
            np.fill_diagonal(linked, False)
            root = roots(linked)
            tied = np.flatnonzero(root != np.arange(len(root)))
            a.append(node[rows[root[tied]]])
            b.append(node[rows[tied]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([*held, batch])
            center, block = np.asarray(whole["center"]), np.asarray(whole["block"])
            last = np.flatnonzero((center != center[-1]) | (block != block[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from tasks(whole.slice(0, cut))
            held = whole.slice(cut).combine_chunks().to_batches()
        if held:
            yield from tasks(pa.Table.from_batches(held))

    return run


class Join:
    """One run over a table of documents; ``result`` is lazy, the rest is written as it goes."""

    def __init__(self, spark: SparkSession, docs: DataFrame, k: int, percent: int):
        self.spark, self.percent = spark, percent
        self.scratch = Scratch(spark, "jaccard")
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        table = self.scratch.cut(self.docs.mapInArrow(_read_sets(Sets(k)), "doc_id long, n long, node long, check long, token long"))
        rows = table.where("token IS NULL").drop("token")
        # two sets of one identity: some in ten thousand million documents, so the driver can hold them
        clashes = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("check").alias("a"), F.max("check").alias("b")).where("a <> b").select("node").toArrow()["node"]
        self.sets = Sets(k, np.asarray(clashes))
        if len(clashes):
            rows = self.scratch.cut(self.docs.mapInArrow(_read_sets(self.sets), "doc_id long, n long, node long, check long, token long")).where("token IS NULL").drop("token")
        self.table = rows.drop("check")
        self.holders = self.table.where("n > 0 AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
        count, total = self.table.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        share = max(HOT_SHARE, total / max(1, count) / HOT_ENTRIES)
        hot = table.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= max(2 * HOT_IN_CHUNK, share * count)).toArrow()
        self.hot = Hot(np.asarray(hot["token"]).view(np.uint64), np.asarray(hot["n"]))

    def least(self, n: Column) -> Column:
        """Shingles that a set of ``n`` shares with any it is linked with."""
        return F.floor((n * self.percent + 99) / 100)

    def compatible(self, x: Column, y: Column) -> Column:
        """Sizes that allow the similarity."""
        x, y = F.shiftright(x, 4), F.shiftright(y, 4)
        return 100 * F.least(x, y) >= self.percent * F.greatest(x, y)

    def matches(self, nl: Column) -> Column:
        """By how much a prefix is longer than a single match needs, and one."""
        n = F.shiftright(nl, 4)
        return F.least(1 + F.floor(n * nl.bitwiseAND(15) / 100), self.least(n))

    def needed(self, x: Column, y: Column) -> Column:
        """Shingles that two prefixes must share."""
        rest = lambda c: self.least(F.shiftright(c, 4)) - self.matches(c)
        whole = F.ceil((F.shiftright(x, 4) + F.shiftright(y, 4)) * self.percent / (100 + self.percent) - 1e-6)
        return F.greatest(F.lit(1), whole - F.greatest(rest(x), rest(y)))

    def demanded(self, nl: Column) -> Column:
        """Shingles that a prefix shares with that of any partner: matches of the one whose rest is longer, at least those of the
        smallest set of a compatible size."""
        smallest = self.least(F.shiftright(nl, 4))
        return F.greatest(F.lit(1), F.least(1 + F.floor(smallest * LEAST_LEVEL / 100), self.least(smallest)))

    def links(self) -> DataFrame:
        """Links between nodes that connect what the whole graph of links connects."""
        spark, scratch = self.spark, self.scratch
        lists = self._lists(self.docs.where("doc_id IS NOT NULL").select("text").mapInArrow(_prefixes(self.sets, self.percent, self.hot, partitions(spark)), _POSTING), _PREFIX)
        cold = lists.where("size IS NOT NULL").select("token", "node", "nl", "pivot", "pivot_nl")
        hot = lists.where("size IS NULL").select("token", "node", "nl").distinct()
        votes = cold.unionByName(hot.join(self._pivots(hot.withColumn("component", F.col("node")), 0).drop("pivot_component"), "token"))
        nodes = scratch.cut(self._ballot(votes).where(F.col("shared") >= self.demanded(F.col("nl"))))
        if not nodes.limit(1).count():
            return spark.createDataFrame([], "a long, b long")
        alive = maybe_broadcast(nodes.select("node"), 16)
        before, lists = lists, scratch.cut(cold.select("token", "node", "nl").unionByName(hot).join(alive, "node", "left_semi"))
        scratch.drop(before)
        found, known = [], None
        for turn in range(STAR_ROUNDS):
            if turn:
                pivots = self._pivots(lists, turn)
                votes = lists.join(pivots.where("pivot_component IS NOT NULL"), "token").where("component <> pivot_component")
                nodes = self._ballot(votes)
            ties = self.compared(scratch.cut(self._ties(nodes)))
            if not ties.limit(1).count():
                break
            found.append(ties)
            known = scratch.cut(components(spark, _union(found), scratch))
            before = lists
            lists = lists.drop("component").join(maybe_broadcast(known, 24), "node", "left").withColumn("component", F.coalesce("component", "node"))
            still = lists.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("token")
            lists = scratch.cut(lists.join(still, "token", "left_semi"))
            scratch.drop(before)
        if known is None:
            lists = lists.withColumn("component", F.col("node"))
        alive = lists.groupBy("node").agg(F.count("*").alias("shared"), F.first("nl").alias("nl"), F.first("component").alias("component"))
        alive = scratch.cut(alive.where(F.col("shared") >= self.demanded(F.col("nl"))).join(self.holders, "node").select("doc_id", "node", "component"))
        scratch.drop(lists)
        return _union([*found, *self._rest(alive)])

    def _lists(self, postings: DataFrame, kind: list[str]) -> DataFrame:
        return self.scratch.cut(postings.repartition(partitions(self.spark), "part").mapInArrow(_open(kind), _LIST))

    def _pivots(self, lists: DataFrame, turn: int) -> DataFrame:
        """(token, pivot, pivot_nl, pivot_component) of each list: one of its nodes, another in each turn."""
        by = F.xxhash64("node", F.lit(turn))
        pivots = lists.groupBy("token").agg(F.min_by(F.struct("node", "nl", "component"), by).alias("p"))
        return pivots.select("token", F.col("p.node").alias("pivot"), F.col("p.nl").alias("pivot_nl"), F.col("p.component").alias("pivot_component"))

    def _ballot(self, votes: DataFrame) -> DataFrame:
        """(node, nl, shared, best) of postings with their lists' pivots: in how many lists a node is, and the other node that is
        the pivot of most of them. Which pivots come out changes the work and not the result."""
        votes = votes.select("node", "nl", "pivot", "pivot_nl").repartition(partitions(self.spark), "node")
        pairs = votes.groupBy("node", "pivot").agg(F.count("*").alias("c"), F.first("nl").alias("nl"), F.first("pivot_nl").alias("pivot_nl"))
        other = F.when((F.col("node") != F.col("pivot")) & self.compatible(F.col("nl"), F.col("pivot_nl")), F.struct("c", "pivot", "pivot_nl"))
        return pairs.groupBy("node").agg(F.first("nl").alias("nl"), F.sum("c").alias("shared"), F.max(other).alias("best"))

    def _ties(self, nodes: DataFrame) -> DataFrame:
        """(center, member): nodes and their best pivots, where half of what a link needs is there, as only the lists are counted
        whose pivot it is."""
        good = 2 * F.col("best.c") >= self.needed(F.col("nl"), F.col("best.pivot_nl"))
        return nodes.where(good).select(F.col("best.pivot").alias("center"), F.col("node").alias("member"))

    def _rest(self, alive: DataFrame) -> list[DataFrame]:
        """Links between components, by the whole sets of the nodes ``alive`` (doc_id, node, component)."""
        least = self.least(F.shiftright("nl", 4))
        docs = self.docs.join(maybe_broadcast(alive, 40), "doc_id").select("text", "node", "component")
        lists = self._lists(docs.mapInArrow(_whole(self.sets, self.hot, partitions(self.spark)), _POSTING), _WHOLE)
        self.scratch.drop(alive)
        hot = lists.where("size IS NULL").select("token", "node", "nl", "component")
        per = hot.groupBy("token", "component").agg(F.count("*").alias("c")).groupBy("token")
        per = per.agg(F.sum("c").alias("size"), F.count("*").alias("components"), F.max_by("component", F.struct("c", "component")).alias("major"))
        columns = ["token", "node", "nl", "component", "size", "major"]
        whole = lists.where("size IS NOT NULL").select(*columns).unionByName(hot.join(per.where("components > 1"), "token").select(*columns))
        # a node with too few shared shingles goes; of the others the rarest lists are joined, as many as a partner can't all miss
        own = W.partitionBy("node")
        rarest = own.orderBy("size", "token")
        whole = whole.repartition(partitions(self.spark), "node").withColumn("shared", F.count("*").over(own)).where(F.col("shared") >= least)
        prefix = whole.withColumn("rank", F.row_number().over(rarest)).where(F.col("rank") <= F.col("shared") - least + 1)
        prefix = prefix.withColumn("before", F.collect_list("token").over(rarest.rowsBetween(W.unboundedPreceding, -1)))
        prefix = self.scratch.cut(prefix.select("token", "node", "nl", "component", "size", "major", "before"))
        self.scratch.drop(lists)
        # lists are ordered by size, so that a pair without a common narrow list shares wide ones only
        narrow, wide = prefix.where(F.col("size") <= WIDE), self.scratch.cut(prefix.where(F.col("size") > WIDE).select("token", "node", "component"))
        side = lambda x: narrow.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "nl", "component", "before")], *(["major"] if x == "a" else []))
        # of each pair one node at least lies outside the list's commonest component
        once = (F.col("component_b") == F.col("major")) | (F.col("node_a") < F.col("node_b"))
        pairs = side("a").where("component_a <> major").join(side("b"), "token")
        pairs = pairs.where((F.col("component_a") != F.col("component_b")) & once & self.compatible(F.col("nl_a"), F.col("nl_b")) & ~F.arrays_overlap("before_a", "before_b"))
        pairs = self.scratch.cut(pairs.select(F.greatest("node_a", "node_b").alias("center"), F.least("node_a", "node_b").alias("member")).distinct())
        self.scratch.drop(prefix)
        return [*self._settled(pairs), *self._packed(wide)]

    def _packed(self, lists: DataFrame) -> list[DataFrame]:
        """Links that connect what those within each of ``lists`` (token, node, component) do, with a row for a node and a pack
        instead of one for a pair."""
        spark, scratch, found = self.spark, self.scratch, []
        for turn in range(STAR_ROUNDS):
            lists, before = scratch.cut(self._several(lists)), lists
            scratch.drop(before)
            if not lists.limit(1).count():
                return found
            packs = scratch.cut(self._packs(lists, turn))
            mixed = packs.groupBy("pack").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("pack")
            links = self._met(packs.join(mixed, "pack").select(F.col("pack").alias("center"), F.lit(0).alias("block"), "node"))
            scratch.drop(packs)
            if not links.limit(1).count():
                break
            found.append(links)
            known = scratch.cut(components(spark, links.unionByName(lists.select(F.col("node").alias("a"), F.col("component").alias("b")).distinct()), scratch))
            lists, before = scratch.cut(lists.drop("component").join(maybe_broadcast(known, 24), "node", "left").withColumn("component", F.coalesce("component", "node"))), lists
            scratch.drop(before, known)
        lists = scratch.cut(self._several(lists))
        packs = scratch.cut(self._packs(lists, 0, True))
        held = scratch.cut(lists.drop("component").join(packs, "node").groupBy("token", "pack").agg(F.min("component").alias("low"), F.max("component").alias("high")))
        side = lambda x: held.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("pack", "low", "high")])
        apart = (F.col("pack_a") <= F.col("pack_b")) & (F.least("low_a", "low_b") != F.greatest("high_a", "high_b"))
        pairs = scratch.cut(side("a").join(side("b"), "token").where(apart).select("pack_a", "pack_b").distinct())
        of = pairs.select(F.xxhash64("pack_a", "pack_b").alias("center"), F.explode(F.array_distinct(F.array("pack_a", "pack_b"))).alias("pack"))
        links = self._met(of.join(packs, "pack").select("center", F.lit(0).alias("block"), "node"))
        scratch.drop(lists, packs, held, pairs)
        return [*found, links]

    def _several(self, lists: DataFrame) -> DataFrame:
        """Lists that several components have."""
        several = lists.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("token")
        return lists.join(several, "token", "left_semi")

    def _packs(self, lists: DataFrame, turn: int, apart: bool = False) -> DataFrame:
        """(node, component, pack): each node in a pack of nodes that share one of its lists, another in each turn; if ``apart``,
        those of the list's commonest component in packs of their own."""
        homes = lists.groupBy("node").agg(F.first("component").alias("component"), F.min_by("token", F.xxhash64("token", F.lit(turn))).alias("home"))
        if apart:
            per = homes.groupBy("home", "component").agg(F.count("*").alias("c")).groupBy("home").agg(F.max_by("component", F.struct("c", "component")).alias("major"))
            homes = homes.join(per, "home").withColumn("inside", F.col("component") == F.col("major")).drop("major")
        else:
            homes = homes.withColumn("inside", F.lit(False))
        sizes = homes.groupBy("home", "inside").agg(F.ceil(F.count("*") / (BLOCK // 2)).alias("blocks"))
        return homes.join(sizes, ["home", "inside"]).select("node", "component", F.xxhash64("home", "inside", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("pack"))

    def _settled(self, pairs: DataFrame) -> list[DataFrame]:
        """Links that connect what those of ``pairs`` (center, member) do. Where nodes have many pairs each, every member first
        meets one of its centers, the same one for as many as can be, and pairs within what that links need no comparison."""
        scratch, found = self.scratch, []
        for turn in range(STAR_ROUNDS):
            nodes = pairs.select(F.explode(F.array("center", "member")).alias("node")).distinct().count()
            if pairs.count() <= 2 * nodes:
                break
            one = pairs.groupBy("member").agg(F.min_by("center", F.xxhash64("center", F.lit(turn))).alias("center"))
            links = self.compared(scratch.cut(one.select("center", "member")))
            if not links.limit(1).count():
                break
            found.append(links)
            known = scratch.cut(components(self.spark, _union(found), scratch))
            side = lambda name, known=known: maybe_broadcast(known, 24).select(F.col("node").alias(name), F.col("component").alias(f"of_{name}"))
            apart = F.coalesce("of_center", "center") != F.coalesce("of_member", "member")
            before, pairs = pairs, scratch.cut(pairs.join(side("center"), "center", "left").join(side("member"), "member", "left").where(apart).select("center", "member"))
            scratch.drop(before, known)
        return [*found, self.compared(pairs)]

    def compared(self, stars: DataFrame) -> DataFrame:
        """Links (a, b) among centers and members of ``stars`` (center, member), a written table: each center meets its members in
        blocks, so that a member's set travels once for each of its centers."""
        sizes = stars.groupBy("center").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        members = stars.join(sizes, "center").select("center", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int").alias("block"), F.col("member").alias("node"))
        centers = sizes.select("center", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("center").alias("node"))
        out = self._met(members.unionByName(centers))
        self.scratch.drop(stars)
        return out

    def _met(self, rows: DataFrame) -> DataFrame:
        """Links (a, b) among the nodes of each task of ``rows`` (center, block, node)."""
        plan = rows.join(self.holders, "node").groupBy("doc_id").agg(F.collect_list(F.struct("center", "block", "node")).alias("tasks"))
        plan = self.scratch.cut(plan)
        size = plan.agg(F.coalesce(F.sum(F.size("tasks") * 32 + 24), F.lit(0))).first()[0]
        docs = self.docs.join(maybe_broadcast(plan, -(-size // max(1, plan.count()))), "doc_id").select("text", "tasks")
        rows = docs.mapInArrow(_placed_sets(self.sets), "center long, block int, node long, data binary")
        rows = rows.repartition(partitions(self.spark), "center", "block").sortWithinPartitions("center", "block")
        out = self.scratch.cut(rows.mapInArrow(_compare(self.percent), "a long, b long"))
        self.scratch.drop(plan)
        return out

    def result(self) -> DataFrame:
        links = self.scratch.cut(self.links())
        known = components(self.spark, links, self.scratch)
        rows = self.table.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
        low = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("low"), F.count("*").alias("size")).where("size > 1")
        low = self.scratch.cut(low)
        return rows.join(low, "component", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("low", "doc_id").alias("component_id"))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): documents linked by a Jaccard similarity of ``percent`` / 100 or more.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; a set holds the distinct shingles of ``k`` words, or the
    whole sequence of fewer. ``component_id`` is the smallest doc_id that links reach, itself included. Null and wordless
    texts have an empty set and link with nothing. Equal texts, and repeated rows, are linked if they have words. Rows
    that share a doc_id but not a text are one end of links. A null doc_id is linked with nothing but copies, which share
    the smallest doc_id that is not null. Other columns are ignored. An empty table gives an empty result.
    """
    return Join(spark, docs, k, percent).result()


def deduplicate(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of :func:`near_duplicates`, that of the smallest doc_id (null is largest).

    Rows are told apart by doc_id and text, so rows that share a doc_id only stay. Of rows equal in both one stays, chosen by
    a hash of all columns. Null and wordless texts all stay. An empty table gives an empty result. All columns stay, whatever
    their names.
    """
    scratch = Scratch(spark, "deduplicate")
    key = F.xxhash64("doc_id", "text")
    found = scratch.cut(near_duplicates(spark, docs.select(key.alias("doc_id"), "text"), k, percent).where("n_shingles > 0"))
    member, group = F.col("doc_id").alias("key"), F.col("component_id").alias("group")
    linked = found.where("doc_id <> component_id")
    linked = scratch.cut(linked.select(member, group).unionByName(linked.select(F.col("component_id").alias("key"), group)).distinct())
    named = docs.select(key.alias("key"), "doc_id").join(maybe_broadcast(linked, 24), "key")
    stays = named.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")).select(F.col("first.key").alias("key"))
    gone = scratch.cut(linked.join(stays, "key", "left_anti").select("key"))
    repeated = scratch.cut(found.groupBy(member).agg(F.count("*").alias("n")).where("n > 1").select("key"))
    name = _free("key", docs.columns)
    left = docs.withColumn(name, key).join(maybe_broadcast(gone, 16).withColumnRenamed("key", name), name, "left_anti")
    if not repeated.limit(1).count():
        return left.select(*_quoted(docs))
    repeated = maybe_broadcast(repeated, 16).withColumnRenamed("key", name)
    whole = F.struct(*_quoted(docs))
    again = left.join(repeated, name, "left_semi").groupBy(name).agg(F.min_by(whole, F.xxhash64(whole)).alias("row")).select("row.*")
    return left.join(repeated, name, "left_anti").select(*_quoted(docs)).unionByName(again)


def _free(name: str, taken: list[str]) -> str:
    """``name`` with as many underscores before it as make it new."""
    while name.lower() in (x.lower() for x in taken):
        name = f"_{name}"
    return name


def _quoted(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4, percent=85)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(words[i:i + 3], ' ') AS s FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 4)
    UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 3)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
inter AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM inter JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
pairs AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, pairs.y FROM reach JOIN pairs ON reach.r = pairs.x),
low AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN low USING (doc_id)
"""
