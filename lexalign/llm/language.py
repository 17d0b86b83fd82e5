"""Language ID by words first, backing off to shorter and shorter character n-grams.

Known words are scored by their log frequency in each language. An unseen word is read from left to right by the longest
known n-gram at each place, from four characters down to one. Words and n-grams are counted over all learning documents:
each task adds up its own counts and sends them by hash, and each partition adds up its share. All counts stay in a written
table, and all of them count.

Words above a fixed share of all occurrences are broadcast, as are n-grams as far as a fixed size goes. Documents are read in
units of some MB. A unit asks the partitions of the table for its other words, and for n-grams of these where not all are
broadcast, each of them once; the answers come back to the unit, which then scores its documents. So neither the model nor a
word's occurrences are ever in one place.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.llm.quality import remainder
from lexalign.llm.storage import Scratch, partitions
from lexalign.llm.tokens import LETTER, classes
from lexalign.llm.words import U64, Parcels, chunks, ranges_hash

FOLDS, HELD_OUT = 4, 2
LONGEST = 4
#: Words of at least this share of all occurrences are broadcast, and n-grams up to a size; each as far as it fits.
SHARE = 1e-7
MODEL_BYTES = 16 << 20
#: Bytes of text worked on at once, and of a unit that asks for its words at once.
CHUNK, UNIT = 1 << 20, 8 << 20
#: Counts that wait in a task before they are sent.
PENDING = 1 << 18
EDGE = 1
SMOOTH = 0.1
_SENT = ["i8", "u1", "u4", "u8"]

_lower: list[np.ndarray] = []


def lower(points: np.ndarray) -> np.ndarray:
    """Lower-case code points, where one code point stands for one."""
    if not _lower:
        table = np.arange(0x110000, dtype=np.uint32)
        for i in range(0x110000):
            if not 0xD800 <= i < 0xE000 and (c := chr(i)) != (x := c.lower()) and len(x) == 1:
                table[i] = ord(x)
        _lower.append(table)
    return _lower[0][points]


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, and start, end and document of each run of letters."""
    text = data.tobytes().decode(errors="replace")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    where = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=where[1:])
    begin = where[offsets]
    if begin[-1] != len(points):  # bytes that are no UTF-8
        return letter_words(*_repaired(data, offsets))
    points = lower(points)
    inside = np.zeros(len(points) + 2, bool)
    inside[1:-1] = classes()[points] == LETTER
    edge = np.zeros(len(points) + 1, bool)
    edge[begin] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return points, start, end, np.searchsorted(begin, start, "right") - 1


def _repaired(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = [data[a:b].tobytes().decode(errors="replace").encode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])


def n_grams(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Words set side by side with an edge before and after each: for each n the hash of the n-gram at each place, 0 where
    none fits into the word; and the word of each place."""
    size = end - start + 2
    total = np.cumsum(size)
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(total[-1] if len(total) else 0) - np.repeat(total - size, size)
    inner = (place > 0) & (place < size[word] - 1)
    flat = np.full(len(word), EDGE, np.uint64)
    flat[inner] = points[start[word[inner]] + place[inner] - 1]
    out = []
    for n in range(1, LONGEST + 1):
        at = np.flatnonzero(place + n <= size[word])
        if n == 1:
            at = at[inner[at]]
        hashes = np.zeros(len(word), U64)
        hashes[at] = ranges_hash(flat, at, at + n) | U64(1)
        out.append(hashes)
    return out, word


def word_keys(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return ranges_hash(points.astype(U64), start, end) | U64(1)


def _add_up(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of (count, kind, language, key), counts of equal ones added."""
    count, *keys = columns
    order = np.lexsort(keys)
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    return np.add.reduceat(count[order], at), *(k[at] for k in keys)


def _count(parts: int):
    """Counts of words (kind 0) and n-grams (kind n) by language, in parcels by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parcels = Parcels(_SENT, parts, 4 << 20)
        waiting: list[tuple[np.ndarray, ...]] = []

        def sent(last: bool) -> Iterator[tuple[int, bytes]]:
            if waiting:
                rows = _add_up(*(np.concatenate(c) for c in zip(*waiting, strict=True)))
                waiting[:] = [rows]
                if last or len(rows[0]) > PENDING:
                    waiting.clear()
                    yield from parcels.add((rows[3] % U64(parts)).astype(np.int64), *rows)
            if last:
                yield from parcels.flush()

        def batch_of(rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
            for part, data in rows:
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([data], pa.binary())], names=["part", "data"])

        for batch in batches:
            for part, data, offsets in chunks(batch, "text", CHUNK):
                language = np.asarray(part.column("language"))
                points, start, end, doc = letter_words(data, offsets)
                if not len(start):
                    continue
                keys = word_keys(points, start, end)
                pair, first, count = _pairs(keys, language[doc])
                langs = pair.astype(np.uint32)
                waiting.append((count, np.zeros(len(count), np.uint8), langs, keys[first]))
                grams, word = n_grams(points, start[first], end[first])
                for n, hashes in enumerate(grams, 1):
                    some = hashes > 0
                    waiting.append(_add_up(count[word[some]], np.full(some.sum(), n, np.uint8), langs[word[some]], hashes[some]))
                if sum(len(w[0]) for w in waiting) > 2 * PENDING:
                    yield from batch_of(sent(False))
        yield from batch_of(sent(True))

    return run


def _pairs(keys: np.ndarray, language: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, language): the language, the first place and the count."""
    order = np.lexsort((language, keys))
    a, b = keys[order], language[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    return b[at], order[at], np.diff(np.append(at, len(order)))


_COUNTS = "part int, kind int, key long, total long, langs array<int>, counts array<long>"


def _sum_parcels(parts: int):
    """A row for each word or n-gram of a partition, with the languages that have it and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Parcels(_SENT, 1).read([x for batch in batches for x in batch.column("data").to_pylist()])
        if not len(rows):
            return
        count, kind, language, key = _add_up(rows["f0"], rows["f1"], rows["f2"], rows["f3"])
        order = np.lexsort((language, key, kind))
        count, kind, language, key = count[order], kind[order], language[order], key[order]
        at = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (kind[1:] != kind[:-1])))
        total, ends = np.add.reduceat(count, at), np.append(at, len(key))
        for begin in range(0, len(at), 20_000):
            some = at[begin : begin + 20_000]
            end = ends[begin + len(some)]
            offsets = pa.array(ends[begin : begin + len(some) + 1] - some[0], pa.int32())
            lists = (pa.ListArray.from_arrays(offsets, pa.array(x[some[0] : end].astype(t))) for x, t in ((language, np.int32), (count, np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array((key[some] % U64(parts)).astype(np.int32)), pa.array(kind[some], pa.int32()), pa.array(key[some].view(np.int64)), pa.array(total[begin : begin + len(some)], pa.int64()), *lists], names=["part", "kind", "key", "total", "langs", "counts"])

    return run


def _logs(n: int, row: np.ndarray, language: np.ndarray, count: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Log frequencies by language of ``n`` words or n-grams, from their counts where there are any."""
    out = np.full((n, len(below)), SMOOTH)
    out[row, language] += count
    return np.log(out / below)


class Table:
    """Log frequencies by language of some words or n-grams, by key."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], logs[order]

    @classmethod
    def of(cls, rows: pa.Table, below: np.ndarray) -> Table:
        langs, counts = rows["langs"].combine_chunks(), rows["counts"].combine_chunks()
        owner = np.repeat(np.arange(len(rows)), np.asarray(langs.value_lengths()))
        return cls(np.asarray(rows["key"]).view(U64), _logs(len(rows), owner, np.asarray(langs.flatten()), np.asarray(counts.flatten()), below))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in the table, -1 where it has none."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


class Model:
    """What is broadcast: tables of words and of n-grams by their length, whether these are all there are, and by kind and
    language what a count is divided by."""

    def __init__(self, languages: list[str], below: np.ndarray, tables: list[Table], whole: bool):
        self.languages, self.below, self.tables, self.whole = languages, below, tables, whole


def train(spark: SparkSession, docs: DataFrame, scratch: Scratch, share: float = SHARE, size: int = MODEL_BYTES) -> tuple[Model | None, DataFrame | None]:
    """Model of the texts of ``docs`` (text, lang), and the table of all counts; rows without either teach nothing."""
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    languages = sorted(r.lang for r in docs.select("lang").distinct().collect())  # one row for each language
    if not languages:
        return None, None
    parts = partitions(spark)
    place = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")) - 1
    counted = docs.select("text", place.cast("int").alias("language")).mapInArrow(_count(parts), "part int, data binary")
    counts = scratch.cut(counted.repartition(parts, "part").mapInArrow(_sum_parcels(parts), _COUNTS))
    below = np.full((LONGEST + 1, len(languages)), SMOOTH)
    for r in counts.groupBy("kind").agg(F.count("*").alias("n")).collect():
        below[r.kind] = SMOOTH * (r.n + 1)
    by = counts.select("kind", F.explode(F.arrays_zip("langs", "counts")).alias("x")).groupBy("kind", "x.langs").agg(F.sum("x.counts").alias("n"))
    occurrences = 0
    for r in by.collect():  # a row for each kind and language
        below[r.kind, r.langs] += r.n
        occurrences += r.n if r.kind == 0 else 0
    # how many there are of each count tells the least count to broadcast; counts are binned by halves of a power
    most, words = size // (8 + 8 * len(languages)), F.col("kind") == 0
    step = F.floor(F.log2("total") * 2)
    bins = counts.where(~words | (F.col("total") >= share * occurrences)).groupBy(words.alias("words"), step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect()
    least = {}
    for kind in (True, False):
        held = np.cumsum([r.n for r in bins if r.words == kind])
        steps = [r.step for r in bins if r.words == kind]
        fits = int((held <= most).sum())
        least[kind] = steps[fits - 1] if fits else None, fits == len(steps)
    chosen = F.lit(False)
    for kind, mine in ((True, words & (F.col("total") >= share * occurrences)), (False, ~words)):
        if least[kind][0] is not None:
            chosen = chosen | (mine & (step >= least[kind][0]))
    rows = counts.where(chosen).select("kind", "key", "langs", "counts").toArrow()
    kinds = np.asarray(rows["kind"])
    tables = [Table.of(rows.filter(pa.array(kinds == kind)), below[kind]) for kind in range(LONGEST + 1)]
    return Model(languages, below, tables, least[False][1]), counts


def _requests(points: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Kind and key of what a unit must ask for its words outside the model."""
    kinds, asked = [np.zeros(len(keys), np.uint8)], [keys]
    if not model.whole:
        for n, hashes in enumerate(n_grams(points, start, end)[0], 1):
            hashes = np.unique(hashes[hashes > 0])
            hashes = hashes[model.tables[n].find(hashes) < 0]
            kinds.append(np.full(len(hashes), n, np.uint8))
            asked.append(hashes)
    return np.concatenate(kinds), np.concatenate(asked)


def _blob(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


_ASKED = "unit long, part int, data binary"


def _read(shared, parts: int):
    """For each unit a row with its documents and words outside the model, and one for each partition that it asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        number = TaskContext.get().partitionId() << 32
        docs: list[tuple] = []
        rare: list[tuple] = []
        size = n_docs = 0

        def unit() -> pa.RecordBatch:
            word, doc, n, lengths, points = (np.concatenate(c) for c in zip(*rare, strict=True))
            keys, first, inverse = np.unique(word, return_index=True, return_inverse=True)
            ends = np.cumsum(lengths)
            kinds, asked = _requests(points, (ends - lengths)[first], ends[first], keys, model)
            part = (asked % U64(parts)).astype(np.int32)
            order = np.lexsort((asked, kinds, part))
            kinds, asked, part = kinds[order], asked[order], part[order]
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
            chosen = np.repeat(np.isin(np.arange(len(lengths)), first), lengths)
            doc_id, null, held, sums, some = (np.concatenate(c) for c in zip(*docs, strict=True))
            mine = _blob(doc_id=doc_id, null=null, held=held, sums=sums, some=some, doc=doc, n=n, word=inverse, lengths=lengths[np.sort(first)], points=points[chosen], place=np.argsort(np.argsort(first)), keys=keys, kinds=kinds, asked=asked, part=part)
            rows = [(number, None, mine)] + [(number, int(part[a]), kinds[a:b].tobytes() + asked[a:b].tobytes()) for a, b in zip(cuts, np.append(cuts[1:], len(part))[: len(cuts)], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["unit", "part", "data"])

        for batch in batches:
            for part, data, offsets in chunks(batch, "text", CHUNK):
                points, start, end, doc = letter_words(data, offsets)
                n, k = part.num_rows, len(model.languages)
                sums = np.zeros((n, k))
                keys, first, inverse = np.unique(word_keys(points, start, end), return_index=True, return_inverse=True)
                at = model.tables[0].find(keys)[inverse]
                known = at >= 0
                for i in range(k):
                    sums[:, i] = np.bincount(doc[known], model.tables[0].logs[at[known], i], minlength=n)
                ids = part.column("doc_id")
                docs.append((np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.asarray(part.column("held_out")), sums, np.bincount(doc, minlength=n) > 0))
                pair, where, count = np.unique(doc[~known] * np.int64(len(keys) + 1) + inverse[~known], return_index=True, return_counts=True)
                word = inverse[~known][where]
                begin, stop = start[first[word]], end[first[word]]
                length = stop - begin
                flat = np.repeat(begin - np.cumsum(length) + length, length) + np.arange(length.sum())
                rare.append((keys[word], doc[~known][where] + n_docs, count, length, points[flat]))
                size, n_docs = size + len(data), n_docs + n
                if size >= UNIT:
                    yield unit()
                    number, size, n_docs = number + 1, 0, 0
                    docs, rare = [], []
        if docs:
            yield unit()

    return run


def _answer(key: tuple, asked: pa.Table, counts: pa.Table) -> pa.Table:
    """For each unit that asks a partition: the places of what is known in its question, the languages and the counts."""
    kind, keys = np.asarray(counts["kind"]).astype(np.uint8), np.asarray(counts["key"]).view(U64)
    order = np.lexsort((keys, kind))
    edges = np.searchsorted(kind[order], np.arange(LONGEST + 2))
    langs, numbers = counts["langs"].combine_chunks(), counts["counts"].combine_chunks()
    n = np.asarray(langs.value_lengths()) if len(counts) else np.zeros(0, np.int64)
    begin = np.cumsum(n) - n
    langs, numbers = np.asarray(langs.flatten()), np.asarray(numbers.flatten())
    out = []
    for unit, data in zip(asked["unit"].to_pylist(), asked["data"].to_pylist(), strict=True):
        size = len(data) // 9
        kinds, mine = np.frombuffer(data, np.uint8, size), np.frombuffer(data, U64, size, size)
        places, rows = [], []
        for i in np.unique(kinds).tolist():
            here = np.flatnonzero(kinds == i)
            some = order[edges[i] : edges[i + 1]]
            if len(some):
                at = np.minimum(np.searchsorted(keys[some], mine[here]), len(some) - 1)
                hit = keys[some[at]] == mine[here]
                places.append(here[hit])
                rows.append(some[at[hit]])
        place, row = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, rows))
        each = n[row]
        flat = np.repeat(begin[row] - np.cumsum(each) + each, each) + np.arange(each.sum())
        answer = np.empty(len(flat), _FOUND)
        answer["place"], answer["lang"], answer["n"] = np.repeat(place, each), langs[flat], numbers[flat]
        out.append((unit, key[0].as_py(), answer.tobytes()))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else ([], [], []), (pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["unit", "part", "data"])


_FOUND = np.dtype([("place", "u4"), ("lang", "u4"), ("n", "i8")])


def _scored(shared):
    """Documents of a unit, once its questions are answered."""

    def run(key: tuple, units: pa.Table, answers: pa.Table) -> pa.Table:
        model = shared.value
        x = np.load(io.BytesIO(units["data"][0].as_py()))
        kinds, asked, part = x["kinds"], x["asked"], x["part"]
        found = []
        for p, data in zip(answers["part"].to_pylist(), answers["data"].to_pylist(), strict=True):
            rows = np.frombuffer(data, _FOUND)
            found.append((rows["place"] + np.searchsorted(part, p), rows["lang"], rows["n"]))
        place, lang, n = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        tables = []
        for kind in range(LONGEST + 1):
            mine = kinds[place] == kind
            rows, row = np.unique(place[mine], return_inverse=True)
            tables.append(Table(asked[rows], _logs(len(rows), row, lang[mine], n[mine], model.below[kind])))
        keys, scores = x["keys"], np.zeros((len(x["keys"]), len(model.languages)))
        at = tables[0].find(keys)
        scores[at >= 0] = tables[0].logs[at[at >= 0]]
        unseen = np.flatnonzero(at < 0)
        ends = np.cumsum(x["lengths"])
        order = x["place"][unseen]
        scores[unseen] = _by_grams(x["points"], (ends - x["lengths"])[order], ends[order], model, tables)
        sums, word = x["sums"], x["word"]
        for i in range(sums.shape[1]):
            sums[:, i] += np.bincount(x["doc"], scores[word, i] * x["n"], minlength=len(sums))
        best = sums.argmax(axis=1)  # the first of equal ones
        score = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        names = pa.array(model.languages, pa.string()).take(pa.array(best))
        some = pa.array(x["some"])
        lang_pred = pa.compute.if_else(some, names, pa.scalar("und"))
        return pa.Table.from_arrays([pa.array(x["doc_id"], pa.int64(), mask=x["null"]), pa.array(x["held"]), lang_pred, pa.array(np.where(x["some"], score, 0.0))], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def _by_grams(points: np.ndarray, start: np.ndarray, end: np.ndarray, model: Model, tables: list[Table]) -> np.ndarray:
    """Scores of unseen words by the longest known n-gram at each place. Places overlap: a word weighs as two of them."""
    grams, word = n_grams(points, start, end)
    open_, sums, count = np.ones(len(word), bool), np.zeros((len(start), len(model.languages))), np.zeros(len(start))
    for n in range(LONGEST, 0, -1):
        at = np.flatnonzero(open_ & (grams[n - 1] > 0))
        for table in (model.tables[n], tables[n]):
            row = table.find(grams[n - 1][at])
            hit = row >= 0
            for i in range(sums.shape[1]):
                sums[:, i] += np.bincount(word[at[hit]], table.logs[row[hit], i], minlength=len(sums))
            count += np.bincount(word[at[hit]], minlength=len(sums))
            open_[at[hit]] = False
            at = at[~hit]
    return sums * (2 / np.maximum(count, 2))[:, None]


def identify(spark: SparkSession, docs: DataFrame, share: float = SHARE, size: int = MODEL_BYTES) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): a row for each row of ``docs``.

    Learns from texts and non-null ``lang`` of rows whose crc32(doc_id as text) mod 4 is not 2. A text without letters, empty
    or null is ``und`` with score 0, as is every text if there is nothing to learn from. A null doc_id counts as held out.
    Ties go to the language that sorts first. Repeated rows teach each time and get equal results. Other columns are ignored.
    An empty table gives an empty result. ``share`` and ``size`` say what is broadcast and change no result.
    """
    scratch = Scratch(spark, "language")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.withColumn("held_out", F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(True)))
    model, counts = train(spark, rows.where("NOT held_out"), scratch, share, size)
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)
    read = scratch.cut(rows.select("doc_id", "held_out", "text").mapInArrow(_read(shared, partitions(spark)), _ASKED))
    table = counts if not model.whole else counts.where("kind = 0")
    table = table.select("part", "kind", "key", "langs", "counts")
    asked = read.where("part IS NOT NULL")
    answers = asked.groupBy("part").cogroup(table.groupBy("part")).applyInArrow(_answer, _ASKED)
    units = read.where("part IS NULL")
    return units.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(_scored(shared), "doc_id long, held_out boolean, lang_pred string, score double")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
