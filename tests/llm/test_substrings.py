import hashlib
import re
from collections import Counter

import lexalign.llm.storage
from lexalign.llm.storage import Scratch
from lexalign.llm.substrings import anchors, digests, keyed, parse, parsed, remove_duplicates


def brute(rows, length):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", r.text or "") for r in rows]
    seen = Counter(tuple(w[i : i + length]) for w in texts for i in range(len(w) - length + 1))
    out = []
    for r, w in zip(rows, texts, strict=True):
        gone = {i + j for i in range(len(w) - length + 1) if seen[tuple(w[i : i + length])] > 1 for j in range(length)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r.doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(spark, documents):
    rows = documents.collect()
    for length, gram in ((35, 16), (5, 3)):
        assert sorted(map(tuple, digests(spark, documents, length, gram).collect()), key=str) == brute(rows, length)


def test_partitions_do_not_matter(spark, documents):
    one = sorted(map(tuple, digests(spark, documents.coalesce(1)).collect()), key=str)
    assert one == sorted(map(tuple, digests(spark, documents.repartition(11)).collect()), key=str)


def test_kept_text(spark):
    docs = spark.createDataFrame([(1, "a b c  d e"), (2, "x a b c y"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in remove_duplicates(spark, docs, 3, 2).collect()}
    assert got == {1: "d e", 2: "x y", 3: ""}


def test_shuffled_joins_give_the_same(spark, documents, monkeypatch):
    monkeypatch.setattr(lexalign.llm.storage, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, digests(spark, documents).collect()), key=str) == brute(documents.collect(), 35)


def test_factors_stand_at_their_sources(spark, documents):
    length = 12
    docs = keyed(documents)
    texts = {r._key: re.findall(r"[^\x20\x09-\x0D]+", r.text or "") for r in docs.collect()}
    found = {r._key: r.factors for r in parsed(spark, docs, Scratch(spark, "test"), length, 6).collect()}
    count = Counter(tuple(w[i : i + length]) for r in docs.collect() for w in [texts[r._key]] for i in range(len(w) - length + 1))
    assert sum(map(len, found.values())) > 20
    for key, words in texts.items():
        covered = set()
        for f in found.get(key, []):
            n = f.windows + length - 1
            assert words[f.start : f.start + n] == texts[f.source][f.at : f.at + n] and len(words) >= f.start + n
            assert covered.isdisjoint(range(f.start, f.start + f.windows))
            covered |= set(range(f.start, f.start + f.windows))
        assert covered == {i for i in range(len(words) - length + 1) if count[tuple(words[i : i + length])] > 1}


def test_parse_takes_the_longest():
    marks = [(0, 4, 7, 10), (4, 3, 7, 14), (2, 4, 9, 0), (6, 5, 9, 4), (20, 1, 7, 0)]
    assert parse(marks) == [(0, 7, 7, 10), (7, 4, 9, 5), (20, 1, 7, 0)]


def test_empty(spark, empty):
    assert digests(spark, empty).collect() == []


def test_anchor_is_leftmost_smallest():
    import numpy as np

    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 6, 200).astype(np.uint64)
    at = np.concatenate([np.arange(90), np.arange(100, 210)])
    starts, low = anchors(hashes, at, 7)
    want = [(i, i + int(np.argmin(hashes[i : i + 7]))) for i in range(194) if at[i + 6] - at[i] == 6]
    assert list(zip(starts.tolist(), low.tolist(), strict=True)) == want
