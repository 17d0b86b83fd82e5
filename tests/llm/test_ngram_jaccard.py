import random
import re

import numpy as np

import lexalign.llm.ngram_jaccard
import lexalign.llm.storage
from lexalign.llm.graph import components
from lexalign.llm.ngram_jaccard import Join, Sets, deduplicate, near_duplicates
from lexalign.llm.storage import Scratch


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent):
    sets = [shingles(r.text, k) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            low[find(i)] = min(low.get(find(i), r.doc_id), r.doc_id)
    return sorted(((r.doc_id, len(sets[i]), low.get(find(i)) if sets[i] else r.doc_id) for i, r in enumerate(rows)), key=str)


def test_against_brute_force(spark, documents):
    rows = documents.collect()
    for k, percent in ((4, 85), (2, 60)):
        assert sorted(map(tuple, near_duplicates(spark, documents, k, percent).collect()), key=str) == brute(rows, k, percent)


def test_chains_and_hot_groups(spark):
    """A third of all rows are near copies, some linked only through others; all share a frequent passage."""
    rng = random.Random(9)
    common = " ".join(f"c{i}" for i in range(30))
    words = [f"v{i}" for i in range(120)]
    rows, now = [], words
    for i in range(150):
        now = list(now)
        now[rng.randrange(120)] = f"n{i}"
        rows.append((1000 - i, " ".join(now)))
    rows += [(2000 + i, common + " " + " ".join(f"r{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_duplicates(spark, docs, 4, 85).collect()), key=str) == brute(docs.collect(), 4, 85)


def test_shuffled_joins_and_small_blocks(spark, documents, monkeypatch):
    """The ways beyond the limits."""
    monkeypatch.setattr(lexalign.llm.storage, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lexalign.llm.ngram_jaccard, "BLOCK", 2)
    assert sorted(map(tuple, near_duplicates(spark, documents, 4, 85).collect()), key=str) == brute(documents.collect(), 4, 85)


def test_clashing_identities_are_told_apart():
    texts = [b"a b c d", b"e f g h", b"a b c d", b"e f g h i"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    node = Sets(4).of(data, offsets)[3]
    assert node[0] == node[2] and len(set(node.tolist())) == 3
    again = Sets(4, node[:1]).of(data, offsets)[3]
    assert again[0] == again[2] != node[0] and (again[[1, 3]] == node[[1, 3]]).all()


def test_settled_pairs_connect_what_all_links_connect(spark):
    """A dense graph of candidates of which some are links: rounds first, the rest at once."""
    rng = random.Random(21)
    base = [f"b{i}" for i in range(80)]
    rows = [(i, " ".join(w if rng.random() > 0.02 * (i % 4) else f"x{rng.randrange(10**6)}" for w in base)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = Join(spark, docs, 2, 85)
    nodes = [r.node for r in join.holders.collect()]
    every = [(max(a, b), min(a, b)) for i, a in enumerate(nodes) for b in nodes[:i]]
    pairs = join.scratch.cut(spark.createDataFrame(every, "center long, member long"))
    links = join._settled(pairs)
    assert len(links) > 1
    whole = links[0]
    for x in links[1:]:
        whole = whole.unionByName(x)
    known = dict(components(spark, whole, join.scratch).collect())
    doc = {r.node: r.doc_id for r in join.holders.collect()}
    low = {}
    for n in nodes:
        low[known.get(n, n)] = min(low.get(known.get(n, n), doc[n]), doc[n])
    want = {i: c for i, _, c in brute(docs.collect(), 2, 85)}
    assert {doc[n]: low[known.get(n, n)] for n in nodes} == {doc[n]: want[doc[n]] for n in nodes}


def test_dense_candidates_make_no_pairs(spark, monkeypatch):
    """Near copies that are candidates all with all, some of them links: rows grow with the group, not with its square."""
    rng = random.Random(31)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(160):
        words = list(base)
        for at in rng.sample(range(150), 1 if i % 20 == 0 else 2 + i % 2):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs, tasks, settled, met = [], [], Join._settled, Join._met
    monkeypatch.setattr(Join, "_settled", lambda self, p: pairs.append(p.count()) or settled(self, p))
    monkeypatch.setattr(Join, "_met", lambda self, r: tasks.append(r.count()) or met(self, r))
    monkeypatch.setattr(lexalign.llm.ngram_jaccard, "BLOCK", 64)
    assert sorted(map(tuple, near_duplicates(spark, docs, 4, 85).collect()), key=str) == brute(docs.collect(), 4, 85)
    assert sum(pairs) < 160 * 20
    assert max(tasks) < 160 * 30


def test_boilerplate_and_a_very_long_text(spark):
    """Documents that share most of a template, but not enough; a chain of passages; a text of many shingles beside them."""
    rng = random.Random(12)
    template = [f"t{i}" for i in range(100)]
    rows = [(i, " ".join([*template, *(f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 60)))])) for i in range(120)]
    passages = [" ".join(f"p{j}q{i}" for i in range(40)) for j in range(30)]
    rows += [(500 + j, f"{passages[j]} {passages[j + 1]}") for j in range(29)]
    long = [f"l{rng.randrange(10**7)}" for _ in range(60_000)]
    rows += [(900, " ".join(long)), (901, " ".join([*long[:59_000], "end"])), (902, " ".join(long[20_000:])), (903, " ".join([*long[:30_000], *template]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_duplicates(spark, docs, 4, 85).collect()), key=str) == brute(docs.collect(), 4, 85)


def test_deduplicate_keeps_one_of_each_group(spark, documents):
    kept = deduplicate(spark, documents)
    assert kept.columns == documents.columns
    rows = documents.collect()
    want = sorted({i for i, n, c in brute(rows, 5, 80) if i is not None and i == c})
    got = kept.collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == want
    assert not [r for r in got if r.doc_id is None]  # a copy of another document


def test_deduplicate_tells_rows_of_one_id_apart(spark):
    rng = random.Random(4)
    a, b, c = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(60)) for x in "abc")
    rows = [(5, a, 1), (7, a + " x", 2), (7, b, 3), (7, c, 4), (7, c, 4), (9, None, 5), (9, None, 5), (None, b + " y", 6)]
    kept = deduplicate(spark, spark.createDataFrame(rows, "doc_id long, text string, `key` long"))
    assert kept.columns == ["doc_id", "text", "key"]
    assert sorted(r.key for r in kept.collect()) == [1, 3, 4, 5, 5]


def test_empty(spark, empty):
    assert near_duplicates(spark, empty).collect() == []
    assert deduplicate(spark, empty).collect() == []


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(500, 500), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    for few in (10**6, 0):
        got = dict(components(spark, spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"), few).collect())
        assert got == {x: find(x) for x in list(root)}
