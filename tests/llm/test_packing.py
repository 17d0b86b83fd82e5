import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexalign.llm import tokens
from lexalign.llm.packing import differencing, op4_packing, pack, pack_documents
from lexalign.llm.tokens import encoder

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def encoded(texts):
    raw = [t.encode() for t in texts]
    ids, at = encoder().encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


def test_ids(tokenizer):
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'ll", "'re", "a", "B", "é", "1", "²", "$", "_", "　", "漢", "the", " 'd", "'v", "e", "l", "😀", "\x00", "<|endoftext|>", "\U000e0fff"]
    texts = ["", "don't they've x'd  've", "x <|endoftext|> y", "<|endoftext|><|endoftext|>", " a  <|endoftext|>  b", "<|endof", "text|> a", *("".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(3000))]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoded(texts) == want
    assert [encoded([t])[0] for t in texts[:300]] == want[:300]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60), st.integers(8, 100), st.integers(1, 8))
def test_pack(sizes, capacity, most):
    windows = pack(sizes, capacity, most)
    assert len(windows) >= -(-sum(sizes) // capacity)
    got = defaultdict(list)
    for w in windows:
        assert 0 < sum(n for _, _, n in w) <= capacity
        for i, start, n in w:
            assert 0 < n <= most
            got[i].append((start, n))
    for i, size in enumerate(sizes):
        at = 0
        for start, n in sorted(got[i]):
            assert start == at
            at += n
        assert at == size


def least_maximum(sizes, k):
    """Over all partitions into k windows the least size of the fullest one."""
    best = sum(sizes)

    def place(i, sums):
        nonlocal best
        if max(sums) >= best:
            return
        if i == len(sizes):
            best = max(sums)
            return
        for j in {x: j for j, x in enumerate(sums)}.values():  # windows of one size are alike
            place(i + 1, sums[:j] + [sums[j] + sizes[i]] + sums[j + 1 :])

    place(0, [0] * k)
    return best


def test_differencing_against_every_partition():
    """Never better than the best partition, and close to it; two windows of the textbook's numbers differ by two."""
    rng = random.Random(4)
    excess = []
    for _ in range(150):
        sizes, k = [rng.randrange(1, 60) for _ in range(rng.randrange(2, 9))], rng.randrange(2, 5)
        windows = differencing(np.array(sizes), k)
        assert sorted(i for w in windows for i in w) == list(range(len(sizes))) and len(windows) <= k
        most = max(sum(sizes[i] for i in w) for w in windows)
        best = least_maximum(sizes, k)
        assert best <= most <= best * 4 / 3
        excess.append(most / best)
    assert sum(excess) / len(excess) < 1.03
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in differencing(np.array([8, 7, 6, 5, 4]), 2))
    assert sums == [14, 16]


def test_count_rises_where_the_capacity_is_exceeded():
    windows = pack([6, 6, 6], 10)  # two windows would hold 18 of 20, but not whole sizes
    assert sorted(w for w in windows) == [[(0, 0, 6)], [(1, 0, 6)], [(2, 0, 6)]]


def test_without_cuts_windows_are_near_equal():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 100, 400)
    windows = pack(sizes, 1000)
    sums = [sum(n for _, _, n in w) for w in windows]
    assert sorted(i for w in windows for i, _, _ in w) == list(range(400))
    assert max(sums) <= 1000 and max(sums) - min(sums) <= 20
    assert sorted(i for w in differencing(sizes, 7) for i in w) == list(range(400))


def test_a_text_of_more_different_pieces_than_the_cache_holds(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 50)
    text = " ".join(f"x{i}y" for i in range(400))
    assert encoded([text, "again x1y", text]) == [tokenizer.encode(t, add_special_tokens=False).ids for t in (text, "again x1y", text)]


def test_documents(spark, documents, tokenizer):
    rows = pack_documents(spark, documents, capacity=256, group=10).collect()
    want = sorted(tuple([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in documents.collect())
    windows, by = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append(r)
        by[r.doc_id, r.doc_tokens].append(r)
        assert len(r.ids) == 4 * r.length
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    assert sum(r.length for r in rows) == sum(map(len, want))
    single = {k: v for k, v in by.items() if sum(r.length for r in v) == k[1]}
    whole = sorted(tuple(np.frombuffer(b"".join(r.ids for r in sorted(v, key=lambda r: r.start)), "<u4").tolist()) for v in single.values())
    assert len(single) >= len(by) - 2 and set(whole) <= set(want)


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pack_documents(spark, docs).collect()
    assert sum(r.length for r in rows) > 0.99 * 1024 * len({r.sequence_id for r in rows})


def test_query_has_the_digests_of_the_ids(spark):
    sf = "/root/testdata/sf0.001"
    whole = pack_documents(spark, spark.read.parquet(f"{sf}/documents.parquet")).collect()
    want = sorted((r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens) for r in whole)
    assert sorted(tuple(r)[:5] for r in op4_packing(spark, sf).collect()) == want


def test_empty(spark, empty):
    assert pack_documents(spark, empty).collect() == []
