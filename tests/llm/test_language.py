import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from lexalign.llm.language import identify, n_grams, op6_language
from lexalign.llm.words import ranges_hash

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = op6_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_unseen_words_back_off(spark):
    rows = [(i, t, lang, i) for i, (t, lang) in enumerate([("straße größe mädchen schön", "de"), ("hello there my friend the", "en")] * 20)]
    rows += [(1000 + i, t, None, 0) for i, t in enumerate(["schönheit größer", "friendly others", "12 34 ...", "", None, "— …"])]
    got = {r.doc_id: r for r in identify(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, key long")).collect()}
    assert [got[1000 + i].lang_pred for i in range(6)] == ["de", "en", "und", "und", "und", "und"]
    assert got[1002].score == 0


def test_odd_tables(spark, documents, empty):
    rows = identify(spark, documents).collect()
    assert len(rows) == documents.count() and {r.lang_pred for r in rows} <= {"en", "und"}
    assert identify(spark, empty).collect() == []
    assert {r.lang_pred for r in identify(spark, documents.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()} == {"und"}


def test_n_grams_of_padded_words():
    text = "abc de"
    points = np.array([ord(c) for c in text], np.uint32)
    grams, word = n_grams(points, np.array([0, 4]), np.array([3, 6]))
    flat = np.array([1, 97, 98, 99, 1, 1, 100, 101, 1], np.uint64)
    want = ranges_hash(flat, np.array([0, 1, 5]), np.array([4, 5, 9])) | np.uint64(1)
    assert grams[3][grams[3] > 0].tolist() == want.tolist()
    assert (grams[0] > 0).sum() == 5 and word.tolist() == [0] * 5 + [1] * 4


def brute(rows, languages=("de", "en")):
    """Word-first backoff with dictionaries, as the module's docstring has it."""
    words = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    grams = lambda w: [[f"\1{w}\1"[i : i + n] for n in range(1, 5) if i + n <= len(w) + 2 and (n > 1 or 0 < i <= len(w))] for i in range(len(w) + 2)]
    counts = [Counter() for _ in range(5)]
    for i, text, lang in rows:
        if lang is not None and i is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            for w in words(text):
                counts[0][w, lang] += 1
                for place in grams(w):
                    for g in place:
                        counts[len(g)][g, lang] += 1
    known = [{x for x, _ in c} for c in counts]
    total = [{lang: sum(n for (_, a), n in c.items() if a == lang) + 0.1 * (len(known[k]) + 1) for lang in languages} for k, c in enumerate(counts)]
    log = lambda k, x, lang: math.log((counts[k][x, lang] + 0.1) / total[k][lang])

    def score(w, lang):
        if w in known[0]:
            return log(0, w, lang)
        hits = [log(len(g), g, lang) for place in grams(w) for g in [next((g for g in reversed(place) if g in known[len(g)]), None)] if g]
        return sum(hits) * 2 / max(2, len(hits))

    out = []
    for i, text, _ in rows:
        sums = [sum(score(w, lang) for w in words(text)) for lang in languages]
        best = max(range(len(languages)), key=lambda j: (sums[j], -j))
        some = bool(words(text))
        out.append((i, languages[best] if some else "und", 1 / sum(math.exp(x - sums[best]) for x in sums) if some else 0.0))
    return out


def test_against_brute_force(spark):
    """Whatever is broadcast: all, some or nothing."""
    rng = random.Random(6)
    stock = {"de": ["straße", "größe", "mädchen", "schön", "und", "der"], "en": ["the", "of", "friend", "there", "hello", "street"]}
    rows = [(i, " ".join([*rng.choices(stock[lang], k=5), *("".join(rng.choice("aeioust") for _ in range(rng.randrange(1, 6))) for _ in range(3))]), lang) for i in range(120) for lang in [rng.choice(["de", "en"])]]
    rows += [(500 + i, t, None) for i, t in enumerate(["schönheit größer", "streets friendly", "Straße", "zzz qqq", "x", "12 ...", "", None, "und the"])]
    rows += [(700, "the und", "en"), (700, "the und", "en"), (None, "friend", "en")]
    want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for share, size in ((0.0, 1 << 20), (0.02, 24 * 40), (2.0, 0)):
        got = identify(spark, docs, share, size).collect()
        assert len(got) == len(want)
        by = {r.doc_id: r for r in got}
        for i, lang, score in want:
            assert abs(by[i].score - score) < 1e-9, (i, share)
            assert by[i].lang_pred == lang


def test_units_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in identify(spark, docs).collect())
    again = sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in identify(spark, docs.repartition(5), 1e-3, 1 << 12).collect())
    assert whole == again and len(whole) == docs.count()
