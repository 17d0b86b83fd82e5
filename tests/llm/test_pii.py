import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexalign.llm.pii import KINDS, Field, apart, emails, examples, find_pii, luhn, mask_pii, patterns, runs, shape, trained

FORMS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    out = []
    for kind, form in enumerate(FORMS):
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (True, kind == 1 and all(int(p) <= 255 for p in m[0].split(".")), 14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15)[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.@+-1234 ()é\n", max_size=40))
def test_patterns(text):
    assert patterns(text) == brute(text)


def test_patterns_on_numbers():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(["4111111111111111", "411111111111111 1", "1.2.3.4", ".5", "256.1.1.1", "0255.1.1.1", "+1 (017) 555-7713", "a@b.c", "@", " ", "-", "x", "+", "é", "12345678901234567890"]) for _ in range(rng.randrange(8)))
        assert patterns(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000 + "x", "+1" + "(" * 300_000, "a@" * 100_000, "1." * 200_000):
        assert len(patterns(text)) < 100_001
    assert list(emails("x" * 300_000 + "@y.z")) == [(0, 300_004)]


@pytest.fixture(scope="module")
def field():
    return trained()


def test_field_on_held_out_examples(field):
    right = found = there = 0
    for words, states in examples(400, seed=99):
        for a, b in runs(words):
            path = field.viterbi([[shape(words[i], words[i - 1] if i else None, words[i + 1] if i + 1 < len(words) else None) for i in range(a, b)]])[0]
            there += sum(s > 0 for s in states[a:b])
            found += sum(p > 0 for p in path)
            right += sum(p == s > 0 for p, s in zip(path, states[a:b], strict=True))
    assert right >= 0.95 * there and right >= 0.95 * found


def test_viterbi_is_the_best_path(field):
    rng = np.random.default_rng(4)
    noisy = Field(field.emit + rng.standard_normal(field.emit.shape) * 3, field.step)
    moves = noisy.steps()
    sequences = [[rng.choice(len(field.emit), 5, replace=False).tolist() for _ in range(rng.integers(1, 5))] for _ in range(30)]
    n = len(moves)
    for got, s in zip(noisy.viterbi(sequences), sequences, strict=True):
        def score(path, s=s):
            total = moves[0, path[0]] + moves[path[-1], 0] + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False))
            return total + sum(noisy.emit[hold, p].sum() for hold, p in zip(s, path, strict=True))

        best = max(score(np.unravel_index(i, (n,) * len(s))) for i in range(n ** len(s))) if len(s) < 4 else score(got)
        assert abs(score(got) - best) < 1e-6


def test_documents(spark, documents):
    rng = random.Random(1)
    texts = ["mail ann.lee@mail.example.com now", "é call (017) 555-7713 or +1 (017) 555-7713.", "ip 10.0.0.1, 4111 1111 1111 1111", "token = \"a94a8fe5ccb19ba61c4c0873d391e987982fbbd3\" in 1998", None, "", "1" * 50_000, " ".join(str(rng.randrange(10**6)) for _ in range(3000))]
    table = documents.drop("text").limit(0).selectExpr("doc_id", "cast(null as string) text").union(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: r for r in find_pii(spark, table).collect()}
    for i, text in enumerate(texts):
        base = brute(text or "")
        listed = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(k == x for _, x, _ in base) for k in range(4)]
        assert set(filter(None, listed.split(","))) <= set(got[i].spans.split(","))
    assert got[1].spans == "phone:7:21,phone:25:42"  # the first by its shape alone
    assert got[3].spans == ""
    masked = dict(mask_pii(spark, table).collect())
    assert masked[0] == "mail <EMAIL> now" and masked[1] == "é call <PHONE> or <PHONE>." and masked[4] is None and masked[3] == texts[3]


def test_clean_prose_stays(spark, documents, empty):
    assert all(not r.spans for r in find_pii(spark, documents).collect())
    assert find_pii(spark, empty).collect() == []
    assert mask_pii(spark, documents).columns == documents.columns


def test_long_runs_of_digits_do_not_stop_it():
    assert patterns("x " + "0" * 5000 + ".1.1.1 y") == [(2, 1, 5008)]
    assert patterns("x " + "1" * 5000 + ".1.1.1 " + "0." * 9000) == patterns("x " + "1" * 5000 + ".1.1.1 " + "0." * 9000)


def test_apart():
    assert apart([(0, 0, 3), (4, 1, 9), (20, 2, 30)], [(3, 0, 5), (10, 1, 40)]) == [(0, 0, 3)]
    assert apart([(0, 0, 3), (5, 1, 9)], []) == [(0, 0, 3), (5, 1, 9)]
