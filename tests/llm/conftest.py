import random

import pytest


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def documents(spark):
    """Copies, near copies, repeats, odd blanks, nulls, wordless and long texts, a repeated row and a clashing extra column."""
    rng = random.Random(3)
    base = [prose(rng, n) for n in (1, 2, 3, 4, 5, 9, 10, 34, 35, 36, 60, 200, 400)]
    texts = [*base, base[11], base[11].upper(), None, "", " \t\n ", "x" * 20_000, "a b " * 300, prose(rng, 6000)]
    for share in (0.01, 0.03, 0.05, 0.1):
        words = base[12].split()
        texts += [" ".join(w if rng.random() > share else "edited" for w in words) for _ in range(4)]
    passage = prose(rng, 50)
    texts += [f"{prose(rng, 40)}\n{passage}　é {prose(rng, 30)}" for _ in range(4)]
    texts += [f"{passage} {passage}", base[12] + " tail", "Ünï çödé   Straße " * 5]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}", len(t or ""), i) for i, t in enumerate(texts)]
    rows += [rows[12], (None, base[10], None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, node long"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture
def empty(documents):
    return documents.limit(0)
