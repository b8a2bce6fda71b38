from __future__ import annotations

import random

import pytest

from registrum.llm.common import ship_package


@pytest.fixture(scope="session", autouse=True)
def package_on_executors(spark):
    ship_package(spark)


def texts(seed: int, n: int) -> list[str | None]:
    """Texts with copies, edited copies, shared passages, blanks, nulls and odd characters."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("al", "be", "ga", "dé", "ep", "ze") for b in ("ron", "tis", "m,", "x.", "Ö", "9")]
    bases = [[rng.choice(words) for _ in range(rng.choice([1, 4, 12, 40, 90]))] for _ in range(10)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    out: list[str | None] = [None, "", "   \n\t ", "\0" * 60, "a" * 300, "a" * 120]
    while len(out) < n:
        w = list(rng.choice(bases)) if rng.random() < 0.7 else [rng.choice(words) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            if w:
                w[rng.randrange(len(w))] = rng.choice(words)
        t = " ".join(w)
        if rng.random() < 0.2:
            t = f"{t}\n{passage}"
        out.append(t.upper() if rng.random() < 0.1 else t)
    return out[:n]


@pytest.fixture
def odd_documents(spark):
    """Documents with nulls in any column, repeated rows and ids, a very long text, and extra columns
    whose names clash with the operators' own."""
    rows = [(i if i % 11 else None, t, "en" if i % 7 else None, "s", len(t or ""), i, f"b{i}") for i, t in enumerate(texts(5, 60))]
    rows += rows[5:9] + [(8, "another text of document eight " * 9, "fr", None, 3, 1, "x"), (500, "long word " * 30_000, "en", "s", 9, 2, "y")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score long, key string"
    return spark.createDataFrame(rows, schema), rows


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
