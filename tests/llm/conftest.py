import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text, lang, source, n_chars): nulls, empty and very long
    texts, exact copies, near copies, shared passages, repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 6))) for _ in range(400)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage = text(60)
    base = text(150)
    out = []
    for i in range(60):
        t = text(rng.randint(1, 90))
        if i % 6 == 0:
            t = f"{t}\n{passage}\t {text(10)}"
        if i % 10 == 3:
            near = base.split()
            near[rng.randrange(150)] = "changed"
            t = " ".join(near)
        if i % 15 == 4:
            t = base
        out.append((i * 3, t, "en", f"s{i % 4}", len(t)))
    out += [(500, None, None, None, None), (501, "", "en", "s1", 0), (502, " \t\n ", "en", None, 4),
            (503, "Ünï ÇÖDE one 漢字 😀 " * 3, "xx", "s9", 1), (504, text(40_000), "en", "s0", 1),
            (505, f"{passage} {passage}", "en", "s0", 1), (None, text(40), "en", "s0", 1), (None, text(40), "en", "s2", 1)]
    return out + [out[0], out[0], out[12]]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
