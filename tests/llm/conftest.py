import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot int, k string, h string, size double, row string"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def vocabulary(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 9))) for _ in range(n)]


def made(seed=1, n=60):
    """Texts with copies, near copies, chains of near copies, shared passages, repeats inside, very short, empty and null ones."""
    rng = random.Random(seed)
    words = {"en": vocabulary(10), "de": [w + "ö" for w in vocabulary(20)]}
    passage = " ".join(rng.choice(words["en"]) for _ in range(70))
    out = []
    for i in range(n):
        lang = "en" if i % 3 else "de"
        out.append((" ".join(rng.choice(words[lang]) for _ in range(rng.randint(60, 200))), lang))
    for i in range(0, 12, 2):  # near copies, one word in so many changed, and chains of them
        w = out[i][0].split()
        for step in range(1, 4):
            w = list(w)
            w[(step * 29) % len(w)] = f"new{i}x{step}"
            out.append((" ".join(w), out[i][1]))
    out += [out[5], out[5], out[7], (out[8][0].upper(), out[8][1])]
    for i in range(12):
        a, b = out[20 + i][0][:300], out[30 + i][0][:200]
        out.append((f"{a} {passage}\n{b}", "en"))
    line = " ".join(rng.choice(words["en"]) for _ in range(12))
    out += [("\n".join([line] * 8), "en"), ("one two", "en"), ("one two", "en"), ("One\ttwo ", "en"), ("", "en"), ("", None), (None, "en"), (" \n\t", "de"), ("word " * 300, "en"), ("# $ % & | < > *", "en"), ("ﬁne Straße  É", "de"), ("fine strasse é", "de")]
    out.append((" ".join(rng.choice(words["de"]) for _ in range(30_000)), "de"))
    return out


@pytest.fixture(scope="session")
def rows():
    out = [(i * 3 + 1, t, lang, None if i % 17 == 3 else f"src{min(i % 11, 4)}", len(t or ""), 1, "x", "y", 0.5, "r") for i, (t, lang) in enumerate(made())]
    out.append(out[4])  # a repeated row
    random.Random(3).shuffle(out)
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
