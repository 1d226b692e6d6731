import random

import pytest
from pyspark.sql import types as T

WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "né") for b in ("ra", "tu", "x") for c in ("", "s", "n", "re")]

#: Documents with columns that share names with what the operators add.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("Size", T.StringType()),
        T.StructField("_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("_score", T.StringType()),
    ]
)


def prose(rng, n):
    out = []
    for i in range(n):
        word = rng.choice(WORDS) + str(rng.randrange(40))
        out.append(word.capitalize() if i % 9 == 0 else word)
        if i % 13 == 12:
            out.append(".\n" if rng.random() < 0.5 else ", ")
    return " ".join(out)


def make_rows(seed=3):
    """Texts with copies, near copies, shared passages and lines, junk, and odd values."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.choice([1, 3, 8, 30, 90, 150])) for _ in range(40)]
    passage, line = prose(rng, 60).replace("\n", " "), "A line that many documents share"
    for i in range(0, 20, 2):
        texts[i] = f"{texts[i]}\n{passage}\n{texts[i][:40]}"
    for i in range(0, 24, 3):
        texts[i] = f"  {line.upper() if i % 2 else line} \t\n{texts[i]}\nshort\n{texts[i + 1]}"
    base = prose(rng, 200).split(" ")
    for i in range(8):  # near copies in a chain
        copy = list(base)
        for j in range(i):
            copy[20 * j + 5] = f"changed{j}"
        texts.append(" ".join(copy))
    texts += [texts[5]] * 6 + [texts[5].upper(), texts[5] + "\n"]
    texts += [None, "", " ", "\n\n", "\t\x0b one\r\n", "ß É é́ 　 x\x85y \x1c z", "%% ## || <a> & $5", "!! ?"]
    texts += ["repeat the same words again " * 30, "x" * 5000, prose(rng, 20_000)]
    rows = [
        (i, t, rng.choice(["en", "de", None]), "s", len(t or ""), 7, "big", "id", "k", "0.1")
        for i, t in enumerate(texts)
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows in five partitions, out of order."""
    mixed = list(rows)
    random.Random(1).shuffle(mixed)
    return spark.createDataFrame(mixed, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def odd(spark, rows):
    """The rows, with some repeated and some without an id."""
    mixed = [*rows, *rows[5:9], *[(None, *r[1:]) for r in rows[:6]]]
    return spark.createDataFrame(mixed, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
