"""Schemas and texts of the tests."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType())])
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", LongType()), StructField("toxic", LongType())])
BENCH = StructType([StructField("item_id", StringType()), StructField("text", StringType())])


def words(rng, n, size=400):
    return [f"w{int(rng.paretovariate(0.7)) % size}" for _ in range(n)]


def varied_texts(seed=3):
    """Texts with copies, near copies, shared lines, empties, nulls and one very long text."""
    rng = random.Random(seed)
    shared = [" ".join(words(rng, n)) for n in (6, 12, 30, 70)]
    out = [None, "", "  \n\t ", "one", "One", "a b c d", "x" * 30_000, "émile ÀB ñ 你好 😀 a\x0bb", "\n\nmany\n\nbreaks\n"]
    for i in range(60):
        lines = [" ".join(words(rng, rng.randint(1, 60))) for _ in range(rng.randint(1, 4))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), rng.choice(shared))
        out.append("\n".join(lines))
    base = " ".join(words(rng, 120))
    for i in range(25):
        copy = base.split()
        for _ in range(i % 7):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(50)}"
        out.append(" ".join(copy))
    out += [base, base, base.upper()]
    out.append(" ".join(words(rng, 20_000, 3000)))
    return out
