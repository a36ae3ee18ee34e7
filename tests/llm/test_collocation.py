"""Phrase collocations against plain Python and SQL."""

import random
import re
from collections import Counter

import pytest

from compare import difference, duck
from llm_samples import DOCS, words
from wardlake.llm import collocation

SF = "/root/testdata/sf0.01"


def plain_phrases(rows, least, best):
    """Every n-gram of every piece in one dictionary per language."""
    counts, out = {}, []
    for lang, text in rows:
        own = counts.setdefault(lang if lang is not None else "und", Counter())
        lower = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).decode()
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            own.update(tuple(w[i:i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
    for lang, own in counts.items():
        n = sum(f for p, f in own.items() if len(p) == 1)
        candidates = {p: f for p, f in own.items() if len(p) > 1 and f >= least}
        kept = []
        for p, a in candidates.items():
            if any(100 * f >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, f in candidates.items() if len(q) > len(p)):
                continue
            score, _, l, r = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:best], 1)]
    return sorted(out)


def varied(seed=5):
    rng = random.Random(seed)
    fixed = ["new york city", "by and large", "Ünder ÀB ñ 你好", "to be or not to be", "a a a a a a"]
    rows = [(None, None), ("en", None), (None, ""), ("", "x y x y x y."), ("en", " \t.,;\n\r\x0b\x0c!?:")]
    for i in range(500):
        parts = []
        for _ in range(rng.randint(1, 6)):
            parts += words(rng, rng.randint(0, 12), 60)
            if rng.random() < 0.6:
                parts.append(rng.choice(fixed))
            parts.append(rng.choice([".", ",", "\n", ";", "\t", "! ", " ? ", "\r\n", ""]))
        text = " ".join(parts)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text.upper() if i % 9 == 0 else text))
    rows += [rows[20]] * 30
    rows.append(("en", " ".join(words(rng, 30_000, 200)) + " new york"))
    return rows


@pytest.mark.parametrize("head,side,dense,flush,held", [(2048, 256, 4096, 1 << 20, 1 << 20), (32, 8, 4, 3000, 500), (4, 2, 1, 500, 1)])
def test_phrases_equal_plain_ones(spark, monkeypatch, head, side, dense, flush, held):
    for name, value in (("HEAD", head), ("SIDE", side), ("DENSE", dense), ("FLUSH", flush), ("HELD", held)):
        monkeypatch.setattr(collocation, name, value)
    rows = varied()
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], DOCS).selectExpr(
        "*", "'x' AS word", "'y' AS phrase", "1 AS name", "2 AS f").repartition(3)
    out = collocation.mine(docs, least=5, best=40)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(tuple(r) for r in out.collect())
    assert got == plain_phrases(rows, 5, 40) and len(got) > 60


def test_phrases_of_nothing(spark):
    assert collocation.mine(spark.createDataFrame([], DOCS)).count() == 0
    assert collocation.mine(spark.createDataFrame([(1, None, None, "s", 0), (2, "one two", "en", "s", 0)], DOCS)).count() == 0


def test_scores_beyond_64_bits(spark):
    row = spark.sql(f"SELECT CAST({collocation.SCALE} AS DECIMAL(20, 0)) * CAST({9 * 10**18} AS DECIMAL(20, 0)) div (CAST({10**18} AS DECIMAL(20, 0)) + CAST({8 * 10**18} AS DECIMAL(20, 0))) AS s").first()
    assert row.s == 2_000_000


def test_phrases_equal_sql(spark):
    out = difference(collocation.run(spark, SF), duck(SF), collocation.SQL)
    assert out is None, out
