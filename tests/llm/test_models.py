"""Classifiers and the language model."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_samples import LABELS, varied_texts, words
from wardlake.llm import hmm, quality, toxicity


@pytest.fixture
def labelled(spark, make_docs, tables):
    """Toxic texts have one of three words, poor ones end their words in stars."""
    rng = random.Random(11)
    texts, labels = [], []
    for i in range(500):
        w = words(rng, rng.randint(20, 60))
        kind = i % 5
        if kind == 0:
            w.insert(rng.randrange(len(w)), rng.choice(["vilething", "vilest", "vileword"]))
        if kind == 1:
            w = [x + "***" for x in w]
        texts.append(" ".join(w))
        labels.append((i, int(kind != 1), int(kind == 0)))
    texts += [None, ""]
    ids = [*range(500), None, 501]
    return tables(documents=make_docs(texts, ids, extra=True), labels=spark.createDataFrame([*labels, labels[0], (None, 1, 1)], LABELS))


def test_toxicity_on_held_out_rows(spark, labelled):
    rows = toxicity.run(spark, labelled).collect()
    assert len(rows) == 502
    held = [r for r in rows if r.held_out and r.doc_id < 500]
    assert {r.held_out for r in rows if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0} == {True}
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    docs = spark.read.parquet(f"{labelled}/documents.parquet")
    kept = toxicity.stage(spark, docs, labelled)
    assert kept.columns == docs.columns
    assert kept.where("doc_id is null").count() == 1
    assert abs(kept.count() - 402) <= 8


def test_toxicity_does_not_read_held_out_labels(spark, labelled, tables):
    labels = spark.read.parquet(f"{labelled}/labels.parquet").cache()
    labels.count()
    before = toxicity.fit(spark.read.parquet(f"{labelled}/documents.parquet"), labels)
    flipped = labels.selectExpr("doc_id", "quality", "IF(pmod(crc32(cast(cast(doc_id AS string) AS binary)), 5) = 0, 1 - toxic, toxic) AS toxic")
    after = toxicity.fit(spark.read.parquet(f"{labelled}/documents.parquet"), flipped)
    assert np.array_equal(before[0], after[0]) and before[1] == after[1]


def test_toxicity_without_labels(spark, make_docs, tables):
    folder = tables(documents=make_docs(["some text", None]), labels=spark.createDataFrame([], LABELS))
    assert [r.predicted for r in toxicity.run(spark, folder).collect()] == [0, 0]


def test_quality_orders_grades(spark, labelled):
    rows = quality.run(spark, labelled).collect()
    assert len(rows) == 502
    mean = {k: np.mean([r.expected_grade for r in rows if r.doc_id is not None and r.doc_id < 500 and r.held_out and r.doc_id % 5 == k]) for k in (0, 1, 2)}
    assert mean[1] < mean[0] < mean[2]
    assert all(r.tail_1 >= r.tail_2 and abs(r.expected_grade - r.tail_1 - r.tail_2) < 1e-9 for r in rows)
    assert all(r.keep == (r.doc_id % 5 != 1) for r in rows if r.held_out and r.doc_id < 500 and r.doc_id % 5 > 0)


def test_quality_of_one_grade_only():
    weights, cuts = quality.train(np.full(5, 2), np.zeros(5, np.int64), np.arange(6), 3)
    assert not weights.any() and cuts[0] <= cuts[1]


def test_hmm_counts_and_base(make_docs):
    texts = varied_texts()
    rows = hmm.score(make_docs(texts, extra=True)).collect()
    split = {i: [*(t or "").encode().lower().split(), None] for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in split}
    counts = Counter(w for i, ws in split.items() if not held[i] for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for r in rows:
        own = split[r.doc_id]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(counts[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0


def test_rare_words_are_joined(make_docs, monkeypatch):
    docs = make_docs(varied_texts())
    want = {r.doc_id: r for r in hmm.score(docs).collect()}
    monkeypatch.setattr(hmm, "LOOKUP", 40)
    monkeypatch.setattr(hmm, "HEADS", hmm.HEADS)
    got = {r.doc_id: r for r in hmm.score(docs).collect()}
    for i, r in want.items():
        assert got[i].n_known == r.n_known and got[i].base_score == pytest.approx(r.base_score, rel=1e-9)


def brute_likelihood(sequence, start, move, emit):
    k = len(start)
    total = 0.0
    for path in itertools.product(range(k), repeat=len(sequence)):
        p = start[path[0]] * emit[sequence[0], path[0]]
        for a, b, s in zip(path, path[1:], sequence[1:]):
            p *= move[a, b] * emit[s, b]
        total += p
    return total


def test_forward_and_expected_counts_against_all_paths():
    rng = np.random.default_rng(4)
    k, symbols = 3, 5
    start, move = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k)
    emit = rng.dirichlet(np.ones(symbols), k).T
    sequences = [rng.integers(0, symbols, n) for n in (4, 1, 6, 6, 2)]
    got = hmm.likelihood(sequences, (start, move, emit))
    assert got == pytest.approx([math.log10(brute_likelihood(s, start, move, emit)) for s in sequences])
    starts, moves, emissions = hmm.expected(hmm.Packed(sequences), start, move, emit)
    want_starts, want_moves, want_emissions = np.zeros(k), np.zeros((k, k)), np.zeros((symbols, k))
    for s in sequences:
        total = brute_likelihood(s, start, move, emit)
        for path in itertools.product(range(k), repeat=len(s)):
            p = start[path[0]] * emit[s[0], path[0]]
            for a, b, x in zip(path, path[1:], s[1:]):
                p *= move[a, b] * emit[x, b]
            want_starts[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                want_moves[a, b] += p / total
            for z, x in zip(path, s):
                want_emissions[x, z] += p / total
    assert starts == pytest.approx(want_starts) and moves == pytest.approx(want_moves) and emissions == pytest.approx(want_emissions)


def test_hmm_of_nothing(make_docs):
    assert hmm.score(make_docs([])).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = hmm.score(make_docs(["all unknown words"], [only])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (4, 0, 0) and row.base_score == pytest.approx(0.0)
