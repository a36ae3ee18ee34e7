import re

import numpy as np
import pyarrow as pa
import pytest

from llm_samples import varied_texts
from wardlake.llm import words as W
from wardlake.llm import work


@pytest.mark.parametrize("kind, pattern", [("printed", rb"[^\x20\x09-\x0D]+"), ("alnum", rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_are_those_of_the_pattern(kind, pattern):
    texts = varied_texts()
    data, offsets = W.raw(pa.array(texts))
    names, _, at = W.words(data, offsets, kind)
    seen = {}
    for i, text in enumerate(texts):
        found = re.findall(pattern, (text or "").encode().lower())
        assert len(found) == at[i + 1] - at[i]
        for word, name in zip(found, names[at[i]:at[i + 1]].tolist()):
            assert seen.setdefault(word, name) == name
    assert len(set(seen.values())) == len(seen)


def test_blocks_give_the_same_names():
    data, offsets = W.raw(pa.array(varied_texts()))
    whole = W.words(data, offsets)[0]
    parts = [W.words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])[0] for i, j in W.blocks(offsets, 500)]
    assert np.array_equal(whole, np.concatenate(parts))


@pytest.mark.parametrize("kind", ["printed", "alnum"])
def test_large_and_small_blocks_give_the_same_names(monkeypatch, kind):
    data, offsets = W.raw(pa.array([" ", *varied_texts(), "last-one"]))
    small = W.words(data, offsets, kind, (2, 5))
    monkeypatch.setattr(W, "_SUMMED", 0)
    assert all(np.array_equal(x, y) for x, y in zip(small, W.words(data, offsets, kind, (2, 5)), strict=True))


def test_shingles_of_short_rows():
    data, offsets = W.raw(pa.array(["a b c d e f", "a b c", "", "a b c", "b c d e f"]))
    names, _, at = W.words(data, offsets)
    found, to = W.shingles(names, at)
    assert np.diff(to).tolist() == [2, 1, 0, 1, 1]
    assert found[to[1]] == found[to[3]] and found[1] == found[to[4]]


def test_ranks_keep_names_apart():
    counts = np.random.default_rng(1).integers(0, 9, 1 << work.SKETCH_BITS)
    names = np.random.default_rng(2).integers(0, 2**64, 5000, dtype=np.uint64)
    ranked = work.by_rank(names, work.ranks_of(counts))
    assert len(np.unique(ranked)) == len(np.unique(names))
    low = np.uint64(64 - work.SKETCH_BITS)
    order = np.argsort(ranked)
    assert (np.diff(counts[(names[order] >> low).astype(int)]) >= 0).all()


def test_dense_sums_and_bitmap(spark):
    df = spark.range(1000).repartition(7)

    def add(batch, total):
        total += np.bincount(batch.column(0).to_numpy() % 10, minlength=10)

    assert work.dense_sums(df, add, 10).tolist() == [100] * 10
    bits = work.bitmap(df.where("id % 3 = 0"))
    ids = np.arange(1000)
    hit = work.marked(bits, ids)
    assert hit[::3].all() and hit.sum() < 345
    assert work.dense_sums(df.where("id < 0"), add, 10).tolist() == [0] * 10
