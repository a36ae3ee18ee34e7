"""Clustering and near duplicates of vectors against plain Python."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from compare import difference, duck
from wardlake.llm import shallot, vector_join

VECTORS = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())),
                      StructField("label", IntegerType()), StructField("ids", StringType()), StructField("cluster", StringType())])
SF = "/root/testdata/sf0.001"


def frame(spark, rows, kind=VECTORS):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], kind).repartition(3)


def plain_clusters(rows, clusters, rounds, dims):
    """Every vector against every centroid, in whole numbers."""
    kept = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in named[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for k in range(len(centres)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == k]
            if own:
                centres[k] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    most = (1 << 63) - 1
    total = [sum(d for d, c in found if c == k) for k in range(len(centres))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((str(i), c, min(d, most), min(total[c], most), min(sum(total), most), shas[c]) for (i, _), (d, c) in zip(kept, found)))


def got(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


@pytest.mark.parametrize("spread,clusters", [(1.0, 5), (0.002, 5), (1.0, 1), (3.0, 12)])
def test_clusters_equal_plain_ones(spark, spread, clusters):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=4) * spread + rng.integers(0, 3)).tolist()) for i in range(400)]
    rows += [(400 + i, rows[i % 7][1]) for i in range(60)] + [(500 + i, [0.25, 0.25, 0.25, 0.25]) for i in range(40)]
    rows += [(600, None), (601, []), (602, [1.0, 2.0, 3.0]), (603, [1.0, None, 0.0, 0.0]), (604, [math.nan, 0.0, 0.0, 0.0]),
             (605, [math.inf, 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    out = shallot.cluster(frame(spark, rows), clusters=clusters, rounds=4, dims=4)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert got(out) == plain_clusters(rows, clusters, 4, 4)


@pytest.mark.parametrize("huge", [1e9, 1e300])
def test_clusters_of_huge_numbers(spark, huge):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(60)] + [(100 + i, (rng.normal(size=3) * huge).tolist()) for i in range(5)]
    assert got(shallot.cluster(frame(spark, rows), clusters=4, rounds=3, dims=3)) == plain_clusters(rows, 4, 3, 3)


def test_clusters_of_few_or_no_vectors(spark):
    assert shallot.cluster(frame(spark, []), dims=2).count() == 0
    assert shallot.cluster(frame(spark, [(None, [1.0, 2.0]), (1, None)]), dims=2).count() == 0
    rows = [(5, [1.0, 2.0]), (5, [1.0, 2.0]), (9, [3.0, 2.0])]
    assert got(shallot.cluster(frame(spark, rows), dims=2)) == plain_clusters(rows, 8, 10, 2)


def test_search_measures_less_than_everything():
    rng = np.random.default_rng(3)
    points = (rng.normal(size=(2000, 8)) * 40 + rng.integers(0, 12, (2000, 1)) * 900).astype(np.int64)
    before = [[int(x) for x in points[i]] for i in range(12)]
    state = np.zeros(2000, np.int64), np.ones(2000, np.int64), np.full(2000, np.inf), np.zeros(2000)
    seen = []
    for _ in range(6):
        centres = shallot.Centres(before if not seen else now, before)
        *state, measured = shallot.search(points, centres, *state)
        full = np.stack([((points - c) ** 2).sum(1) for c in centres.exact])
        assert (state[0] == full.argmin(0)).all()
        seen.append(measured)
        before, now = centres.values, [[int(x) for x in points[state[0] == c].sum(0) // max(1, (state[0] == c).sum())]
                                       if (state[0] == c).any() else centres.values[c] for c in range(12)]
    assert seen[0] < 2000 * 12 and seen[-1] < 2000 * 12 / 4


def test_clusters_equal_sql(spark):
    out = difference(shallot.run(spark, SF), duck(SF), shallot.SQL)
    assert out is None, out


def test_floats_are_read_as_doubles(spark):
    kind = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType())), *VECTORS.fields[2:]])
    rows = [(i, [float(np.float32(i / 7)), float(np.float32(0.1))]) for i in range(30)]
    assert got(shallot.cluster(frame(spark, rows, kind), clusters=3, dims=2)) == plain_clusters(rows, 3, 10, 2)


def plain_links(rows, least=0.9):
    """Every pair of rows; ids, not rows, are the nodes of components."""
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def direction(v):
        v = np.array(v) / max(map(abs, v))
        return v / math.sqrt(v @ v)

    units = [direction(v) if i is not None and good(v) else None for i, v in rows]
    near = {k: [] for k in range(len(rows))}
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in range(len(rows)):
        for y in range(x):
            if units[x] is not None and units[y] is not None and len(units[x]) == len(units[y]) and units[x] @ units[y] >= least:
                near[x].append(y)
                near[y].append(x)
                a, b = find(rows[x][0]), find(rows[y][0])
                root[max(a, b)] = min(a, b)
    return sorted((str(i), len(near[k]), None if i is None else find(i), i is None or find(i) == i) for k, (i, _) in enumerate(rows))


def many_vectors(dims=24, n=500):
    rng = np.random.default_rng(11)
    scale = np.linspace(2, 0.1, dims)
    rows = [rng.normal(size=dims) * scale for _ in range(n)]
    hot = rng.normal(size=dims) * scale
    rows += [hot + rng.normal(size=dims) * s for s in np.linspace(0.05, 0.6, 150)]
    rows += [rows[3]] * 40 + [rows[5] * 7.5] * 3 + [-rows[5]]
    for k in range(60):  # chains: each a step from the one before
        rows.append(rows[-1] + rng.normal(size=dims) * 0.25)
    return [(i * 3 % 2003, v.tolist()) for i, v in enumerate(rows)]


@pytest.mark.parametrize("dims,block,tile", [(24, 1 << 16, 1024), (24, 60, 32), (3, 60, 32), (1, 40, 16)])
def test_near_vectors_equal_plain_ones(spark, monkeypatch, dims, block, tile):
    monkeypatch.setattr(vector_join, "BLOCK", block)
    monkeypatch.setattr(vector_join, "TILE", tile)
    rows = many_vectors(dims, 300)
    rows += [(3000 + i, None if i == 0 else v) for i, v in enumerate([
        None, [], [0.0] * dims, [math.nan] * dims, [None] + [1.0] * (dims - 1), [math.inf] * dims, [1e300] * dims, [1e-300] * dims])]
    rows += [(None, rows[0][1]), (None, None), (9000, [0.5] * (dims + 1)), (9001, [0.4] * (dims + 1))]
    rows += [(9100 + k, [float(k % 2 + 1)] * (dims + 2 + k // 2)) for k in range(14)]  # more lengths than have axes
    out = vector_join.join(frame(spark, rows))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in out.collect()) == plain_links(rows)


def test_near_vectors_that_share_an_id(spark):
    rows = [(7, [1.0, 0.0]), (9, [1.0, 0.0]), (9, [0.0, 1.0]), (11, [0.0, 2.0]), (12, [0.0, 1.0]), (12, None), (13, None), (13, None)]
    out = {(r.vec_id, r.n_links, r.component_id) for r in vector_join.join(frame(spark, rows)).collect()}
    assert out == {(7, 1, 7), (9, 1, 7), (9, 2, 7), (11, 2, 7), (12, 2, 7), (12, 0, 7), (13, 0, 13)}
    assert vector_join.join(frame(spark, [])).count() == 0


def test_leading_dimensions_leave_few_pairs():
    """On axes of falling variance most pairs end after the first step, and none that is linked is lost."""
    rng = np.random.default_rng(2)
    rows = vector_join.unit(rng.normal(size=(600, 64)) * np.exp(-np.arange(64) / 8))
    rows = np.concatenate((rows, vector_join.unit(rows[:50] + rng.normal(size=(50, 64)) * 0.01)))
    i, j, sums = vector_join.near_pairs(rows, rows, 0.9)
    full = rows @ rows.T
    assert set(zip(*np.nonzero(full >= 0.9))) <= set(zip(i.tolist(), j.tolist()))
    assert np.abs(full[i, j] - sums).max() < 1e-4 and len(i) < 2 * (full >= 0.9).sum()


def test_blocks_leave_out_far_vectors():
    counts = np.zeros(4096)
    counts[[100, 4000]] = 500, 300
    blocks = vector_join.Blocks(counts, 0.9)
    assert [b for b, _ in blocks.guests(0, np.array([-0.95]))] == list(range(5))
    assert blocks.first.tolist()[-1] == 8 and blocks.home(np.array([0.954]), np.array([5], np.uint64))[0] >= 5


def test_near_vectors_equal_sql(spark):
    out = difference(vector_join.run(spark, SF), duck(SF), vector_join.SQL)
    assert out is None, out


def test_near_floats(spark):
    kind = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType())), *VECTORS.fields[2:]])
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in many_vectors(8, 50)]
    out = vector_join.join(frame(spark, rows, kind))
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in out.collect()) == plain_links(rows)
