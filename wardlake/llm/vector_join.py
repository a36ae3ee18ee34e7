"""Exact cosine join of vectors by tiles whose dimensions stand in order of variance.

Equal vectors are one class. The second moments of all vectors give principal axes, and every vector is
turned into them, so its leading numbers carry most of its length. Tiles of vectors are then
compared over a few leading dimensions at a time: the product so far plus the product of the lengths of the
rests (Cauchy-Schwarz) bounds the cosine, and pairs whose bound stays below the threshold are left out
of the next step. What survives all dimensions is measured in double precision.

Two unit vectors with cosine t are at most sqrt(2 - 2t) apart on every axis, so blocks of vectors are
intervals of the first axis and a vector meets only blocks within that distance. A block holds at most
BLOCK vectors; crowded places are cut by hash. Pairs of blocks are tasks. A task counts the links of
each vector and returns a spanning forest, never the pairs, so a group of near copies costs
what its vectors cost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import graph
from wardlake.llm import words as W
from wardlake.llm import work

LEAST = 0.9
#: Most vectors in a block (a task holds two), blocks that any input is cut into, vectors in a tile, dimensions in a step.
BLOCK, LANES, TILE, STEP = 1 << 16, 8, 1024, 16
#: Cells of the first axis that blocks are made of, the most dimensions that are turned into principal axes, and
#: how many lengths of vectors, the most common ones, have axes; others share one job that cuts them by hash.
CELLS, TURNED, LENGTHS = 1 << 12, 1024, 4
#: Margins of the bounds against rounding in single and double precision.
_SINGLE, _DOUBLE = 1e-4, 1e-9


def usable(column: Column) -> Column:
    """Whether a vector has a direction: some component is not zero, none is null or not finite."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length one, in double precision; scaled first, so that squares neither vanish nor overflow."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def axes(own: DataFrame, dims: int) -> np.ndarray | None:
    """Principal axes as columns, longest first; None above TURNED dimensions, which stay in their order."""
    if dims > TURNED:
        return None

    def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
        rows = unit(_matrix(batch.column(0), dims))
        total += (rows.T @ rows).ravel()

    moments = work.dense_sums(own.select("embedding"), add, dims * dims)
    _, vectors = np.linalg.eigh(moments.reshape(dims, dims))
    return np.ascontiguousarray(vectors[:, ::-1])


def turned(rows: np.ndarray, turn: np.ndarray | None) -> np.ndarray:
    return rows if turn is None or turn.shape[0] != rows.shape[1] else rows @ turn


class Blocks:
    """Intervals of the first axis with about equally many vectors; an interval too crowded is several blocks."""

    def __init__(self, counts: np.ndarray, least: float) -> None:
        self.eps = math.sqrt(max(0.0, 2 - 2 * least)) + _DOUBLE
        most = max(1, min(BLOCK, math.ceil(counts.sum() / LANES)))
        used = np.flatnonzero(counts)
        # runs of used cells, each as full as fits; one cell with more is cut by hash
        cuts, parts = [], []
        for at, n in zip(used.tolist(), counts[used].astype(np.int64).tolist()):
            if not parts or parts[-1] + n > most:
                cuts.append(at)
                parts.append(0)
            parts[-1] += n
        self.cuts = np.array(cuts or [0])
        self.cells = len(counts)
        ends = used[np.append(np.searchsorted(used, self.cuts[1:]) - 1, -1)] if len(used) else self.cuts
        parts = np.maximum(1, -(-np.array(parts or [0]) // most))
        self.first = np.concatenate(([0], np.cumsum(parts)))
        interval = np.repeat(np.arange(len(parts)), parts)
        # a cell's width more, as the place of a vector near a border may be rounded to either side
        self.low, self.high = (self.cuts[interval] - 1) / self.cells * 2 - 1, (ends[interval] + 2) / self.cells * 2 - 1

    def home(self, place: np.ndarray, names: np.ndarray) -> np.ndarray:
        """The block of each vector, by its number on the first axis and, in crowded intervals, its hashed name."""
        interval = np.maximum(np.searchsorted(self.cuts, cell(place, self.cells), side="right") - 1, 0)
        parts = self.first[interval + 1] - self.first[interval]
        return self.first[interval] + (names % parts.astype(np.uint64)).astype(np.int64)

    def guests(self, block: int, place: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each block that vectors of ``block`` must meet, and which of them; its own block first."""
        for other in range(len(self.low)):
            near = (place >= self.low[other] - self.eps) & (place <= self.high[other] + self.eps)
            if near.any():
                yield other, near


class Scattered:
    """Blocks by hash alone, for lengths that few vectors have."""

    def __init__(self, vectors: int) -> None:
        self.parts = max(1, -(-vectors // BLOCK))

    def home(self, place: np.ndarray, names: np.ndarray) -> np.ndarray:
        return (names % np.uint64(self.parts)).astype(np.int64)

    def guests(self, block: int, place: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for other in range(self.parts):
            yield other, np.ones(len(place), bool)


def cell(place: np.ndarray, cells: int) -> np.ndarray:
    return np.clip(((place + 1) / 2 * cells).astype(np.int64), 0, cells - 1)


def near_pairs(left: np.ndarray, right: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs of unit rows whose product may be ``least`` or more, and the product within the margin.

    Dimensions should stand in order of weight: after each STEP of them the bound drops what can not get there,
    over the whole tile while much is left, then pair by pair.
    """
    dims = left.shape[1]
    x, y = left.astype(np.float32), right.astype(np.float32)
    floor = least - _SINGLE - dims * 2.0**-23
    rests = {k: (np.sqrt((left[:, k:] ** 2).sum(1)), np.sqrt((right[:, k:] ** 2).sum(1))) for k in range(STEP, dims, STEP)}
    so_far, k = x[:, :STEP] @ y[:, :STEP].T, STEP
    while k < dims:
        open_ = so_far + np.outer(*(rest.astype(np.float32) for rest in rests[k])) >= floor
        if np.count_nonzero(open_) * 16 < open_.size:
            break
        so_far += x[:, k:k + STEP] @ y[:, k:k + STEP].T
        k += STEP
    else:
        open_ = so_far >= floor
    i, j = np.nonzero(open_)
    sums = so_far[i, j].astype(np.float64)
    while len(i) and k < dims:
        sums += np.einsum("ij,ij->i", left[i, k:k + STEP], right[j, k:k + STEP])
        k += STEP
        reach = sums + rests[k][0][i] * rests[k][1][j] if k < dims else sums
        stay = reach >= floor
        i, j, sums = i[stay], j[stay], sums[stay]
    return i, j, sums


def _reached(rows: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Which pairs reach ``least`` in double precision, a slice at a time."""
    out = np.empty(len(i), bool)
    size = max(1, (1 << 22) // rows.shape[1])
    for a in range(0, len(i), size):
        cut = slice(a, a + size)
        out[cut] = np.einsum("ij,ij->i", rows[i[cut]], rows[j[cut]]) >= least
    return out


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked members one label, the least index among them."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label[:] = label[label]


def join_blocks(left: np.ndarray, right: np.ndarray | None, copies: np.ndarray, turn: np.ndarray | None,
                least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (weighted with the partner's copies) and component label of all rows of two blocks, or of one with itself."""
    rows = unit(left) if right is None else unit(np.concatenate((left, right)))
    m, n = len(left), len(rows)
    axis = turned(rows, turn)
    order = np.concatenate([np.argsort(axis[:m, 0], kind="stable"), m + np.argsort(axis[m:, 0], kind="stable")])
    eps = math.sqrt(max(0.0, 2 - 2 * least)) + _DOUBLE
    links, label = np.zeros(n, np.int64), np.arange(n)
    for a in range(0, m, TILE):
        ours = order[a:min(a + TILE, m)]
        for b in range(a, m, TILE) if right is None else range(m, n, TILE):
            theirs = order[b:min(b + TILE, m if right is None else n)]
            gap = max(axis[theirs[0], 0] - axis[ours[-1], 0], axis[ours[0], 0] - axis[theirs[-1], 0])
            if gap > eps:
                continue
            i, j, sums = near_pairs(axis[ours], axis[theirs], least)
            if right is None and a == b:
                once = i < j
                i, j, sums = i[once], j[once], sums[once]
            i, j = ours[i], theirs[j]
            close = np.flatnonzero(sums < least + _SINGLE + rows.shape[1] * 2.0**-23)
            if len(close):
                keep = np.ones(len(i), bool)
                keep[close] = _reached(rows, i[close], j[close], least)
                i, j = i[keep], j[keep]
            links += np.bincount(i, copies[j], n).astype(np.int64) + np.bincount(j, copies[i], n).astype(np.int64)
            _unite(label, i, j)
    return links, label


def _classes(vectors: DataFrame) -> DataFrame:
    """One row per different vector: its key, least id, copies and components."""
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    return rows.groupBy("one", "two").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"),
                                          F.first("embedding").alias("embedding"))


def _placed(own: DataFrame, blocks: Blocks | Scattered, turn: np.ndarray | None) -> DataFrame:
    """Packed vectors for every pair of blocks: its key, side, length, ids, copies and components."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = pc.list_value_length(whole.column(2)).to_numpy()
            for dims in np.unique(lengths).tolist():
                batch = whole.filter(pa.array(lengths == dims))
                ids, copies, raw = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), dims)
                at = turned(unit(raw), turn)[:, 0]
                home = blocks.home(at, W.mix(ids.astype(np.uint64)))
                for block in np.unique(home).tolist():
                    inside = np.flatnonzero(home == block)
                    for other, near in blocks.guests(block, at[inside]):
                        rows = inside[near]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([f"{dims}:{min(block, other)}:{max(block, other)}"]), pa.array([0 if block == other else 1 if block < other else 2], pa.int32()),
                             pa.array([dims], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (ids[rows], copies[rows], raw[rows]))],
                            ["pair", "side", "dims", "ids", "copies", "vectors"])

    return own.mapInArrow(place, "pair string, side int, dims int, ids binary, copies binary, vectors binary")


def _compared(placed: DataFrame, turn: np.ndarray | None, single: bool, least: float) -> DataFrame:
    kind = np.float32 if single else np.float64

    def side(group: pa.Table, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        part = group.filter(pc.equal(group.column("side"), number))
        ids, copies, rows = (b"".join(part.column(name).to_pylist()) for name in ("ids", "copies", "vectors"))
        return np.frombuffer(ids, np.int64), np.frombuffer(copies, np.int64), np.frombuffer(rows, kind).reshape(-1, group.column("dims")[0].as_py())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in work.groups(batches, "pair"):
            ids, copies, rows = side(group, 0)
            right = None
            if not len(ids):  # two blocks, unless only one has vectors that must meet the other
                (ids, copies, rows), (more, counts, right) = side(group, 1), side(group, 2)
                if not len(ids) or not len(more):
                    continue
                ids, copies = np.concatenate((ids, more)), np.concatenate((copies, counts))
            count, label = join_blocks(rows, right, copies, turn, least)
            lowest = np.full(len(ids), np.iinfo(np.int64).max)
            np.minimum.at(lowest, label, ids)
            some = np.flatnonzero(count)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(lowest[label[some]]), pa.array(count[some])], ["a", "b", "n"])

    return placed.repartition("pair").sortWithinPartitions("pair").mapInArrow(compare, "a long, b long, n long")


def links(classes: DataFrame, single: bool, least: float) -> DataFrame:
    """``a``, the least ``b`` that one task found it linked with (or itself), and its links there, copies counted."""
    classes = classes.select("first", "copies", "embedding", F.size("embedding").alias("dims"))
    sizes = classes.groupBy("dims").count().orderBy(F.desc("count"), "dims").limit(LENGTHS).collect()
    others = classes.where(~F.col("dims").isin([row.dims for row in sizes])).drop("dims")
    found = _compared(_placed(others, Scattered(others.count()), None), None, single, least)
    for row in sizes:
        own = classes.where(F.col("dims") == row.dims).drop("dims")
        turn = axes(own, row.dims)

        def add(batch: pa.RecordBatch, total: np.ndarray, turn: np.ndarray | None = turn, dims: int = row.dims) -> None:
            total += np.bincount(cell(turned(unit(_matrix(batch.column(2), dims)), turn)[:, 0], CELLS), minlength=CELLS)

        blocks = Blocks(work.dense_sums(own, add, CELLS), least)
        found = found.unionByName(_compared(_placed(own, blocks, turn), turn, single, least))
    return found


def join(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``.

    Vectors are linked whose cosine is ``least`` (above 0) or more, over all rows; vectors of different length are not
    comparable. A null, empty or zero vector, and one with a null or not finite component, is linked with nothing.
    Repeated rows are vectors of their own that link each other; rows that share an id belong to one component. A row
    without id is linked with nothing, has no component and is kept. Other columns are not read.
    """
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    embedding = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    named = vectors.select(F.col("vec_id").cast("long"), embedding.alias("embedding")).select(
        "vec_id", "embedding", F.xxhash64("embedding").alias("one"), F.xxhash64(F.lit(7), F.reverse("embedding")).alias("two"))
    classes = work.save(_classes(named), "vectors")
    linked = work.save(links(classes, single, least), "vector-links")
    keyed = named.where(F.col("vec_id").isNotNull()).select("vec_id", "one", "two", usable(F.col("embedding")).alias("usable"))
    # classes that say more of their rows than the rows themselves do
    degrees = linked.groupBy("a").agg(F.sum("n").alias("n"))
    several = (classes.join(degrees, F.col("first") == F.col("a"), "left")
               .where((F.col("copies") > 1) | F.col("n").isNotNull())
               .select("one", "two", "first", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")))
    alone = keyed.where(~F.col("usable")).select("vec_id", F.col("vec_id").alias("first"), F.lit(0).cast("long").alias("n_links"))
    rows = work.save(keyed.where("usable").join(several, ["one", "two"], "left").select(
        "vec_id", F.coalesce("first", "vec_id").alias("first"), F.coalesce("n_links", F.lit(0)).alias("n_links")).unionByName(alone), "vector-rows")
    same_id = (rows.groupBy("vec_id").agg(F.min("first").alias("a"), F.max("first").alias("z")).where(F.col("a") < F.col("z"))
               .select("vec_id", "a").join(rows.select("vec_id", F.col("first").alias("b")), "vec_id").select("a", "b").distinct())
    joined = graph.components(linked.select("a", "b").unionByName(same_id))
    out = (rows.join(joined, F.col("first") == F.col("node"), "left")
           .select("vec_id", "n_links", F.coalesce("component", "first").alias("component_id")))
    nameless = vectors.where(F.col("vec_id").isNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nameless).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(work.table(spark, sf_dir, "embeddings"))


SQL = f"""WITH RECURSIVE usable AS MATERIALIZED (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
linked AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) END >= {LEAST}),
reached AS (SELECT a, b FROM linked UNION SELECT r.a, l.b FROM reached r JOIN linked l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM linked GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(b, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id"""
