"""Exact k-means on whole-number vectors with remembered second-nearest centroids (Shallot search).

Vectors are scaled, floored and packed into blocks of rows that stay where they were read; nothing is
shuffled but one sum row per centroid and task. Each vector carries its nearest and second-nearest
centroid, an upper bound of the distance to the first and a lower bound of that to all others. A round moves
the bounds by what the centroids moved. Where they still tell the centroids apart nothing is computed. Else the
two remembered centroids are measured, the closer one becomes the start, and its neighbours are
scanned from near to far until they lie outside the ball that its distance and the second-best
distance span; the ball shrinks with each better find. Bounds are floating-point numbers with a
margin; every measured distance and every comparison is in whole numbers, so ties are exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import work

CLUSTERS, ROUNDS, SCALE, SEED, DIMS = 8, 10, 1024, 3, 64
#: Vectors in one packed row.
BLOCK = 2048
_UP, _DOWN = 1 + 1e-9, 1 - 1e-9
_MOST = (1 << 63) - 1
_STATE = "ids array<bigint>, points binary, near binary, second binary, upper binary, lower binary, moved binary"
_NAMES = [part.split()[0] for part in _STATE.split(", ")]


def whole(embedding: str, dims: int) -> Column:
    """Whether a vector has ``dims`` components, none of them null or not finite."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))

    column = F.col(embedding).cast("array<double>")
    return F.coalesce((F.size(column) == dims) & F.forall(column, finite), F.lit(False))


def narrow(dims: int) -> int:
    """The largest component for which squared distances fit 64 bits and packed ones 32; 2**27 for 64 dimensions."""
    return min(math.isqrt((1 << 62) // dims) // 2, (1 << 31) - 1)


def floored(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of rows as 64-bit numbers, or as Python's where they would not fit the arithmetic."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if not scaled.size or np.abs(scaled).max() <= narrow(values.shape[1]):
        return scaled.astype(np.int64)
    exact = [math.floor(x * scale) if abs(x) < 2.0**53 else int(x) * scale for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def pack(points: np.ndarray) -> bytes:
    if points.dtype == object:
        return b"t" + ",".join(map(str, points.ravel().tolist())).encode()
    return b"n" + points.astype("<i4").tobytes()


def unpack(data: bytes, dims: int) -> np.ndarray:
    if data[:1] == b"t":
        return np.array([int(x) for x in data[1:].split(b",")], dtype=object).reshape(-1, dims)
    return np.frombuffer(data, "<i4", offset=1).astype(np.int64).reshape(-1, dims)


def _squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    apart = points - centres
    return (apart * apart).sum(axis=1)


class Centres:
    """Centroids of a round, their neighbours by distance and how far each came since the last round."""

    def __init__(self, values: list[list[int]], before: list[list[int]] | None = None) -> None:
        self.values = values
        self.count = len(values)
        most = narrow(len(values[0]))
        self.wide = any(abs(x) > most for row in values for x in row)
        self.exact = np.array(values, dtype=object if self.wide else np.int64).reshape(self.count, -1)
        if self.wide:
            return
        apart = self.exact[:, None, :] - self.exact[None, :, :]
        gaps = np.sqrt((apart * apart).sum(2).astype(float))
        np.fill_diagonal(gaps, np.inf)
        self.order = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = gaps * _DOWN
        self.half = self.gaps.min(1) / 2
        moved = np.zeros(self.count)
        if before is not None and not any(abs(x) > most for row in before for x in row):
            moved = np.sqrt(_squared(self.exact, np.array(before, np.int64)).astype(float)) * _UP
        elif before is not None:
            moved = np.full(self.count, np.inf)
        self.moved = moved
        others = np.where(np.eye(self.count, dtype=bool), 0.0, moved[None, :])
        self.others = others.max(1)


def nearest_exactly(points: np.ndarray, centres: Centres) -> np.ndarray:
    """Nearest centroid of each vector in Python's whole numbers; for values beyond 64-bit arithmetic."""
    table = np.stack([_squared(points.astype(object), row) for row in centres.exact.astype(object)])
    return np.array([min(range(centres.count), key=lambda c: (table[c, i], c)) for i in range(len(points))], np.int64)


def search(points: np.ndarray, centres: Centres, near: np.ndarray, second: np.ndarray, upper: np.ndarray,
           lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """One round for a block: nearest and second-nearest centroid, the bounds, and how many distances were measured."""
    upper = (upper + centres.moved[near]) * _UP
    lower = np.maximum(lower - centres.others[near], 0) * _DOWN
    near, second = near.copy(), second.copy()
    if centres.count == 1:
        return near, second, upper, lower, 0
    rows = np.flatnonzero(upper >= np.maximum(lower, centres.half[near]))
    first = _squared(points[rows], centres.exact[near[rows]])
    measured = len(rows)
    upper[rows] = np.sqrt(first.astype(float)) * _UP
    open_ = upper[rows] >= np.maximum(lower[rows], centres.half[near[rows]])
    rows, first = rows[open_], first[open_]
    if not len(rows):
        return near, second, upper, lower, measured
    one, two = near[rows], second[rows]
    other = _squared(points[rows], centres.exact[two])
    measured += len(rows)
    swap = (other < first) | ((other == first) & (two < one))
    start, skip = np.where(swap, two, one), np.where(swap, one, two)
    best, best_d = start.copy(), np.where(swap, other, first)
    next_, next_d = skip.copy(), np.where(swap, first, other)
    reach = np.sqrt(best_d.astype(float)) * _UP
    ball = reach + np.sqrt(next_d.astype(float)) * _UP
    live = np.arange(len(rows))
    for step in range(centres.count - 1):
        centre = centres.order[start[live], step]
        inside = centres.gaps[start[live], centre] <= ball[live]
        live, centre = live[inside], centre[inside]
        if not len(live):
            break
        todo = centre != skip[live]
        at, centre = live[todo], centre[todo]
        far = _squared(points[rows[at]], centres.exact[centre])
        measured += len(at)
        wins = (far < best_d[at]) | ((far == best_d[at]) & (centre < best[at]))
        places = ~wins & ((far < next_d[at]) | ((far == next_d[at]) & (centre < next_[at])))
        w, p = at[wins], at[places]
        next_[w], next_d[w] = best[w], best_d[w]
        best[w], best_d[w] = centre[wins], far[wins]
        next_[p], next_d[p] = centre[places], far[places]
        ball[at] = reach[at] + np.sqrt(next_d[at].astype(float)) * _UP
    near[rows], second[rows] = best, next_
    upper[rows] = np.sqrt(best_d.astype(float)) * _UP
    lower[rows] = np.sqrt(next_d.astype(float)) * _DOWN
    return near, second, upper, lower, measured


def _sums(points: np.ndarray, near: np.ndarray, old: np.ndarray | None, count: int) -> bytes:
    """Per centroid: members and component sums that a block gains, as text of whole numbers."""
    lines = []
    for c in range(count):
        now = near == c
        was = np.zeros_like(now) if old is None else old == c
        come, gone = points[now & ~was], points[was & ~now]
        if len(come) or len(gone):
            total = come.sum(axis=0) - gone.sum(axis=0)
            lines.append(f"{c}:" + ",".join(map(str, [len(come) - len(gone), *total.tolist()])))
    return ";".join(lines).encode()


def _gathered(blocks: DataFrame, count: int, width: int) -> list[list[int]]:
    """Sums of the ``moved`` columns, added up on the executors; one row per centroid reaches the driver."""
    def row(c: int, total: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([",".join(map(str, total))])], ["c", "total"])

    def add(totals: dict[int, list[int]], c: int, part: str) -> None:
        new = [int(x) for x in part.split(",")]
        totals[c] = [a + b for a, b in zip(totals[c], new)] if c in totals else new

    def count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for line in filter(None, text.decode().split(";")):
                    c, part = line.split(":")
                    add(totals, int(c), part)
        for c, total in totals.items():
            yield row(c, total)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            for c, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                add(totals, c, part)
        for c, total in totals.items():
            yield row(c, total)

    parts = blocks.select("moved").mapInArrow(count_up, "c int, total string").repartition("c").mapInArrow(merge, "c int, total string")
    out = [[0] * width for _ in range(count)]
    for found in parts.collect():
        out[found.c] = [int(x) for x in found.total.split(",")]
    return out


def _first_blocks(kept: DataFrame, dims: int, scale: int) -> DataFrame:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            ids = batch.column(0)
            with np.errstate(over="ignore"):
                small = np.abs(flat * scale).max(axis=1, initial=0) < narrow(dims)
            for rows in (np.flatnonzero(small), np.flatnonzero(~small)):
                for i in range(0, len(rows), BLOCK):
                    part = rows[i:i + BLOCK]
                    n = len(part)
                    state = [np.zeros(n, "<i2").tobytes(), np.ones(n, "<i2").tobytes(), np.full(n, np.inf).tobytes(), np.zeros(n).tobytes()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids.take(pa.array(part)).to_pylist()], pa.list_(pa.int64())),
                         *(pa.array([x], pa.binary()) for x in (pack(floored(flat[part], scale)), *state, b""))], _NAMES)

    return kept.mapInArrow(blocks, _STATE)


def _round(blocks: DataFrame, centres: Centres, dims: int, first: bool) -> DataFrame:
    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                data = [row.column(i)[0].as_py() for i in range(1, 6)]
                points = unpack(data[0], dims)
                old, second = (np.frombuffer(x, "<i2").astype(np.int64) for x in data[1:3])
                upper, lower = (np.frombuffer(x) for x in data[3:5])
                if points.dtype == object or centres.wide:
                    near, upper, lower = nearest_exactly(points, centres), np.full(len(points), np.inf), np.zeros(len(points))
                    second = np.where(near == second, old if first is False else (near + 1) % centres.count, second)
                    second = np.where(near == second, (near + 1) % centres.count, second)
                else:
                    near, second, upper, lower, _ = search(points, centres, old, second, upper, lower)
                yield pa.RecordBatch.from_arrays(
                    [row.column(0), row.column(1), *(pa.array([x], pa.binary()) for x in (
                        near.astype("<i2").tobytes(), second.astype("<i2").tobytes(), upper.tobytes(), lower.tobytes(),
                        _sums(points, near, None if first else old, centres.count)))], _NAMES)

    return blocks.mapInArrow(advance, _STATE)


def _distances(blocks: DataFrame, centres: Centres, dims: int) -> DataFrame:
    """Blocks with exact distances in ``lower`` and the sum per centroid in ``moved``."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                points = unpack(batch.column(1)[k].as_py(), dims)
                near = np.frombuffer(batch.column(2)[k].as_py(), "<i2").astype(np.int64)
                if centres.wide or points.dtype == object:
                    far = _squared(points.astype(object), centres.exact.astype(object)[near])
                else:
                    far = _squared(points, centres.exact[near])
                exact = far.astype(object)
                sums = ";".join(f"{c}:{(near == c).sum()},{exact[near == c].sum()}" for c in np.unique(near).tolist())
                out = np.array([min(x, _MOST) for x in exact.tolist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), pa.array([near.tolist()], pa.list_(pa.int32())), pa.array([out.tolist()], pa.list_(pa.int64())),
                     pa.array([sums.encode()], pa.binary())], ["ids", "near", "far", "moved"])

    return blocks.mapInArrow(measure, "ids array<bigint>, near array<int>, far array<bigint>, moved binary")


def starts(kept: DataFrame, clusters: int, seed: int, scale: int) -> list[list[int]]:
    """Whole-number components of the ``clusters`` vectors whose hashed ids come first; rows without id are none."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.where(F.col("vec_id").isNotNull()).orderBy(key, "embedding").limit(clusters).collect()
    return [[int(x) for x in floored(np.array([r.embedding], float), scale)[0].tolist()] for r in rows]


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
            seed: int = SEED, dims: int = DIMS) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256`` per kept vector.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are not read. Kept are vectors of ``dims`` components,
    none null or not finite; each component x becomes floor(scale * x), exact at any size. The first
    centroids are the vectors with the least sha256 of ``seed:vec_id`` (rows of one id by their components), fewer if
    there are fewer vectors. Rows without id are clustered but never start a centroid, so a table in which no row has
    an id, or none is kept, gives no rows. Repeated rows count each. Ties go to the smaller number. A distance or
    inertia beyond 64 bits shows as the largest long; comparisons and sums stay exact.
    """
    spark = vectors.sparkSession
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    kept = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(whole("embedding", dims))
    first = starts(kept, clusters, seed, scale)
    if not first:
        return spark.createDataFrame([], out)
    centres, blocks, folder = Centres(first), _first_blocks(kept, dims, scale), None
    totals = [[0] * (dims + 1) for _ in first]
    for turn in range(rounds + 1):
        last, (blocks, folder) = folder, work.save_at(_round(blocks, centres, dims, turn == 0), "shallot")
        if last:
            work.delete(spark, last)
        if turn == rounds:
            break
        gained = _gathered(blocks, centres.count, dims + 1)
        totals = [[a + b for a, b in zip(*pair)] for pair in zip(totals, gained)]
        moved = [[x // total[0] for x in total[1:]] if total[0] else old for total, old in zip(totals, centres.values)]
        centres = Centres(moved, centres.values)
    measured, _ = work.save_at(_distances(blocks, centres, dims), "shallot-far")
    work.delete(spark, folder)
    inertias = [pair[1] for pair in _gathered(measured, centres.count, 2)]
    whole_inertia = min(sum(inertias), _MOST)
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centres.values]
    own = F.array(*(F.lit(min(x, _MOST)).cast("long") for x in inertias))
    sha = F.array(*(F.lit(x) for x in digests))
    rows = measured.select(F.explode(F.arrays_zip("ids", "near", "far")).alias("v"))
    return rows.select(
        F.col("v.ids").alias("vec_id"), F.col("v.near").alias("cluster"), F.col("v.far").alias("distance"),
        F.element_at(own, F.col("v.near") + 1).alias("cluster_inertia"), F.lit(whole_inertia).cast("long").alias("inertia"),
        F.element_at(sha, F.col("v.near") + 1).alias("centroid_sha256"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(work.table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds written out, one row per vector and component."""
    finite = f"len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}"
    parts = [
        f"kept AS MATERIALIZED (SELECT vec_id, embedding FROM embeddings WHERE {finite})",
        f"points AS MATERIALIZED (SELECT vec_id, unnest(generate_series(1, {DIMS})) AS p, "
        f"floor({SCALE} * unnest(embedding)::DOUBLE)::BIGINT AS x FROM kept)",
        "first AS (SELECT vec_id, row_number() OVER (ORDER BY h) - 1 AS c FROM "
        f"(SELECT vec_id, sha256('{SEED}:' || vec_id) AS h FROM kept ORDER BY h LIMIT {CLUSTERS}))",
        "c0 AS MATERIALIZED (SELECT c, p, x FROM first JOIN points USING (vec_id))",
    ]
    for turn in range(ROUNDS + 1):
        parts.append(f"d{turn} AS (SELECT vec_id, c, sum((points.x - k.x) * (points.x - k.x))::BIGINT AS d "
                     f"FROM points JOIN c{turn} k USING (p) GROUP BY vec_id, c)")
        parts.append(f"a{turn} AS MATERIALIZED (SELECT vec_id, c, d FROM d{turn} "
                     "QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)")
        if turn < ROUNDS:
            # // truncates, so negative sums with a rest go one lower
            parts.append(f"m{turn} AS (SELECT c, p, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM points JOIN a{turn} USING (vec_id) GROUP BY c, p)")
            parts.append(f"c{turn + 1} AS MATERIALIZED (SELECT c, p, CASE WHEN n IS NULL THEN x ELSE (s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END)::BIGINT END AS x "
                         f"FROM c{turn} LEFT JOIN m{turn} USING (c, p))")
    return f"""WITH {', '.join(parts)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha AS centroid_sha256
FROM a{ROUNDS} JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY p)) AS sha FROM c{ROUNDS} GROUP BY c) USING (c)"""


SQL = _sql()
