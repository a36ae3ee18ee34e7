"""Hashed text features, and the bounded samples of labelled rows that classifiers are fitted on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm import words as W

BITS = 18
HEADS = (4, 5)
_LOW = np.uint64(64 - BITS)


def _shape_table() -> np.ndarray:
    """Classes of bytes in a shape: letters, digits and non-ASCII as one each, other bytes as they are."""
    table = np.arange(256, dtype=np.int64)
    table[97:123], table[65:91], table[48:58], table[128:] = 97, 65, 48, 97
    return table


_SHAPES = _shape_table()


def _slot(*parts: np.ndarray) -> np.ndarray:
    out = np.zeros(1, np.uint64)
    for part in parts:
        out = W.mix(out * np.uint64(0x9E3779B97F4A7C15) + np.asarray(part).astype(np.uint64) + np.uint64(1))
    return out >> _LOW


def _octave(share: np.ndarray) -> np.ndarray:
    """0 for a half and more, 1 for a quarter and more, and so on to 12."""
    return np.clip(np.floor(-np.log2(np.maximum(share, 1e-9)) + 1e-9), 0, 12).astype(np.int64)


def _shapes(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Per text: which share of its words ends in which shape, and how many words are new."""
    names, starts, at = W.words(data, offsets)
    kept = W.PRINTED[data]
    out = []
    lengths = np.add.reduceat(kept.astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
    last = starts + lengths - 1
    shape = np.zeros(len(starts), np.int64)
    for back in range(3):
        shape = shape * 256 + np.where(lengths > back, _SHAPES[data[np.maximum(last - back, 0)]], 0)
    for i in range(len(offsets) - 1):
        a, b = at[i], at[i + 1]
        if a == b:
            out.append(_slot(np.array([7])))
            continue
        kinds, counts = np.unique(shape[a:b], return_counts=True)
        new = len(np.unique(names[a:b])) / (b - a)
        out.append(np.concatenate((
            _slot(np.full(len(kinds), 1), kinds, _octave(counts / (b - a))),
            _slot(np.array([2]), np.array([int(new * 10)])), _slot(np.array([3]), np.array([int(np.log2(b - a))])))))
    return out


def texts(data: np.ndarray, offsets: np.ndarray, shapes: bool) -> Iterator[np.ndarray]:
    """Distinct feature numbers of each text: its words, the heads of its words, and shapes if asked for."""
    for i, j in W.blocks(offsets):
        part, at_bytes = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        names, _, at, *heads = W.words(part, at_bytes, "alnum", HEADS)
        hashed = np.stack([names, *(W.mix(h + np.uint64(k)) for k, h in zip(HEADS, heads))], axis=1) >> _LOW
        more = _shapes(part, at_bytes) if shapes else None
        for k in range(j - i):
            own = hashed[at[k]:at[k + 1]].ravel()
            yield np.unique(np.concatenate((own, more[k])) if more else own).astype(np.int32)


def sample(labels: DataFrame, keep: Column, value: Column, rows: int) -> DataFrame:
    """At most ``rows`` labelled rows that ``keep`` allows: doc_id and the value, by hash of the id.

    An id with several labels has one, the least.
    """
    one = labels.where(keep & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(value).alias("value"))
    return one.where(F.col("value").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fetch(docs: DataFrame, picked: DataFrame, shapes: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value, features and feature offsets of the picked rows; at most as many rows as were picked ids.

    ``picked`` is bounded by the caller, so it is broadcast; texts stay where they are, and only
    feature numbers reach the driver. Of repeated ids one row is taken.
    """
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x.tobytes() for x in texts(*W.raw(batch.column("text")), shapes)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("value"), pa.array(rows, pa.binary())], ["doc_id", "value", "features"])

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(picked), "doc_id")
    rows = (chosen.mapInArrow(extract, "doc_id long, value int, features binary")
            .groupBy("doc_id", "value").agg(F.min("features").alias("features")).collect())
    rows.sort(key=lambda r: r.doc_id)
    at = np.concatenate(([0], np.cumsum([len(r.features) // 4 for r in rows]))).astype(np.int64)
    flat = np.frombuffer(b"".join(r.features for r in rows), np.int32)
    return np.array([r.value for r in rows], np.int64), flat, at


def sums(weights: np.ndarray, features: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of the weights of each row's features."""
    total = np.concatenate(([0.0], np.cumsum(weights[features])))
    return total[at[1:]] - total[at[:-1]]


def column_subset(keep: np.ndarray, features: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The kept features numbered anew: their old numbers, the flat list, its offsets, its rows."""
    chosen = keep[features]
    rows = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))[chosen]
    ids, flat = np.unique(features[chosen], return_inverse=True)
    return ids, flat, np.searchsorted(rows, np.arange(len(at))), rows


class Adam:
    """Steps of bounded size along a gradient."""

    def __init__(self, size: int, rate: float):
        self.value, self.rate, self.step = np.zeros(size), rate, 0
        self._m, self._v = np.zeros(size), np.zeros(size)

    def move(self, gradient: np.ndarray) -> None:
        self.step += 1
        self._m += 0.1 * (gradient - self._m)
        self._v += 0.001 * (gradient**2 - self._v)
        m, v = self._m / (1 - 0.9**self.step), self._v / (1 - 0.999**self.step)
        self.value -= self.rate * m / (np.sqrt(v) + 1e-6)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def margins(docs: DataFrame, weights: np.ndarray, shapes: bool, carry: list[str], name: str) -> DataFrame:
    """``carry`` columns and the column ``name``, the sum of a text's feature weights, for every row.

    The weights are one array of 2**BITS numbers whatever the input; no row is dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    schema = docs.select(*carry).schema.add(name, "double")
    names = schema.names

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            out = np.array([float(table[x].sum(dtype=np.float64)) for x in texts(*W.raw(text), shapes)], np.float64)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(carry))), pa.array(out)], names)

    return docs.select(*carry, F.col("text").cast("string").alias(name)).mapInArrow(score, schema)
