"""Document fingerprints by locally consistent parsing.

A text's bytes are the first symbols. On each level runs of one symbol become one; deterministic coin
tossing then labels every symbol by the lowest bit in which it differs from the one before, and again on
the labels until six are left; local maxima of the labels start phrases, and a phrase's name is a
hash of its symbols. A phrase's borders depend on a few symbols around it only, so a substring is cut
into the same phrases wherever it stands, but for its ends. A fingerprint holds the least names of
the phrases of LEVELS.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import words as W
from wardlake.llm import work

#: Levels whose phrases count (about 10 and 30 bytes long) and how many names a fingerprint keeps.
LEVELS, KEPT = (2, 3), 64
_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTES = W.mix(np.arange(256, dtype=np.uint64) + np.uint64(0xABCDEF))


def _before(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The symbol before each one; a row's first symbol gets one that differs in the lowest bit."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[first] = x[first] ^ x.dtype.type(1)
    return out


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """2 * place + value of the lowest bit in which each symbol differs from the one before."""
    differ = x ^ _before(x, first)
    low = differ & (~differ + x.dtype.type(1))
    place = np.bitwise_count(low - x.dtype.type(1))
    return (2 * place + ((x & low) != 0)).astype(np.uint8)


def parse(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of each row of symbols, and the row offsets in them."""
    if not len(symbols):
        return symbols, at
    edges = at[:-1][np.diff(at) > 0]
    change = np.empty(len(symbols), bool)
    change[1:] = symbols[1:] != symbols[:-1]
    change[edges] = True
    starts = np.flatnonzero(change)
    if len(starts) < len(symbols):
        lengths = np.diff(np.append(starts, len(symbols)))
        single = symbols[starts]
        symbols = np.where(lengths > 1, W.mix(single + lengths.astype(np.uint64) * _R), single)
        at = np.searchsorted(starts, at)
        edges = at[:-1][np.diff(at) > 0]
    labels = _toss(symbols, edges)
    for _ in range(3):
        labels = _toss(labels, edges)
    peak = np.ones(len(labels), bool)
    peak[1:] = labels[1:] > labels[:-1]
    peak[:-1] &= labels[:-1] >= labels[1:]
    peak[edges] = True
    starts = np.flatnonzero(peak)
    lengths = np.diff(np.append(starts, len(symbols)))
    place = np.arange(len(symbols)) - np.repeat(starts, lengths)
    names = np.add.reduceat(symbols * W._power_table(int(lengths.max()))[place], starts)
    return W.mix(names + lengths.astype(np.uint64) * _R), np.searchsorted(starts, at)


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """The KEPT least 32-bit names of each text's phrases, ascending; none for an empty text."""
    out: list[np.ndarray] = []
    data, offsets = W.raw(pa.array(texts, pa.large_string()))
    for i, j in W.blocks(offsets):
        symbols, at = _BYTES[data[offsets[i]:offsets[j]]], offsets[i:j + 1] - offsets[i]
        found, ats = [], []
        for level in range(1, max(LEVELS) + 1):
            symbols, at = parse(symbols, at)
            if level in LEVELS:
                found.append((W.mix(symbols + np.uint64(level)) >> np.uint64(32)).astype(np.uint32))
                ats.append(at)
        for k in range(j - i):
            own = np.sort(np.concatenate([f[a[k]:a[k + 1]] for f, a in zip(found, ats)]))
            out.append(own[np.append(True, own[1:] != own[:-1])][:KEPT] if len(own) else own)
    return out


def shown(names: np.ndarray) -> str:
    return names.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of the phrases, estimated from the least names of both; 1 for two empty texts."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate((a, b)))
    twice = both[1:] == both[:-1]
    union = len(both) - twice.sum()
    if union <= KEPT:
        return float(twice.sum() / union)
    distinct = both[np.append(True, ~twice)]
    limit = distinct[KEPT - 1]
    return float((both[1:][twice] <= limit).sum() / KEPT)


def edited(text: str, other: str) -> str:
    """``text`` with the last half of its code points replaced by as many first ones of ``other``, or all."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in ranges of ids, each range in descending order, followed by the row after its last.

    Bounds come from approximate quantiles of the ids, so ranges hold like numbers of rows;
    the head of each range is copied to the range above, and the head of all to the lowest range. Columns:
    part, border (the copied row), doc_id, text. Rows without id come last; equal ids go by text hash.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = F.lit(-(2**63)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("at", F.coalesce("doc_id", least))
    shares = [i / (4 * parts) for i in range(1, 4 * parts)]
    bounds = np.unique(np.array(rows.select("doc_id").approxQuantile("doc_id", shares, 1 / (16 * parts)) or [0.0]).astype(np.int64))

    @F.pandas_udf("int")
    def part_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, at.to_numpy(), side="right").astype(np.int32))

    heads = sorted((r.part, r.head) for r in rows.select(part_of("at").alias("part"), "at").groupBy("part").agg(F.max("at").alias("head")).collect())
    tops = np.array([head for _, head in heads], np.int64)
    above = np.array([heads[(i + 1) % len(heads)][0] for i in range(len(heads))], np.int32)

    @F.pandas_udf("int")
    def copy_of(at: pd.Series) -> pd.Series:
        """The part that needs a copy of this head, -1 for other rows."""
        i = np.minimum(np.searchsorted(tops, at.to_numpy()), len(tops) - 1)
        return pd.Series(np.where(tops[i] == at.to_numpy(), above[i], -1).astype(np.int32))

    own = F.struct(F.col("part"), F.lit(False).alias("border"))
    copies = F.when(F.col("copy") >= 0, F.array(own, F.struct(F.col("copy").alias("part"), F.lit(True).alias("border")))).otherwise(F.array(own))
    dealt = rows.withColumn("part", part_of("at")).withColumn("copy", copy_of("at")).withColumn("to", F.explode(copies))
    return (dealt.select("to.part", "to.border", "doc_id", "text", "at").repartition(parts, "part")
            .sortWithinPartitions("part", "border", F.desc("at"), F.xxhash64("text")).drop("at"))


def run_rows(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs``, of its edited text, and likenesses to that and to the next row.

    A null text is empty. The row after one is that with the next lower id, after the last the first; a
    single row follows itself. Equal ids are ordered by a hash of their texts, rows without id come last.
    """
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def emit(held: list[tuple], following: list[tuple]) -> pa.RecordBatch:
        changed = [edited(h[3], f[3]) for h, f in zip(held, following)]
        marks = fingerprints(changed)
        return pa.RecordBatch.from_arrays([
            pa.array([h[2] for h in held], pa.int64()), pa.array([len(h[3]) for h in held], pa.int64()),
            pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]), pa.array([shown(h[4]) for h in held]),
            pa.array([shown(m) for m in marks]), pa.array([likeness(h[4], m) for h, m in zip(held, marks)], pa.float64()),
            pa.array([likeness(h[4], f[4]) for h, f in zip(held, following)], pa.float64())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for batch in batches:
            offsets = W.raw(batch.column(3))[1]
            for i, j in W.blocks(offsets, 1 << 22):
                piece = batch.slice(i, j - i)
                texts = piece.column(3).to_pylist()
                rows = list(zip(*(piece.column(k).to_pylist() for k in range(3)), texts, fingerprints(texts)))
                line = ([last] if last else []) + rows
                pairs = [(a, b) for a, b in zip(line, line[1:]) if not a[1] and a[0] == b[0]]
                if pairs:
                    yield emit([p[0] for p in pairs], [p[1] for p in pairs])
                last = line[-1] if line else None

    return with_next(docs).mapInArrow(walk, schema)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_rows(work.table(spark, sf_dir, "documents"))
