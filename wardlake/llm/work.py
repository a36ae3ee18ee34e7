"""Tables between the jobs of an operator, and the settings of its Python tasks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake import session
from wardlake.llm.words import mix

SKETCH_BITS = 19
FILTER_BITS = 23
_PIECES = 16
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_PIECE = "piece int, part binary"


def save(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again: cuts lineage, survives executors."""
    return save_at(df, label)[0]


def save_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``save``, and the folder, for tables that ``delete`` removes once they have been followed by the next."""
    path = session.shared_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def delete(spark: SparkSession, path: str) -> None:
    """Remove a working folder that ``save_at`` made; no plan that reads it may still be run."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def small_batches(spark: SparkSession, limit: int = 1 << 22) -> Iterator[None]:
    """Jobs that run meanwhile give Python tasks batches of ``limit`` bytes, or of one longer row.

    Spark and Python both hold a batch outside their rows, by default a whole split of texts. A lower setting stays.
    """
    before = spark.conf.get(_BATCH_BYTES)
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", before.strip().lower()).groups()
    spark.conf.set(_BATCH_BYTES, f"{min(int(number) << 10 * ' kmgtp'.index(unit or ' '), limit)}b")
    try:
        yield
    finally:
        spark.conf.set(_BATCH_BYTES, before)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it, so that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dense_sums(parts: DataFrame, add: Callable[[pa.RecordBatch, np.ndarray], None], size: int) -> np.ndarray:
    """Sum over all tasks of one array of ``size`` numbers that ``add`` fills from each batch.

    The arrays are added up piece by piece on the executors; only the sums reach the driver.
    ``size`` must not depend on the rows. Whole numbers are exact up to 2**53.
    """
    width = -(-size // _PIECES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(width * _PIECES), False
        for batch in batches:
            add(batch, total[:size])
            seen = True
        if seen:
            for piece, part in enumerate(total.reshape(_PIECES, -1)):
                spots = np.flatnonzero(part).astype("<i4")
                yield _piece(piece, spots.tobytes() + part[spots].tobytes())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = len(part) // 12
                sums.setdefault(piece, np.zeros(width))[np.frombuffer(part, "<i4", n)] += np.frombuffer(part, np.float64, n, 4 * n)
        for piece, part in sums.items():
            yield _piece(piece, part.tobytes())

    rows = parts.mapInArrow(count, _PIECE).repartition(_PIECES, "piece").mapInArrow(merge, _PIECE).collect()
    out = np.zeros((_PIECES, width))
    for row in rows:
        out[row.piece] += np.frombuffer(bytes(row.part), np.float64)
    return out.ravel()[:size]


def _piece(number: int, part: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([part], pa.binary())], ["piece", "part"])


def frequency_ranks(parts: DataFrame, add: Callable[[pa.RecordBatch, np.ndarray], None], bits: int = SKETCH_BITS) -> np.ndarray:
    """Ranks of 2**bits hash buckets by how often they occur in all rows, rarest first.

    Ties go by bucket, so the ranks are a permutation: with it, top hash bits become
    rarity, and names keep a total order.
    """
    return ranks_of(dense_sums(parts, add, 1 << bits))


def ranks_of(counts: np.ndarray) -> np.ndarray:
    ranks = np.empty(len(counts), np.uint32)
    ranks[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.uint32)
    return ranks


def bitmap(ids: DataFrame) -> np.ndarray:
    """Fixed-size bitmap of the hashes of a long column, packed to bytes.

    It only saves shuffling: rows that it lets through wrongly are dropped by the join that follows,
    and with more ids than bits it lets all rows through.
    """
    size = 1 << (FILTER_BITS - 3)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size * 8, bool)
        for batch in batches:
            bits[_slots(batch.column(0).to_numpy())] = True
        for piece, part in enumerate(np.packbits(bits).reshape(_PIECES, -1)):
            yield _piece(piece, part.tobytes())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                new = np.frombuffer(part.as_buffer(), np.uint8)
                whole[piece] = whole[piece] | new if piece in whole else new
        for piece, part in whole.items():
            yield _piece(piece, part.tobytes())

    out = np.zeros((_PIECES, size // _PIECES), np.uint8)
    for row in ids.mapInArrow(mark, _PIECE).repartition(_PIECES, "piece").mapInArrow(merge, _PIECE).collect():
        out[row.piece] |= np.frombuffer(bytes(row.part), np.uint8)
    return out.ravel()


def _slots(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def marked(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether the bitmap has each id."""
    slots = _slots(ids)
    return (bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1


def by_rank(names: np.ndarray, ranks: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Names renamed so that smaller is rarer; different names stay different."""
    low = np.uint64(64 - bits)
    return (ranks[names >> low].astype(np.uint64) << low) | (names & ((np.uint64(1) << low) - np.uint64(1)))


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of one key after another; the batches must come sorted by it. Holds one group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def in_fifths(column: str = "doc_id"):
    """crc32 of the id as text, modulo 5."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(5))
