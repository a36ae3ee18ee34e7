"""Words of whole texts as 64-bit names, for whole Arrow batches at once.

A word is a maximal run of bytes of a class; A-Z are folded first. Its name is a
polynomial hash of its bytes, mixed. Texts are handled in blocks of bounded bytes, so memory
does not grow with the batch; a single longer text makes a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19
U = np.uint64
_RADIX = U(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> U(33))
    h = h * _MIX1
    h = h ^ (h >> U(33))
    h = h * _MIX2
    return h ^ (h >> U(33))


def _byte_table(keep: np.ndarray) -> np.ndarray:
    """A name per byte value, 0 outside the class, equal for A-Z and a-z."""
    byte = np.arange(256, dtype=np.uint64)
    byte[65:91] += U(32)
    names = mix(byte * _RADIX + U(0x1234567))
    return np.where(keep, names, U(0))


_ALL = np.arange(256)
#: Not white space: everything but \x20 and \x09-\x0D.
PRINTED = ~((_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13)))
#: Letters, digits and all that is not ASCII.
ALNUM = (_ALL >= 128) | ((_ALL >= 48) & (_ALL <= 57)) | ((_ALL >= 65) & (_ALL <= 90)) | ((_ALL >= 97) & (_ALL <= 122))
TABLES = {"printed": (PRINTED, _byte_table(PRINTED)), "alnum": (ALNUM, _byte_table(ALNUM))}

_powers = np.ones(1, np.uint64)
_ODD = _RADIX | U(1)
_INVERSE = U(pow(int(_ODD), -1, 1 << 64))
#: Blocks up to this size are hashed by running sums over powers and inverse powers of all places.
_SUMMED = 1 << 20
_place_powers: list[np.ndarray] = []


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 256), _RADIX | U(1), np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers


def _places(n: int) -> list[np.ndarray]:
    """Powers of the radix and of its inverse for the places of a block of n bytes."""
    if not _place_powers or len(_place_powers[0]) < n:
        steps = np.full((2, max(n, BLOCK_BYTES)), _ODD, np.uint64)
        steps[1], steps[:, 0] = _INVERSE, 1
        _place_powers[:] = np.cumprod(steps, axis=1)
    return _place_powers


def raw(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, count=column.offset + len(column) + 1)[column.offset:]
    data = np.frombuffer(buffers[2] or b"", np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = j


def words(data: np.ndarray, offsets: np.ndarray, kind: str = "printed",
          heads: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray, *tuple[np.ndarray, ...]]:
    """Names and start bytes of all words, and the n + 1 offsets of the rows in them.

    For each length in ``heads`` the names of the words' first bytes follow.
    """
    keep, table = TABLES[kind]
    kept = keep[data]
    first = kept.copy()
    first[1:] &= ~kept[:-1]
    edges = offsets[:-1]
    edges = edges[edges < len(data)]
    first[edges] = kept[edges]
    starts = np.flatnonzero(first)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, starts, np.zeros(len(offsets), np.int64), *[none for _ in heads]
    to = np.searchsorted(starts, offsets)
    if len(data) <= _SUMMED:
        powers, inverse = _places(len(data))
        sums = np.cumsum(table[data] * powers[:len(data)])
        before = np.where(starts > 0, sums[starts - 1], U(0))
        ends = np.append(starts[1:], len(data)) - 1
        names = [mix((sums[np.minimum(ends, starts + n - 1) if n else ends] - before) * inverse[starts]) for n in (0, *heads)]
        return names[0], starts, to, *names[1:]
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    # bytes after a word's end up to the next word have the name 0 and add nothing
    parts = table[data[starts[0]:]] * _power_table(int(lengths.max()))[place]
    names = [mix(np.add.reduceat(np.where(place < n, parts, U(0)) if n else parts, starts - starts[0])) for n in (0, *heads)]
    return names[0], starts, to, *names[1:]


def shingles(names: np.ndarray, at: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Names of all runs of ``size`` words and the row offsets in them.

    A row of fewer words, but not none, has one run of all its words.
    """
    counts = np.diff(at)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    to = np.concatenate(([0], np.cumsum(n)))
    if not to[-1]:
        return np.zeros(0, np.uint64), to
    start = np.arange(to[-1]) - np.repeat(to[:-1] - at[:-1], n)
    have = np.repeat(np.minimum(counts, size), n)
    out = have.astype(np.uint64)
    for k in range(size):
        at_k = np.minimum(start + k, len(names) - 1)
        part = mix(names[at_k] + U((k + 1) * int(_RADIX) & 0xFFFFFFFFFFFFFFFF))
        out = out * (_RADIX | U(1)) + np.where(k < have, part, U(0))
    return mix(out), to


def list_array(values: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values, kind))
