"""SentencePiece merges with seeded dropout, and their exact inverse.

A text is encoded with a leading space; spaces become the visible mark. Merges run over an
agenda of adjacent pairs, best score first, leftmost on ties. A candidate that comes up is skipped for
good when a keyed hash of seed, stream, unit, place and merged piece falls below the
dropout rate; a skipped pair can only be met again as part of other pieces. With rate 0 the result is the
model's own segmentation. What the vocabulary lacks is written as bytes, so decoding returns every text.

Merges never cross a space that follows another character, so units (spaces and the word behind them) are
independent; those met before are kept in a bounded cache. New units of a block of texts are merged together: every row
of a matrix is a unit's agenda, and a round takes the next candidate of each. Long units have a heap each. The stream is one of STREAMS, chosen by the
document's id: the same word is cut differently in documents of different streams and under other seeds.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from wardlake.llm import words as W
from wardlake.llm import work

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED, DROPOUT, STREAMS = 20240501, 0.1, 4
CACHE_UNITS, CACHED_LENGTH = 600_000, 64
#: Units that are merged together.
_ROWS = 1 << 13
MARK = "▁"
_UNIT = re.compile(r" *[^ ]+| +")
#: Stands for a mark that the text itself has; no piece contains it.
_LITERAL = "\0" + MARK


class Vocabulary:
    """Pieces with scores, and the ids of the byte pieces."""

    def __init__(self, pieces: list[str], scores: list[float], is_byte: list[bool], control: list[bool]):
        self.ids = {p: i for i, p in enumerate(pieces) if not is_byte[i] and not control[i]}
        self.scores = {p: scores[i] for p, i in self.ids.items()}
        self.hashes = {p: crc32(p.encode()) for p in self.ids}
        self.bytes = {int(pieces[i][3:5], 16): i for i in range(len(pieces)) if is_byte[i]}
        self.raw = [bytes([int(p[3:5], 16)]) if is_byte[i] else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        if len(self.bytes) != 256 or len(pieces) > 65536:
            raise ValueError("a model with 256 byte pieces and at most 65536 pieces is needed")


def load(path: str = MODEL) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    return Vocabulary([model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)],
                      [model.is_byte(i) for i in range(n)], [model.is_control(i) or model.is_unknown(i) for i in range(n)])


def keyed_skip(seed: int, stream: int, rate: float, vocabulary: Vocabulary) -> Callable[[int, int, str], bool] | None:
    """Whether a candidate is dropped, from the unit's hash, its place and the merged piece."""
    if rate <= 0:
        return None
    start, limit, hashes = crc32(f"{seed}:{stream}".encode()), int(rate * 2**32), vocabulary.hashes

    def skip(unit: int, place: int, piece: str) -> bool:
        x = ((unit ^ start) + hashes[piece] * 0x9E3779B1 + place * 0x85EBCA6B) & 0xFFFFFFFF
        x = ((x ^ (x >> 16)) * 0xC2B2AE35) & 0xFFFFFFFF
        return x ^ (x >> 15) < limit

    return skip


class Merges:
    """Merges of many short units at once; symbols are piece ids and, behind them, numbers of other characters."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, ids = vocabulary, vocabulary.ids
        self.n = len(vocabulary.raw)
        symbols = dict(ids)
        for c in {c for p in ids for c in p}:
            symbols.setdefault(c, len(symbols) - len(ids) + self.n)
        #: The symbol of what is in no piece; nothing merges with it.
        self.other = np.int64(len(symbols) - len(ids) + self.n)
        self.chars = np.full(0x110000, self.other, np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.chars[ord(c)] = i
        self.chars[ord(" ")], self.chars[ord(MARK)] = self.chars[ord(MARK)], self.other
        values, rank = np.unique(np.array([vocabulary.scores[p] for p in ids]), return_inverse=True)
        #: By piece, the rank of its score from 1; 0 is no candidate.
        self.rank = np.zeros(self.n + 1, np.int32)
        self.rank[list(ids.values())] = rank + 1
        self.hashes = np.zeros(self.n + 1, np.uint64)
        self.hashes[list(ids.values())] = [vocabulary.hashes[p] for p in ids]
        pairs = {(symbols[p[:k]], symbols[p[k:]]): i for p, i in ids.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols}
        keys = np.array([a * (self.other + 1) + b for a, b in pairs], np.int64)
        self._bits = max(4, int(len(keys)).bit_length() + 3)
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._merged = np.full(1 << self._bits, self.n, np.int32)
        slots, found, todo = self._slots(keys), np.array(list(pairs.values()), np.int32), np.arange(len(keys))
        while len(todo):
            free = todo[self._keys[slots[todo]] < 0]
            self._keys[slots[free]] = keys[free]
            done = todo[self._keys[slots[todo]] == keys[todo]]
            self._merged[slots[done]] = found[done]
            todo = todo[self._keys[slots[todo]] != keys[todo]]
            slots[todo] = (slots[todo] + 1) & (len(self._keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols make, or ``n``."""
        keys = left.astype(np.int64) * (self.other + 1) + right
        slots = self._slots(keys)
        there = self._keys[slots]
        out = np.where(there == keys, self._merged[slots], np.int32(self.n))
        todo = np.flatnonzero((there != keys) & (there >= 0))
        while len(todo):
            slots[todo] = (slots[todo] + 1) & (len(self._keys) - 1)
            there = self._keys[slots[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self._merged[slots[todo[hit]]]
            todo = todo[~hit & (there >= 0)]
        return out

    def encode(self, units: list[str], start: int, limit: int) -> list[bytes]:
        """Piece ids of units, in 16 bits each, with the start and limit of the keyed hash."""
        length = np.array([len(u) for u in units])
        m, wide = len(units), int(length.max())
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        inside = np.arange(wide) < length[:, None]
        symbols = np.full((m, wide), self.other, np.int32)
        symbols[inside] = self.chars[points]
        place = np.broadcast_to(np.arange(wide, dtype=np.int8), (m, wide)).copy()
        made = np.full((m, wide), self.n, np.int32)
        if wide > 1:
            made[:, :-1] = self.merged(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(m, -1)
        agenda = self.rank[made]
        names = np.array([crc32(u.encode()) for u in units], np.uint64) ^ np.uint64(start)
        out_symbols, out_place, out_length = symbols, place, length
        rows, column = np.arange(m), np.arange(wide)
        low = np.uint64(0xFFFFFFFF)
        while True:
            at = agenda.argmax(1)
            each = np.arange(len(rows))
            alive = agenda[each, at] > 0
            if not alive.all():
                ended = rows[~alive]
                out_symbols[ended], out_place[ended], out_length[ended] = symbols[~alive], place[~alive], length[~alive]
                rows, at, names, length = rows[alive], at[alive], names[alive], length[alive]
                symbols, place, made, agenda = symbols[alive], place[alive], made[alive], agenda[alive]
                each = each[:len(rows)]
            if not len(rows):
                break
            piece = made[each, at]
            x = (names + self.hashes[piece] * np.uint64(0x9E3779B1) + place[each, at].astype(np.uint64) * np.uint64(0x85EBCA6B)) & low
            x = ((x ^ (x >> np.uint64(16))) * np.uint64(0xC2B2AE35)) & low
            skip = x ^ (x >> np.uint64(15)) < np.uint64(limit)
            agenda[each[skip], at[skip]] = 0
            go, i = each[~skip], at[~skip]
            if not len(go):
                continue
            symbols[go, i] = piece[~skip]
            gap = np.full(len(rows), wide)
            gap[go] = i
            gap = gap[:, None]
            for x, behind in ((symbols, column[:-1] > gap), (place, column[:-1] > gap), (made, column[:-1] >= gap), (agenda, column[:-1] >= gap)):
                np.copyto(x[:, :-1], x[:, 1:].copy(), where=behind)
            length[go] -= 1
            for go, i in ((go[i > 0], i[i > 0] - 1), (go[i + 1 < length[go]], i[i + 1 < length[go]]), (go[i + 1 >= length[go]], None)):
                if i is None:
                    last = length[go] - 1
                    made[go, last], agenda[go, last] = self.n, 0
                else:
                    made[go, i] = self.merged(symbols[go, i], symbols[go, i + 1])
                    agenda[go, i] = self.rank[made[go, i]]
        plain = (out_symbols < self.n) | (column >= out_length[:, None])
        flat, step = np.where(out_symbols < self.n, out_symbols, 0).astype(np.uint16).tobytes(), 2 * wide
        out = [flat[k * step:k * step + 2 * n] for k, n in enumerate(out_length.tolist())]
        for k in np.flatnonzero(~plain.all(1)):
            ids: list[int] = []
            for symbol, p in zip(out_symbols[k, :out_length[k]].tolist(), out_place[k].tolist()):
                ids.extend([symbol] if symbol < self.n else [self.vocabulary.bytes[b] for b in units[k][p].encode()])
            out[k] = array("H", ids).tobytes()
        return out


def _merge(parts: list[str | None], scores: dict[str, float], skip: Callable[[int, int, str], bool] | None, name: int) -> list[str]:
    """The agenda of a unit with a heap and linked places."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda = []
    for i in range(n - 1):
        piece = parts[i] + parts[i + 1]
        if piece in scores:
            agenda.append((-scores[piece], i, i + 1, piece))
    heapq.heapify(agenda)
    while agenda:
        _, left, right, piece = heapq.heappop(agenda)
        if parts[left] is None or parts[right] is None or after[left] != right or parts[left] + parts[right] != piece:
            continue
        if skip and skip(name, left, piece):
            continue
        parts[left], parts[right] = piece, None
        end = after[left] = after[right]
        if end < n:
            before[end] = left
            more = piece + parts[end]
            if more in scores:
                heapq.heappush(agenda, (-scores[more], left, end, more))
        start = before[left]
        if start >= 0:
            more = parts[start] + piece
            if more in scores:
                heapq.heappush(agenda, (-scores[more], start, left, more))
    return [p for p in parts if p is not None]


def encode_unit(unit: str, vocabulary: Vocabulary, skip: Callable[[int, int, str], bool] | None) -> list[int]:
    """Piece ids of one unit."""
    parts = [MARK if c == " " else _LITERAL if c == MARK else c for c in unit] if " " in unit or MARK in unit else list(unit)
    ids = vocabulary.ids
    out: list[int] = []
    for part in _merge(parts, vocabulary.scores, skip, crc32(unit.encode()) if skip else 0):
        known = ids.get(part)
        if known is not None:
            out.append(known)
        else:
            out.extend(vocabulary.bytes[b] for b in (MARK if part == _LITERAL else part).encode())
    return out


class Encoder:
    """Encodes texts of all streams with a bounded cache of units."""

    def __init__(self, vocabulary: Vocabulary, seed: int = SEED, rate: float = DROPOUT):
        self.vocabulary, self.seed, self.rate = vocabulary, seed, rate
        self._merges = Merges(vocabulary)
        self._caches: dict[int, dict[str, bytes]] = {}
        self._held = 0

    def encode(self, text: str, stream: int) -> np.ndarray:
        return self.encode_all([text], [stream])[0]

    def encode_all(self, texts: list[str], streams: list[int]) -> list[np.ndarray]:
        """Ids of each text as 16-bit numbers; none for an empty text."""
        if self._held > CACHE_UNITS:
            self._caches.clear()
            self._held = 0
        cut = [_UNIT.findall(" " + t) if t else [] for t in texts]
        new: dict[int, set[str]] = {}
        for units, stream in zip(cut, streams):
            new.setdefault(stream, set()).update(set(units).difference(self._caches.setdefault(stream, {})))
        long = [(stream, u) for stream, units in new.items() for u in self._add(stream, units)]
        out = [np.frombuffer(b"".join(map(self._caches[stream].__getitem__, units)), np.uint16) for units, stream in zip(cut, streams)]
        for stream, unit in long:
            del self._caches[stream][unit]
        return out

    def _add(self, stream: int, units: set[str]) -> list[str]:
        """Put units into the stream's cache; those too long to stay there are returned."""
        cache, skip = self._caches[stream], keyed_skip(self.seed, stream, self.rate, self.vocabulary)
        long = [u for u in units if len(u) > CACHED_LENGTH]
        short = sorted((u for u in units if len(u) <= CACHED_LENGTH), key=len)
        for i in range(0, len(short), _ROWS):
            rows = short[i:i + _ROWS]
            cache.update(zip(rows, self._merges.encode(rows, crc32(f"{self.seed}:{stream}".encode()), int(max(self.rate, 0) * 2**32))))
        for unit in long:
            cache[unit] = array("H", encode_unit(unit, self.vocabulary, skip)).tobytes()
        self._held += len(short)
        return long

    def decode(self, ids: np.ndarray) -> str:
        return decode(ids, self.vocabulary)


#: The encoder of a Python worker; workers serve task after task and keep its cache.
_encoders: dict[tuple, Encoder] = {}


def _encoder(vocabulary: Vocabulary, key: tuple, seed: int, rate: float) -> Encoder:
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary, seed, rate)
    return _encoders[key]


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of a segmentation, whichever merges made it."""
    return b"".join(map(vocabulary.raw.__getitem__, ids.tolist()))[1:].decode()


def encode(docs: DataFrame, carry: list[str], path: str = MODEL, seed: int = SEED, rate: float = DROPOUT) -> DataFrame:
    """``carry`` columns, ``stream``, ``n_pieces``, ``pieces`` (ids) and ``lossless`` for every row.

    ``lossless`` says that the pieces, decoded, are the text again. A null text has no pieces, like
    an empty one. A null id belongs to stream 0; repeated rows are cut alike.
    """
    shared, key = docs.sparkSession.sparkContext.broadcast(load(path)), (path, seed, rate)
    stream = F.coalesce(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)), F.lit(STREAMS)).cast("int"), F.lit(0))
    rows = docs.select(*carry, F.when(F.col("doc_id").isNull(), 0).otherwise(stream).alias("stream"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text_"))
    schema = rows.drop("text_").schema.add("n_pieces", "long").add("pieces", ArrayType(IntegerType())).add("lossless", "boolean")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, key, seed, rate)
        for batch in batches:
            n = batch.num_columns
            streams, texts = batch.column(n - 2).to_pylist(), batch.column(n - 1)
            for start, stop in W.blocks(W.raw(texts)[1], 1 << 22):
                block = texts.slice(start, stop - start).to_pylist()
                ids = encoder.encode_all(block, streams[start:stop])
                exact = [decode(x, encoder.vocabulary) == t for x, t in zip(ids, block)]
                counts = np.array([len(x) for x in ids], np.int64)
                at = np.concatenate(([0], np.cumsum(counts)))
                kept = [batch.column(i).slice(start, stop - start) for i in range(n - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(counts), W.list_array(np.concatenate(ids).astype(np.int32), at, pa.int32()), pa.array(exact)],
                    [*schema.names])

    return rows.mapInArrow(cut, schema)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(work.table(spark, sf_dir, "documents"), ["doc_id"])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document, by doc_id and source."""
    return encode(docs, ["doc_id", "source"])
