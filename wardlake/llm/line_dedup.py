"""Exact set-similarity join of text lines; lines that match an earlier one are removed.

A line's words form a set, ordered by rarity. Sets of Jaccard likeness LINK / OF or more share a word of
their prefixes, so prefix words are indexed, and entries of one word are compared: by length,
by position (what is left after the shared word), and by a parity sketch whose differing bits are a lower
bound of the differing words; larger sets have larger sketches, so few pairs pass that are no links. What passes is
verified on the full sets. A line goes if its set occurs earlier or if an earlier line matches its
set; earlier means a smaller (doc_id, line number). All copies of a set meet in its words, so an entry knows where its
set occurs first, and a pair which is the later one.

A line takes at most FIRST_PAIRS earlier partners from each of its words. Lines that had more and are not removed by
these are compared in a second round with every earlier entry of those words, so the result is that of all
pairs, but a group of near copies does not emit all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import words as W
from wardlake.llm import work

LINK, OF = 80, 100
#: Lines without a word are no text and always stay.
MIN_WORDS = 1
#: Sets of fewer words are alike only when equal, which their names tell: they need no index entries.
MIN_INDEXED = 4
FIRST_PAIRS = 8
#: A word whose hash bucket counts more than this many words is dealt out as pairs of blocks.
HOT = 1 << 22
_FLUSH_ENTRIES = 1 << 20
#: Entries that are copied into the order of their parts at once, and bytes of blobs that leave a task together.
_SORTED_ENTRIES, _SENT_BYTES = 1 << 16, 1 << 21
#: Bytes of text that are cut into lines at once: their arrays stay in a core's cache.
_BLOCK = 1 << 17
_ENTRY = (("word", "<u4"), ("node", "<u8"), ("size", "<u4"), ("place", "<u4"), ("block", "<u8"), ("doc", "<i8"), ("line", "<i4"))
_OCCURRENCE = (("node", "<u8"), ("check", "<u4"), ("doc", "<i8"), ("line", "<i4"))
#: Sets from these sizes on have sketches of 2 and 4 numbers of 64 bits, smaller ones of one.
_TWO, _FOUR = 24, 64
_COPY, _PAIR, _OPEN = 0, 1, 2
_FOUND = "kind int, a long, b long, a_doc long, a_line int, doc long, line int, word long"


@dataclass
class Lines:
    """Lines of a block of texts: where they are, their sets (flat, rarest word first) and names of the sets."""

    row: np.ndarray
    number: np.ndarray
    at: np.ndarray
    names: np.ndarray
    mixed: np.ndarray
    size: np.ndarray
    node: np.ndarray
    check: np.ndarray


def read_lines(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray | None, words: np.ndarray | None = None) -> Lines:
    """Lines with their sets in order of rarity, or of names without ``ranks``.

    With ``words``, a bitmap, sets of lines that have none of these words are left empty.
    """
    names, starts, _ = W.words(data, offsets)
    breaks = np.flatnonzero(data == 10)
    row = np.concatenate((np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, side="right") - 1))
    begin = np.concatenate((offsets[:-1], breaks + 1))
    order = np.lexsort((begin, row))
    row, begin = row[order], begin[order]
    number = np.arange(len(row)) - np.searchsorted(row, row)
    to = np.append(np.searchsorted(starts, begin), len(starts))
    line = np.repeat(np.arange(len(row)), np.diff(to))
    if words is not None:
        has = np.zeros(len(row), bool)
        has[line[work.marked(words, W.mix(names) >> np.uint64(32))]] = True
        names, line = names[has[line]], line[has[line]]
    keys = names if ranks is None else work.by_rank(names, ranks)
    if len(row) < 1 << 16:  # one sort key: line, then the top bits of the word
        order = np.argsort((line.astype(np.uint64) << np.uint64(48)) | (keys >> np.uint64(16)))
    else:
        order = np.lexsort((keys, line))
    names, line = names[order], line[order]
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (line[1:] != line[:-1])
    names, line = names[new], line[new]
    size = np.bincount(line, minlength=len(row))
    at = np.concatenate(([0], np.cumsum(size)))
    mixed = W.mix(names)
    node, check = (np.concatenate((np.zeros(1, np.uint64), np.cumsum(x))) for x in (mixed, mixed * (mixed | np.uint64(1))))
    node = W.mix(node[at[1:]] - node[at[:-1]] + size.astype(np.uint64))
    check = W.mix(check[at[1:]] - check[at[:-1]]) >> np.uint64(33)
    return Lines(row, number, at, names, mixed, size, node, check)


def needed(n):
    return (n * LINK + OF - 1) // OF


def sketch_width(size):
    return np.where(size < _TWO, 1, np.where(size < _FOUR, 2, 4))


def entries(lines: Lines, ids: np.ndarray) -> dict[str, np.ndarray]:
    """Index entries of the prefix words of each different set of the block, where it occurs first."""
    order = np.lexsort((lines.number, ids[lines.row], lines.node))
    own = np.zeros(len(order), bool)
    own[order] = np.append(True, lines.node[order][1:] != lines.node[order][:-1])
    own &= lines.size >= MIN_INDEXED
    prefix = np.where(own, lines.size - needed(lines.size) + 1, 0)
    line = np.repeat(np.arange(len(prefix)), prefix)
    place = np.arange(len(line)) - np.repeat(np.cumsum(prefix) - prefix, prefix)
    at = lines.at[line] + place
    bits, part = np.uint64(1) << (lines.mixed & np.uint64(63)), (lines.mixed >> np.uint64(6)) & np.uint64(3)
    parity = np.zeros((4, len(bits) + 1), np.uint64)
    for k in range(4):
        np.bitwise_xor.accumulate(np.where(part == k, bits, np.uint64(0)), out=parity[k, 1:])
    sketches = {f"sketch{k}": (parity[k, lines.at[1:]] ^ parity[k, lines.at[:-1]])[line] for k in range(4)}
    return {"word": (lines.mixed[at] >> np.uint64(32)).astype("<u4"), "node": lines.node[line].astype("<u8"),
            "size": lines.size[line].astype("<u4"), "place": place.astype("<u4"), "doc": ids[lines.row[line]].astype("<i8"),
            "line": lines.number[line].astype("<i4"), "bucket": lines.names[at] >> np.uint64(64 - work.SKETCH_BITS),
            **sketches}


def pairs_of(e: dict[str, np.ndarray], wanted: np.ndarray | None) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Entries of one word each in a common order, the places in it of possible links' earlier and later
    ends, and of entries that had more partners.

    Without ``wanted`` every entry is paired with FIRST_PAIRS earlier ones at most; with it, wanted
    nodes are paired with all earlier ones.
    """
    order = np.lexsort((e["node"], e["group"]))
    group, node = e["group"][order], e["node"][order]
    new = np.ones(len(order), bool)
    new[1:] = (group[1:] != group[:-1]) | (node[1:] != node[:-1])
    copied = np.flatnonzero(~new | np.append(~new[1:], False))
    run = np.cumsum(new)[copied]
    order[copied] = order[copied][np.lexsort((e["line"][order[copied]], e["doc"][order[copied]], run))]
    order = order[new]
    order = order[np.lexsort((e["size"][order], e["group"][order]))]
    e = {k: v[order] for k, v in e.items()}
    n = len(order)
    size, place, width = e["size"].astype(np.int64), e["place"].astype(np.int64), sketch_width(e["size"])
    small = e["sketch0"] ^ e["sketch1"] ^ e["sketch2"] ^ e["sketch3"]
    middle = [e["sketch0"] ^ e["sketch2"], e["sketch1"] ^ e["sketch3"]]
    large = [e[f"sketch{k}"] for k in range(4)]
    doc, line = e["doc"], e["line"]
    # entries of one word by size: partners of the next larger sizes follow, up to ``ends``
    number = np.cumsum(np.append(True, e["group"][1:] != e["group"][:-1])) if n else np.zeros(0, np.int64)
    wide = np.int64(1) << 33
    ends = np.searchsorted(number * wide + size, number * wide + size * OF // LINK, side="right")
    found, full = np.zeros(n, np.int64), np.zeros(n, bool)
    chosen = None if wanted is None else work.marked(wanted, e["node"])
    lefts, rights = [], []
    active, step = np.arange(n), 0
    while True:
        step += 1
        active = active[active + step < ends[active]]
        if not len(active):
            break
        x, y = active, active + step
        total = size[x] + size[y]
        go = (np.minimum(place[x], place[y]) + np.minimum(size[x] - place[x], size[y] - place[y])) * (OF + LINK) >= LINK * total
        go &= np.bitwise_count(small[x] ^ small[y]).astype(np.int64) * (OF + LINK) <= (OF - LINK) * total
        x, y, total = x[go], y[go], total[go]
        for least, parts in ((2, middle), (4, large)):
            apart = sum(np.bitwise_count(p[x] ^ p[y]).astype(np.int64) for p in parts)
            go = (np.minimum(width[x], width[y]) < least) | (apart * (OF + LINK) <= (OF - LINK) * total)
            x, y, total = x[go], y[go], total[go]
        go = (doc[x] != doc[y]) | (line[x] != line[y])
        x, y = x[go], y[go]
        ahead = (doc[x] < doc[y]) | ((doc[x] == doc[y]) & (line[x] < line[y]))
        x, y = np.where(ahead, x, y), np.where(ahead, y, x)
        if wanted is None:
            go = found[y] < FIRST_PAIRS
            full[y[~go]] = True
        else:
            go = chosen[y]
        x, y = x[go], y[go]
        np.add.at(found, y, 1)
        lefts.append(x)
        rights.append(y)
    left, right = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (lefts, rights))
    return e, left, right, np.flatnonzero(full)


def _planes(column: np.ndarray) -> bytes:
    """The column's bytes, first bytes first: equal ones lie side by side and are compressed."""
    return np.ascontiguousarray(column).view(np.uint8).reshape(len(column), -1).T.tobytes()


def _column(raw: np.ndarray, n: int, kind: str) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(-1, n).T).view(kind).ravel()


def _joined(held: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """The columns of all blocks one behind the other; ``held`` is emptied, so one column at most is there twice."""
    names = list(held[0])
    e = {k: np.concatenate([h.pop(k) for h in held]) for k in names}
    held.clear()
    return e


def _by_part(e: dict[str, np.ndarray], part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray, dict[str, np.ndarray]]]:
    """Rows in the order of their parts, some parts after the other: the first one's number, their cuts and columns.

    Only these rows are copied, about _SORTED_ENTRIES of them.
    """
    part = part.astype(np.uint16 if parts < 1 << 16 else np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for i, j in W.blocks(cuts, _SORTED_ENTRIES):
        own = order[cuts[i]:cuts[j]]
        yield i, cuts[i:j + 1] - cuts[i], {k: v[own] for k, v in e.items()}


def _pack_entries(e: dict[str, np.ndarray], parts: int) -> Iterator[tuple[int, bytes]]:
    """Parts and blobs of entries: columns by bytes, then as many sketch numbers as the size asks for."""
    for first, cuts, some in _by_part(e, _group(e) % np.uint64(parts), parts):
        width = sketch_width(some["size"])
        small = some["sketch0"] ^ some["sketch1"] ^ some["sketch2"] ^ some["sketch3"]
        middle = [some["sketch0"] ^ some["sketch2"], some["sketch1"] ^ some["sketch3"]]
        for p in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[p], cuts[p + 1])
            one, two, four = (width[own] == k for k in (1, 2, 4))
            blob = [np.int64(cuts[p + 1] - cuts[p]).tobytes(), *(_planes(some[k][own]) for k, _ in _ENTRY), small[own][one].tobytes()]
            blob += [m[own][two].tobytes() for m in middle] + [some[f"sketch{k}"][own][four].tobytes() for k in range(4)]
            yield first + int(p), b"".join(blob)


def _pack_occurrences(o: dict[str, np.ndarray], parts: int) -> Iterator[tuple[int, bytes]]:
    for first, cuts, some in _by_part(o, W.mix(o["node"]) % np.uint64(parts), parts):
        for p in np.flatnonzero(np.diff(cuts)):
            yield first + int(p), b"".join(_planes(some[k][cuts[p]:cuts[p + 1]]) for k, _ in _OCCURRENCE)


def _batches(packed: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Parts and blobs in batches of about _SENT_BYTES, which is what Python and Spark hold of them outside their rows."""
    parts, blobs, held = [], [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])

    for part, blob in packed:
        parts.append(part)
        blobs.append(blob)
        held += len(blob)
        if held >= _SENT_BYTES:
            yield batch()
            parts, blobs, held = [], [], 0
    if parts:
        yield batch()


def _unpack_entries(blob) -> dict[str, np.ndarray]:
    raw = np.frombuffer(blob, np.uint8)
    n, start = int(raw[:8].view(np.int64)[0]), 8
    e = {}
    for k, kind in _ENTRY:
        stop = start + n * np.dtype(kind).itemsize
        e[k], start = _column(raw[start:stop], n, kind), stop
    width = sketch_width(e["size"])
    sketches = np.zeros((4, n), np.uint64)
    for k in (1, 2, 4):
        own = np.flatnonzero(width == k)
        stop = start + 8 * k * len(own)
        sketches[:k, own] = np.frombuffer(raw[start:stop].tobytes(), np.uint64).reshape(k, -1)
        start = stop
    return e | {f"sketch{k}": x for k, x in enumerate(sketches)}


def _group(e: dict[str, np.ndarray]) -> np.ndarray:
    return W.mix(e["word"].astype(np.uint64) + e["block"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _dealt(e: dict[str, np.ndarray], hot: np.ndarray) -> dict[str, np.ndarray]:
    """Entries of frequent words once per pair of blocks that their node belongs to."""
    blocks = hot[e.pop("bucket").astype(np.int64)]
    own = (W.mix(e["node"]) % blocks.astype(np.uint64)).astype(np.int64)
    other = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    e = {k: np.repeat(v, blocks) for k, v in e.items()} if len(other) > len(own) else e
    own = np.repeat(own, blocks)
    return e | {"block": (np.minimum(own, other) * np.int64(1 << 20) + np.maximum(own, other)).astype("<u8")}


def _copies(blobs) -> tuple[np.ndarray, np.ndarray]:
    """Documents and lines of occurrences of a set behind its first."""
    columns: dict[str, list[np.ndarray]] = {}
    for blob in blobs:
        raw = np.frombuffer(blob, np.uint8)
        n, start = len(raw) // sum(np.dtype(kind).itemsize for _, kind in _OCCURRENCE), 0
        for k, kind in _OCCURRENCE:
            stop = start + n * np.dtype(kind).itemsize
            columns.setdefault(k, []).append(_column(raw[start:stop], n, kind))
            start = stop
    node, check, doc, line = (np.concatenate(columns[k]) for k, _ in _OCCURRENCE)
    order = np.lexsort((line, doc, check, node))
    node, check, doc, line = node[order], check[order], doc[order], line[order]
    new = np.append(True, (node[1:] != node[:-1]) | (check[1:] != check[:-1]))
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (doc != doc[first]) | (line != line[first])
    return doc[later], line[later]


def _each(batches: Iterator[pa.RecordBatch], ranks: np.ndarray | None, words: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, Lines]]:
    """Ids and lines of blocks of (doc_id, text) batches."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        data, offsets = W.raw(batch.column(1))
        for i, j in W.blocks(offsets, _BLOCK):
            yield ids[i:j], read_lines(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], ranks, words)


def _found(docs: DataFrame, shared, hot, wanted: np.ndarray | None = None, cut: np.ndarray | None = None) -> DataFrame:
    """Lines that repeat an earlier set, possible links and entries that need the second round, by kind.

    The second round has the open nodes as ``wanted`` and the words in which they had more partners as ``cut``.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chosen, words = spark.sparkContext.broadcast(wanted), spark.sparkContext.broadcast(cut)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        seen: list[dict[str, np.ndarray]] = []
        n_held = n_seen = 0
        for ids, lines in _each(batches, shared.value, words.value):
            e = entries(lines, ids)
            if words.value is not None:
                some = work.marked(words.value, e["word"])
                e = {k: v[some] for k, v in e.items()}
            else:
                kept = lines.size >= MIN_WORDS
                o = {"node": lines.node[kept], "check": lines.check[kept], "doc": ids[lines.row[kept]], "line": lines.number[kept]}
                seen.append({k: o[k].astype(kind) for k, kind in _OCCURRENCE})
                n_seen += len(o["node"])
            held.append(_dealt(e, hot.value))
            n_held += len(held[-1]["word"])
            if max(n_held, n_seen) > _FLUSH_ENTRIES:
                yield from pack(held, seen)
                n_held = n_seen = 0
        if held:
            yield from pack(held, seen)

    def pack(held: list[dict[str, np.ndarray]], seen: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_pack_entries(_joined(held), 4 * parts))
        if seen:
            yield from _batches((4 * parts + p, blob) for p, blob in _pack_occurrences(_joined(seen), parts))

    def rows(kind: int, n: int, **columns: np.ndarray) -> pa.RecordBatch:
        names = ["a", "b", "a_doc", "a_line", "doc", "line", "word"]
        kinds = [pa.int32() if k.endswith("line") else pa.int64() for k in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), *(pa.array(columns[k].astype(t.to_pandas_dtype())) if k in columns else pa.nulls(n, t) for k, t in zip(names, kinds))],
            ["kind", *names])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in work.groups(batches, "part"):
            blobs = [blob.as_buffer() for blob in table.column("blob")]
            if table.column("part")[0].as_py() >= 4 * parts:
                doc, line = _copies(blobs)
                yield rows(_COPY, len(doc), doc=doc, line=line)
                continue
            several = [_unpack_entries(b) for b in blobs]
            e = {k: np.concatenate([s[k] for s in several]) for k in several[0]}
            del several, blobs
            e, x, y, more = pairs_of(e | {"group": _group(e)}, chosen.value)
            yield rows(_PAIR, len(x), a=e["node"][x].view(np.int64), b=e["node"][y].view(np.int64), a_doc=e["doc"][x], a_line=e["line"][x],
                       doc=e["doc"][y], line=e["line"][y])
            yield rows(_OPEN, len(more), a=e["node"][more].view(np.int64), word=e["word"][more])

    packed = docs.mapInArrow(index, "part int, blob binary").repartition(parts, "part").sortWithinPartitions("part")
    return work.save(packed.mapInArrow(compare, _FOUND), "line-found")


def _spot(doc, line):
    """One number for a document and a line, for bitmaps."""
    return F.shiftleft(doc, 12).bitwiseXOR(line.cast("long"))


def _beaten(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Later ends (node, doc_id, line) of the possible links whose sets are alike enough; sets are read where they first occur."""
    context = docs.sparkSession.sparkContext
    pairs = work.save(found.where(F.col("kind") == _PAIR).drop("kind", "word").distinct(), "line-pairs")
    spots = pairs.select(F.explode(F.array(_spot(F.col("a_doc"), F.col("a_line")), _spot(F.col("doc"), F.col("line")))))
    spots = context.broadcast(work.bitmap(spots))
    bits = context.broadcast(work.bitmap(pairs.select(F.explode(F.array("a", "b")))))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offsets = W.raw(batch.column(1))
            for i, j in W.blocks(offsets, _BLOCK):
                lines = read_lines(*_some_lines(ids[i:j], data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], spots.value), None)
                _, first = np.unique(lines.node, return_index=True)
                first = first[(lines.size[first] >= MIN_INDEXED) & work.marked(bits.value, lines.node[first])]
                at = np.concatenate(([0], np.cumsum(lines.size[first])))
                take = np.arange(at[-1]) + np.repeat(lines.at[first] - at[:-1], lines.size[first])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lines.node[first].view(np.int64)), W.list_array(lines.names[take].view(np.int64), at, pa.int64())], ["node", "words"])

    known = docs.mapInArrow(sets, "node long, words array<long>").groupBy("node").agg(F.min("words").alias("words"))
    known = work.save(known, "line-sets")
    both = (pairs.join(known.select(F.col("node").alias("a"), F.col("words").alias("x")), "a")
            .join(known.select(F.col("node").alias("b"), F.col("words").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y"))
    alike = both.where(common * OF >= LINK * (F.size("x") + F.size("y") - common))
    return work.save(alike.select(F.col("b").alias("node"), F.col("doc").alias("doc_id"), "line").distinct(), "line-later")


def _some_lines(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, spots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the lines whose spots are marked, as a block of one text per line."""
    breaks = np.flatnonzero(data == 10)
    row = np.concatenate((np.arange(len(ids)), np.searchsorted(offsets, breaks, side="right") - 1))
    begin = np.concatenate((offsets[:-1], breaks + 1))
    order = np.lexsort((begin, row))
    row, begin = row[order], begin[order]
    number = np.arange(len(row)) - np.searchsorted(row, row)
    length = np.append(begin[1:], len(data)) - begin
    own = work.marked(spots, (ids[row].astype(np.int64) << np.int64(12)) ^ number)
    return data[np.repeat(own, length)], np.concatenate(([0], np.cumsum(length[own])))


def removed_lines(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``lines``, the numbers (from 0) of its lines that go, for documents that lose some.

    Rows without doc_id have no place in the order: their lines neither match nor go. Rows that share a
    doc_id are one document: equal lines at one number do not match each other. Lines without a word
    are not compared.
    """
    docs = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    context = docs.sparkSession.sparkContext

    def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
        data, offsets = W.raw(batch.column(0))
        names = (W.words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])[0] for i, j in W.blocks(offsets, _BLOCK))
        buckets = [(x >> np.uint64(64 - work.SKETCH_BITS)).astype(np.int32) for x in names]
        total += np.bincount(np.concatenate(buckets), minlength=len(total)) if buckets else 0

    counts = work.dense_sums(docs.select("text"), add, 1 << work.SKETCH_BITS)
    shared = context.broadcast(work.ranks_of(counts))
    hot = context.broadcast(np.ceil(np.maximum(counts, 1) / max(HOT, counts.sum() / 1024)).astype(np.int64))
    found = _found(docs, shared, hot)
    beaten = _beaten(docs, found)
    more = found.where(F.col("kind") == _OPEN).select(F.col("a").alias("node"), "word").join(beaten, "node", "left_anti")
    more = work.save(more, "line-open")
    if not more.isEmpty():
        wanted, cut = work.bitmap(more.select("node").distinct()), work.bitmap(more.select("word").distinct())
        beaten = beaten.unionByName(_beaten(docs, _found(docs, shared, hot, wanted, cut)))
    gone = found.where(F.col("kind") == _COPY).select(F.col("doc").alias("doc_id"), "line").unionByName(beaten.select("doc_id", "line"))
    return gone.groupBy("doc_id").agg(F.collect_set("line").alias("lines"))


def dedup(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with later matching lines taken out of ``text``, and the names of two more columns.

    They hold the number of lines and how many of them went. A null text stays null and has
    no lines; see :func:`removed_lines` for the cases.
    """
    gone, total, taken = (work.fresh(docs, name) for name in ("gone_lines", "n_lines", "n_removed"))
    with work.small_batches(docs.sparkSession):
        lost = work.save(removed_lines(docs), "gone-lines").withColumnRenamed("lines", gone)
    bits = docs.sparkSession.sparkContext.broadcast(work.bitmap(lost.select("doc_id")))

    @F.pandas_udf("boolean")
    def may_lose(ids: pd.Series) -> pd.Series:
        return pd.Series(work.marked(bits.value, ids.to_numpy()))

    # only texts that may lose lines are shuffled, hashed and not sorted, by one plan at every size; the others pass by
    touched = F.col("doc_id").isNotNull() & may_lose(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)))
    joined = docs.where(touched).join(lost.hint("shuffle_hash"), "doc_id", "left").select(*docs.columns, gone)
    joined = joined.unionByName(docs.where(~touched).withColumn(gone, F.lit(None).cast("array<int>")))
    lines = F.split(F.col("text").cast("string"), "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.array_contains(gone, i))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    went = F.when(F.col(gone).isNull(), 0).otherwise(n - F.size(kept)).cast("long")
    columns = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return joined.select(*columns, n.alias(total), went.alias(taken)), total, taken


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, total, taken = dedup(work.table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col(total).alias("n_lines"), F.col(taken).alias("n_removed"), "text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their later matching lines; those of which nothing is left go."""
    out, _, taken = dedup(docs)
    out = out.where((F.col(taken) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(taken) == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
