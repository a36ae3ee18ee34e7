"""Exact Jaccard join of documents over word shingles, as a join in a metric space.

Jaccard distance is a metric. Two sets of likeness t = LINK / OF or more share one of their
rarest shingles (their prefix); the least document with a shingle in its prefix is a pivot, and
all documents with that shingle form the pivot's first region. So each linked pair meets in a
region, and no document of other text does. A region is joined by itself: pivots spread over it make
Voronoi cells, each document is also copied to the cells whose pivot is at most twice the link distance
farther than its own (the triangle inequality puts every link partner there), and cells are
joined the same way until they are small or stop shrinking. There a document is compared only
with those whose distances to all pivots differ by at most the link distance. Only a spanning
forest of the links leaves a region: links inside one component are not repeated.

Regions above BLOCK documents are dealt as pairs of blocks, so a task holds 2 * BLOCK documents.
Texts follow into a region only for documents with a possible partner there: counts of a set's
shingles over CELLS hash cells differ between two sets by no more than the sets do, so most documents
that met by one common phrase are told apart by these counts alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardlake.llm import graph
from wardlake.llm import words as W
from wardlake.llm import work

SHINGLE, LINK, OF = 5, 80, 100
BLOCK, LEAF, PIVOTS = 512, 32, 8
CELLS = 256


def needed(n):
    """Shingles that a set of n shares at least with a linked one."""
    return (n * LINK + OF - 1) // OF


def sets(text, ranks: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Each text's distinct shingles, ascending; with ``ranks``, the rarest first."""
    data, offsets = W.raw(text)
    for i, j in W.blocks(offsets):
        names, _, at = W.words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        found, to = W.shingles(names, at, SHINGLE)
        if ranks is not None:
            found = work.by_rank(found, ranks)
        for k in range(j - i):
            own = np.sort(found[to[k]:to[k + 1]])
            yield own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def linked(common: np.ndarray, n: np.ndarray, m: int) -> np.ndarray:
    return OF * common >= LINK * (n + m - common)


def cell_counts(own: np.ndarray) -> np.ndarray:
    """How many shingles fall into each hash cell, up to 255."""
    cells = (W.mix(own) >> np.uint64(56)).astype(np.int64)
    return np.minimum(np.bincount(cells, minlength=CELLS), 255).astype(np.uint8)


def possible(counts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which sets may be linked with another one: |x - y| of linked sets is a fixed part of |x| + |y| at most."""
    out = np.zeros(len(size), bool)
    wide = counts.astype(np.int16)
    for x in range(len(size) - 1):
        if out[x] and out[x + 1:].all():
            continue
        apart = np.abs(wide[x + 1:] - wide[x]).sum(1, dtype=np.int64)
        near = (OF + LINK) * np.maximum(apart, np.abs(size[x + 1:] - size[x])) <= (OF - LINK) * (size[x + 1:] + size[x])
        if near.any():
            out[x] = True
            out[x + 1:] |= near
    return out


def join_region(members: list[np.ndarray]) -> np.ndarray:
    """Component of each set, as the least index in it, over all links between the given sets."""
    m = len(members)
    label = np.arange(m)
    if m < 2:
        return label
    size = np.array([len(x) for x in members])
    at = np.concatenate(([0], np.cumsum(size)))
    kinds, flat = np.unique(np.concatenate(members), return_inverse=True)
    order = np.argsort(flat, kind="stable")
    owners = np.repeat(np.arange(m), size)[order]
    post = np.searchsorted(flat[order], np.arange(len(kinds) + 1))
    eps = (OF - LINK) / OF + 1e-12

    def common(x: int) -> np.ndarray:
        """Shingles that each member shares with x."""
        own = flat[at[x]:at[x + 1]]
        starts, counts = post[own], post[own + 1] - post[own]
        to = np.concatenate(([0], np.cumsum(counts)))
        return np.bincount(owners[np.arange(to[-1]) + np.repeat(starts - to[:-1], counts)], minlength=m)

    def unite(x: int, ids: np.ndarray, shared: np.ndarray) -> None:
        for y in np.unique(label[ids[linked(shared[ids], size[ids], size[x])]]):
            if y != label[x]:
                low, high = min(y, label[x]), max(y, label[x])
                label[label == high] = low

    def close(ids: np.ndarray, known: list[np.ndarray]) -> None:
        """Join ``ids``; ``known`` has distances of all members to the pivots so far."""
        if len(np.unique(label[ids])) == 1:
            return
        if len(ids) > LEAF:
            rows, nearest, x = [], np.full(len(ids), np.inf), ids[0]
            for _ in range(PIVOTS):
                shared = common(x)
                unite(x, ids, shared)
                far = 1 - shared / np.maximum(size + size[x] - shared, 1)
                rows.append(far)
                nearest = np.minimum(nearest, far[ids])
                if nearest.max() == 0:
                    break
                x = ids[int(np.argmax(nearest))]
            apart = np.stack(rows)[:, ids]
            cells = [ids[row <= apart.min(0) + 2 * eps] for row in apart]
            known = [*known, *rows]
            if max(len(c) for c in cells) <= 0.8 * len(ids):
                for cell, home in zip(cells, range(len(cells))):
                    if (apart.argmin(0) == home).any():
                        close(cell, known)
                return
        table = np.stack(known)[:, ids] if known else np.zeros((1, len(ids)))
        for k, x in enumerate(ids[:-1]):
            rest = ids[k + 1:]
            near = (np.abs(table[:, k + 1:] - table[:, k:k + 1]).max(0) <= eps) & (label[rest] != label[x])
            near &= (size[rest] * LINK <= OF * size[x]) & (size[x] * LINK <= OF * size[rest])
            if near.any():
                unite(x, rest[near], common(x))

    close(np.arange(m), [])
    return label


def _prepare(docs: DataFrame) -> DataFrame:
    """Set size, set signature and prefix (rarest shingles) of every document."""
    def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
        data, offsets = W.raw(batch.column(0))
        for i, j in W.blocks(offsets):
            names, _, at = W.words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            found = W.shingles(names, at, SHINGLE)[0] >> np.uint64(64 - work.SKETCH_BITS)
            total += np.bincount(found.astype(np.int64), minlength=len(total))

    ranks = work.frequency_ranks(docs.select("text"), add)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, signatures, prefixes, cells = [], [], [], []
            for own in sets(batch.column(1), shared.value):
                sizes.append(len(own))
                signatures.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                cells.append(cell_counts(own).tobytes())
                prefixes.append(own[:len(own) - needed(len(own)) + 1] if len(own) else own)
            at = np.concatenate(([0], np.cumsum([len(x) for x in prefixes])))
            flat = np.concatenate(prefixes).view(np.int64) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), pa.array(cells, pa.binary()), W.list_array(flat, at, pa.int64())],
                ["doc_id", "n_shingles", "signature", "cells", "prefix"])

    return work.save(docs.mapInArrow(describe, "doc_id long, n_shingles long, signature binary, cells binary, prefix array<long>"), "sets")


def links(docs: DataFrame, prepared: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between documents of different sets that connect the same documents as all links do."""
    one = (prepared.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
           .groupBy("signature").agg(F.min(F.struct("doc_id", "prefix")).alias("one")))
    index = one.select(F.col("one.doc_id").alias("doc_id"), F.explode("one.prefix").alias("shingle"))
    pivot = F.min("doc_id").over(Window.partitionBy("shingle")).alias("pivot")
    near = work.save(index.select("doc_id", pivot).where(F.col("doc_id") != F.col("pivot")).distinct(), "regions")
    members = near.unionByName(near.select(F.col("pivot").alias("doc_id"), "pivot").distinct())
    sizes = near.groupBy("pivot").agg(F.ceil((F.count("doc_id") + 1) / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    dealt = (members.join(sizes, "pivot")
             .select("doc_id", "pivot", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("doc_id", F.xxhash64("pivot", F.least("own", "other"), F.greatest("own", "other")).alias("region")))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in work.groups(batches, "region"):
            counts = np.frombuffer(b"".join(group.column("cells").to_pylist()), np.uint8).reshape(-1, CELLS)
            keep = possible(counts, group.column("n_shingles").to_numpy())
            if keep.any():
                yield from group.select(["region", "doc_id"]).filter(pa.array(keep)).to_batches()

    digests = prepared.where(F.col("n_shingles") > 0).select("doc_id", "n_shingles", "cells")
    met = dealt.join(digests, "doc_id").select("region", "doc_id", "n_shingles", "cells").repartition("region").sortWithinPartitions("region")
    dealt = work.save(met.mapInArrow(sift, "region long, doc_id long").distinct(), "possible")
    wanted = docs.sparkSession.sparkContext.broadcast(work.bitmap(dealt.select("doc_id")))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(work.marked(wanted.value, batch.column(0).to_numpy())))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in work.groups(batches, "region"):
            ids = group.column("doc_id").to_numpy()
            label = join_region(list(sets(group.column("text"))))
            least = np.full(len(ids), np.iinfo(np.int64).max)
            np.minimum.at(least, label, ids)
            found = least[label]
            other = found != ids
            if other.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[other]), pa.array(found[other])], ["a", "b"])

    chosen = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(pick, "doc_id long, text string")
    placed = chosen.join(dealt, "doc_id").select("region", "doc_id", "text").repartition("region").sortWithinPartitions("region")
    return placed.mapInArrow(compare, "a long, b long")


def join(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``docs``.

    A set holds the distinct SHINGLE-word runs of a text, or all its words if they are fewer. A null
    or wordless text has none and is linked with nothing: its component is its own id. Equal sets are one
    class and are compared once. Rows with one doc_id are one document with several texts; a
    row without doc_id can not be linked and has no component. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    prepared = _prepare(docs)
    joined = graph.components(links(docs, prepared))
    alone = prepared.where(F.col("doc_id").isNull() | (F.col("n_shingles") == 0)).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    real = prepared.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).select("doc_id", "n_shingles", "signature")
    classes = real.groupBy("signature").agg(F.min("doc_id").alias("first"))
    named = (classes.join(joined, F.col("first") == F.col("node"), "left")
             .select("signature", F.coalesce("component", "first").alias("component_id")))
    return real.join(named, "signature").select("doc_id", "n_shingles", "component_id").unionByName(alone)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(work.table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, that with the least id; documents without words or id stay."""
    found = join(docs)
    losers = found.where((F.col("n_shingles") > 0) & (F.col("component_id") < F.col("doc_id"))).select("doc_id").distinct()
    return docs.join(losers, "doc_id", "left_anti").select(*docs.columns)
