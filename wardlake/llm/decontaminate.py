"""Benchmark decontamination over a positional inverted index.

Terms are ordered by how often they occur in the documents. Of each benchmark window the LEADS
rarest positions are kept; the index stores document, term and position of every occurrence of
those terms. A posting at p of the term at item position q speaks for the alignment p - q of document and
item, so lists are intersected by counting the item positions that speak for one alignment. An
alignment with as many as a window has leads is read word by word in the document's full
list, which is stored for such documents alone. Proximity matches are alignments that
agree only within SLACK words: bands of 2 * SLACK shifts at steps of SLACK hold every range of SLACK + 1 shifts
whole, and the ranges are counted exactly inside a band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import words as W
from wardlake.llm import work

WINDOW, LEADS, SLACK = 10, 3, 8


def _words(text) -> Iterator[np.ndarray]:
    data, offsets = W.raw(text)
    for i, j in W.blocks(offsets):
        names, _, at = W.words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], "alnum")
        for k in range(j - i):
            yield names[at[k]:at[k + 1]]


def _ranks(docs: DataFrame) -> np.ndarray:
    def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
        data, offsets = W.raw(batch.column(0))
        for i, j in W.blocks(offsets):
            names = W.words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], "alnum")[0]
            total += np.bincount((names >> np.uint64(64 - work.SKETCH_BITS)).astype(np.int64), minlength=len(total))

    return work.frequency_ranks(docs.select("text"), add)


def leads(terms: np.ndarray) -> np.ndarray:
    """Positions of an item's words that are among the LEADS rarest of some window; ``terms`` as ranked names."""
    width = min(WINDOW, len(terms))
    if not width:
        return np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(terms, width)
    order = np.argsort(windows, axis=1, kind="stable")[:, :LEADS]
    return np.unique(order + np.arange(len(windows))[:, None])


def _items(bench: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Ranked words and lead positions of each distinct benchmark row with words."""
    shared = bench.sparkSession.sparkContext.broadcast(ranks)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [work.by_rank(x, shared.value) for x in _words(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("item_id"), pa.array([x.view(np.int64) for x in terms], pa.list_(pa.int64())),
                 pa.array([leads(x) for x in terms], pa.list_(pa.int64()))], ["item", "item_id", "terms", "leads"])

    rows = bench.select(F.col("item_id").cast("string"), F.col("text").cast("string")).distinct()
    rows = rows.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text")
    found = rows.mapInArrow(index, "item long, item_id string, terms array<long>, leads array<long>")
    return work.save(found.where(F.size("terms") > 0), "items")


def _postings(docs: DataFrame, ranks: np.ndarray, wanted: np.ndarray) -> DataFrame:
    """Per row of documents: a key, the number and a digest of its words, and its postings of wanted terms."""
    context = docs.sparkSession.sparkContext
    shared, filtered = context.broadcast(ranks), context.broadcast(wanted)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, terms, places = [], [], [], []
            for names in _words(batch.column(1)):
                ranked = work.by_rank(names, shared.value)
                hit = np.flatnonzero(work.marked(filtered.value, ranked))
                counts.append(len(names))
                digests.append(_digest(names))
                terms.append(ranked[hit].view(np.int64))
                places.append(hit)
            at = np.concatenate(([0], np.cumsum([len(x) for x in terms])))
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (terms, places)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(digests, pa.int64()),
                 W.list_array(flat[0], at, pa.int64()), W.list_array(flat[1].astype(np.int32), at, pa.int32())],
                ["doc_id", "tag", "n_words", "digest", "terms", "places"])

    found = docs.mapInArrow(index, "doc_id long, tag long, n_words long, digest long, terms array<long>, places array<int>")
    return work.save(found.withColumn("key", F.monotonically_increasing_id()), "postings")


def _digest(names: np.ndarray) -> int:
    powers = W._power_table(max(len(names), 1))[:len(names)]
    return int(W.mix(np.array([(names * powers).sum(dtype=np.uint64)], np.uint64)).view(np.int64)[0])


def _full_lists(docs: DataFrame, ranks: np.ndarray, chosen: DataFrame) -> DataFrame:
    """All ranked words of the chosen documents (doc_id, digest)."""
    context = docs.sparkSession.sparkContext
    shared, filtered = context.broadcast(ranks), context.broadcast(work.bitmap(chosen.select("digest")))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = list(_words(batch.column(0)))
            digests = np.array([_digest(x) for x in every], np.int64)
            hit = np.flatnonzero(work.marked(filtered.value, digests))
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests[hit]), pa.array([work.by_rank(every[i], shared.value).view(np.int64) for i in hit], pa.list_(pa.int64()))],
                ["digest", "all_terms"])

    found = docs.select("text").mapInArrow(index, "digest long, all_terms array<long>")
    return found.groupBy("digest").agg(F.min("all_terms").alias("all_terms"))


def find(docs: DataFrame, bench: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (key, doc_id, a hash of the text as tag, n_words), phrase matches and proximity matches.

    A phrase match (key, item_id, shift, width, starts) says which windows of the item, by start, occur
    in the document at shift + start. A proximity match (key, item_id) has at least half of the item's
    leads, and LEADS of them, at shifts that differ by SLACK words at most. Null texts have no words; rows
    with equal ids are separate; a null item_id matches but names no item.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("tag"))
    ranks = _ranks(docs)
    items = _items(bench, ranks)
    spots = items.select("item", F.posexplode("terms").alias("q", "term"), "leads").where(F.array_contains("leads", F.col("q").cast("long")))
    spots = spots.select("term", "item", "q", F.size("leads").alias("n_leads"), F.lit(LEADS).alias("few"))
    postings = _postings(docs, ranks, work.bitmap(spots.select("term")))
    flat = postings.select("key", "digest", F.explode(F.arrays_zip("terms", "places")).alias("at")).select("key", "digest", "at.terms", "at.places")
    spoken = flat.join(spots, F.col("terms") == F.col("term")).select("key", "digest", "item", "q", "n_leads", (F.col("places") - F.col("q")).alias("shift"))
    width = F.least(F.size("terms"), F.lit(WINDOW))
    sized = items.select("item", "item_id", "terms", width.alias("width"))
    aligned = work.save(
        spoken.groupBy("key", "digest", "item", "shift").agg(F.count_distinct("q").alias("agree"), F.first("n_leads").alias("n_leads")), "alignments")
    enough = aligned.join(sized, "item").where(F.col("agree") >= F.least(F.col("width"), F.lit(LEADS)))
    enough = work.save(enough.select("key", "digest", "item_id", "shift", "width", "terms"), "candidates")
    lists = _full_lists(docs, ranks, enough)
    read = enough.join(lists, "digest").withColumn("starts", F.filter(
        F.sequence(F.lit(0), F.size("terms") - F.col("width")),
        lambda a: (F.col("shift") + a >= 0) & (F.col("shift") + a + F.col("width") <= F.size("all_terms"))
        & (F.slice("all_terms", F.greatest(F.col("shift") + a, F.lit(0)) + 1, F.col("width")) == F.slice("terms", a + 1, F.col("width")))))
    phrases = work.save(read.where(F.size("starts") > 0).select("key", "item_id", "shift", "width", "starts"), "phrases")
    step = F.floor(F.col("shift") / SLACK).cast("int")
    bands = (spoken.select("key", "item", "n_leads", "q", "shift", F.explode(F.array(step, step - 1)).alias("band"))
             .groupBy("key", "item", "band").agg(F.collect_set(F.struct("shift", "q")).alias("at"), F.first("n_leads").alias("n_leads")))
    need = F.greatest(F.lit(LEADS), F.ceil(F.col("n_leads") / 2))
    near = bands.where((F.size("at") >= need) & F.exists("at", lambda x: F.size(F.array_distinct(F.transform(
        F.filter("at", lambda y: y["shift"].between(x["shift"], x["shift"] + SLACK)), lambda y: y["q"]))) >= need))
    near = near.join(items.select("item", "item_id"), "item").select("key", "item_id").distinct()
    return postings.select("key", "doc_id", "tag", "n_words"), phrases, near


def report(docs: DataFrame, bench: DataFrame, proximity: bool = True) -> DataFrame:
    """Hit words and items of every document row; see :func:`find` for nulls and repeated rows.

    Without ``proximity`` the columns of proximity matches are left out and not computed.
    """
    every, phrases, near = find(docs, bench)
    width = F.col("width")
    spans = F.array_distinct(F.flatten(F.transform("starts", lambda a: F.sequence(F.col("shift") + a, F.col("shift") + a + width - 1))))
    words = phrases.select("key", F.explode(spans).alias("word")).distinct().groupBy("key").agg(F.count("word").alias("n_hit"))
    items = (phrases.select("key", "item_id").distinct().groupBy("key")
             .agg(F.sort_array(F.collect_set("item_id")).alias("ids")))
    out = every.join(words, "key", "left").join(items, "key", "left")
    none = F.array().cast("array<string>")
    ids = F.coalesce("ids", none)
    columns = [
        F.col("doc_id"), F.col("n_words"), F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")]
    if not proximity:
        return out.select(*columns)
    close = near.groupBy("key").agg(F.count("item_id").alias("n_near_items"), F.sort_array(F.collect_set("item_id")).alias("near_ids"))
    return out.join(close, "key", "left").select(
        *columns, F.coalesce("n_near_items", F.lit(0)).alias("n_near_items"), F.array_join(F.coalesce("near_ids", none), ",").alias("near_items"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(work.table(spark, sf_dir, "documents"), work.table(spark, sf_dir, "benchmark"), proximity=False)


def run_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of :func:`run` with the proximity matches, which its SQL twin has no columns for."""
    return report(work.table(spark, sf_dir, "documents"), work.table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any occurrence of a benchmark window, unchanged."""
    found = find(docs, work.table(spark, sf_dir, "benchmark"))
    hit = found[0].join(found[1].select("key").distinct(), "key").select(F.col("doc_id").alias("hit_id"), "tag").distinct()
    same = docs["doc_id"].eqNullSafe(hit["hit_id"]) & (F.xxhash64(docs["text"]) == hit["tag"])
    return docs.join(hit, same, "left_anti").select(*docs.columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[a : a + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS a FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, a, array_to_string(w[a : a + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, a, dw.n FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::varchar AS item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""
