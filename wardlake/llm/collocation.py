"""Phrase collocations by direct-address tiling.

A phrase of m words is a pair: a frequent phrase of m - 1 words and the word behind it. Both sides are ranked by
frequency. A task splits the pairs of the HEAD most frequent on either side into tiles of SIDE x SIDE ranks; a tile
with many pairs is counted as a dense array with bincount, a sparse one and all pairs of rarer members as sorted
coordinates with run lengths. The sums leave a task packed by shards of phrase names; Spark deals the shards and
sorted runs of one shard are merged. Pairs that prove
frequent are ranked anew and become the left side of the next round, so triples and quadruples
are pairs as well. A phrase can only be frequent if its parts are; a fixed-size bitmap of the frequent parts keeps others
out of the count.

Words are told apart by 64-bit names mixed with the language's; each name's word comes from a join with the counted
vocabulary. All tables grow with the texts and stay with Spark; only the heads and the bitmaps, both of fixed
size, are broadcast.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardlake.llm import words as W
from wardlake.llm import work

LEAST, LONGEST, BEST, SCALE = 30, 4, 2000, 2_000_000
#: A phrase goes if a longer one around it occurs COVER / OF times as often or more.
COVER, OF = 80, 100
#: Ranks with dense tiles, ranks on a tile's side, pairs that make a tile dense, pairs that are counted at once, and phrases held before they are passed on.
HEAD, SIDE, DENSE, FLUSH, HELD = 2048, 256, 1 << 12, 1 << 19, 1 << 19
#: Words of the corpus per shard, and the fewest and most shards.
SHARE, FEWEST, MOST = 1 << 20, 16, 1 << 17
_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_ALL = np.arange(256)
#: White space inside a piece and the bytes that end one.
_BREAKS = np.isin(_ALL, list(b".,;:!?\n\x0b\x0c\r"))
_KEPT = ~(_BREAKS | np.isin(_ALL, [32, 9]))
_WORD = re.compile(rb"[^\x20\x09.,;:!?\x0A-\x0D]+")
W.TABLES["phrase"] = (_KEPT, W._byte_table(_KEPT))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of phrases followed by a word."""
    return W.mix(left * _R + W.mix(right + np.uint64(0x51ED2701)))


def _lang_names(langs: pa.Array) -> np.ndarray:
    coded = langs.dictionary_encode(null_encoding="encode")
    names = [int.from_bytes(hashlib.blake2b((x or "und").encode(), digest_size=8).digest(), "little") for x in coded.dictionary.to_pylist()]
    # a language that is an empty string is one of its own
    names = [n if x != "" else 1 for n, x in zip(names, coded.dictionary.to_pylist())]
    return np.array(names, np.uint64)[coded.indices.to_numpy()] if names else np.zeros(0, np.uint64)


def tokens(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block of (lang, text) rows: bytes, names of words, their starts, whether each begins a piece, and its row."""
    langs = _lang_names(batch.column(0))
    data, offsets = W.raw(batch.column(1))
    for i, j in W.blocks(offsets):
        part = data[offsets[i]:offsets[j]]
        names, starts, at = W.words(part, offsets[i:j + 1] - offsets[i], "phrase")
        if not len(names):
            continue
        counts = np.diff(at)
        breaks = np.cumsum(_BREAKS[part])[starts]
        begins = np.append(True, breaks[1:] > breaks[:-1])
        begins[at[:-1][counts > 0]] = True
        yield part, W.mix(names + np.repeat(langs[i:j], counts) * _R), starts, begins, np.repeat(np.arange(i, j), counts)


def _vocabulary(docs: DataFrame) -> DataFrame:
    """``name``, ``lang``, ``word`` and count ``f`` of every word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, said = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, object)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(known.view(np.int64)), pa.array([x[0] for x in said], pa.string()),
                 pa.array([x[1].decode() for x in said], pa.string()), pa.array(total)], ["name", "lang", "word", "f"])

        for batch in batches:
            langs = batch.column(0)
            for data, names, starts, _, owner in tokens(batch):
                found, first, counts = np.unique(names, return_index=True, return_counts=True)
                place = np.searchsorted(known, found)
                old = np.zeros(len(found), bool)
                inside = place < len(known)
                old[inside] = known[place[inside]] == found[inside]
                total[place[old]] += counts[old]
                new = np.flatnonzero(~old)
                if not len(new):
                    continue
                ends = np.append(starts, len(data))
                spoken = np.empty(len(new), object)
                for k, at in enumerate(first[new].tolist()):
                    lang = langs[int(owner[at])].as_py()
                    spoken[k] = ("und" if lang is None else lang, _WORD.match(data[starts[at]:ends[at + 1]].tobytes()).group().lower())
                known = np.insert(known, place[new], found[new])
                total = np.insert(total, place[new], counts[new])
                said = np.insert(said, place[new], spoken)
            if len(known) >= HELD:
                yield rows()
                known, total, said = known[:0], total[:0], said[:0]
        if len(known):
            yield rows()

    parts = docs.mapInArrow(count, "name long, lang string, word string, f long")
    return work.save(parts.groupBy("name", "lang", "word").agg(F.sum("f").alias("f")), "vocabulary")


class Head:
    """The most frequent of one side, by rank: names, and the words they are made of."""

    def __init__(self, table: DataFrame, size: int) -> None:
        rows = table.orderBy(F.desc("f"), "name").limit(HEAD).collect()
        names = np.array([r.name for r in rows], np.int64).view(np.uint64)
        self.words = np.array([list(r.words) for r in rows], np.int64).reshape(-1, size).view(np.uint64)
        self.rank = np.argsort(names, kind="stable")
        self.names = names[self.rank]

    def ranks(self, names: np.ndarray) -> np.ndarray:
        """Rank of each name, -1 outside the head."""
        if not len(self.names):
            return np.full(len(names), -1)
        place = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return np.where(self.names[place] == names, self.rank[place], -1)


class Counter:
    """Counts of pairs in one task: dense tiles, and sorted coordinates for the rest."""

    def __init__(self, left: Head, right: Head, size: int, shards: int) -> None:
        self.left, self.right, self.size, self.shards = left, right, size, shards
        self.tiles: dict[int, np.ndarray] = {}
        self.names, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.words = np.zeros((0, size), np.uint64)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pairs = 0

    def add(self, left: np.ndarray, right: np.ndarray, words: np.ndarray) -> None:
        self.waiting.append((left, right, words))
        self.pairs += len(left)
        if self.pairs >= FLUSH:
            self.flush()

    def flush(self) -> None:
        if not self.pairs:
            return
        left, right, words = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.pairs = [], 0
        row, column = self.left.ranks(left), self.right.ranks(right)
        ranked = (row >= 0) & (column >= 0)
        across = -(-HEAD // SIDE)
        tile = np.where(ranked, row // SIDE * across + column // SIDE, -1)
        many = np.bincount(tile[ranked], minlength=across * across) >= DENSE
        dense = ranked & many[tile]
        cell = tile[dense] * (SIDE * SIDE) + row[dense] % SIDE * SIDE + column[dense] % SIDE
        order = np.argsort(tile[dense], kind="stable")
        cell, cuts = cell[order], np.cumsum(np.bincount(tile[dense], minlength=across * across))
        for number in np.flatnonzero(many).tolist():
            part = cell[cuts[number - 1] if number else 0:cuts[number]] - number * SIDE * SIDE
            held = self.tiles.get(number)
            counted = np.bincount(part, minlength=SIDE * SIDE)
            self.tiles[number] = counted if held is None else held + counted
        self.names, self.words, self.counts = merged(
            np.concatenate((self.names, joined(left[~dense], right[~dense]))), np.concatenate((self.words, words[~dense])),
            np.concatenate((self.counts, np.ones(int((~dense).sum()), np.int64))))

    def rows(self, last: bool) -> Iterator[pa.RecordBatch]:
        """What is held, if it is much or the ``last``."""
        if last:
            self.flush()
            across = -(-HEAD // SIDE)
            for number, counted in self.tiles.items():
                cell = np.flatnonzero(counted)
                row, column = number // across * SIDE + cell // SIDE, number % across * SIDE + cell % SIDE
                words = np.concatenate((self.left.words[row], self.right.words[column]), axis=1)
                yield self._batch(_name(list(words.T)), words, counted[cell])
        if last or len(self.names) >= HELD:
            if len(self.names):
                yield self._batch(self.names, self.words, self.counts)
            self.names, self.counts, self.words = self.names[:0], self.counts[:0], self.words[:0]

    def _batch(self, names: np.ndarray, words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        """One row per shard, its phrases in order of their words."""
        shard = (names % np.uint64(self.shards)).astype(np.int32)
        order = np.lexsort((*words.T[::-1], shard))
        found, first = np.unique(shard[order], return_index=True)
        cuts = np.append(first, len(order)).tolist()
        parts = [words[order[i:j]].tobytes() + counts[order[i:j]].astype("<i8").tobytes() for i, j in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(parts, pa.binary())], ["shard", "part"])


def merged(names: np.ndarray, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coordinates sorted by name, the counts of runs added up, each with the words of its first."""
    order = np.argsort(names, kind="stable")
    names = names[order]
    first = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(names) else np.zeros(0, np.int64)
    return names[first], words[order[first]], np.add.reduceat(counts[order], first) if len(first) else counts


def _frequent(docs: DataFrame, size: int, left: Head, right: Head, bitmaps: list[np.ndarray], least: int, shards: int) -> DataFrame:
    """``name``, ``words`` (names) and count ``f`` of all phrases of ``size`` words that occur ``least`` times or more."""
    shared = docs.sparkSession.sparkContext.broadcast((left, right, bitmaps))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, bitmaps = shared.value
        counter = Counter(left, right, size, shards)
        for batch in batches:
            for _, word, _, begins, _ in tokens(batch):
                name, good = word, work.marked(bitmaps[0], word)
                for m in range(2, size + 1):
                    # a phrase starts where its first and its last m - 1 words are a frequent phrase in one piece
                    both = good[:-1] & good[1:] & ~begins[m - 1:]
                    longer = joined(name[:-1], word[m - 1:])
                    if m == size:
                        at = np.flatnonzero(both)
                        counter.add(name[at], word[at + m - 1], np.stack([word[at + k] for k in range(m)], axis=1))
                    else:
                        good = both
                        good[both] = work.marked(bitmaps[m - 1], longer[both])
                        name = longer
                    if len(good) < 2:
                        break
            yield from counter.rows(False)
        yield from counter.rows(True)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in work.groups(batches, "shard"):
            held, waiting, n = None, [], 0
            for part in (*group.column("part").to_pylist(), None):
                if part is not None:
                    count = len(part) // (8 * size + 8)
                    waiting.append((np.frombuffer(part, np.uint64, count * size).reshape(-1, size), np.frombuffer(part, "<i8", count, 8 * size * count)))
                    n += count
                if waiting and (part is None or n >= HELD):
                    words, counts = (np.concatenate(x) for x in zip(*waiting))
                    names = _name([words[:, k].copy() for k in range(size)])
                    held = merged(*((names, words, counts) if held is None else map(np.concatenate, zip(held, (names, words, counts)))))
                    waiting, n = [], 0
            names, words, counts = held
            often = counts >= least
            if often.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[often].view(np.int64)), _lists(list(words[often].T)), pa.array(counts[often])], ["name", "words", "f"])

    counted = docs.mapInArrow(count, "shard int, part binary").repartition("shard").sortWithinPartitions("shard")
    return work.save(counted.mapInArrow(merge, "name long, words array<long>, f long"), f"phrases-{size}")


def _name(words: list[np.ndarray]) -> np.ndarray:
    out = words[0]
    for word in words[1:]:
        out = joined(out, word)
    return out


def _lists(words: list[np.ndarray]) -> pa.Array:
    flat = np.stack(words, axis=1).view(np.int64)
    return W.list_array(flat.ravel(), np.arange(len(flat) + 1) * len(words), pa.int64())


def _parts(phrases: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Per phrase and cut: names of the first part and the rest; and names of all shorter phrases of two or more words inside each."""
    def words_of(batch: pa.RecordBatch) -> list[np.ndarray]:
        flat = batch.column(1).flatten().to_numpy().reshape(-1, size)
        return [flat[:, k].copy().view(np.uint64) for k in range(size)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = words_of(batch)
            for k in range(1, size):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array(np.full(batch.num_rows, k, np.int32)),
                     pa.array(_name(words[:k]).view(np.int64)), pa.array(_name(words[k:]).view(np.int64))],
                    ["name", "words", "a", "k", "head", "rest"])

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = words_of(batch)
            for m in range(2, size):
                for k in range(size - m + 1):
                    yield pa.RecordBatch.from_arrays([pa.array(_name(words[k:k + m]).view(np.int64)), batch.column(2)], ["name", "longer"])

    return (phrases.mapInArrow(cut, "name long, words array<long>, a long, k int, head long, rest long"),
            phrases.mapInArrow(inside, "name long, longer long"))


def mine(docs: DataFrame, least: int = LEAST, best: int = BEST) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the ``best`` phrases of two to LONGEST words per language.

    ``docs`` has ``lang`` and ``text``; other columns are not read. Texts are lower-cased (A-Z), cut into pieces at
    ``. , ; : ! ?`` and line breaks, and into words at blanks and tabs. All counts are per language over all rows,
    repeated rows included; a null language is ``und``, a null or empty text has no words, and a table without any gives no rows.
    ``a`` counts the phrase, which must occur ``least`` times or more, ``n`` all words. A phrase cut in two parts that
    occur ``l`` and ``r`` times scores floor(2000000 a / (l + r)); its lowest score counts, ties to the
    shortest first part. A phrase goes if a longer candidate holds it and occurs 80 % as often or more. Ranks go by
    score, ``a`` and the phrase's bytes.
    """
    docs = docs.select(F.col("lang").cast("string"), F.col("text").cast("string"))
    vocabulary = _vocabulary(docs)
    totals = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
    words = vocabulary.where(F.col("f") >= least).select("name", F.array("name").alias("words"), "f")
    said = totals.agg(F.sum("n")).first()[0] or 0
    shards = min(MOST, FEWEST + said // SHARE)
    right = left = Head(words, 1)
    levels, bitmaps = [words], [work.bitmap(words.select("name"))]
    for size in range(2, LONGEST + 1):
        phrases = _frequent(docs, size, left, right, bitmaps, least, shards)
        levels.append(phrases)
        if size < LONGEST:
            left = Head(phrases, size)
            bitmaps = [*bitmaps, work.bitmap(phrases.select("name"))]

    counted = levels[0].select("name", "f")
    cuts = inside = None
    for size, phrases in enumerate(levels[1:], 2):
        counted = counted.unionByName(phrases.select("name", "f"))
        cut, within = _parts(phrases, size)
        cuts = cut if cuts is None else cuts.unionByName(cut)
        inside = within if inside is None else inside.unionByName(within)
    exact = "CAST({} AS DECIMAL(20, 0))".format
    scored = (cuts.join(counted.select(F.col("name").alias("head"), F.col("f").alias("l")), "head")
              .join(counted.select(F.col("name").alias("rest"), F.col("f").alias("r")), "rest")
              .withColumn("score", F.expr(f"{exact(SCALE)} * {exact('a')} div ({exact('l')} + {exact('r')})"))
              .groupBy("name", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    longest = inside.groupBy("name").agg(F.max("longer").alias("longer"))
    kept = (scored.join(longest, "name", "left")
            .where(F.col("longer").isNull() | F.expr(f"{OF} * {exact('longer')} < {COVER} * {exact('a')}")))
    # the words of a phrase by one join: a row for each place, put together again
    placed = kept.select("name", "a", "cut", F.posexplode("words").alias("place", "word_name"))
    spoken = (placed.join(vocabulary.select(F.col("name").alias("word_name"), "lang", "word"), "word_name")
              .groupBy("name", "a", "cut", "lang").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("said"))
              .select("lang", F.array_join(F.col("said.word"), " ").alias("phrase"), "a", "cut.*"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spoken.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(work.table(spark, sf_dir, "documents"))


SQL = rf"""WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
spoken AS MATERIALIZED (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM spoken, generate_series(1, {LONGEST}) t(m)),
counted AS MATERIALIZED (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL),
candidates AS MATERIALIZED (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM counted WHERE m >= 2 AND f >= {LEAST}),
cuts AS (SELECT lang, m, phrase, w, a, unnest(generate_series(1, m - 1)) AS k FROM candidates),
scored AS (
    SELECT c.lang, c.phrase, a, h.f AS l, t.f AS r, ({SCALE}::HUGEINT * a // (h.f + t.f))::BIGINT AS score FROM cuts c
    JOIN counted h ON h.lang = c.lang AND h.m = k AND h.phrase = array_to_string(w[1:k], ' ')
    JOIN counted t ON t.lang = c.lang AND t.m = c.m - k AND t.phrase = array_to_string(w[k + 1:c.m], ' ')
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer FROM (
        SELECT lang, w, a, s, unnest(generate_series(1, m - s + 1)) AS i FROM (
            SELECT lang, w, a, m, unnest(generate_series(2, m - 1)) AS s FROM candidates WHERE m > 2))
    GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM scored LEFT JOIN inside USING (lang, phrase) JOIN totals USING (lang)
WHERE longer IS NULL OR {OF} * longer::HUGEINT < {COVER} * a::HUGEINT
QUALIFY rank <= {BEST}"""
