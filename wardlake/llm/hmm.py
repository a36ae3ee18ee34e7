"""Hidden Markov language model over word classes, trained by Baum-Welch on all training texts.

Words of a text and one end form its tokens. The HEADS most frequent words are classes of their own; every
other word belongs to one of TAILS classes by the hash of its last bytes, so a class needs no
lookup and the alphabet is bounded. The hidden chain emits classes; a word follows from
its class as (c + 0.5) / (N_class + 0.5 * (V_class + 1)), with one unknown word in each
tail class. Both parts are proper distributions, so the score is the log10 probability of the text.

Jobs: word counts (shuffled by word); texts as class sequences, with the words that are not among
the LOOKUP most frequent set aside for a join with the counts; class pairs, whose likelihood
gives the first parameters; ROUNDS of expected counts over all training sequences, added up
across partitions; the scaled forward recursion over every text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import work

HEADS, TAILS, LOOKUP = 2048, 1023, 1 << 18
END = HEADS + TAILS
CLASSES = END + 1
STATES, ROUNDS, FIRST_ROUNDS, PRIOR = 8, 3, 80, 30.0
COARSE = 512
SUFFIX_BYTES = 3
_FLUSH, _CHUNK_TOKENS = 200_000, 1_000_000


def tail_class(word: bytes) -> int:
    return HEADS + crc32(word[-SUFFIX_BYTES:]) % TAILS


def tokens(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _held_out():
    return F.coalesce(work.in_fifths() == 1, F.lit(False))


def count_words(docs: DataFrame) -> DataFrame:
    """``word``, ``tail`` class and count ``c`` over all rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(tokens(text.as_py() or ""))
                if len(held) > _FLUSH:
                    yield rows(held)
                    held.clear()
        if held:
            yield rows(held)

    def rows(held: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.binary()), pa.array([tail_class(w) for w in held], pa.int32()), pa.array(held.values(), pa.int64())],
            ["word", "tail", "c"])

    return docs.select("text").mapInArrow(count, "word binary, tail int, c long").groupBy("word", "tail").agg(F.sum("c").alias("c"))


class Lexicon:
    """Totals of the counts, the frequent words with their classes, and the sizes of the tail classes."""

    def __init__(self, counts: DataFrame, texts: int):
        octave = F.floor(F.log2("c") * 8)
        sizes = sorted(((r.octave, r.n) for r in counts.groupBy(octave.alias("octave")).agg(F.count("word").alias("n")).collect()), reverse=True)
        cut, held = math.inf, 0
        for at, n in sizes:
            held += n
            if held > LOOKUP:
                break
            cut = at
        found = counts.where(octave >= (cut if sizes and cut < math.inf else 10**6)).select("word", "c").toArrow()
        words, c = found.column("word").to_pylist(), np.asarray(found.column("c"), np.int64)
        order = sorted(range(len(words)), key=lambda i: (-c[i], words[i]))
        self.words = [words[i] for i in order]
        self.counts = c[order]
        heads = set(self.words[:HEADS])
        by_tail = counts.groupBy("tail").agg(F.sum("c").alias("c"), F.count("word").alias("v")).collect()
        self.tail_c, self.tail_v = np.zeros(CLASSES), np.zeros(CLASSES)
        for row in by_tail:
            self.tail_c[row.tail], self.tail_v[row.tail] = row.c, row.v
        self.total, self.kinds, self.ends = int(self.tail_c.sum()) + texts, int(self.tail_v.sum()) + (texts > 0), texts
        for word, n in zip(self.words[:HEADS], self.counts):
            tail = tail_class(word)
            self.tail_c[tail] -= n
            self.tail_v[tail] -= 1
        self.base_total = self.total + 0.5 * (self.kinds + 1)
        self.inner = self.tail_c + 0.5 * (self.tail_v + 1)
        self.classes = np.array([i if i < HEADS else tail_class(w) for i, w in enumerate(self.words)], np.int64)
        self.class_c = self.tail_c.copy()
        self.class_c[:len(heads)] = self.counts[:HEADS]
        self.class_c[END] = texts

    def base(self, c):
        return np.log10((c + 0.5) / self.base_total)


def encode(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Each row's class sequence, its sums over frequent words, and its other words with counts."""
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.words, lexicon.counts, lexicon.classes, lexicon.inner, lexicon.base_total, lexicon.ends))
    schema = ("doc_id long, held_out boolean, n_tokens long, known long, base double, inside double, sequence binary, "
              "words array<binary>, times array<int>, tails array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, classes, inner, base_total, ends = shared.value
        place = {w: i for i, w in enumerate(words)}
        base = np.log10((np.append(counts, [ends, 0]) + 0.5) / base_total)
        inside = np.where(classes < HEADS, 0.0, np.log10((counts + 0.5) / inner[classes])) if len(words) else np.zeros(0)
        inside = np.append(inside, [0.0, 0.0])
        n = len(words)
        all_classes = np.append(classes, [END, 0]).astype(np.uint16)
        suffixes: dict[bytes, int] = {}
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for text in batch.column(2):
                found = tokens(text.as_py() or "")
                ids = np.array([place.get(w, -1) for w in found] + [n], np.int64)
                rest = np.flatnonzero(ids < 0)
                sequence = all_classes[ids]
                rare = [found[i] for i in rest.tolist()]
                if len(suffixes) > _FLUSH:
                    suffixes.clear()
                for w in rare:
                    if w[-SUFFIX_BYTES:] not in suffixes:
                        suffixes[w[-SUFFIX_BYTES:]] = tail_class(w)
                sequence[rest] = [suffixes[w[-SUFFIX_BYTES:]] for w in rare]
                ids = ids[ids >= 0]
                others = Counter(rare)
                values = (len(found) + 1, len(ids) - (ends == 0), float(base[ids].sum()), float(inside[ids].sum()), sequence.astype("<u2").tobytes(),
                          list(others.keys()), list(others.values()), [suffixes[w[-SUFFIX_BYTES:]] for w in others])
                for column, value in zip(out, values):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(out, kinds))],
                ["doc_id", "held_out", "n_tokens", "known", "base", "inside", "sequence", "words", "times", "tails"])

    rows = docs.select("doc_id", _held_out().alias("held_out"), "text").mapInArrow(run, schema)
    return work.save(rows.withColumn("key", F.monotonically_increasing_id()), "sequences")


class Packed:
    """Sequences laid out step by step, longest first, so that each step is one slice."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences])
        self.order = np.argsort(-lengths, kind="stable")
        ordered = lengths[self.order]
        self.active = np.searchsorted(-ordered, -np.arange(ordered[0]), side="left")
        self.at = np.concatenate(([0], np.cumsum(self.active)))
        rank = np.repeat(np.arange(len(ordered)), ordered)
        starts = np.cumsum(ordered) - ordered
        place = self.at[np.arange(len(rank)) - np.repeat(starts, ordered)] + rank
        self.seen = np.empty(len(rank), np.int64)
        self.seen[place] = np.concatenate([sequences[i] for i in self.order])
        self.rank = np.empty(len(rank), np.int64)
        self.rank[place] = rank


def forward(packed: Packed, start: np.ndarray, move: np.ndarray, emit: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Scales of all tokens by the scaled forward recursion, and the state beliefs if asked for.

    ``emit`` has a row of states for each class.
    """
    at, seen = packed.at, packed.seen
    scale = np.empty(len(seen), emit.dtype)
    beliefs = np.empty((len(seen), len(start)), emit.dtype) if keep else None
    belief = None
    for t in range(len(packed.active)):
        a, b = at[t], at[t + 1]
        belief = (start if belief is None else belief[:b - a] @ move) * emit[seen[a:b]]
        total = belief.sum(1)
        belief /= total[:, None]
        scale[a:b] = total
        if keep:
            beliefs[a:b] = belief
    return scale, beliefs


def expected(packed: Packed, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions (class by state) of the sequences: the E-step of Baum-Welch."""
    scale, beliefs = forward(packed, start, move, emit, True)
    at, seen = packed.at, packed.seen
    n, k = beliefs.shape
    after = np.ones((n, k), emit.dtype)
    ahead = np.zeros((n, k), emit.dtype)
    for t in range(len(packed.active) - 1, 0, -1):
        a, b = at[t], at[t + 1]
        ahead[a:b] = emit[seen[a:b]] * after[a:b] / scale[a:b, None]
        after[at[t - 1]:at[t - 1] + b - a] = ahead[a:b] @ move.T
    later = np.arange(at[1], n)
    previous = np.repeat(at[:-2], packed.active[1:]) + packed.rank[later] if n > at[1] else later
    moves = move * (beliefs[previous].T @ ahead[later]).astype(np.float64)
    held = beliefs * after
    emissions = np.stack([np.bincount(seen, weights=held[:, z], minlength=len(emit)) for z in range(k)], axis=1)
    return held[:at[1]].sum(0, dtype=np.float64), moves, emissions


def coarse(classes: np.ndarray) -> np.ndarray:
    """Classes folded to COARSE: the first heads stay, the end stays, others share slots."""
    half = COARSE // 2
    return np.where(classes < half, classes, np.where(classes == END, COARSE - 1, half + classes % (half - 1)))


def first_parameters(pairs: np.ndarray, class_c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moves and state shares of classes that make the counted class pairs likely (EM on the pairs)."""
    rng = np.random.default_rng(7)
    left = pairs.sum(1) + 1e-9
    share = rng.dirichlet(np.full(STATES, 2.0), COARSE).T * left
    emit = share / share.sum(1, keepdims=True)
    joint = rng.dirichlet(np.full(STATES, 1.0), STATES) + 4 * np.eye(STATES)
    joint /= joint.sum()
    for _ in range(FIRST_ROUNDS):
        ratio = pairs / np.maximum(emit.T @ joint @ emit, 1e-300)
        from_left = emit * (joint @ emit @ ratio.T)
        from_right = emit * (joint.T @ emit @ ratio)
        joint = joint * (emit @ ratio @ emit.T)
        joint = (joint + 1e-6) / (joint + 1e-6).sum()
        emit = from_left + from_right + 1e-9
        emit /= emit.sum(1, keepdims=True)
    weight = joint.sum(1)
    posterior = emit * weight[:, None]
    posterior /= posterior.sum(0, keepdims=True)
    return joint / joint.sum(1, keepdims=True), (posterior[:, coarse(np.arange(CLASSES))] * class_c).T


def parameters(starts: np.ndarray, moves: np.ndarray, emissions: np.ndarray, class_c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distributions from expected counts, smoothed towards the classes' own shares."""
    shares = (class_c + 0.5) / (class_c + 0.5).sum()
    start = (starts + 1) / (starts + 1).sum()
    move = (moves + 1) / (moves + 1).sum(1, keepdims=True)
    emit = (emissions + PRIOR * shares[:, None]) / (emissions.sum(0) + PRIOR)
    return start, move, emit


def _chunks(column) -> Iterator[tuple[int, list[np.ndarray]]]:
    held, total, first = [], 0, 0
    for i, value in enumerate(column):
        held.append(np.frombuffer(value.as_buffer(), "<u2"))
        total += len(held[-1])
        if total >= _CHUNK_TOKENS:
            yield first, held
            held, total, first = [], 0, i + 1
    if held:
        yield first, held


def train(encoded: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, move and emission distributions after ROUNDS of Baum-Welch over the rows that are not held out."""
    own = encoded.where(~F.col("held_out")).select("sequence")

    def add_pairs(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for _, sequences in _chunks(batch.column(0)):
            flat = coarse(np.concatenate(sequences).astype(np.int64))
            pair = flat[:-1] * COARSE + flat[1:]
            total += np.bincount(pair[flat[:-1] != COARSE - 1], minlength=len(total))

    pairs = work.dense_sums(own, add_pairs, COARSE * COARSE).reshape(COARSE, COARSE)
    move, emissions = first_parameters(pairs, lexicon.class_c)
    model = parameters(np.zeros(STATES), move * 1e3, emissions, lexicon.class_c)
    sizes = (STATES, STATES * STATES, CLASSES * STATES)
    for _ in range(ROUNDS):
        shared = encoded.sparkSession.sparkContext.broadcast(tuple(x.astype(np.float32) for x in model))

        def add(batch: pa.RecordBatch, total: np.ndarray, shared=shared) -> None:
            for _, sequences in _chunks(batch.column(0)):
                total += np.concatenate([x.ravel() for x in expected(Packed(sequences), *shared.value)])

        sums = work.dense_sums(own, add, sum(sizes))
        starts, moves, emissions = np.split(sums, np.cumsum(sizes)[:-1])
        model = parameters(starts, moves.reshape(STATES, STATES), emissions.reshape(CLASSES, STATES), lexicon.class_c)
    return model


def likelihood(sequences: list[np.ndarray], model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each class sequence."""
    packed = Packed(sequences)
    scale, _ = forward(packed, *model, False)
    out = np.empty(len(sequences))
    out[packed.order] = np.bincount(packed.rank, weights=np.log10(scale), minlength=len(sequences))
    return out


def score(docs: DataFrame) -> DataFrame:
    """Score of every row of ``docs`` under the unigram base and the hidden Markov model.

    A null or empty text is one end token. Rows without doc_id count as training rows; repeated
    rows are counted and scored each. Without any training row every token is unknown. Other
    columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    own = docs.where(~_held_out())
    counts = work.save(count_words(own), "words")
    lexicon = Lexicon(counts, own.count())
    encoded = encode(docs, lexicon)
    model = train(encoded, lexicon)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [likelihood(s, shared.value) for _, s in _chunks(batch.column(7))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(7)), pa.array(np.concatenate(parts) if parts else np.zeros(0))],
                                             ["key", "doc_id", "held_out", "n_tokens", "known", "base", "inside", "hidden"])

    schema = "key long, doc_id long, held_out boolean, n_tokens long, known long, base double, inside double, hidden double"
    scored = encoded.select("key", "doc_id", "held_out", "n_tokens", "known", "base", "inside", "sequence").mapInArrow(run, schema)
    rare = encoded.select("key", F.explode(F.arrays_zip("words", "times", "tails")).alias("w")).select("key", "w.words", "w.times", "w.tails")
    inner = F.element_at(F.lit(lexicon.inner.tolist()), F.col("tails") + 1)
    c = F.coalesce("c", F.lit(0)) + 0.5
    joined = rare.join(counts.select(F.col("word").alias("words"), "c"), "words", "left")
    sums = joined.groupBy("key").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10(c / lexicon.base_total)).alias("more_base"),
        F.sum(F.col("times") * F.log10(c / inner)).alias("more_inside"))
    zero = F.lit(0.0)
    return scored.join(sums, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("hidden") + F.col("inside") + F.coalesce("more_inside", zero)).alias("score"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(work.table(spark, sf_dir, "documents"))
