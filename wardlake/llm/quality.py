"""Quality by ordinal regression with cumulative logits.

One weight per feature serves all grades; ordered thresholds cut the margin into grades:
P(grade >= k) = logistic(margin - threshold_k).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import features as X
from wardlake.llm.work import in_fifths, table

#: Bound of the labelled sample that the model is fitted on.
RATED = 6000
EVIDENCE, RATE, DECAY, EPOCHS = 4.0, 0.05, 1e-4, 100
KEEP_GRADE, KEEP_TAIL = 1, 0.5


def grade() -> Column:
    """Rating of a labelled row: 0 poor quality, 1 good but toxic, 2 good."""
    return F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when(F.col("quality") == 1, 2)


def train(grades: np.ndarray, flat: np.ndarray, at: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of all features and ``levels`` - 1 ascending thresholds, by maximum likelihood.

    Features with less than EVIDENCE standard errors of grade shift get no weight. Threshold
    gaps are exponentials of free numbers, so they stay ordered.
    """
    size, n = 1 << X.BITS, len(grades)
    weights = np.zeros(size)
    shares = np.array([(grades >= k).mean() if n else 0.5 for k in range(1, levels)]).clip(1e-3, 1 - 1e-3)
    cuts = np.maximum.accumulate(-np.log(shares / (1 - shares)) + np.arange(levels - 1) * 1e-3)
    if not n or grades.min() == grades.max():
        return weights, cuts
    rows = np.repeat(np.arange(n), np.diff(at))
    df = np.bincount(flat, minlength=size)
    shift = np.bincount(flat, weights=(grades - grades.mean())[rows], minlength=size)
    z = shift / np.maximum(grades.std() * np.sqrt(df * np.maximum(1 - df / n, 1e-9)), 0.5)
    ids, flat, at, rows = X.column_subset(np.abs(z) >= EVIDENCE, flat, at)
    model = X.Adam(len(ids) + levels - 1, RATE)
    d = len(ids)
    model.value[d:] = np.concatenate((cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))))
    for _ in range(EPOCHS):
        free = model.value[d:]
        cuts = free[0] + np.concatenate(([0], np.cumsum(np.exp(free[1:]))))
        tails = X.logistic(X.sums(model.value[:d], flat, at)[:, None] - cuts[None, :])
        slope = tails * (1 - tails)
        upper = np.concatenate((np.ones((n, 1)), tails), axis=1)
        lower = np.concatenate((tails, np.zeros((n, 1))), axis=1)
        p = np.maximum((upper - lower)[np.arange(n), grades], 1e-9)
        # d(-log p)/d(margin - cut_k): the cut below the grade pulls up, the one above pushes down
        by_cut = np.zeros_like(tails)
        k = np.arange(1, levels)[None, :]
        by_cut -= np.where(k == grades[:, None], slope, 0) / p[:, None]
        by_cut += np.where(k == grades[:, None] + 1, slope, 0) / p[:, None]
        pull = by_cut.sum(1) / n
        to_cuts = -by_cut.sum(0) / n
        gaps = np.array([to_cuts[j:].sum() * np.exp(free[j]) for j in range(1, levels - 1)])
        model.move(np.concatenate((np.bincount(flat, weights=pull[rows], minlength=d) + DECAY * model.value[:d], [to_cuts.sum()], gaps)))
    free = model.value[d:]
    weights[ids] = model.value[:d]
    return weights, free[0] + np.concatenate(([0], np.cumsum(np.exp(free[1:]))))


def fit(docs: DataFrame, labels: DataFrame, levels: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Model of the training rows: rated ids whose crc32 modulo 5 is not 0."""
    picked = X.sample(labels, (in_fifths() != 0) & grade().isNotNull(), grade(), RATED)
    return train(*X.fetch(docs, picked, True), levels)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], carry: list[str]) -> DataFrame:
    """``carry``, ``expected_grade`` and ``tail_k`` = P(grade >= k) for every k and row.

    A null or empty text has the score of a text without words. Repeated rows score alike.
    """
    weights, cuts = model
    tails = [(1 / (1 + F.exp(F.lit(float(c)) - F.col("margin")))).alias(f"tail_{k}") for k, c in enumerate(cuts, 1)]
    out = X.margins(docs, weights, True, carry, "margin").select(*carry, *tails)
    return out.withColumn("expected_grade", sum((F.col(f"tail_{k}") for k in range(2, len(cuts) + 1)), F.col("tail_1")))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probabilities and the selection for every document; fold 0 is held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = score(docs, model, ["doc_id"])
    return out.select("doc_id", F.coalesce(in_fifths() == 0, F.lit(False)).alias("held_out"), "expected_grade",
                      "tail_1", "tail_2", (F.col(f"tail_{KEEP_GRADE}") >= KEEP_TAIL).alias("keep"))
