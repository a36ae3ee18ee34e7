"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic rows count as labels; all other labelled rows are text without a label, in
which a known share (the class prior) is toxic. The risk of the negative class is
estimated as R_u(-) - prior * R_p(-) and kept from turning negative: when it does, the step goes up
that part instead (Kiryo et al., 2017).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import features as X
from wardlake.llm.work import fresh, in_fifths, table

#: Bounds of the labelled sample that the classifier is fitted on.
POSITIVES, UNLABELLED = 2500, 7500
EVIDENCE, RATE, DECAY, EPOCHS = 4.0, 0.05, 1e-4, 100
REJECT = 0.5


def train(positive: tuple[np.ndarray, np.ndarray], unlabelled: tuple[np.ndarray, np.ndarray], prior: float) -> tuple[np.ndarray, float]:
    """Weights of all features and the bias, from (features, offsets) of either sample.

    Features whose share differs between the samples by fewer than EVIDENCE standard errors
    get no weight. Without a positive row the weights are 0 and the bias is far below.
    """
    size = 1 << X.BITS
    n_p, n_u = len(positive[1]) - 1, len(unlabelled[1]) - 1
    weights = np.zeros(size)
    if not n_p or not n_u or not 0 < prior < 1:
        return weights, -10.0 if not n_p else 0.0
    flat = np.concatenate((positive[0], unlabelled[0]))
    at = np.concatenate((positive[1], unlabelled[1][1:] + positive[1][-1]))
    in_p, in_u = (np.bincount(s[0], minlength=size) for s in (positive, unlabelled))
    share = (in_p + in_u + 1) / (n_p + n_u + 2)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    ids, flat, at, rows = X.column_subset(np.abs(z) >= EVIDENCE, flat, at)
    model = X.Adam(len(ids) + 1, RATE)
    model.value[-1] = np.log(prior / (1 - prior))
    for _ in range(EPOCHS):
        margin = X.sums(model.value[:-1], flat, at) + model.value[-1]
        p = X.logistic(margin)
        as_negative = np.logaddexp(0, margin)
        pull = np.empty(len(margin))
        if as_negative[n_p:].mean() >= prior * as_negative[:n_p].mean():
            pull[:n_p], pull[n_p:] = -prior / n_p, p[n_p:] / n_u
        else:
            pull[:n_p], pull[n_p:] = prior * p[:n_p] / n_p, -p[n_p:] / n_u
        gradient = np.append(np.bincount(flat, weights=pull[rows], minlength=len(ids)) + DECAY * model.value[:-1], pull.sum())
        model.move(gradient)
    weights[ids] = model.value[:-1]
    return weights, float(model.value[-1])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Classifier of the training rows: labels of ids whose crc32 modulo 5 is not 0."""
    own = in_fifths() != 0
    toxic = F.coalesce(F.col("toxic").cast("int"), F.lit(0))
    counts = labels.where(own).agg(F.avg(toxic).alias("prior")).first()
    prior = float(counts.prior or 0.0)
    sides = []
    for keep, rows in ((own & (toxic == 1), POSITIVES), (own, UNLABELLED)):
        _, flat, at = X.fetch(docs, X.sample(labels, keep, F.lit(1), rows), False)
        sides.append((flat, at))
    return train(sides[0], sides[1], prior)


def score(docs: DataFrame, model: tuple[np.ndarray, float], carry: list[str], name: str = "score") -> DataFrame:
    """``carry`` columns and ``name``, the probability of toxicity, for every row.

    A null or empty text has the score of a text without features. Repeated rows score alike.
    """
    weights, bias = model
    scored = X.margins(docs, weights, False, carry, name)
    return scored.withColumn(name, 1 / (1 + F.exp(-(F.col(name) + F.lit(bias)))))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; the rows of fold 0 are held out of the fit."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = score(docs, model, ["doc_id"])
    return out.select("doc_id", F.coalesce(in_fifths() == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= REJECT).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, unchanged. It is fitted on the labelled rows of ``documents``."""
    model = fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    name = fresh(docs, "toxicity")
    return score(docs, model, docs.columns, name).where(F.col(name) < REJECT).drop(name)
