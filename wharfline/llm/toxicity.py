"""Toxicity by non-negative positive-unlabelled learning.

The classifier sees confirmed toxic texts and a sample of all texts, whose labels it does not look at.  With the class
prior pi, the risk of calling a clean text toxic is estimated as the unlabelled risk less pi times the positive one; when
that goes below zero, the step is taken back along its gradient instead (the non-negative correction).  The model is
linear in which hashed words occur, so that one word counts the same in a short and in a very long text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline.llm.features import counted, drawn_texts, letter_words, ragged, row_sums, sigmoid
from wharfline.llm.text import blocks

BITS = 18
POSITIVES, UNLABELLED = 8_000, 24_000  # texts of the training sample at most (about)
EPOCHS, RATE, SHRINK = 200, 0.05, 1e-4
SURE, LEAST = 4.0, 2.5  # standard errors, and texts, by which a word must be commoner in the toxic ones


class ToxicModel(NamedTuple):
    weights: np.ndarray
    bias: float
    prior: float


def _present(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and ``slots``: the distinct hashed words of the text."""
    kept = rows.select(*columns, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, offsets, raw in blocks(batch, "text"):
                owner, slots, _ = counted(*letter_words(offsets, raw, BITS), BITS)
                cuts = np.searchsorted(owner, np.arange(part.num_rows + 1))
                lists = [slots[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(lists, pa.binary())], names=[*columns, "slots"])

    return kept.mapInArrow(run, kept.drop("text").schema.add("slots", "binary"))


def fit_nnpu(slots: np.ndarray, bounds: np.ndarray, positive: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias from rows that are positive or unlabelled; Adam on the corrected risk with the logistic loss."""
    size = 1 << BITS
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    # the slope of the risk at weight 0 is prior * (unlabelled share - positive share) of a word: only words that are commoner in
    # the positives by more than chance explains get a weight
    in_p = np.bincount(slots[positive[owner]], minlength=size) / n_p
    in_u = np.bincount(slots[~positive[owner]], minlength=size) / n_u
    known = in_p - in_u > SURE * np.sqrt(in_u * (1 - np.minimum(in_u, 1)) / n_p) + LEAST / n_p
    slots, owner = slots[known[slots]], owner[known[slots]]
    bounds = np.searchsorted(owner, np.arange(len(bounds)))
    w, b = np.zeros(size), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, EPOCHS + 1):
        z = row_sums(w[slots], bounds) + b
        p = sigmoid(z)
        # losses: -log p for a positive, -log(1 - p) for a negative; their slopes are p - 1 and p
        risk_u = np.logaddexp(0, z[~positive]).mean() if (~positive).any() else 0.0
        risk_p = np.logaddexp(0, z[positive]).mean() if positive.any() else 0.0
        if risk_u - prior * risk_p >= 0:
            slope = np.where(positive, prior * (p - 1) / n_p - prior * p / n_p, p / n_u)
        else:  # the estimated risk of clean texts is negative: undo the overfit
            slope = np.where(positive, prior * p / n_p, -p / n_u)
        grad = np.concatenate((np.bincount(slots, weights=slope[owner], minlength=size), [slope.sum()]))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
        w, b = w - move[:-1], b - move[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * SHRINK / (np.sqrt(v[:-1] / (1 - 0.999**step)) + 1e-7), 0)
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
          prior: float | None = None, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> ToxicModel:
    """Fit on ``positives`` toxic texts and ``unlabelled`` texts of ``docs`` (all, if there are fewer).

    Copies of a text under one key count once; rows with a null key are drawn by their texts.  Which texts are drawn follows from
    the hashes of keys and texts alone.

    ``prior`` is the share of toxic texts; by default, that of the labelled rows.  Null labels and null keys are no labels.
    Without a toxic text, the model gives the prior to every text.
    """
    marks = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).select(F.col(key).alias("key"), (F.col(label) == 1).cast("int").alias("mark"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    marked = marks.join(rows.select("key").distinct(), "key", "left_semi")
    n, share = marked.agg(F.count("*"), F.avg("mark")).first()
    prior = min(0.95, max(0.001, prior if prior is not None else (share or 0.001)))
    keys = marked.filter("mark = 1").select("key", F.lit(None).cast("string").alias("text")).distinct()
    toxic = drawn_texts(keys, positives, "p").select("key")
    confirmed = drawn_texts(rows.join(F.broadcast(toxic), "key", "left_semi"), positives, "p")  # at most ``positives`` keys
    texts = confirmed.withColumn("positive", F.lit(True)).unionByName(drawn_texts(rows, unlabelled, "u").withColumn("positive", F.lit(False)))
    sample = _present(texts.select("positive", "hash", "text"), ["positive", "hash"]).toArrow().sort_by([("positive", "descending"), ("hash", "ascending")])
    positive = np.array(sample.column("positive").to_pylist(), dtype=bool)
    if not positive.any():
        return ToxicModel(np.zeros(1 << BITS, dtype=np.float32), float(np.log(prior / (1 - prior))), prior)
    slots, bounds = ragged(sample.column("slots"), "<i4")
    weights, bias = fit_nnpu(slots.astype(np.int64), bounds, positive, prior)
    return ToxicModel(weights.astype(np.float32), bias, prior)


def score(docs: DataFrame, model: ToxicModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.5) -> DataFrame:
    """``keep`` columns, ``score`` (0 to 1) and ``predicted`` (1 if score >= threshold) of every row.

    A null or empty text gets the score of a text without words.  Rows are scored one by one, from their whole text:
    repeated rows get the same score, and other columns have no effect.  An empty table gives no rows.
    """
    rows = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live = model.weights != 0
        for batch in batches:
            for part, offsets, raw in blocks(batch, "__text"):
                owner, slots = letter_words(offsets, raw, BITS)
                owner, slots, _ = counted(owner[live[slots]], slots[live[slots]], BITS)
                z = np.bincount(owner, weights=model.weights[slots], minlength=part.num_rows) + model.bias
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(keep))), pa.array(sigmoid(z))], names=[*keep, "score"])

    out = rows.mapInArrow(run, rows.drop("__text").schema.add("score", "double"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
