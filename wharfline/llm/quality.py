"""Text quality by a factorisation machine.

Inputs are hashed words (damped counts of unit length), statistics of a text's structure and the row's own length field.
Besides a weight, each input has a vector of ``FACTORS`` numbers, and each pair of inputs adds the product of
their vectors.  The sum over all pairs is half of the square of sums less the sum of squares: linear in the inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline.llm.features import counted, drawn_texts, letter_words, ragged, row_sums, sigmoid
from wharfline.llm.text import blocks, word_bounds, word_hashes

BITS, FACTORS = 16, 8
SAMPLE = 16_000  # labelled texts of the training sample at most
EPOCHS, BATCH, RATE, DECAY = 12, 256, 0.02, 1e-5
STATISTICS = 14
_CLASSES = np.zeros(256, dtype=np.int64)  # of bytes: letters, upper case, digits, marks, white space, other
_CLASSES[33:127] = 3
_CLASSES[97:123], _CLASSES[65:91], _CLASSES[48:58] = 0, 1, 2
_CLASSES[[9, 10, 11, 12, 13, 32]] = 4
_CLASSES[128:] = 5


class QualityModel(NamedTuple):
    weights: np.ndarray
    factors: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray
    slope: float = 1.0  # of the logit, and what is added to it, as fitted on texts that were left out
    offset: float = 0.0


def statistics(offsets: np.ndarray, raw: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Structure of each text: shares of byte classes, word lengths, repetition, lines, and its length field."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    size = np.maximum(1, np.diff(offsets)).astype(np.float64)
    out = np.zeros((n, STATISTICS))
    shares = np.bincount(owner * 6 + _CLASSES[raw], minlength=n * 6).reshape(n, 6)
    out[:, :6] = shares / size[:, None]
    starts, ends, docs = word_bounds(offsets, raw)
    words = np.diff(docs)
    whose = np.repeat(np.arange(n), words)
    many = np.maximum(1, words).astype(np.float64)
    out[:, 6] = np.bincount(whose, weights=np.minimum(ends - starts, 40), minlength=n) / many
    hashes = word_hashes(raw, starts, ends)
    distinct, _, _ = counted(whose, (hashes >> np.uint64(24)).astype(np.int64), 40)
    out[:, 7] = np.bincount(distinct, minlength=n) / many
    marks = _CLASSES[raw] == 3
    out[:, 8] = np.bincount(whose[marks[np.maximum(ends - 1, 0)]], minlength=n) / many  # words that end in a mark
    lone = (ends - starts == 1) & marks[np.minimum(starts, max(0, len(raw) - 1))] if len(raw) else np.zeros(0, bool)
    out[:, 9] = np.bincount(whose[lone], minlength=n) / many  # marks that stand alone
    twice = np.zeros(len(raw), dtype=bool)
    twice[1:] = marks[1:] & marks[:-1]
    out[:, 10] = np.bincount(owner[twice], minlength=n) / size
    out[:, 11] = np.log1p(words)
    out[:, 12] = np.bincount(owner[raw == 10], minlength=n) / many
    out[:, 13] = np.log1p(np.maximum(0, length))
    return out


def _inputs(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``columns``, ``slots``, ``amounts`` and ``stats`` of each text; ``rows`` has text and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, offsets, raw in blocks(batch, "text"):
                bounds, slots, amounts, stats = _block(offsets, raw, _length(part))
                pairs = list(zip(bounds[:-1], bounds[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in columns), pa.array([slots[a:b].astype("<i4").tobytes() for a, b in pairs], pa.binary()),
                     pa.array([amounts[a:b].astype("<f4").tobytes() for a, b in pairs], pa.binary()),
                     pa.array([s.astype("<f8").tobytes() for s in stats], pa.binary())], names=[*columns, "slots", "amounts", "stats"])

    schema = rows.select(*columns).schema.add("slots", "binary").add("amounts", "binary").add("stats", "binary")
    return rows.select(*columns, "text", "length").mapInArrow(run, schema)


def _length(part: pa.RecordBatch) -> np.ndarray:
    return part.column(part.schema.get_field_index("length")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)


def _block(offsets: np.ndarray, raw: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    owner, slots, counts = counted(*letter_words(offsets, raw, BITS), BITS)
    bounds = np.searchsorted(owner, np.arange(len(offsets)))
    amounts = np.log1p(counts)
    norm = np.sqrt(row_sums(amounts * amounts, bounds))
    return bounds, slots, amounts / norm[owner], statistics(offsets, raw, length)


def _with_stats(slots, amounts, bounds, stats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Append each row's statistics to its words, in slots of their own after the hashed ones."""
    n, k = stats.shape
    sizes = np.diff(bounds) + k
    ends = np.concatenate(([0], np.cumsum(sizes)))
    at = np.concatenate((np.arange(len(slots)) + np.repeat(np.arange(n) * k, np.diff(bounds)), (ends[1:, None] - k + np.arange(k)).ravel()))
    s, x = np.empty(ends[-1], dtype=np.int64), np.empty(ends[-1])
    s[at] = np.concatenate((slots, np.tile((1 << BITS) + np.arange(k), n)))
    x[at] = np.concatenate((amounts, stats.ravel()))
    return s, x, ends


def predict(model: QualityModel, slots: np.ndarray, amounts: np.ndarray, bounds: np.ndarray, stats: np.ndarray) -> np.ndarray:
    scaled = np.clip((stats - model.mean) / model.scale, -4, 4) * 0.25
    s, x, ends = _with_stats(slots, amounts, bounds, scaled)
    return sigmoid(model.slope * _raw(model.weights, model.factors, model.bias, s, x, ends)[0] + model.offset)


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logits that fit the left-out labels; targets just short of 0 and 1 keep them finite."""
    n1, n0 = y.sum(), (1 - y).sum()
    if not n1 or not n0:
        return 1.0, 0.0
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    ab = np.array([1.0, 0.0])
    x = np.stack([z, np.ones(len(z))], axis=1)
    for _ in range(60):
        p = sigmoid(x @ ab)
        grad = x.T @ (p - t) + 1e-3 * (ab - [1.0, 0.0])
        ab = ab - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), grad).clip(-1, 1)
    return (float(ab[0]), float(ab[1])) if ab[0] > 0 else (1.0, 0.0)


def _raw(w, v, b, s, x, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vx = v[s] * x[:, None]
    total = row_sums(vx, ends)
    z = b + row_sums(w[s] * x, ends) + 0.5 * ((total * total).sum(1) - row_sums((vx * vx).sum(1), ends))
    return z, total, vx


def fit_machine(slots, amounts, bounds, stats, y: np.ndarray, seed: int = 7) -> QualityModel:
    """AdaGrad over shuffled batches; the logistic loss of the machine's output."""
    rng = np.random.default_rng(seed)
    mean, scale = stats.mean(0), np.maximum(stats.std(0), 1e-6)
    s, x, ends = _with_stats(slots, amounts, bounds, np.clip((stats - mean) / scale, -4, 4) * 0.25)
    size = (1 << BITS) + stats.shape[1]
    w, v = np.zeros(size), rng.normal(0, 0.02, (size, FACTORS))
    share = min(0.99, max(0.01, y.mean()))
    b = float(np.log(share / (1 - share)))
    gw, gv, gb = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    lengths = np.diff(ends)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            rows = order[lo : lo + BATCH]
            e = np.concatenate(([0], np.cumsum(lengths[rows])))
            at = np.repeat(ends[rows] - e[:-1], lengths[rows]) + np.arange(e[-1])
            ss, xx = s[at], x[at]
            z, total, vx = _raw(w, v, b, ss, xx, e)
            g = np.repeat((sigmoid(z) - y[rows]) / len(rows), lengths[rows]) * xx
            used, place = np.unique(ss, return_inverse=True)
            dw = np.bincount(place, weights=g) + DECAY * w[used]
            whose = np.repeat(np.arange(len(rows)), lengths[rows])
            each = g[:, None] * (total[whose] - vx)
            dv = np.stack([np.bincount(place, weights=each[:, k]) for k in range(FACTORS)], axis=1) + DECAY * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= 5 * RATE * dw / np.sqrt(gw[used])
            v[used] -= RATE * dv / np.sqrt(gv[used])
            db = (sigmoid(z) - y[rows]).mean()
            gb += db * db
            b -= 5 * RATE * db / np.sqrt(gb)
    return QualityModel(w.astype(np.float32), v.astype(np.float32), float(b), mean, scale)


def _rows(slots, amounts, bounds, stats, y, rows: np.ndarray) -> tuple:
    size = np.diff(bounds)[rows]
    ends = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(bounds[rows] - ends[:-1], size) + np.arange(ends[-1])
    return slots[at], amounts[at], ends, stats[rows], y[rows]


def fit(slots, amounts, bounds, stats, y: np.ndarray) -> QualityModel:
    """The machine from seven of eight texts, its calibration from the eighth."""
    out = np.arange(len(y)) % 8 == 7
    model = fit_machine(*_rows(slots, amounts, bounds, stats, y, np.flatnonzero(~out)))
    *inputs, truth = _rows(slots, amounts, bounds, stats, y, np.flatnonzero(out))
    if not len(truth):
        return model
    p = np.clip(predict(model, *inputs), 1e-9, 1 - 1e-9)
    slope, offset = calibrate(np.log(p / (1 - p)), truth)
    return model._replace(slope=slope, offset=offset)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
          length: str | None = "n_chars", sample: int = SAMPLE) -> QualityModel:
    """Fit on ``sample`` labelled texts (all, if there are fewer); ``length``: a length column, None if there is none.

    Null labels and null keys are no labels; a key that is labelled both ways counts as labelled 1.  Copies of a text under one key
    count once.  Which texts are drawn, left out for the calibration and taken together in a step follows from the hashes
    of keys and texts alone, not from how the rows lie.  Without any labelled text, every score is 0.5.
    """
    marks = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max((F.col(label) == 1).cast("double")).alias("y"))
    chosen = drawn_texts(marks.withColumn("text", F.lit(None).cast("string")), sample, "q").select("key", "y")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), (F.col(length) if length else F.lit(None)).cast("double").alias("length"))
    labelled = drawn_texts(rows.join(F.broadcast(chosen), "key"), sample, "q")  # at most ``sample`` keys
    texts = _inputs(labelled.select("y", "hash", "text", "length"), ["y", "hash"]).toArrow().sort_by("hash")
    if not texts.num_rows:
        size = (1 << BITS) + STATISTICS
        return QualityModel(np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32), 0.0, np.zeros(STATISTICS), np.ones(STATISTICS))
    slots, bounds = ragged(texts.column("slots"), "<i4")
    amounts, _ = ragged(texts.column("amounts"), "<f4")
    stats = ragged(texts.column("stats"), "<f8")[0].reshape(-1, STATISTICS)
    return fit(slots.astype(np.int64), amounts.astype(np.float64), bounds, stats, texts.column("y").to_numpy())


def score(docs: DataFrame, model: QualityModel, text: str = "text", length: str | None = "n_chars", keep: tuple[str, ...] = ("doc_id",),
          threshold: float = 0.3) -> DataFrame:
    """``keep`` columns, ``score`` (0 to 1) and ``predicted`` (1 if score >= threshold) of every row.

    A null or empty text gets the score of a text without words; a null length counts as 0.  Rows are scored one by one
    from their whole text; repeated rows get the same score, and other columns have no effect.
    """
    rows = docs.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), F.col(text).alias("text"),
                       (F.col(length) if length else F.lit(None)).cast("double").alias("length"))
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, offsets, raw in blocks(batch, "text"):
                bounds, slots, amounts, stats = _block(offsets, raw, _length(part))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(predict(model, slots, amounts, bounds, stats))], names=[*names, "score"])

    out = rows.mapInArrow(run, rows.select(*names).schema.add("score", "double"))
    return out.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
