"""Language ID: sparse multinomial logistic regression on TF-IDF of character n-grams.

Term frequencies are shares of a text's n-grams of one to three characters; document frequencies are counted over all
learning texts.  Weights are learned by follow-the-regularised-leader with L1 and L2 penalties, so most stay zero, and the
scores are made honest by a temperature fitted on texts that were left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.llm.features import drawn, ragged, row_sums
from wharfline.llm.text import binary, lean, mix, offsets_and_bytes

BITS, ORDERS = 16, 3
BLOCK_BYTES = 1 << 18  # of text at a time: each byte takes about 150 in arrays
SAMPLE = 800  # texts of each language in the training sample at most
EPOCHS, BATCH = 8, 64
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-3
SCALE = 20.0
UNKNOWN = "und"
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


class LanguageModel(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # n-gram slots x languages, inverse document frequency included
    bias: np.ndarray
    temperature: float


def _texts(batch: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Blocks of a batch with their lower-cased texts."""
    column = binary(batch.column(at))
    offsets, _ = offsets_and_bytes(column)
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK_BYTES, side="right")) - 1)
        yield batch.slice(lo, hi - lo), [x.decode("utf-8", "replace").lower() for x in column.slice(lo, hi - lo).to_pylist()]
        lo = hi


def has_letter(text: str) -> bool:
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    return bool(_LETTER[raw].any()) or any(c.isalpha() for c in text)


def ngram_slots(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of the texts one after the other, and the bounds of the texts.

    White space of any length counts as one space, and one stands before and after a text.
    """
    spaced = [f" {' '.join(t.split())} " for t in texts]
    sizes = np.array([len(t) for t in spaced], dtype=np.int64)
    points = np.frombuffer("".join(spaced).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    n = len(points)
    out = np.empty((n, ORDERS), dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    gram = np.zeros(n, dtype=np.uint64)
    valid = np.ones((n, ORDERS), dtype=bool)
    for k in range(ORDERS):
        gram[: n - k] = gram[: n - k] * np.uint64(1_000_003) + points[k:] + np.uint64(1)
        out[:, k] = (mix(gram, k) >> np.uint64(64 - BITS)).astype(np.int64)
        valid[: n - k, k] = owner[k:] == owner[: n - k]
        valid[n - k :, k] = False
    counts = np.bincount(owner, weights=valid.sum(1), minlength=len(texts)).astype(np.int64)
    return out[valid], np.concatenate(([0], np.cumsum(counts)))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts and in how many each slot occurs: a table of 2^BITS numbers, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, last = np.zeros(1 << BITS, dtype=np.int64), 0, np.zeros(1 << BITS, dtype=np.int64)
        for batch in batches:
            for _, block in _texts(batch, 0):
                slots, bounds = ngram_slots(block)
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    own = slots[a:b]
                    place = np.arange(len(own))
                    last[own] = place  # the last place of a slot stands for it
                    df[own[last[own] == place]] += 1
                n += len(block)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["slot", "df"])

    rows = texts.mapInArrow(lean(run), "slot long, df long").groupBy("slot").agg(F.sum("df").alias("df")).toArrow()
    df, n = np.zeros(1 << BITS, dtype=np.int64), 0
    slot, value = rows.column("slot").to_numpy(), rows.column("df").to_numpy()
    df[slot[slot >= 0]] = value[slot >= 0]
    n = int(value[slot < 0].sum())
    return n, df


def _profiles(rows: DataFrame) -> DataFrame:
    """(lang, hash, slots, amounts): distinct n-grams and their shares of one text for each language and hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            new = []
            for pair in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                new.append(pair not in seen)
                seen.add(pair)
            for part, block in _texts(batch.filter(pa.array(new, pa.bool_())), 1):
                slots, bounds = ngram_slots(block)
                s, x = [], []
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    own, counts = np.unique(slots[a:b], return_counts=True)
                    s.append(own.astype("<i4").tobytes()), x.append((counts / max(1, b - a)).astype("<f4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(s, pa.binary()), pa.array(x, pa.binary())], names=["lang", "hash", "slots", "amounts"])

    made = rows.select("lang", "text", "hash").mapInArrow(lean(run), "lang string, hash long, slots binary, amounts binary")
    return made.dropDuplicates(["lang", "hash"])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_ftrl(slots, values, bounds, y: np.ndarray, classes: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias; per-coordinate follow-the-regularised-leader over shuffled batches."""
    rng = np.random.default_rng(seed)
    size = (1 << BITS) + 1  # the last slot is the bias, which has no penalty
    z, n = np.zeros((size, classes)), np.zeros((size, classes))
    penalty = np.full((size, 1), L1)
    penalty[-1] = 0
    lengths = np.diff(bounds)

    def weights(at):
        return np.where(np.abs(z[at]) <= penalty[at], 0.0, -(z[at] - np.sign(z[at]) * penalty[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            rows = order[lo : lo + BATCH]
            e = np.concatenate(([0], np.cumsum(lengths[rows])))
            at = np.repeat(bounds[rows] - e[:-1], lengths[rows]) + np.arange(e[-1])
            used, place = np.unique(np.append(slots[at], size - 1), return_inverse=True)
            w = weights(used)
            own, x = place[:-1], values[at][:, None]
            p = _softmax(row_sums(w[own] * x, e) + w[place[-1]])
            p[np.arange(len(rows)), y[rows]] -= 1
            each = np.repeat(p / len(rows), lengths[rows], axis=0) * x
            g = np.stack([np.bincount(own, weights=each[:, c], minlength=len(used)) for c in range(classes)], axis=1)
            g[place[-1]] = p.mean(0)
            step = (np.sqrt(n[used] + g * g) - np.sqrt(n[used])) / ALPHA
            z[used] += g - step * w
            n[used] += g * g
    w = weights(np.arange(size))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits that makes the left-out texts likeliest."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> LanguageModel:
    """Learn from all rows of ``docs`` with a text and a language: document frequencies over all of them, weights from
    ``sample`` distinct texts of each language (all, if there are fewer).  Without any such row, the model knows no language."""
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    chosen = _profiles(drawn(rows, sample, F.xxhash64(F.lit("l"), "text"), "lang")).toArrow().sort_by([("hash", "ascending"), ("lang", "ascending")])
    if not chosen.num_rows:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 1.0)
    total, df = document_frequencies(rows.select("text"))
    idf = np.log((1 + total) / (1 + df)) + 0.1
    languages = sorted(set(chosen.column("lang").to_pylist()))
    y = np.array([languages.index(x) for x in chosen.column("lang").to_pylist()])
    slots, bounds = ragged(chosen.column("slots"), "<i4")
    values = ragged(chosen.column("amounts"), "<f4")[0] * idf[slots] * SCALE
    out = np.arange(len(y)) % 8 == 7  # left out for the temperature
    parts = {}
    for name, rows_of in (("fit", np.flatnonzero(~out)), ("out", np.flatnonzero(out))):
        size = np.diff(bounds)[rows_of]
        e = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(bounds[rows_of] - e[:-1], size) + np.arange(e[-1])
        parts[name] = slots[at].astype(np.int64), values[at], e, y[rows_of]
    weights, bias = fit_ftrl(*parts["fit"], len(languages))
    s, x, e, truth = parts["out"]
    temperature = fit_temperature(row_sums(weights[s] * x[:, None], e) + bias, truth)
    return LanguageModel(languages, (weights * (idf * SCALE)[:, None]).astype(np.float32), bias, temperature)


def predict(texts: list[str], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    slots, bounds = ngram_slots(texts)
    n = np.maximum(1, np.diff(bounds))[:, None]
    p = _softmax((row_sums(model.weights[slots], bounds) / n + model.bias) / model.temperature) if model.languages else np.zeros((len(texts), 1))
    known = np.array([bool(model.languages) and has_letter(t) for t in texts])
    best = p.argmax(1)
    return [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, p.max(1), 0.0)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` (a learned language, or ``und``) and ``score`` (0 to 1, calibrated).

    A null or empty text, or one without a letter, is ``und`` with score 0, as is any text if no language was learned.
    Ties go to the language first in order.  Rows are judged one by one from their whole text.  Columns of ``docs`` named
    lang_pred or score are replaced.  An empty table stays empty.
    """
    others = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rest = [c for c in others if c != text]
    rows = docs.select((F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))).alias("row"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in _texts(batch, 1):
                lang, score = predict(block, model)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(lang, pa.string()), pa.array(score)], names=["row", "text", "lang_pred", "score"])

    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(lean(run), schema).select(
        *((F.col("text") if c == text else F.col("row")[c]).alias(c) for c in others), "lang_pred", "score")
