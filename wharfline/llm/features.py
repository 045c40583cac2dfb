"""Hashed words of texts for the classifiers, and the bounded training samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharfline.llm import text as T
from wharfline.session import cut

FEW = 100_000  # strata, of a name and a number each, that are sent to every task
_BREAK = np.ones(256, dtype=bool)  # everything but ASCII letters and bytes of other scripts
_BREAK[65:91] = _BREAK[97:123] = _BREAK[128:] = False


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key's text, modulo ``folds`` (null: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def letter_words(offsets: np.ndarray, raw: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the document and slot below 2^bits of every lower-cased run of letters."""
    starts, ends, docs = T.word_bounds(offsets, raw, _BREAK)
    slots = (T.word_hashes(T.lower_ascii(raw), starts, ends) >> np.uint64(64 - bits)).astype(np.int64)
    return np.repeat(np.arange(len(offsets) - 1), np.diff(docs)), slots


def counted(owner: np.ndarray, slots: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, slot) in order, and how often each occurs."""
    keys, counts = np.unique((owner << bits) | slots, return_counts=True)
    return keys >> bits, keys & ((1 << bits) - 1), counts


def sampled(rows: DataFrame, limit: int, by: Column, stratum: str | None = None) -> DataFrame:
    """At most about ``limit`` rows (of each stratum), chosen by the hash ``by`` alone; all rows if there are fewer."""
    wide = F.lit(1 << 30)
    place = F.pmod(by, wide)
    if stratum is None:
        n = rows.count()
        return rows if n <= limit else rows.filter(place < int(limit / n * (1 << 30)))
    counts = rows.groupBy(stratum).agg(F.count("*").alias("__n"))
    # the texts stay where they are if the strata are few, whatever share of the rows one of them holds
    few = counts.count() <= FEW
    return rows.join(F.broadcast(counts) if few else counts, stratum).filter(place.cast("double") * F.col("__n") < float(limit << 30)).drop("__n")


SALTS = 64


def drawn(rows: DataFrame, limit: int, by: Column, stratum: str) -> DataFrame:
    """Rows of exactly ``limit`` smallest values ``hash`` of ``by`` in each stratum (all, if there are fewer), each with all its copies.

    Ranks are taken within salted parts first, so that a large stratum is no single task.
    """
    hashed = rows.withColumn("hash", by)
    salted = Window.partitionBy(stratum, F.pmod("hash", F.lit(SALTS))).orderBy("hash")
    few = hashed.select(stratum, "hash").distinct().withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= limit)
    whole = few.withColumn("rank", F.row_number().over(Window.partitionBy(stratum).orderBy("hash"))).filter(F.col("rank") <= limit)
    chosen = cut(whole.select(stratum, "hash"), "sample-drawn")
    # the texts stay where they are if the strata are few
    return hashed.join(F.broadcast(chosen) if chosen.count() <= FEW else chosen, [stratum, "hash"])


def drawn_texts(rows: DataFrame, limit: int, seed: str) -> DataFrame:
    """Exactly ``limit`` distinct (key, text) of ``rows`` (all, if there are fewer), each once, with ``hash``.

    The hash of both decides: rows of one key, and null keys, are drawn apart by their texts, and copies count once.  The
    hashes are counted first, so that those that are put in order are hardly more than ``limit`` (by six standard deviations).
    """
    hashed = rows.withColumn("hash", F.xxhash64(F.lit(seed), F.col("key").isNull(), "key", F.col("text").isNull(), "text"))
    distinct = cut(hashed.select("hash").distinct(), "sample-hashes")
    n = distinct.count()
    if n > limit:
        place = F.shiftrightunsigned("hash", 33)  # 31 bits
        share = (limit + 6 * limit**0.5 + 20) / n
        some = distinct.filter(place < min(1 << 31, int(share * (1 << 31)) + 1))
        chosen = cut(some.orderBy(place, "hash").limit(limit), "sample-drawn")
        hashed = hashed.join(F.broadcast(chosen) if limit <= FEW else chosen, "hash")
    return hashed.dropDuplicates(["hash"])


def ragged(column: pa.ChunkedArray | pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column's rows one after the other, and the bounds of the rows."""
    parts = [np.frombuffer(x, dtype=dtype) for x in column.to_pylist()]
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))
    return (np.concatenate(parts) if parts else np.zeros(0, dtype=dtype)), bounds


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over the rows of a ragged array (0 for empty rows)."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), dtype=np.float64)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, bounds[:-1][full], axis=0, dtype=np.float64)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
