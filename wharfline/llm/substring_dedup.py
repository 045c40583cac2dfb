"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark, merged into removal intervals.

A word goes if a window that covers it has its word sequence starting also in a document with a smaller key.
Sending one row for every window would move several times the input.  Windows that follow each other and have the same
smallest inner hash (of ``ANCHOR`` words) therefore travel as one *run*, about one row for twenty words:

* equal windows have equal inner hashes, so windows that are equal lie in runs of the same anchor;
* a run whose word sequence is found whole in a smaller document goes whole (first count, by 128-bit hash of the run);
* of a sequence whose anchor also heads a different sequence, all places in its smallest document are opened into their
  windows, which are then counted one by one (second count, by 128-bit hash of the window).

Both counts take a minimum per hash, which Spark combines before the shuffle; a passage in a third of all documents is
one key in the counts, and the joins that follow read stored tables, which adaptive execution may split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.llm.text import blocks, mix, powers, windows, word_bounds, word_hashes
from wharfline.session import cut

ANCHOR = 10
LOWEST = -(2**63)  # the document of null keys
_BASES = (0xC2B2AE3D27D4EB4F, 0x9FB21C651E98DF25)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries."""
    if len(x) < width:
        return x[:0]
    span, low = 1, x
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


class Spans:
    """128-bit hashes of any spans of a word array."""

    def __init__(self, words: np.ndarray):
        self.parts = []
        for base in _BASES:
            prefix = np.zeros(len(words) + 1, dtype=np.uint64)
            np.cumsum(words * powers(np.uint64(base | 1), len(words)), out=prefix[1:])
            self.parts.append((prefix, powers(np.uint64(pow(base | 1, -1, 2**64)), len(words) + 1)))

    def hash(self, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        size = (end - start).astype(np.uint64)
        return [mix((p[end] - p[start]) * inverse[start] + size, k).view(np.int64) for k, (p, inverse) in enumerate(self.parts)]


def runs_of(words: np.ndarray, docs: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (word number in the block), number of windows and anchor of every run; ``docs``: word number of each document."""
    inner = min(ANCHOR, window)
    low = sliding_min(windows(words, inner), window - inner + 1)
    owner = np.repeat(np.arange(len(docs) - 1), np.diff(docs))
    valid = np.flatnonzero(owner[: len(low)] == owner[window - 1 :][: len(low)]) if len(low) else np.zeros(0, np.int64)
    if not len(valid):
        return valid, valid, np.zeros(0, dtype=np.uint64)
    low, whose = low[valid], owner[valid]
    new = np.concatenate(([True], (low[1:] != low[:-1]) | (whose[1:] != whose[:-1])))
    start = np.flatnonzero(new)
    return valid[start], np.diff(np.concatenate((start, [len(valid)]))), low[start]


def _runs(rows: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, offsets, raw in blocks(batch, "text"):
                starts, ends, docs = word_bounds(offsets, raw)
                words = word_hashes(raw, starts, ends)
                first, count, anchor = runs_of(words, docs, window)
                s1, s2 = Spans(words).hash(first, first + count + window - 1)
                owner = np.searchsorted(docs, first, side="right") - 1
                at = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(s1), pa.array(s2), part.column(0).take(at), part.column(1).take(at),
                     pa.array((first - docs[owner]).astype(np.int32)), pa.array(count.astype(np.int32))],
                    names=["anchor", "s1", "s2", "doc", "copy", "start", "n"])

    return rows.select("doc", "copy", "text").mapInArrow(run, "anchor long, s1 long, s2 long, doc long, copy long, start int, n int")


def _open_runs(rows: DataFrame, window: int) -> DataFrame:
    """The windows of the runs that a row's ``runs`` name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, offsets, raw in blocks(batch, "text"):
                starts, ends, docs = word_bounds(offsets, raw)
                spans = Spans(word_hashes(raw, starts, ends))
                lists = part.column(part.schema.get_field_index("runs"))
                sizes = lists.value_lengths().to_numpy()
                flat = lists.flatten()
                owner = np.repeat(np.arange(len(sizes)), sizes)
                start, n = flat.field(0).to_numpy().astype(np.int64), flat.field(1).to_numpy().astype(np.int64)
                edges = np.concatenate(([0], np.cumsum(n)))
                place = np.repeat(start - edges[:-1], n) + np.arange(edges[-1])
                owner = np.repeat(owner, n)
                at = pa.array(owner)
                h1, h2 = spans.hash(place + docs[owner], place + docs[owner] + window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1), pa.array(h2), part.column(0).take(at), part.column(1).take(at), pa.array(place.astype(np.int32))],
                    names=["h1", "h2", "doc", "copy", "start"])

    return rows.mapInArrow(run, "h1 long, h2 long, doc long, copy long, start int")


def removal_intervals(rows: DataFrame, window: int) -> DataFrame:
    """(doc, copy, spans): sorted windows to remove, as lists of (first window, number of windows)."""
    runs = cut(_runs(rows, window), "substring-runs")
    head = F.min(F.struct("doc", "copy", "start", "n")).alias("head")
    heads = cut(runs.groupBy("anchor", "s1", "s2").agg(head, F.max("doc").alias("last"), F.count("*").alias("k")), "substring-heads")
    mixed = cut(heads.groupBy("anchor").agg(F.count("*").alias("m")).filter("m > 1").select("anchor"), "substring-mixed")
    # places besides the head: whole in a larger document, opened in the head's own, of which nothing goes if it is the smallest of all
    again = cut(
        heads.filter("k > 1").join(mixed.withColumn("mixed", F.lit(True)), "anchor", "left")
        .select("s1", "s2", F.col("head.doc").alias("first"), (F.col("mixed").isNotNull() & (F.col("head.doc") > LOWEST)).alias("open"), "last")
        .filter("first < last or open").drop("last"), "substring-again")
    others = cut(
        runs.join(again, ["s1", "s2"]).filter("first < doc or (first = doc and open)")
        .select("doc", "copy", "start", "n", (F.col("first") < F.col("doc")).alias("whole")), "substring-others")
    whole = others.filter("whole").drop("whole")
    inner = heads.join(mixed, "anchor").select("head.*").unionByName(others.filter("not whole").drop("whole"))
    # a set: repeated rows give the same places
    opened = cut(inner.groupBy("doc", "copy").agg(F.collect_set(F.struct("start", "n")).alias("runs")), "substring-opened")
    # a repeated row would give its windows twice, which changes no minimum
    places = cut(_open_runs(rows.join(opened, ["doc", "copy"]).select("doc", "copy", "text", "runs"), window), "substring-windows")
    firsts = cut(places.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last").drop("last"),
                 "substring-firsts")
    single = places.join(firsts, ["h1", "h2"]).filter("first < doc").select("doc", "copy", "start", F.lit(1).alias("n"))
    gone = whole.unionByName(single).distinct()
    return cut(gone.groupBy("doc", "copy").agg(F.collect_list(F.struct("start", "n")).alias("spans")), "substring-spans")


def keep_mask(n_words: int, starts: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """False for the words that the windows cover."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + counts + window - 1, -1)
    return np.cumsum(edge[:-1]) == 0


def substring_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = 50) -> DataFrame:
    """``docs`` with repeated windows taken out of ``text`` (kept words joined by one space), n_words and n_removed.

    A null or empty text has no words and comes back empty.  Rows with one key are one document: what they share stays.
    A null key is the smallest.  Texts of fewer words than a window keep all.  Columns of ``docs`` named n_words or
    n_removed are replaced.  Very long texts are read whole.  An empty table stays empty.
    """
    others = [c for c in docs.columns if c not in (text, "n_words", "n_removed")]
    lowest = F.lit(LOWEST).cast("long")
    rows = docs.select(F.struct(*others).alias("row"), F.col(text).alias("text"),
                       F.coalesce(F.col(key).cast("long"), lowest).alias("doc"), F.xxhash64(text).alias("copy"))
    spans = removal_intervals(rows.select("doc", "copy", "text"), window)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, offsets, raw in blocks(batch, "text"):
                data = raw.tobytes()
                kept, counts, removed = [], [], []
                for d, gone in enumerate(part.column("spans")):
                    words = data[offsets[d] : offsets[d + 1]].split()
                    counts.append(len(words))
                    if gone.is_valid:
                        own = gone.values
                        mask = keep_mask(len(words), own.field(0).to_numpy().astype(np.int64), own.field(1).to_numpy().astype(np.int64), window)
                        words = [words[k] for k in np.flatnonzero(mask)]
                    removed.append(counts[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                    names=["row", "text", "n_words", "n_removed"])

    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    out = rows.join(spans, ["doc", "copy"], "left").select("row", "text", "spans").mapInArrow(apply, schema)
    return out.select("row.*", F.col("text").alias(text), "n_words", "n_removed")
