"""Near duplicates: banded MinHash for candidates, odd sketches to judge them, full sets to confirm, components.

Texts with equal shingle sets are one *class*; only classes are compared, and none of their copies is expanded.

* ``BANDS`` bands of ``ROWS`` MinHash values put a class into as many buckets.  Two classes of similarity 0.8 share no
  bucket with probability (1 - 0.8^4)^32 = 5e-8, at 0.85 5e-11.
* The 128 MinHash values of a class are also folded into an odd sketch: each flips one of 1024 bits.  The number of
  bits in which two sketches differ estimates a high similarity closely; candidates far below the threshold go
  unread (``MARGIN``: about five standard errors).  Classes in crowded buckets get a sketch of eight times the size.
* No bucket is expanded into pairs.  First, every member meets two hubs of its bucket, the same for all buckets of a
  group.  Then components are formed, and only members outside the largest component of their bucket meet those of other
  components.  Pairs within a component need no look: they change nothing.
* Components come from alternating large and small stars, in stored tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharfline.llm.text import blocks, lean, lower_ascii, mix, ngrams, word_bounds, word_hashes
from wharfline.session import cut

BANDS, ROWS = 32, 4
SAMPLES, WIDE = BANDS * ROWS, 1024  # MinHash values of a sketch
BITS_PER_SAMPLE = 8
MARGIN, WIDE_MARGIN = 0.16, 0.057
_FACTORS = mix(np.arange(1, WIDE + 1, dtype=np.uint64), 11) | np.uint64(1)
_SHIFTS = mix(np.arange(1, WIDE + 1, dtype=np.uint64), 12)
_SALTS = mix(np.arange(1, BANDS + 1, dtype=np.uint64), 13)


def shingle_sets(offsets: np.ndarray, raw: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: ``size`` words, all words of a shorter text, none of an empty one."""
    starts, ends, docs = word_bounds(offsets, raw)
    words = word_hashes(lower_ascii(raw), starts, ends)
    grams = ngrams(words, size)
    out = []
    for a, b in zip(docs[:-1], docs[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        else:
            out.append(ngrams(words[a:b], int(b - a), 5) if b > a else words[:0])
    return out


def minhash(sets: list[np.ndarray], samples: int = SAMPLES) -> np.ndarray:
    """One row of ``samples`` minima for each (non-empty) set."""
    flat = np.concatenate(sets)
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1])).astype(np.int64)
    out = np.empty((len(sets), samples), dtype=np.uint64)
    for k in range(samples):
        out[:, k] = np.minimum.reduceat(flat * _FACTORS[k] + _SHIFTS[k], first)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of BITS_PER_SAMPLE bits for each sample, as 64-bit words."""
    n, k = samples.shape
    place = (mix(samples + _SHIFTS[:k], 14) & np.uint64(BITS_PER_SAMPLE * k - 1)).astype(np.int64)
    parity = np.zeros((n, BITS_PER_SAMPLE * k), dtype=np.uint8)
    np.bitwise_xor.at(parity, (np.arange(len(samples))[:, None], place), np.uint8(1))
    return np.packbits(parity, axis=1, bitorder="little").view(np.uint64)


def most_different(similarity: float, samples: int = SAMPLES, margin: float = MARGIN) -> int:
    """Bits in which the sketches of two sets of this similarity less ``margin`` are expected to differ."""
    low, bits = max(0.0, similarity - margin), BITS_PER_SAMPLE * samples
    return math.ceil(bits / 2 * (1 - math.exp(-4 * samples * (1 - low) / bits)))


def _signatures(rows: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "copy", "n", "c1", "c2", "bands", "sketch"]
        for batch in batches:
            for part, offsets, raw in blocks(batch, "text"):
                sets = shingle_sets(offsets, raw, size)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                c1, c2 = (np.array([mix(s, k).sum(dtype=np.uint64) for s in sets], dtype=np.uint64) for k in (21, 22))
                full = [s for s in sets if len(s)]
                bands = np.zeros((len(sets), BANDS), dtype=np.uint64)
                sketch = np.zeros((len(sets), BITS_PER_SAMPLE * SAMPLES // 64), dtype=np.uint64)
                if full:
                    low = minhash(full)
                    key = low[:, ::ROWS].copy()
                    for k in range(1, ROWS):
                        key = mix(key, k) + low[:, k::ROWS]
                    bands[n > 0], sketch[n > 0] = mix(key + _SALTS, 15), odd_sketch(low)
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.view(np.int64).ravel()), x.shape[1]).cast(pa.list_(pa.int64())) for x in (bands, sketch)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)), *lists], names=names)

    return rows.select("doc", "copy", "text").mapInArrow(
        lean(run), "doc long, copy long, n long, c1 long, c2 long, bands array<long>, sketch array<long>")


def _sets(rows: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, offsets, raw in blocks(batch, "text"):
                sets = [s.tobytes() for s in shingle_sets(offsets, raw, size)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return rows.select("node", "text").mapInArrow(lean(run), "node long, shingles binary")


def _wide_sketches(sets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                full = [np.frombuffer(x, dtype=np.uint64) for x in part.column(1).to_pylist()]
                words = odd_sketch(minhash(full, WIDE)).view(np.int64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(words.ravel()), words.shape[1]).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["node", "wide"])

    return sets.select("node", "shingles").mapInArrow(lean(run), "node long, wide array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(k) for k in (2, 3))
            good = []
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(c[k].as_buffer(), dtype=np.uint64) for c in (left, right))
                x, y = (x, y) if len(x) >= len(y) else (y, x)
                at = np.searchsorted(x, y)
                both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    full = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        .select("a", "b", "x", "y")
    )
    return full.mapInArrow(lean(run), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge (a, b); component: the smallest node reachable.

    Large star: each larger neighbour is tied to the smallest one; small star: each smaller neighbour is.  When a round
    changes nothing, every node is tied to its component.  A round takes minima per node, combined before the
    shuffle, and joins them to stored tables, so that a node with very many edges may be split.
    """
    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = cut(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-edges")
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "component-low")
        large = cut(both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct(), "component-large")
        low = cut(large.groupBy("a").agg(F.min("b").alias("m")), "component-low")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.withColumnRenamed("m", "b"))
        edges = cut(small.filter("a != b").distinct(), "component-small")
        now = mark(edges)
        if now == before:
            break
        before = now
    # every node hangs on its component; the component itself has no edge of its own
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, percent: int = 85) -> DataFrame:
    """All columns of ``docs`` with ``n_shingles``, ``component_id`` and ``kept`` (the row's key is its component).

    Texts are linked if 100 * intersection >= percent * union of their sets of ``shingle``-word shingles (A-Z in lower
    case).  A null or empty text has an empty set and no links.  A repeated row is a copy; rows with one key belong
    to one document, and all that its texts are linked with is one component.  A null key is a document of its own and stays
    null: its component is the smallest key of its group, null without one, where one row of the group is kept.
    Columns of ``docs`` named like the results are replaced.  Very long texts are read whole.  An empty table stays empty.
    """
    others = [c for c in docs.columns if c not in (text, "n_shingles", "component_id", "kept")]
    # a null key: a node of each text; copies of a text are copies of the document
    named = docs.select(F.struct(*others).alias("row"), F.col(text).alias("text"), F.col(key).isNull().alias("nameless"),
                        F.coalesce(F.col(key).cast("long"), F.xxhash64(F.lit("null key"), text)).alias("doc"), F.xxhash64(text).alias("copy"))
    rows = named.select("doc", "copy", "text")
    signatures = cut(_signatures(rows, shingle), "near-signatures")
    classes = cut(
        signatures.filter("n > 0").groupBy("c1", "c2").agg(
            F.min(F.struct("doc", "copy")).alias("head"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .select("c1", "c2", F.col("head.doc").alias("node"), F.col("head.copy").alias("copy"), "n", "bands", "sketch"),
        "near-classes")

    members = cut(classes.select(F.posexplode("bands").alias("band", "bucket"), "node"), "near-members")
    buckets = cut(
        members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("hub"), F.min(F.struct(F.xxhash64("node"), "node")).alias("other"))
        .filter("size > 1").select("bucket", "size", "hub", F.col("other.node").alias("other")), "near-buckets")
    shared = cut(members.join(buckets, "bucket"), "near-shared")
    meetings = shared.select(F.explode(F.array("hub", "other")).alias("h"), "node").filter("h != node")
    limit = most_different(percent / 100)
    bits = sum((F.bit_count(F.col("p.sketch")[k].bitwiseXOR(F.col("q.sketch")[k])) for k in range(BITS_PER_SAMPLE * SAMPLES // 64)), F.lit(0))
    alike = (bits <= limit) & (100 * F.least("p.n", "q.n") >= percent * F.greatest("p.n", "q.n"))

    def ordered(a: str, b: str) -> list:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    marks = classes.select("node", "n", "sketch")
    candidates = cut(
        meetings.select(*ordered("h", "node")).distinct()
        .join(marks.alias("p"), F.col("a") == F.col("p.node")).join(marks.alias("q"), F.col("b") == F.col("q.node"))
        .filter(alike).select("a", "b").distinct(), "near-candidates")

    active = cut(shared.select("node").distinct(), "near-active")
    heads = classes.select("node", "copy").join(active, "node")
    sets = cut(_sets(rows.join(heads.select(F.col("node").alias("doc"), "copy").distinct(), ["doc", "copy"])
                     .select(F.col("doc").alias("node"), "text"), shingle).distinct(), "near-sets")
    links = cut(_confirm(candidates, sets, percent), "near-links")
    first = cut(components(links), "near-first")

    # members that are not yet in the largest component of their bucket, against the other components there
    placed = (
        shared.filter("size > 2 and node != hub and node != other").select("bucket", "band", "node").join(first, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("k")).groupBy("bucket").agg(
        F.count("*").alias("parts"), F.max(F.struct("k", "component")).alias("top")).filter("parts > 1")
    open_buckets = cut(parts.select("bucket", F.col("top.component").alias("top")), "near-open")
    crowded = cut(placed.join(open_buckets, "bucket"), "near-crowded")
    wide = _wide_sketches(sets.join(crowded.select("node").distinct(), "node"))
    described = cut(crowded.join(cut(classes.select("node", "n", "sketch", "bands").join(wide, "node"), "near-wide"), "node"), "near-described")
    loose = described.filter("component != top")
    # a pair is judged in the first bucket that it shares, and once if both are outside the largest component
    earlier = reduce(Column.__or__, [(F.col("p.bands")[k] == F.col("q.bands")[k]) & (F.lit(k) < F.col("p.band")) for k in range(BANDS)])
    once = (F.col("q.component") == F.col("q.top")) | (F.col("p.node") < F.col("q.node"))
    differ = F.aggregate(F.zip_with("p.wide", "q.wide", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    near = (F.col("p.component") != F.col("q.component")) & once & alike & ~earlier & (differ <= most_different(percent / 100, WIDE, WIDE_MARGIN))
    late = cut(
        loose.alias("p").join(described.alias("q"), (F.col("p.bucket") == F.col("q.bucket")) & near)
        .select(*ordered("p.node", "q.node")).distinct(), "near-late")
    more = cut(_confirm(late, sets, percent), "near-more")
    # a document of several texts ties their classes
    texts = signatures.filter("n > 0")
    several = cut(
        texts.groupBy("doc").agg(F.min(F.struct("c1", "c2")).alias("lo"), F.max(F.struct("c1", "c2")).alias("hi"))
        .filter("lo != hi").select("doc"), "near-several")
    ties = (
        texts.select("doc", "c1", "c2").join(several, "doc").distinct().join(classes.select("c1", "c2", "node"), ["c1", "c2"])
        .select(*ordered("doc", "node"))
    )
    component_of = cut(components(links.unionByName(more).unionByName(ties)), "near-components")

    # every text: its class, the class's component
    by_text = (
        signatures.select("doc", "copy", "n", "c1", "c2").distinct().join(classes.select("c1", "c2", "node"), ["c1", "c2"], "left")
        .join(component_of, "node", "left").select("doc", "copy", "n", F.coalesce("component", "node", "doc").alias("component"))
    )
    by_text = cut(by_text, "near-texts")
    found = named.join(by_text, ["doc", "copy"])
    results = ["row.*", F.col("text").alias(text), F.col("n").alias("n_shingles")]
    nameless = named.filter("nameless")
    if nameless.isEmpty():
        return found.select(*results, F.col("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept"))

    # with null keys a component is a node, which may be no key: its smallest key is found from the rows
    keys = cut(
        named.filter("not nameless").select("doc", "copy").distinct().join(by_text, ["doc", "copy"])
        .groupBy("component").agg(F.min("doc").alias("key")), "near-keys")
    numbered = cut(nameless.withColumn("number", F.monotonically_increasing_id()), "near-nameless").join(by_text, ["doc", "copy"])
    numbered = numbered.join(keys, "component", "left")
    # one row of each group without a key; an empty text is no copy of another
    first = cut(
        numbered.filter("key is null and n > 0").groupBy("component").agg(F.min(F.struct("doc", "copy", "number")).alias("first"))
        .select(F.col("first.number").alias("number"), F.lit(True).alias("first")), "near-firsts")
    alone = F.col("key").isNull() & ((F.col("n") == 0) | F.col("first").isNotNull())
    without = numbered.join(first, "number", "left").select(*results, F.col("key").alias("component_id"), alone.alias("kept"))
    return (
        found.filter("not nameless").join(keys, "component")
        .select(*results, F.col("key").alias("component_id"), (F.col("doc") == F.col("key")).alias("kept")).unionByName(without)
    )


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", **rules) -> DataFrame:
    """``docs`` with exactly one row of each component of ``near_duplicates``; a null key with an empty text stays."""
    found = near_duplicates(docs, text, key, **rules).filter("kept")
    kept = cut(found.withColumns({"__copy": F.xxhash64(text), "__number": F.monotonically_increasing_id()}), "near-kept")
    marks = kept.filter("component_id is not null").select("component_id", "__copy", "__number")
    groups = cut(
        marks.groupBy("component_id").agg(F.count("*").alias("k"), F.min(F.struct("__copy", "__number")).alias("first"))
        .filter("k > 1").select("component_id", F.col("first.__number").alias("first")), "near-groups")
    surplus = cut(marks.join(groups, "component_id").filter("__number != first").select("__number"), "near-surplus")
    return kept.join(surplus, "__number", "left_anti").select(docs.columns)
