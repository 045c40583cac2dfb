"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A seed is the hash of the words at the 1s of a mask; the words at its 0s may be anything.  The masks for items of one
length are chosen so that however the allowed number of words is substituted, one of them misses all of these (``masks_of``).  Seeds of all
documents meet the seeds of the benchmark, and each hit puts the item beside the document at one offset.  There the
words are compared one by one: an offset counts if some ``window`` words in a row agree in at least ``percent`` of
them, so that substituted words do not hide a passage.

The document side is one scan without a shuffle: seeds are made and looked up as they are generated, and only hits go
on.  Long texts are cut into overlapping pieces first, so that a row never holds more than PIECE places.  The benchmark
is broadcast in blocks of at most about BLOCK_SEEDS seeds - a benchmark of any size is a loop of such scans.  Hits are
reduced to one row per document, item and offset, and go back to the texts to be verified.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharfline.session import cut

WEIGHT = 6  # words that a mask counts, fewer if an item has not as many left
SEARCH = 200_000  # substitutions times masks that are tried; above, a run of words that no substitution breaks
BLOCK_SEEDS = 200_000
PIECE = 2_000  # places that one row holds
SMALL = 100_000  # rows of 40 bytes that are sent to every task; more are joined by a shuffle


def word_hashes(text: Column) -> Column:
    """Hashes of the runs of letters and digits of the lower-cased text."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


@lru_cache
def masks_of(words: int, changed: int) -> tuple[str, ...]:
    """Masks of which one fits between any ``changed`` substitutions in ``words`` words."""
    weight = min(WEIGHT, words - changed)
    if math.comb(words, changed) * math.comb(words - 1, weight - 1) > SEARCH:
        return ("1" * min(weight, words // (changed + 1)),)
    hits: dict[str, set] = {}
    for places in combinations(range(1, words), weight - 1):
        places = (0, *places)
        mask = "".join("1" if k in places else "0" for k in range(places[-1] + 1))
        shifts = [[k for k in range(words) if k - at not in places] for at in range(words - places[-1])]
        hits[mask] = {x for free in shifts for x in combinations(free, changed)}
    left, out = set(combinations(range(words), changed)), []
    while left:
        out.append(max(hits, key=lambda m: (len(hits[m] & left), -len(m))))
        left -= hits[out[-1]]
    return tuple(out)


def _seeds(df: DataFrame, masks: list[str]) -> DataFrame:
    """One row per place and mask: ``place`` (from 0) and ``seed`` beside the columns of ``df``, but for its word hashes ``h``."""
    kept = [c for c in df.columns if c != "h"]
    reach = max(map(len, masks))
    starts = F.sequence(F.lit(0), F.size("h") - 1, F.lit(PIECE))
    pieces = F.transform(starts, lambda s: F.slice("h", s + 1, PIECE + reach - 1))
    cut_up = df.filter(F.size("h") >= min(map(len, masks))).select(*kept, F.posexplode(pieces).alias("piece", "h"))
    places = F.least(F.size("h"), F.lit(PIECE))
    shifted = [F.slice("h", k + 1, places).alias(f"w{k}") for k in range(reach)]  # null after the last word
    index = F.sequence(F.lit(0), places - 1).alias("at")
    rows = cut_up.select(*kept, "piece", F.inline(F.arrays_zip(index, *shifted)).alias("at", *(f"w{k}" for k in range(reach))))
    hashes = [F.when(F.col(f"w{len(m) - 1}").isNotNull(), F.xxhash64(F.lit(m), *(f"w{k}" for k, c in enumerate(m) if c == "1"))) for m in masks]
    seeds = rows.select(*kept, (F.col("piece") * PIECE + F.col("at")).alias("place"), F.explode(F.array(*hashes)).alias("seed"))
    return seeds.filter("seed is not null")


def _matches(docs: DataFrame, benchmark: DataFrame, text: str, key: str, item_text: str = "text", item_key: str = "item_id",
             window: int = 13, percent: int = 80, block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """(doc, copy, item, matched, window) of each offset that counts; copy: hash of the text."""
    items = (
        benchmark.select(F.col(item_key).alias("item"), word_hashes(F.col(item_text)).alias("h"))
        .filter(F.size("h") > 0).groupBy(F.col("h").alias("words")).agg(F.min("item").alias("item"))
    )
    items = cut(items, "benchmark-items")
    # items of one length (all of ``window`` words or more count as one) have their own masks
    length = F.least(F.lit(window), F.size("words"))
    masks = {n: masks_of(n, n - max(1, math.ceil(percent * n / 100))) for n in sorted({r[0] for r in items.select(length).distinct().collect()} or {window})}
    parts = [_seeds(items.filter(length == n).select("item", F.col("words").alias("h")), list(m)) for n, m in masks.items()]
    seeds = cut(reduce(DataFrame.unionByName, parts).select("seed", "item", F.col("place").alias("start")), "benchmark-seeds")
    blocks = max(1, -(-seeds.count() // block_seeds))
    # rows of one key may hold different texts
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("copy"), F.col(text).alias("text"))
    made = _seeds(rows.select("doc", "copy", word_hashes(F.col("text")).alias("h")), sorted({x for m in masks.values() for x in m}))
    hits = []
    for b in range(blocks):
        part = seeds.filter(F.pmod(F.xxhash64("item", "start"), F.lit(blocks)) == b)  # a block: block_seeds rows on average
        hits.append(made.join(F.broadcast(part), "seed").select("doc", "copy", "item", (F.col("place") - F.col("start")).alias("offset")))
    offsets = cut(reduce(DataFrame.unionByName, hits).distinct(), "benchmark-hits")
    sized = offsets.join(items.select("item", F.size("words").alias("m")), "item")
    # as many hits of a text as it has places for each item, at the most
    found = sized.groupBy(F.col("doc").alias("d"), F.col("copy").alias("c")).agg(F.collect_list(F.struct("item", "offset", "m")).alias("hits"))
    few = offsets.count() <= SMALL
    # the texts stay where they are if the hits are few; those that are hit meet the items' words
    hit = rows.join(F.broadcast(found) if few else found, F.col("doc").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c")))
    # the hashes of a text are stored once, as they would else be made again for every word that is compared
    hashed = cut(hit.select("doc", "copy", "hits", word_hashes(F.col("text")).alias("h")), "benchmark-texts")
    each = F.transform("hits", lambda x: F.struct(
        x["item"].alias("item"), x["offset"].alias("offset"), F.slice("h", F.greatest(x["offset"], F.lit(0)) + 1, x["m"]).alias("part")))
    texts = hashed.select("doc", "copy", F.explode(each).alias("x")).select("doc", "copy", "x.*").join(items, "item")
    skipped = F.least(F.col("offset"), F.lit(0))  # words of the item before the text
    same = F.transform("words", lambda w, k: F.coalesce(F.get("part", skipped + k) == w, F.lit(False)).cast("int"))
    offsets = texts.select("doc", "copy", "item", same.alias("same"))
    width = F.least(F.lit(window), F.size("same"))
    sums = F.transform(F.sequence(F.lit(1), F.size("same") - width + 1),
                       lambda k: F.aggregate(F.slice("same", k, width), F.lit(0), lambda a, x: a + x))
    judged = offsets.select("doc", "copy", "item", F.array_max(sums).alias("matched"), width.alias("window"))
    return judged.filter(F.col("matched") * 100 >= percent * F.col("window"))


def contaminations(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text",
                   item_key: str = "item_id", window: int = 13, percent: int = 80, block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """(key, item key, matched, window): pairs of a document and a benchmark item whose words agree at some offset.

    ``matched`` is the largest number of equal words in ``window`` words in a row (all words of a shorter item).
    Items of equal words are reported under the smallest key, also very short ones: an item of one word matches wherever
    the word stands.  Items and texts without words match nothing.  Rows with one key are one document; null keys are reported together as
    null.  Other columns are ignored.  Empty tables give no rows.
    """
    judged = _matches(docs, benchmark, text, key, item_text, item_key, window, percent, block_seeds)
    return judged.groupBy("doc", "item").agg(F.max("matched").alias("matched"), F.max("window").alias("window")).select(
        F.col("doc").alias(key), F.col("item").alias(item_key), "matched", "window")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", **rules) -> DataFrame:
    """``docs`` without the rows whose text holds a passage of the benchmark; see ``contaminations``.  Other rows of the same
    key, or with a null key, stay."""
    dirty = _matches(docs, benchmark, text, key, **rules).select(F.col("doc").alias("__dirty"), F.col("copy").alias("__copy"))
    dirty = cut(dirty.distinct(), "contaminated")
    return docs.join(dirty, F.col(key).eqNullSafe(F.col("__dirty")) & (F.xxhash64(text) == F.col("__copy")), "left_anti")
