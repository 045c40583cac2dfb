"""Spelling variants: words one edit apart, each tied to a far more frequent neighbour.

Dense prefix-suffix tiling: words lie as rows of padded code-point matrices, left- and right-aligned, and blocks of rows are
compared with each other.  Two words are one edit apart if their common prefix and common suffix together reach the longer
length less one.

Only words that can be near share a tile.  The edit lies in one stretch of GAP code points of the longer word; what
is before and after it is equal in both.  So a word is dealt, for every stretch, to the tile of all words with the same beginning
and end around it: at most a^GAP + a^(GAP-1) distinct words over an alphabet of a letters, however large the vocabulary.
A pair is reported in the tile of the stretch in which its common prefix ends, and so once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharfline.llm.text import lean, offsets_and_bytes
from wharfline.session import cut

LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
GAP = 2  # code points that two words of one tile may differ in
ROWS = 1 << 13  # rows that are put into one pair of matrices (one tile more at most)
CELLS = 1 << 20  # code points that one comparison of blocks holds
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(word: Column) -> Column:
    return F.when(word.rlike("[A-Z]"), F.translate(word, _UPPER, _LOWER)).otherwise(word)


def letter_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = 1) -> DataFrame:
    """(``key``, ``word``) of every maximal run of at least ``least`` letters, A-Z lower-cased."""
    runs = docs.select(F.col(key).alias("key"), F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(LETTERS), F.lit(0))).alias("run"))
    return runs.where(F.length("run") >= least).select("key", lower_ascii(F.col("run")).alias("word"))


def with_lost_letter(runs: DataFrame, one_in: int = 31) -> DataFrame:
    """Runs of which one in ``one_in``, by the crc32 of key and word, loses a code point: known variants to look for."""
    h = F.crc32(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = (h % F.length("word")).cast("int")
    without = F.concat(F.substring("word", F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    return runs.select("key", F.when(h % one_in == 0, without).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = 7, least_count: int = 2) -> DataFrame:
    """(word, n) of the words of at least ``least_length`` code points that occur ``least_count`` times; counted map-side first."""
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def tiles(words: DataFrame, gap: int = GAP) -> DataFrame:
    """(tile, longer, at, word, n): each word in the tiles of its stretches, as a longer or equal and as a shorter one."""
    def of(longer: Column) -> Column:
        def one(k: Column) -> Column:
            end = F.least(longer, k + gap)
            head, tail = F.substring("word", F.lit(1), k), F.right(F.col("word"), longer - end)
            return F.struct(F.xxhash64(longer, k, head, tail).alias("tile"), longer.alias("longer"), k.alias("at"))
        return F.transform(F.sequence(F.lit(0), longer - 1, F.lit(gap)), one)

    length = F.length("word")
    return words.select(F.explode(F.concat(of(length), of(length + 1))).alias("t"), "word", "n").select("t.tile", "t.longer", "t.at", "word", "n")


def _matrices(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words, left-aligned and right-aligned with zeros around them, and their lengths."""
    offsets, raw = offsets_and_bytes(words.cast(pa.large_binary()))
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    length = np.diff(np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[offsets])
    width = int(length.max(initial=1))
    row = np.repeat(np.arange(len(length)), length)
    place = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
    left, right = (np.zeros((len(length), width), dtype=np.uint32) for _ in range(2))
    left[row, place] = points
    right[row, width - np.repeat(length, length) + place] = points
    return left, right, length


def near_pairs(table: pa.Table, gap: int = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of one-edit pairs among rows that are sorted by tile; each pair in one tile only.

    Blocks of rows meet the blocks d rows further on, for every d that the largest tile has.
    """
    left, right, length = _matrices(table.column("word").combine_chunks())
    tile, longer, at = (table.column(c).to_numpy() for c in ("tile", "longer", "at"))
    one, two = [], []
    rows = np.arange(len(tile))
    step = max(1, CELLS // left.shape[1])
    d = 0
    while len(rows):
        d += 1
        rows = rows[rows + d < len(tile)]
        rows = rows[tile[rows] == tile[rows + d]]
        for lo in range(0, len(rows), step):
            i = rows[lo : lo + step]
            j = i + d
            most = np.maximum(length[i], length[j])
            unlike = left[i] != left[j]
            prefix = np.where(unlike.any(1), np.argmax(unlike, 1), most)
            unlike = right[i, ::-1] != right[j, ::-1]
            suffix = np.where(unlike.any(1), np.argmax(unlike, 1), most)
            # the hash of a tile may clash: longer and stretch are compared too
            near = (prefix + suffix >= most - 1) & (prefix < most) & (most == longer[i]) & (longer[i] == longer[j]) & (at[i] == at[j])
            near &= (at[i] <= prefix) & (prefix < at[i] + gap)
            one.append(i[near])
            two.append(j[near])
    return (np.concatenate(one), np.concatenate(two)) if one else (rows, rows)


def near_words(words: DataFrame, gap: int = GAP) -> DataFrame:
    """(word, near, near_n), both ways, of all distinct words of ``words`` (word, n) that differ by one code point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(table: pa.Table) -> pa.RecordBatch:
            i, j = near_pairs(table, gap)
            i, j = np.concatenate((i, j)), np.concatenate((j, i))
            word, n = table.column("word").combine_chunks(), table.column("n").combine_chunks()
            return pa.RecordBatch.from_arrays([word.take(pa.array(i)), word.take(pa.array(j)), n.take(pa.array(j))], names=["word", "near", "near_n"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                held.append(batch.slice(lo, ROWS))
                table = pa.Table.from_batches(held)
                tile = table.column("tile").to_numpy()
                whole = int(np.searchsorted(tile, tile[-1]))  # the last tile may go on in the next batch
                if whole >= ROWS:
                    yield pairs(table.slice(0, whole))
                    held = table.slice(whole).to_batches()
        if held:
            yield pairs(pa.Table.from_batches(held))

    dealt = tiles(words, gap).repartition(F.col("tile")).sortWithinPartitions("tile")
    return dealt.mapInArrow(lean(run), "word string, near string, near_n long")


def spelling_groups(words: DataFrame, ratio: int = 10, gap: int = GAP) -> DataFrame:
    """Group the distinct words of ``words`` (word, n) by spelling.

    Returns word, form, root, n, n_near, form_n.  ``n_near`` counts the words one inserted, deleted or replaced code point
    away.  ``form`` is the one of them with the largest n (ties: the smallest in code-point order) if its n is at
    least ``ratio`` times the word's n, else null, and ``form_n`` its n.  ``root`` is reached by following forms; a word
    without one is its own root.  Forms grow by ``ratio``, so no chain is longer than the logarithm of the largest n.

    Null words take no part.  Words are compared by code points, whatever they are made of; very long ones take
    a row for every stretch.  An empty table gives no rows.  Other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("ratio: forms must be more frequent, or chains would not end")
    words = cut(words.where(F.col("word").isNotNull() & (F.col("word") != "")).select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    best = near_words(words, gap).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rest"), F.col("near"))).alias("best"))
    formed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.rest") >= F.col("n") * ratio, F.struct(F.col("best.near").alias("form"), (-F.col("best.rest")).alias("form_n"))).alias("f"))
    formed = cut(formed.select("word", "n", "n_near", "f.form", "f.form_n"), "spelling-forms")
    links = formed.where("form is not null").select("word", F.col("form").alias("root"))
    longest, most = 0, words.agg(F.max("n")).first()[0] or 1
    while most >= ratio:
        longest, most = longest + 1, most // ratio
    for _ in range(max(0, longest - 1).bit_length()):  # each round doubles the steps that a link stands for
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = cut(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return formed.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
