"""Periodic runs of words: dyadic square catching over completed power-of-two blocks.

Words are appended in order.  At level k every completed block of 2^k words has a catcher.  The suffix of 2^k words that
ends at an appended word is compared with the one block that lies 2^k to 2^(k+1)-1 words before it: equality
at distance q catches a square of period q around that block.  What a catcher sees does not depend on later words, so all
words of one append are compared at once, level by level, which is n comparisons a level.  Caught blocks that follow each other
at one distance are one repetition; it is extended word by word to both sides, by less than a block, and reported as a run.

A run of period q with four periods or more holds at least two aligned blocks of its level, so none is missed.  A block
and a suffix that lie in one repetition of a smaller period are not compared, as a second period there could only be a multiple.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline.llm.text import blocks, lean, mix, word_bounds

LEAST, TIMES = 6, 4  # words of a run, and periods in it
WIDE = 1 << 18  # words that one step of an extension looks at
TEXT_BYTES = 1 << 19  # texts that are one sequence
APPEND = 1 << 20  # words that are appended at once
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _matching(a: np.ndarray, lo: np.ndarray, period: np.ndarray, width: int, step: int) -> np.ndarray:
    """How many words from ``lo`` on (``step`` 1) or before it (-1), ``width`` at most, equal those one period later."""
    out = np.zeros(len(lo), dtype=np.int64)
    rows = max(1, WIDE // max(1, width))
    reach = np.arange(width) if step > 0 else -1 - np.arange(width)
    for k in range(0, len(lo) if width else 0, rows):
        at = lo[k : k + rows, None] + reach
        other = at + period[k : k + rows, None]
        inside = (at >= 0) & (other < len(a))
        same = inside & (a[np.where(inside, at, 0)] == a[np.where(inside, other, 0)])
        out[k : k + rows] = np.where(same.all(1), width, np.argmin(same, 1))
    return out


class SquareCatcher:
    """Finds the runs of a sequence of word numbers that is appended in parts of any size.

    ``append`` returns the runs (start, end, period) whose end the new words have shown, ``finish`` those that reach
    to the last word.  ``longest`` is a length that no run exceeds, if one is known.  Of the hashes of a level only the last few
    blocks are kept.
    """

    def __init__(self, least: int = LEAST, times: int = TIMES, longest: int | None = None):
        self.least, self.times, self.longest = least, max(3, times), longest
        self.words = np.zeros(0, dtype=np.int64)
        self.known = np.zeros(1, dtype=np.int64)  # greatest end of the closed runs that start here or before
        self.hashes: list[np.ndarray] = []  # of each level: the latest windows
        self.open: list[np.ndarray] = []  # of each level: first and last block and period of repetitions that may go on

    def append(self, words: np.ndarray) -> np.ndarray:
        return self._advance(np.asarray(words, dtype=np.int64), last=False)

    def finish(self) -> np.ndarray:
        return self._advance(np.zeros(0, dtype=np.int64), last=True)

    def _advance(self, new: np.ndarray, last: bool) -> np.ndarray:
        before = len(self.words)
        self.words = np.concatenate((self.words, new)) if before else new
        n = len(self.words)
        self.known = np.concatenate((self.known, np.full(len(new), self.known[-1])))
        cover = self.known.copy()  # also of repetitions of lower levels that are still open
        fresh = mix(new.astype(np.uint64))  # hashes of the windows that end in the new words
        out = [np.zeros((0, 3), dtype=np.int64)]
        k, width = 0, 1
        while width <= n and (self.longest is None or width * self.times <= self.longest):
            if k == len(self.open):
                self.open.append(np.zeros((0, 3), dtype=np.int64))
                self.hashes.append(np.zeros(0, dtype=np.uint64))
            windows = np.concatenate((self.hashes[k], fresh))
            origin = n - width + 1 - len(windows)  # place of the first kept window
            runs, held = self._level(k, windows, origin, len(fresh), cover, last)
            closed = runs[~held]
            out.append(closed)
            np.maximum.at(cover, runs[:, 0], runs[:, 1])
            np.maximum.accumulate(cover, out=cover)
            np.maximum.at(self.known, closed[:, 0], closed[:, 1])
            # windows of the next level that end in the new words
            need = windows[max(0, len(windows) - len(fresh) - width) :]
            fresh = mix(need[:-width] * np.uint64(0x9E3779B97F4A7C15) ^ need[width:], k + 1) if len(need) > width else need[:0]
            self.hashes[k] = windows[max(0, len(windows) - 4 * width) :]
            k, width = k + 1, width * 2
        np.maximum.accumulate(self.known, out=self.known)
        found = np.concatenate(out)
        return found[np.lexsort((found[:, 2], found[:, 0]))]

    def _level(self, k: int, windows: np.ndarray, origin: int, fresh: int, cover: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
        """Runs (start, end, period) of one level as far as they are known, and which of them may go on."""
        width, n = 1 << k, len(self.words)
        at = origin + np.arange(len(windows) - fresh, len(windows))  # starts of the new suffixes
        at = at[at >= width]
        block = at // width - 1  # the catcher of each
        start = block * width
        caught = (windows[at - origin] == windows[start - origin]) & (cover[start] < at + width) if len(at) else np.zeros(0, bool)
        block, q = block[caught], (at - start)[caught]
        chains = np.concatenate((self.open[k], np.stack((block, block, q), axis=1)))
        chains = chains[np.lexsort((chains[:, 0], chains[:, 2]))]
        head = np.ones(len(chains), dtype=bool)
        head[1:] = (chains[1:, 2] != chains[:-1, 2]) | (chains[1:, 0] != chains[:-1, 1] + 1)
        first = np.flatnonzero(head)
        chains = np.stack((chains[first, 0], chains[np.append(first[1:], len(chains)) - 1, 1], chains[first, 2]), axis=1) if len(chains) else chains
        held = ((chains[:, 1] + 2) * width + chains[:, 2] > n) & (not last)
        self.open[k] = chains[held]
        need = np.maximum(self.least, self.times * chains[:, 2]) - chains[:, 2]  # equal words, each with the one a period later
        may = (chains[:, 1] - chains[:, 0] + 3) * width - 2 >= need
        (b, e, q), held, need = chains[may].T, held[may], need[may]
        left = _matching(self.words, b * width, q, width, -1)
        right = _matching(self.words, (e + 1) * width, q, width, 1)
        lo, hi = b * width - left, (e + 1) * width + right + q
        # a side that goes on for a whole block runs into blocks that were not compared: a multiple of a known period
        run = (hi - lo - q >= need) & (left < width) & ((right < width) | held) & (cover[lo] < hi)
        return np.stack((lo, hi, q), axis=1)[run], held[run]


def catch(words: np.ndarray, least: int = LEAST, times: int = TIMES, longest: int | None = None) -> np.ndarray:
    """All runs (start, end, period) of a sequence, by start and period; long ones are appended in parts."""
    catcher = SquareCatcher(least, times, longest)
    runs = [catcher.append(words[k : k + APPEND]) for k in range(0, len(words), APPEND)] + [catcher.finish()]
    found = np.concatenate(runs)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _numbered(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """An exact number for every distinct word."""
    lengths = ends - starts
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    flat = raw[np.repeat(starts - bounds[:-1], lengths) + np.arange(bounds[-1])]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(flat)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _block(offsets: np.ndarray, raw: np.ndarray, least: int, times: int) -> tuple[np.ndarray, list[list[tuple[int, int, int]]], list[bytes]]:
    """Words, runs and collapsed text of each text of a block.

    The texts are one sequence with a word of its own after each of them, which no run can cross.
    """
    starts, ends, docs = word_bounds(offsets, raw)
    n, docs_n = np.diff(docs), len(offsets) - 1
    numbers = _numbered(raw, starts, ends)
    owner = np.repeat(np.arange(docs_n), n)
    sequence = np.empty(len(numbers) + docs_n, dtype=np.int64)
    sequence[np.arange(len(numbers)) + owner] = numbers
    base = docs + np.arange(docs_n + 1)  # first place of each text in the sequence
    sequence[base[1:] - 1] = -1 - np.arange(docs_n)
    lo, hi, q = catch(sequence, least, times, int(n.max(initial=0))).T
    whose = np.searchsorted(base, lo, side="right") - 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(docs_n)]
    for d, s, e, p in zip(whose.tolist(), (lo - base[whose]).tolist(), (hi - base[whose]).tolist(), q.tolist(), strict=True):
        runs[d].append((s, e - s, p))
    edge = np.zeros(len(sequence) + 1, dtype=np.int64)  # copies of the first period are dropped
    np.add.at(edge, lo + q, 1)
    np.add.at(edge, hi, -1)
    kept = np.cumsum(edge)[np.arange(len(numbers)) + owner] == 0
    a, z, owner = starts[kept], ends[kept], owner[kept]
    size = z - a + 1  # each with a space after it
    bounds = np.concatenate(([0], np.cumsum(size)))
    flat = np.append(raw, np.uint8(32))[np.minimum(np.repeat(a - bounds[:-1], size) + np.arange(bounds[-1]), len(raw))]
    flat[bounds[1:] - 1] = 32
    data = flat.tobytes()
    cuts = bounds[np.searchsorted(owner, np.arange(docs_n + 1))]
    return n, runs, [data[x : max(x, y - 1)] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Runs of the words of each text, and the text without the copies of their first periods.

    Words are runs of other characters than blanks.  A run has a smallest period q, at least ``least`` words and ``times`` * q
    words (three periods or more), and no neighbouring word goes on with it.  Returns one row for each row of
    ``docs``: ``key``, n_words, ``runs`` (start, length, period in words, by start and period) and ``text``,
    the words outside and the first period of every run, joined by spaces.

    A null text has no words, as an empty one.  A repeated row is a document of its own, and a null key stays null.
    A very long text is taken whole, in time n log n.  Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for part, offsets, raw in blocks(batch, "text", TEXT_BYTES):
                n, runs, kept = _block(offsets, raw, least, times)
                flat = np.array([r for own in runs for r in own], dtype=np.int64).reshape(-1, 3)
                bounds = np.concatenate(([0], np.cumsum([len(own) for own in runs]))).astype(np.int32)
                items = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(kind.value_type))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.ListArray.from_arrays(bounds, items), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["key", "n_words", "runs", "text"])

    found = rows.mapInArrow(lean(run), f"key {rows.schema['key'].dataType.simpleString()}, n_words bigint, runs {RUNS}, text string")
    return found.withColumnsRenamed({"key": key, "text": text})


def strongest(runs: str) -> "F.Column":
    """Of an array of runs, the one with most periods: exact fractions, then the smallest start and period."""
    def better(x, y):
        one, two = x["length"] * y["period"], y["length"] * x["period"]
        return F.when(one > two, x).when(one < two, y).when(x["start"] < y["start"], x).when(x["start"] > y["start"], y).otherwise(
            F.when(x["period"] <= y["period"], x).otherwise(y))

    return F.reduce(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, 0), lambda best, x: F.when(best.isNull(), x).otherwise(better(best, x)))


def with_repeated_tail(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Texts of which a tenth, by the crc32 of the key, ends in copies of one stretch of its words: known runs to look for.

    With h = crc32(key as text) and g = h div 10, a text of n words with h divisible by 10 repeats from word a = g % n
    on the p = 1 + (n - a) div (3 + g % 8) words that start there.  All other texts are left as they are.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    words = F.filter(F.split(F.col(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = docs.withColumn("__w", F.when(h % 10 == 0, words))
    n = F.size("__w").cast("bigint")
    a = F.try_mod(g, n)
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
    repeated = F.concat(
        F.slice("__w", F.lit(1), a.cast("int")),
        F.transform(F.sequence(a, n - 1), lambda i: F.get("__w", (a + (i - a) % p).cast("int"))))
    return rows.withColumn(text, F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col(text))).drop("__w")
