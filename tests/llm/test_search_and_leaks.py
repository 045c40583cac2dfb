"""Top-k search and benchmark decontamination against brute force."""

import math
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wharfline.llm import decontaminate, topk

VECTORS = "vec_id long, embedding array<double>, label int"


def best(rows, queries, k):
    out = []
    good = [(i, np.floor(np.array(v, dtype=float) * 256).astype(int)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, w in good:
        if q in queries:
            scores = []
            for i, v in good:
                if i != q:
                    n = min(len(v), len(w))
                    scores.append((-int(v[:n] @ w[:n]), i))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("shape", [(4, 2), (7, 100), (1000, 1000)])
def test_top_k(spark, shape):
    rng = np.random.default_rng(0)
    rows = [(k, [float(x) for x in rng.integers(-3, 4, 6) / 256]) for k in range(200)]
    rows += [(300 + k, [0.5, -0.25, 0.1, 0.0, 0.0, 0.3]) for k in range(40)]
    rows += [(400, None), (401, [1.0, None, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (404, []), (405, [0.9] * 9), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(4)
    got = topk.top_k(df, df.filter("vec_id % 20 = 0"), 5, shard_rows=shape[0], block_queries=shape[1])
    assert sorted(tuple(r) for r in got.collect()) == best(rows, {i for i, _ in rows if i is not None and i % 20 == 0}, 5)


def test_top_k_edges(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert topk.top_k(empty, empty).count() == 0
    few = spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 1)], VECTORS)
    assert [tuple(r) for r in topk.top_k(few, few).orderBy("query_id").collect()] == [(0, 1, 1, 131072), (1, 1, 0, 131072)]


def contaminated(docs, items, window=13, percent=80):
    def words(t):
        return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]

    seen = {}
    for i, t in items:
        w = tuple(words(t))
        if w:
            seen[w] = min(seen.get(w, i), i)
    out = {}
    for d, t in docs:
        h = words(t)
        for w, i in seen.items():
            for o in range(-len(w) + 1, len(h)):
                same = [0 <= o + j < len(h) and h[o + j] == x for j, x in enumerate(w)]
                n = min(window, len(w))
                top = max(sum(same[k : k + n]) for k in range(len(w) - n + 1))
                if top * 100 >= percent * n:
                    out[d, i] = max(out.get((d, i), (0, 0)), (top, n))
    return sorted((d, i, *x) for (d, i), x in out.items())


ITEMS = [(0, " ".join(f"q{k}" for k in range(30))), (1, " ".join(f"r{k}" for k in range(10))), (2, "too short to be found"), (3, None), (4, ""),
         (9, " ".join(f"q{k}" for k in range(30))), (5, "Some, OTHER words; are (here) for a test of marks and of CASE and length")]


def leaks():
    q = [f"q{k}" for k in range(30)]
    changed = [w if k % 6 else "other" for k, w in enumerate(q)]
    half = ["x"] * 20 + q[14:] + ["y"]
    far = [w if k % 3 else "other" for k, w in enumerate(q)]
    return [(0, "before " + " ".join(q) + " after"), (1, " ".join(changed)), (2, " ".join(half)), (3, " ".join(far)), (4, " ".join(f"r{k}" for k in range(10))),
            (5, "some other words are here\nfor a test of marks\nAND of case and length"), (6, None), (7, ""), (8, "q1 q2 q3"), (9, " ".join(q[20:]) + " end"),
            (10, "clean " * 3_000), (11, " ".join(["z"] * 20_000 + q)), (0, " ".join(q))]


@pytest.mark.parametrize("block", [200_000, 10])
def test_contaminations(spark, block):
    docs = spark.createDataFrame(leaks(), "doc_id long, text string").withColumns({n: F.lit(1) for n in ("h", "item", "seed", "place", "words")})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("h", F.lit(1))
    got = decontaminate.contaminations(docs, items, block_seeds=block)
    want = contaminated([x for x in leaks() if x[0] != 10 and x[0] != 11], ITEMS)
    rows = sorted(tuple(r) for r in got.collect())
    assert [r for r in rows if r[0] not in (10, 11)] == want
    assert [r for r in rows if r[0] in (10, 11)] == [(11, 0, 13, 13)]
    left = decontaminate.decontaminate(docs, items, block_seeds=block)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in leaks()} - {r[0] for r in rows}


def test_native_plan(documents, benchmark_items, spark):
    text = decontaminate.contaminations(documents, benchmark_items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text) and "BroadcastHashJoin" in text


def test_empty_benchmark(awkward, nothing, benchmark_items):
    none = benchmark_items.limit(0)
    assert decontaminate.decontaminate(awkward, none).count() == awkward.count()
    assert decontaminate.decontaminate(nothing, benchmark_items).count() == 0


def test_null_keys_go_with_their_leak(spark):
    docs = spark.createDataFrame([(None, leaks()[0][1]), (1, "clean text")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert [r.doc_id for r in decontaminate.decontaminate(docs, items).collect()] == [1]


@pytest.mark.parametrize("words", range(1, 14))
def test_masks_miss_no_substitution(words):
    changed = words - math.ceil(80 * words / 100)
    for gone in combinations(range(words), changed):
        assert any(all(at + k not in gone for k, c in enumerate(m) if c == "1")
                   for m in decontaminate.masks_of(words, changed) for at in range(words - len(m) + 1))


def test_all_allowed_substitutions_are_found(spark):
    """Items of 1 to 15 words with every allowed and one forbidden number of substitutions; nothing here knows the masks."""
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in range(1, 16)]
    docs, want = [], []
    for n in range(1, 16):
        size = min(n, 13)
        least = math.ceil(80 * size / 100)
        for changed in range(size - least + 2):
            for gone in combinations(range(size), changed):
                d = len(docs)
                docs.append((d, " ".join(["a", *("b" if k in gone else f"i{n}x{k}" for k in range(size)), "c"])))
                if size - changed >= least:
                    want.append((d, n, size - changed, size))
    got = decontaminate.contaminations(spark.createDataFrame(docs, "doc_id long, text string").coalesce(4),
                                       spark.createDataFrame(items, "item_id long, text string").coalesce(2))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_clean_rows_stay_beside_a_leak_of_their_key(spark):
    leak = leaks()[0][1]
    docs = spark.createDataFrame([(None, leak), (None, "clean text"), (None, None), (4, leak), (4, "clean too")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = decontaminate.decontaminate(docs, items).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == [(4, "clean too"), (None, "clean text"), (None, None)]


def test_frequent_word_and_long_text(spark):
    """A one-word item that stands everywhere, and 100,000 words: in time and memory of the text's length."""
    long = " ".join(["the"] + [f"w{k % 5000}" for k in range(99_999)])
    docs = spark.createDataFrame([(0, "the " * 3_000), (1, long), (2, "clean"), (None, "The end"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(0, "the"), (1, " ".join(f"w{k}" for k in range(20)))], "item_id long, text string")
    got = sorted((tuple(r) for r in decontaminate.contaminations(docs, items).collect()), key=str)
    assert got == [(0, 0, 1, 1), (1, 0, 1, 1), (1, 1, 13, 13), (None, 0, 1, 1)]


@pytest.mark.parametrize("largest", [3, 1 << 20, 1 << 27])
@pytest.mark.parametrize("held", [0.03, 0.6])
def test_long_and_short_lists(held, largest):
    """Lists of few rows are rows, long ones a mark for each row; sums beyond 2^53 stay exact."""
    rng = np.random.default_rng(4)
    rows = [np.where(rng.random(12) < held, rng.integers(-largest, largest + 1, 12), 0) for _ in range(700)]
    shard = topk.Shard(np.arange(700) * 3, rows)
    long = [p.dtype == bool for two in shard.postings for p in two]
    assert all(long) if held > 0.5 else not any(long)
    for q in range(0, 700, 23):
        score = np.array([sum(int(x) * int(y) for x, y in zip(rows[q], r)) for r in rows], dtype=object)
        best = sorted((-s, 3 * i) for i, s in enumerate(score) if i != q)[:5]
        ids, scores = shard.search(rows[q], 3 * q, 5)
        assert [(-int(s), int(i)) for i, s in zip(ids, scores)] == best
