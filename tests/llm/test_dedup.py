"""Line, substring and near-duplicate removal against plain Python on whole tables."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from wharfline.llm import line_dedup, near_dup, substring_dedup

SPACES = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def words_of(text):
    return (text or "").encode().split()


def drop_lines(rows):
    held = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            key = lower(line.strip(SPACES))
            if len(key) >= 40:
                held[key].add(d)
    gone = {k: max(v) for k, v in held.items() if len(v) >= 5}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if gone.get(lower(x.strip(SPACES)), d) == d]
        out.append((d, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


def drop_windows(rows, window):
    first = {}
    for d, t in rows:
        w = words_of(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = words_of(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < d:
                gone.update(range(k, k + window))
        out.append((d, b" ".join(x for k, x in enumerate(w) if k not in gone).decode(), len(w), len(gone)))
    return out


def linked(rows, size, percent):
    sets = []
    for _, t in rows:
        w = [lower(x.decode()) for x in words_of(t)]
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    postings = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            postings[g].append(k)
    common = Counter((a, b) for p in postings.values() for i, a in enumerate(p) for b in p[i + 1 :])
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(rows[a][0]), find(rows[b][0])
            parent[max(x, y)] = min(x, y)
    return [(d, len(s), find(d), d == find(d)) for (d, _), s in zip(rows, sets, strict=True)]


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("table", ["awkward", "documents", "crowded", "nothing"])
def test_lines(request, table):
    df = request.getfixturevalue(table)
    got = line_dedup.line_dedup(df)
    rows = sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.select("doc_id", "text", "n_lines", "n_dropped").collect())
    assert rows == sorted(drop_lines(pairs(df)))
    assert set(df.columns) <= set(got.columns)


def test_line_runs_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "ROWS_PER_RANGE", 3)
    text = "\n".join(f"line number {k % 4} padded to more than forty characters" for k in range(8))
    rows = [(k, text if k % 3 else text + f"\nunique line {k} padded to more than forty characters") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = line_dedup.line_dedup(df).collect()
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got) == sorted(drop_lines(rows))


def test_null_keys_are_the_smallest_document(spark):
    rows = [(None, "x" * 50)] * 3 + [(k, "x" * 50) for k in range(4)]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_dropped) for r in got) == {(None, 1): 3, (0, 1): 1, (1, 1): 1, (2, 1): 1, (3, 0): 1}


@pytest.mark.parametrize(("table", "window"), [("awkward", 50), ("awkward", 7), ("documents", 50), ("crowded", 7), ("nothing", 50)])
def test_windows(request, table, window):
    df = request.getfixturevalue(table)
    got = substring_dedup.substring_dedup(df, window=window)
    rows = sorted((r.doc_id, r.text, r.n_words, r.n_removed) for r in got.select("doc_id", "text", "n_words", "n_removed").collect())
    assert rows == sorted(drop_windows(pairs(df), window))
    assert set(df.columns) <= set(got.columns)


def test_windows_of_a_block_repeated_inside_a_document(spark):
    """Every place of a run in its smallest document is compared, not only the first one."""
    rng = np.random.default_rng(8)

    def new(n):
        return [f"n{x}" for x in rng.integers(0, 10**9, n)]

    rows = []
    for k in range(0, 400, 20):
        p, x, y = new(70), new(60), new(60)
        rows += [(k + 3, " ".join(new(40) + p + new(40))), (k + 10, " ".join(x + p + y + new(30) + x + p + y)),
                 (k + 12, " ".join(y + p)), (k + 12, " ".join(new(9) + y + p + x)), (None, " ".join(p[:55] + new(20) + p[:55]))]
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    want = drop_windows([(-1 if d is None else d, t) for d, t in rows], 50)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.text, r.n_words, r.n_removed) for r in got.collect()) == sorted(want)


def test_sliding_minimum():
    x = np.random.default_rng(0).integers(0, 1000, 300).astype(np.uint64)
    for width in (1, 2, 3, 5, 41, 64, 300, 301):
        want = [min(x[k : k + width]) for k in range(len(x) - width + 1)]
        assert substring_dedup.sliding_min(x, width).tolist() == want


@pytest.mark.parametrize(("table", "rule"), [("awkward", (3, 85)), ("documents", (5, 80)), ("crowded", (5, 80)), ("nothing", (3, 85))])
def test_near_duplicates(request, table, rule):
    df = request.getfixturevalue(table)
    got = near_dup.near_duplicates(df, shingle=rule[0], percent=rule[1])
    rows = sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert rows == sorted(linked(pairs(df), *rule))
    assert set(df.columns) <= set(got.columns)


def test_chain_of_near_copies(spark):
    """Neighbours are linked, the ends of the chain are not: one component all the same."""
    rows = [(100 - k, " ".join(f"t{j}" for j in range(4 * k, 4 * k + 90))) for k in range(40)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.drop("text").collect()) == sorted(linked(rows, 3, 85))


def test_group_of_near_copies(spark):
    """Copies with many different edits: some linked with few others, some with none."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(150):
        own = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 12)):
            own[at] = f"e{k}x{at}"
        rows.append((k * 7 % 151, " ".join(own)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(9))
    assert sorted(tuple(r) for r in got.drop("text").collect()) == sorted(linked(rows, 3, 85))


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    for share in (0.85, 0.9, 0.97):  # sets of a narrow and a wide sketch
        base = np.unique(rng.integers(0, 2**63, 2_000).astype(np.uint64))
        n = int(len(base) * 2 * share / (1 + share))
        other = np.concatenate((base[:n], rng.integers(0, 2**63, len(base) - n).astype(np.uint64)))
        s = near_dup.odd_sketch(near_dup.minhash([base, other]))
        assert int(np.bitwise_count(s[0] ^ s[1]).sum()) <= near_dup.most_different(0.85)
        s = near_dup.odd_sketch(near_dup.minhash([base, other], near_dup.WIDE))
        differ = int(np.bitwise_count(s[0] ^ s[1]).sum())
        low, high = (near_dup.most_different(share, near_dup.WIDE, m) for m in (-0.06, 0.06))
        assert low <= differ <= high


def test_null_key_near_duplicates(spark):
    rows = [(None, "a b c d e"), (3, "a b c d e"), (None, "only this one")]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == [(3, 3, True), (None, 3, False), (None, None, True)]


def test_null_keys_do_not_tie_unlike_texts(spark):
    """Each null key is a document of its own; one row of a group without keys is kept."""
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    rows = [(None, a)] * 3 + [(None, a + " tail"), (None, b), (7, b + " tail"), (9, "c d e f"), (None, "c d e f"), (None, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_dup.near_duplicates(df).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got if r.text and r.text[0] in "bc"), key=str) == [
        (7, 7, True), (9, 9, True), (None, 7, False), (None, 9, False)]
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.text and r.text[0] == "a") == [(None, None, False)] * 3 + [(None, None, True)]
    assert [(r.component_id, r.kept) for r in got if not r.text] == [(None, True)] * 2
    assert sorted(((r.doc_id, (r.text or "")[:1]) for r in near_dup.one_of_each(df).collect()), key=str) == [
        (7, "b"), (9, "c"), (None, ""), (None, ""), (None, "a")]


def test_one_row_of_each_component(spark):
    """Repeated rows and several texts under one key leave one row; the texts of a key tie what they are linked with."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (1, a), (1, a + " tail"), (2, b), (5, a), (5, b), (8, c), (8, c), (9, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect())
    assert got == [(1, 1, True)] * 3 + [(2, 1, False)] + [(5, 1, False)] * 2 + [(8, 8, True)] * 2 + [(9, 8, False)]
    assert [r.doc_id for r in near_dup.one_of_each(df).orderBy("doc_id").collect()] == [1, 8]
