"""Token files, spelling groups and periodic runs against round trips, SQL and brute force."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.crosscheck import compare, connect, types_differ
from tests.llm.conftest import SF
from wharfline.llm import mixcoder, packing, periodic, spelling, suite, tokenfile
from wharfline.session import scratch_path

# ---- range coder and files


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(
    st.lists(st.integers(0, 5), max_size=400), st.lists(st.integers(0, 2**31), max_size=60),
    st.builds(lambda w, n: w * n, st.lists(st.integers(0, 60_000), min_size=1, max_size=9), st.integers(1, 60))), max_size=7))
def test_blocks_return(blocks):
    arrays = [np.array(b, dtype=np.int64) for b in blocks]
    coded = mixcoder.encode(arrays)
    back = mixcoder.decode([(ids, len(a), data) for (ids, data), a in zip(coded, arrays, strict=True)])
    assert [b.tolist() for b in back] == blocks
    alone = [mixcoder.encode([a])[0][1] for a in arrays]  # a block's bytes do not depend on those beside it
    assert alone == [data for _, data in coded]


def test_full_block_of_distinct_ids():
    ids = np.random.default_rng(5).permutation(1 << 16)[: 1 << 13] * 3
    (alphabet, data), = mixcoder.encode([ids])
    assert (mixcoder.decode([(alphabet, len(ids), data)])[0] == ids).all()


def test_repeated_ids_cost_little():
    ids = np.tile(np.random.default_rng(6).integers(0, 50_000, 40), 100)
    (_, data), = mixcoder.encode([ids])
    assert len(data) * 8 < 2 * len(ids)


def test_models_are_asked_for_many_ids_at_once(monkeypatch):
    rng, asked, context = np.random.default_rng(9), [], mixcoder._Mixture.context
    monkeypatch.setattr(mixcoder._Mixture, "context", lambda *args: asked.append(1) or context(*args))
    blocks = [rng.zipf(1.3, n) % 900 for n in (2_048, 2_048, 700, 1)]
    coded = mixcoder.encode(blocks)
    assert len(asked) <= 2_048 // 8
    back = mixcoder.decode([(ids, len(b), data) for (ids, data), b in zip(coded, blocks, strict=True)])
    assert all((x == y).all() for x, y in zip(back, blocks, strict=True))


def test_block_of_very_many_ids_beside_small_ones():
    rng = np.random.default_rng(10)
    blocks = [rng.permutation(1 << 18)[:20_000], rng.integers(0, 3, 500), np.array([7])]
    coded = mixcoder.encode(blocks)
    assert [data for _, data in coded[1:]] == [mixcoder.encode([b])[0][1] for b in blocks[1:]]
    back = mixcoder.decode([(ids, len(b), data) for (ids, data), b in zip(coded, blocks, strict=True)])
    assert all((x == y).all() for x, y in zip(back, blocks, strict=True))


@given(st.lists(st.integers(0, 2**35 - 1), max_size=50))
def test_varints(values):
    assert tokenfile.from_varints(tokenfile.varints(np.array(values, dtype=np.int64))).tolist() == values


def test_segments_return_and_damage_is_seen():
    rng = np.random.default_rng(8)
    groups = [([3, None, 9], [rng.integers(0, 49_408, n) for n in (1, 9_000, 40)]), ([], []), ([-5], [np.array([2])])]
    segments = tokenfile.write_segments(groups)
    for (keys, ids), (got_keys, got) in zip(groups, tokenfile.read_segments(segments), strict=True):
        assert got_keys == keys and [x.tolist() for x in got] == [x.tolist() for x in ids]
    for at in [0, 5, 30, *range(40, len(segments[0]), 997), len(segments[0]) - 20]:
        broken = bytearray(segments[0])
        broken[at] ^= 64
        with pytest.raises(ValueError):
            tokenfile.read_segments([bytes(broken)])
    with pytest.raises(ValueError):
        tokenfile.read_segments([segments[0][:-1]])


@pytest.fixture(scope="module")
def words_model():
    return packing.load_model(suite.tokenizer("word_bpe_49k.json"))


def library_ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(suite.tokenizer("word_bpe_49k.json"))
    return [[*e.ids, 2] for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_files_of_whole_table(spark, documents):
    rows = sorted(documents.select("doc_id", "text").collect())
    want, start = {}, 0
    for (doc, _), ids in zip(rows, library_ids([t for _, t in rows]), strict=True):
        want[doc] = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    got = suite.op11_token_files(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and set(dict(got.dtypes).values()) == {"bigint"}
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want


def test_token_files_of_awkward_rows(spark, crowded, words_model):
    odd = crowded.unionByName(crowded.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    path = scratch_path(spark, "test-files")
    tokenfile.write_ids(odd, words_model, path)
    got = sorted(tokenfile.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got][:3] == [None] * 3
    keys = [r.doc_id for r in got][3:]
    assert keys == sorted(keys) and len(got) == odd.count()
    assert [r.start for r in got] == np.concatenate(([0], np.cumsum([r.n_tokens for r in got])[:-1])).tolist()
    source = odd.select("doc_id", "text").collect()
    want = Counter((r[0], tuple(ids)) for r, ids in zip(source, library_ids([r.text for r in source]), strict=True))
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    again = scratch_path(spark, "test-files")
    tokenfile.write_ids(odd, words_model, again)
    assert sorted(map(str, tokenfile.read_ids(spark, again).drop("ids").collect())) == sorted(map(str, tokenfile.read_ids(spark, path, with_ids=False).collect()))


def test_token_files_of_nothing(spark, nothing, words_model):
    path = scratch_path(spark, "test-files")
    tokenfile.write_ids(nothing, words_model, path)
    assert tokenfile.read_ids(spark, path).collect() == []


def test_files_are_smaller_than_ids(spark, documents, words_model):
    path = scratch_path(spark, "test-files")
    tokenfile.write_ids(documents, words_model, path)
    stored, ids = spark.read.parquet(path).agg(F.sum(F.length("data")), F.sum("n_ids")).first()
    assert stored < 1.3 * ids  # two bytes an id as plain numbers


# ---- spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def grouped(counts, ratio=10):
    near = {w: [] for w in counts}
    for a, b in combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {w: min(others, key=lambda x: (-counts[x], x.encode("utf-32-be"))) for w, others in near.items() if others}
    form = {w: f for w, f in form.items() if counts[f] >= ratio * counts[w]}
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, counts[w], len(near[w]), counts.get(form.get(w)))
    return out


WORDS = st.text(st.sampled_from("abcé"), min_size=1, max_size=9)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.one_of(WORDS, st.text(st.sampled_from("ab"), min_size=5, max_size=7)), max_size=60), st.integers(1, 3))
def test_tiles_hold_all_pairs(words, gap):
    """The tile rule written out in Python, and the comparison of the blocks."""
    rows = []
    for w in words:
        for longer in (len(w), len(w) + 1):
            for at in range(0, longer, gap):
                rows.append((hash((longer, at, w[:at], w[len(w) - (longer - min(at + gap, longer)) :] if min(at + gap, longer) < longer else "")), longer, at, w))
    rows.sort(key=lambda r: r[0])
    table = pa.table({"tile": pa.array([r[0] for r in rows], pa.int64()), "longer": pa.array([r[1] for r in rows], pa.int64()),
                      "at": pa.array([r[2] for r in rows], pa.int64()), "word": pa.array([r[3] for r in rows], pa.string())})
    i, j = spelling.near_pairs(table, gap) if rows else ([], [])
    got = Counter(frozenset((rows[a][3], rows[b][3])) for a, b in zip(i, j, strict=True))
    assert got == Counter(frozenset(p) for p in combinations(words, 2) if one_edit(*p))


def test_spelling_groups(spark, monkeypatch):
    monkeypatch.setattr(spelling, "ROWS", 16)
    rng = np.random.default_rng(2)
    words = {"".join(rng.choice(list("abé😀"), rng.integers(1, 9))) for _ in range(150)} | {"b" * 40, "b" * 41, "a" * 3_000, "a" * 2_999}
    counts = {w: int(10 ** rng.integers(0, 5)) + int(rng.integers(0, 3)) for w in sorted(words)}
    rows = [(w, n, 1, 2) for w, n in counts.items()] + [(None, 7, 1, 2), ("", 9, 1, 2)]
    df = spark.createDataFrame(rows, "word string, n int, form int, root int").repartition(4)
    got = {r.word: tuple(r)[1:] for r in spelling.spelling_groups(df).collect()}
    assert got == grouped(counts)
    assert any(g[0] and counts[g[0]] >= 10 and got[g[0]][0] for g in got.values())  # a chain


def test_spelling_of_nothing(spark, nothing):
    assert spelling.spelling_groups(spelling.vocabulary(spelling.letter_runs(nothing))).collect() == []


def contract_words(rows):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def test_spelling_of_awkward_rows(spark, crowded):
    text = "Überfall überfall Uberfall naïvetés NAÏVETÉS l'aventure aventure\x00aventurer ×÷×÷×÷× " * 12
    odd = crowded.unionByName(crowded.limit(1).withColumn("text", F.lit(text)).withColumn("doc_id", F.lit(None).cast("long")))
    rows = odd.select("doc_id", "text").collect()
    runs = spelling.with_lost_letter(spelling.letter_runs(odd, least=7))
    got = {r.word: tuple(r)[1:] for r in spelling.spelling_groups(spelling.vocabulary(runs)).collect()}
    assert got == grouped(contract_words(rows))


def test_spelling_equals_sql_and_brute_force(spark, documents):
    df = suite.op12_spelling(spark, SF)
    con = connect(SF)
    assert compare(df, con, suite.OP12_SQL) is None and not types_differ(df, con, suite.OP12_SQL)
    got = df.agg(F.count("*"), F.sum("n"), F.count("form"), F.max("n_near")).first()
    counts = contract_words(documents.select("doc_id", "text").collect())
    assert got[0] == len(counts) and got[1] == sum(counts.values()) and got[2] > 0 and got[3] > 1


# ---- periodic runs


def runs_by_comparison(a, least=6, times=4):
    """Every period against every place; of the stretches that keep it, those without a smaller period."""
    ids = {w: k for k, w in enumerate(dict.fromkeys(a))}
    a = np.array([ids[w] for w in a], dtype=np.int64)
    n, out = len(a), []
    for q in range(1, n // times + 1):
        same = np.concatenate(([0], (a[:-q] == a[q:]).astype(np.int8), [0]))
        if not same.any():
            continue
        edge = np.diff(same)
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + q).tolist(), strict=True):
            if e - s >= max(least, times * q) and not any((a[s : e - d] == a[s + d : e]).all() for d in range(1, q)):
                out.append((s, e, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


PARTS = st.lists(st.one_of(
    st.lists(st.integers(0, 2), max_size=8), st.builds(lambda w, n: w * n, st.lists(st.integers(0, 2), min_size=1, max_size=8), st.integers(2, 9))), max_size=8)


@settings(max_examples=300, deadline=None)
@given(PARTS, st.integers(3, 5), st.integers(1, 30))
def test_runs(parts, times, size):
    a = [x for p in parts for x in p]
    want = runs_by_comparison(a, 6, times)
    assert [tuple(r) for r in periodic.catch(np.array(a, dtype=np.int64), 6, times).tolist()] == want
    catcher, got = periodic.SquareCatcher(6, times), []
    for k in range(0, len(a), size):
        got += catcher.append(np.array(a[k : k + size])).tolist()
        assert all(end <= min(k + size, len(a)) for _, end, _ in got)
    got += catcher.finish().tolist()
    assert sorted(map(tuple, got), key=lambda r: (r[0], r[2])) == want


def test_long_run_is_linear():
    for a in (np.zeros(400_000, dtype=np.int64), np.tile(np.arange(1_000), 400)):
        start, end, q = periodic.catch(a)[0].tolist()
        assert (start, end, q) == (0, 400_000, 1 if not a.any() else 1_000)


def planted(doc, text):
    words = [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10 == 0 and n and doc is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def digests(words):
    runs = runs_by_comparison(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = (None,) * 4
    for s, e, q in runs:
        if best[0] is None or ((e - s) * best[2], -s, -q) > (best[1] * q, -best[0], -best[2]):
            best = (s, e - s, q, 1000 * (e - s) // q)
    text = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *best, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_periodic_runs_of_whole_table(spark, documents):
    got = {r.doc_id: tuple(r)[1:] for r in suite.op13_periodic(spark, SF).collect()}
    want = {r.doc_id: digests(planted(r.doc_id, r.text)) for r in documents.collect()}
    assert got == want and sum(w[0] > 0 for w in want.values()) > 5


def test_periodic_runs_of_awkward_rows(spark, crowded):
    texts = ["a b " * 30, "x " * 7 + "y", "x x x x x", "a b c a b c a b c a b c a", "é é é é é é\x0bé", "a a a a a a b " * 5]
    extra = crowded.limit(1).select("*", F.explode(F.array(*map(F.lit, texts))).alias("t")).withColumn("text", F.col("t")).drop("t")
    odd = crowded.unionByName(extra.withColumn("doc_id", F.lit(None).cast("long")))
    rows = odd.select("doc_id", "text").collect()
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.text) for r in periodic.periodic_runs(odd).collect())
    want = Counter()
    for doc, text in rows:
        words = [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]
        runs = runs_by_comparison(words)
        gone = {i for s, e, q in runs for i in range(s + q, e)}
        want[(doc, len(words), tuple((s, e - s, q) for s, e, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone))] += 1
    assert got == want
    tails = {r.doc_id: r.text for r in periodic.with_repeated_tail(odd.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()}
    for doc, text in rows:
        if doc is not None:
            assert [w for w in re.split("[\x20\x09-\x0D]+", tails[doc] or "") if w] == planted(doc, text)


def test_periodic_runs_of_nothing(spark, nothing):
    assert periodic.periodic_runs(nothing).collect() == []


def test_segments_encoded_in_parts_are_the_same(monkeypatch):
    rng = np.random.default_rng(14)
    groups = [([k], [rng.zipf(1.3, 9_000) % 700]) for k in range(3)]
    whole, asked, encode = tokenfile.write_segments(groups), [], mixcoder.encode
    monkeypatch.setattr(tokenfile, "ENCODED", 4)
    monkeypatch.setattr(mixcoder, "encode", lambda blocks: asked.append(len(blocks)) or encode(blocks))
    assert tokenfile.write_segments(groups) == whole and asked == [4, 4, 4, 3]
