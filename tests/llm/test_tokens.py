"""Token counts and packing against the tokenizers' own libraries, and exact round trips."""

import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wharfline.llm import bpe, packing, token_count
from wharfline.llm.suite import tokenizer


@pytest.fixture(scope="session")
def pieces():
    return token_count.load_model(tokenizer("piece_bpe_32k.model"))


@pytest.fixture(scope="session")
def words():
    return packing.load_model(tokenizer("word_bpe_49k.json"))


@pytest.fixture(scope="session")
def sp():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))


@pytest.fixture(scope="session")
def hf():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer("word_bpe_49k.json"))


def encode(model, texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    ids, sizes = packing.Encoder(model).texts(offsets, np.frombuffer(b"".join(raw), dtype=np.uint8))
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]


ODD = ["", "a", " ", "  a  b   c ", "aaaaaaaaaaaa aaaa", "\n\tx\r\n", "日本語 😀 naïve ΑΣ ΣΑΣ", "▁▁x ▁", "<s> </s> <0x0A>", "<|startoftext|> x<|endoftext|>y",
       "ab" * 2_000, "banana bananana lolololol", "I'm you're 'tis", "12 3½ ²x", "x\xa0y z\x85w é İ ŉ ß", "\x00\x01\x1cq"]
TEXTS = st.lists(st.text(st.one_of(st.sampled_from("ab éàß '-,.|<>1▁\n\t\x0b"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_piece_counts(pieces, sp, texts):
    assert token_count.count_texts([t.encode() for t in texts], pieces).tolist() == [len(x) for x in sp.encode(texts)]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_word_ids(words, hf, texts):
    assert encode(words, texts) == [e.ids for e in hf.encode_batch(texts, add_special_tokens=False)]


def test_odd_texts(pieces, sp, words, hf):
    assert token_count.count_texts([t.encode() for t in ODD], pieces).tolist() == [len(x) for x in sp.encode(ODD)]
    assert encode(words, ODD) == [e.ids for e in hf.encode_batch(ODD, add_special_tokens=False)]


def test_merging_is_that_of_one_pair_at_a_time():
    rng = np.random.default_rng(4)
    for _ in range(60):
        known = sorted({(int(a), int(b)) for a, b in rng.integers(0, 6, (12, 2))})
        rank = rng.permutation(len(known))
        table = {p: (int(r), 6 + k if k < 3 else int(rng.integers(0, 6))) for k, (p, r) in enumerate(zip(known, rank, strict=True))}
        pairs = bpe.Pairs(*(np.array(x) for x in zip(*((a, b, r, m) for (a, b), (r, m) in table.items()), strict=True)))
        lengths = rng.integers(0, 30, 20)
        symbols = rng.integers(0, 4, lengths.sum())
        got, sizes = bpe.merge(symbols, lengths, pairs)
        want, at = [], 0
        for n in lengths:
            s = symbols[at : at + n].tolist()
            at += n
            while found := [(table[p][0], k) for k, p in enumerate(zip(s, s[1:])) if p in table]:
                _, k = min(found)
                s[k : k + 2] = [table[s[k], s[k + 1]][1]]
            want.append(s)
        assert sizes.tolist() == [len(s) for s in want]
        assert got.tolist() == [x for s in want for x in s]


@pytest.mark.parametrize("table", ["awkward", "documents", "crowded", "nothing"])
def test_token_counts(request, table, pieces, sp):
    df = request.getfixturevalue(table)
    got = sorted(tuple(r) for r in token_count.token_counts(df, pieces, limit=100).collect())
    rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    assert got == sorted((d, len(t.encode()), n, n > 100) for (d, t), n in ((x, len(sp.encode(x[1]))) for x in rows))


@pytest.mark.parametrize("table", ["awkward", "documents", "crowded", "nothing"])
def test_packing_round_trip(request, table, words, hf):
    df = request.getfixturevalue(table)
    got = packing.pack(df, words, window=256, shard_docs=16).collect()
    rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    want = defaultdict(list)
    for d, t in rows:
        want[d].append([*hf.encode(t, add_special_tokens=False).ids, 1])
    back, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and r.length == len(r.ids)
        back[r.doc_id].append((r.start, r.ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(back) == set(want)
    for d, docs in want.items():
        assert sorted(i for x in docs for i in x) == sorted(i for _, ids in back[d] for i in ids)
        if len(docs) == 1:
            assert [i for _, ids in sorted(back[d]) for i in ids] == docs[0]
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 256 or at < 256 and at & (at - 1) == 0


def test_windows_hold_neighbours():
    """Two topics without common words: the windows of a shard do not mix them before one runs out."""
    rng = np.random.default_rng(1)
    docs = [rng.integers(1_000 * (k % 2), 1_000 * (k % 2) + 40, 30) for k in range(40)]
    rows = list(packing.retrieve_and_fill(docs, 90))
    mixed = sum(len({d % 2 for d, _, _ in row}) > 1 for row in rows)
    assert sum(n for row in rows for _, _, n in row) == 1_200 and mixed <= 2


def test_powers_of_two():
    out = list(packing.powers_of_two([(0, 5, 3), (4, 0, 9), (2, 1, 1)]))
    assert [sum(n for _, _, n in row) for row in out] == [8, 4, 1]
    assert [x for row in out for x in row] == [(0, 5, 3), (4, 0, 5), (4, 5, 4), (2, 1, 1)]


def test_neighbours_share_a_shard(spark, words):
    """Twenty topics over many shards: documents of one topic meet, wherever their rows are."""
    rng = np.random.default_rng(6)
    names = ["river", "engine", "poet", "cheese", "planet", "violin", "harbor", "muscle", "senate", "glacier",
             "pepper", "castle", "rocket", "cotton", "lizard", "market", "hockey", "temple", "carbon", "garden"]
    rows = [(k, " ".join([names[k % 20]] * 10 + [f"the of and to in is {names[k % 20]}"] + [str(x) for x in rng.integers(0, 99, 4)])) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    topics = defaultdict(set)
    for r in packing.pack(df, words, window=128, shard_docs=20).collect():
        topics[r.sequence_id].add(r.doc_id % 20)
    assert sum(len(x) == 1 for x in topics.values()) > 0.6 * len(topics)


def test_statistics_are_those_of_the_corpus(spark):
    rows = [(b"", np.array([1, 2, 2], "<u2").tobytes()), (np.array([3, 1], "<u2").tobytes(), np.array([4], "<u2").tobytes())]
    got = packing.count_corpus(spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in rows], "whole binary, rest binary").repartition(2), "<u2")
    want = packing.corpus_of(np.array([0, 2, 1, 1, 1]), 2, 2.0)
    assert (got.idf == want.idf).all() and (got.shared == want.shared).all() and got.mean == want.mean


@pytest.mark.parametrize("known", [0, 5, packing.KNOWN])
def test_pieces_are_encoded_once_by_a_task(words, monkeypatch, known):
    """Blocks after the first bring only new pieces to the merging; forgetting them changes no id."""
    monkeypatch.setattr(packing, "KNOWN", known)
    texts = ["Don't stop the music, o'clock a|b 12", "the music stops; don't <|endoftext|> a|b", "", "THE Music Ä́ 12 o'clock zzyzx"] * 2
    encoder, seen = packing.Encoder(words), []
    true = encoder._distinct
    monkeypatch.setattr(encoder, "_distinct", lambda pieces, odd: (seen.append(pieces.to_pylist()), true(pieces, odd))[1])
    for text in texts:
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        ids, sizes = encoder.texts(np.array([0, len(raw)]), raw)
        want = encoder._by_library([text])[0]
        assert ids.tolist() == want and sizes.tolist() == [len(want)]
    pieces = [p for block in seen for p in block]
    if known > 5:
        assert len(pieces) == len(set(pieces)) == len(encoder.known)
    else:
        assert len(pieces) > len(set(pieces))


def test_encoding_holds_few_bytes_for_each_of_the_text(words, hf):
    lines = ["Ein Wörterbuch of plain words, 12 of them.\n" * n for n in (400, 1, 9_000, 0, 700)] * 20
    whole = lines + [" ", "İ it's", ""] + ["日本 x|> y"]
    assert encode(words, whole) == [e.ids for e in hf.encode_batch(whole, add_special_tokens=False)]
    raw = "".join(lines[:6]).encode()
    offsets = np.linspace(0, len(raw), 41).astype(np.int64) // 44 * 44  # a line has 44 bytes
    encoder = packing.Encoder(words)
    encoder.texts(offsets, np.frombuffer(raw, dtype=np.uint8))
    tracemalloc.start()
    encoder.texts(offsets, np.frombuffer(raw, dtype=np.uint8))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 * len(raw)


def test_short_and_long_sequences_merge_alike():
    """Rows of matrices and ragged arrays; symbols of 16 bits, negative ones, empty sequences and those about as long as a row."""
    rng = np.random.default_rng(12)
    symbols = np.array([0, 1, 2, 40_000, 65_535])
    made = iter(range(100, 65_000))
    known = {(int(a), int(b)): next(made) for a in symbols for b in symbols if rng.random() < 0.6}
    known |= {(m, int(rng.choice(symbols))): next(made) for m in list(known.values())}
    left, right = (np.array(x) for x in zip(*known, strict=True))
    pairs = bpe.Pairs(left, right, rng.permutation(len(known)), np.array(list(known.values())))
    assert pairs.entry is not None
    every = np.array([*symbols, -1, 70_000, 100, 101])
    got = pairs.ranks(np.repeat(every, len(every)), np.tile(every, len(every)))
    assert got.tolist() == pairs.find(np.repeat(every, len(every)), np.tile(every, len(every)))[0].tolist()
    lengths = np.concatenate(([0, 1, bpe.SHORT, bpe.SHORT + 1, 0], rng.integers(0, 2 * bpe.SHORT, 400), rng.integers(0, 9, 9_000)))
    drawn = rng.choice([*symbols, -1], lengths.sum())
    for some in (lengths, lengths[:0], lengths[:1]):
        ids, sizes = bpe.merge(drawn[: some.sum()], some, pairs)
        want, lengths_left = bpe._merge_ragged(drawn[: some.sum()], some, pairs)
        assert ids.tolist() == want.tolist() and sizes.tolist() == lengths_left.tolist()


def test_short_sequences_merge_by_rows(words, monkeypatch):
    """Distinct pieces of usual length never go round by round over all symbols."""
    monkeypatch.setattr(bpe, "_merge_ragged", None)
    text = " ".join(f"{a}{b}" for a in ("harbour", "merging", "ragged") for b in ("ing", "ation", "some", "x"))
    assert len(encode(words, [text, text + " again"])[0]) > 12


def test_known_pieces_are_encoded_once(words, hf, monkeypatch):
    """Over several calls, with forgetting between some of them, and texts for the library among them."""
    monkeypatch.setattr(packing, "KNOWN", 12)
    encoder, asked, distinct = packing.Encoder(words), [], packing.Encoder._distinct
    monkeypatch.setattr(packing.Encoder, "_distinct", lambda self, pieces, odd: asked.append(len(pieces)) or distinct(self, pieces, odd))
    calls = [["", " "], ["one two two one", "it's"], ["two it's three"], ["one two"], ["a b c d e f g h i j"], ["one a b", ""]]
    for texts in calls:
        raw = [t.encode() for t in texts]
        ids, sizes = encoder.texts(np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64), np.frombuffer(b"".join(raw), dtype=np.uint8))
        want = [e.ids for e in hf.encode_batch(texts, add_special_tokens=False)]
        assert ids.tolist() == [i for x in want for i in x] and sizes.tolist() == [len(x) for x in want]
    assert asked == [3, 1, 10, 3]


def drawn_documents(seed):
    rng = np.random.default_rng(seed)
    docs = [(rng.zipf(1.4, int(n)) % 300).astype("<u2") for n in rng.integers(0, 90, 130)]
    return [*docs, *docs[:20], np.zeros(0, dtype="<u2")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_windows_are_those_of_a_full_ranking(monkeypatch, seed):
    """Documents that leave the posting lists, and terms counted for a shard at once, change no choice."""
    docs = drawn_documents(seed)
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=300)
    corpus = packing.corpus_of(df, len(docs), float(np.mean([len(d) for d in docs])))
    counts = [np.unique(d, return_counts=True) for d in docs]
    monkeypatch.setattr(np, "unique", None)  # no document is sorted by itself
    got = list(packing.retrieve_and_fill(docs, 100, corpus))
    used, want, rest = [not len(d) for d in docs], [], None
    while rest or not all(used):
        seed_doc, at = rest or (used.index(False), 0)
        used[seed_doc] = True
        take = min(100, len(docs[seed_doc]) - at)
        row, rest = [(seed_doc, at, take)], (seed_doc, at + take) if at + take < len(docs[seed_doc]) else None
        score = np.zeros(len(docs))
        for t in counts[seed_doc][0].tolist():
            for d, (terms, freq) in enumerate(counts):
                for f in freq[terms == t]:
                    norm = packing.K1 * (1 - packing.B + packing.B * len(docs[d]) / max(1.0, corpus.mean))
                    score[d] += corpus.idf[t] * f * (packing.K1 + 1) / (f + norm)
        for d in np.argsort(-score, kind="stable").tolist():
            room = 100 - sum(n for _, _, n in row)
            if room and not used[d]:
                row.append((d, 0, min(room, len(docs[d]))))
                used[d] = True
                rest = (d, room) if room < len(docs[d]) else rest
        want.append(row)
    assert got == want


def test_signatures_are_least_draws(monkeypatch):
    docs = drawn_documents(4)
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=300)
    corpus = packing.corpus_of(df, len(docs), 1.0)
    want = []
    for d in docs:
        terms = [t for t in np.unique(d).tolist() if df[t] > 1]
        draw = [(packing.mix(np.array(terms, dtype=np.uint64), 31 + k) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54 for k in range(packing.SIGNATURE)]
        want.append([min(zip((-np.log(x) / np.maximum(corpus.idf[terms], 1e-9) ** 2).tolist(), terms, strict=True), default=(0, -1))[1] for x in draw])
    draws = packing.draws_of(corpus)
    monkeypatch.setattr(np, "log", None)  # draws are made once for all documents
    monkeypatch.setattr(np, "unique", None)
    assert packing.signatures(docs, corpus, draws).tolist() == want
    assert packing.signatures([], corpus, draws).shape == (0, packing.SIGNATURE)


def test_distinct_ids():
    stamp = np.zeros(300, dtype=np.int32)
    for d in drawn_documents(5):
        d = d.astype(np.int64)
        assert sorted(d[packing.distinct(d, stamp)].tolist()) == sorted(set(d.tolist()))
