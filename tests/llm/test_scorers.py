"""Scores of whole tables against plain Python over the same models, and samples that follow from texts alone."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wharfline.llm import features, language, packing, quality, toxicity
from wharfline.llm import text as T

LETTERS = re.compile(rb"[A-Za-z\x80-\xff]+")


def slots_of(text, bits):
    """Slot of every run of letters, one word at a time."""
    out = []
    for word in LETTERS.findall((text or "").encode()):
        raw = np.frombuffer(word.lower() if word.isascii() else bytes(b + 32 if 65 <= b <= 90 else b for b in word), dtype=np.uint8)
        out.append(int(T.word_hashes(raw, np.array([0]), np.array([len(raw)]))[0] >> np.uint64(64 - bits)))
    return out


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def test_toxicity_of_whole_table(documents, labels):
    model = toxicity.train(documents, labels)
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score(documents, model).collect()}
    for r in documents.collect():
        want = sigmoid(model.bias + sum(float(model.weights[s]) for s in set(slots_of(r.text, toxicity.BITS))))
        assert got[r.doc_id][0] == pytest.approx(want, abs=1e-5) and got[r.doc_id][1] == int(got[r.doc_id][0] >= 0.5)


def test_quality_of_whole_table_with_all_pairs(documents, labels):
    model = quality.train(documents, labels)
    got = {r.doc_id: r.score for r in quality.score(documents, model).collect()}
    for r in documents.collect():
        slots = slots_of(r.text, quality.BITS)
        counts = {s: math.log1p(slots.count(s)) for s in set(slots)} if len(slots) < 400 else {
            int(s): math.log1p(int(n)) for s, n in zip(*np.unique(slots, return_counts=True))}
        norm = math.sqrt(sum(x * x for x in counts.values())) or 1.0
        raw = (r.text or "").encode()
        stats = quality.statistics(np.array([0, len(raw)]), np.frombuffer(raw, dtype=np.uint8), np.array([float(r.n_chars or 0)]))[0]
        scaled = np.clip((stats - model.mean) / model.scale, -4, 4) * 0.25
        inputs = [(s, x / norm) for s, x in counts.items()] + [((1 << quality.BITS) + k, x) for k, x in enumerate(scaled)]
        vectors = np.array([model.factors[s].astype(float) * x for s, x in inputs])
        products = vectors @ vectors.T
        pairs = np.triu(products, 1).sum()  # every pair once
        z = model.bias + sum(float(model.weights[s]) * x for s, x in inputs) + pairs
        assert got[r.doc_id] == pytest.approx(sigmoid(model.slope * z + model.offset), abs=1e-4)


def test_scores_do_not_depend_on_how_rows_lie(documents, labels):
    for module in (quality, toxicity):
        one, other = (
            {r.doc_id: r.score for r in module.score(documents, module.train(documents.repartition(k), labels.repartition(k + 1))).collect()} for k in (7, 2))
        assert one == other


@pytest.fixture
def crowds(spark):
    """A key with 300 rows and texts, keys with one row each, and a third of null keys; copies of each."""
    rows = [(1, f"own text {k}") for k in range(300)] + [(k, f"text of {k}") for k in range(2, 302)] + [(None, f"lost text {k}") for k in range(300)]
    return spark.createDataFrame(rows * 2, "doc_id long, text string").withColumn("n_chars", F.lit(9)).repartition(3)


def test_samples_hold_their_bounds(spark, crowds, monkeypatch):
    labels = spark.createDataFrame([(1, 1, 1)] * 300 + [(k, k % 2, k % 2) for k in range(2, 302)], "doc_id long, quality int, toxic int")
    sizes = []
    fit, nnpu = quality.fit, toxicity.fit_nnpu
    monkeypatch.setattr(quality, "fit", lambda *a: (sizes.append(len(a[-1])), fit(*a))[1])
    monkeypatch.setattr(toxicity, "fit_nnpu", lambda s, b, p, prior: (sizes.append((int(p.sum()), int((~p).sum()))), nnpu(s, b, p, prior))[1])
    quality.train(crowds, labels, sample=100)
    toxicity.train(crowds, labels, positives=40, unlabelled=120)
    quality.train(crowds, labels, sample=10_000)
    assert sizes == [pytest.approx(100, abs=0), (40, 120), 600] or sizes[0] <= 100 and sizes[1:] == [(40, 120), 600]


def test_null_keys_are_drawn_too(crowds):
    rows = crowds.select(F.col("doc_id").alias("key"), "text")
    drawn = features.drawn_texts(rows, 300, "u").collect()
    kinds = {"one": sum(r.key == 1 for r in drawn), "null": sum(r.key is None for r in drawn), "others": sum((r.key or 0) > 1 for r in drawn)}
    assert len(drawn) == len({(r.key, r.text) for r in drawn}) == 300 and all(60 < n < 140 for n in kinds.values())
    assert features.drawn_texts(rows, 10_000, "u").count() == 900


def test_signatures_of_a_block(documents):
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 300, rng.integers(0, 60)).astype(np.uint16) for _ in range(50)] + [np.zeros(0, np.uint16)]
    df = np.bincount(np.concatenate([np.unique(s) for s in sets]), minlength=400)
    corpus = packing.corpus_of(df, len(sets), 30.0)
    got = packing.signatures(sets, corpus)
    for k, own in enumerate(sets):
        terms = [int(t) for t in sorted(set(own.tolist())) if df[t] > 1]
        for j in range(packing.SIGNATURE):
            draws = [(int(T.mix(np.array([t], dtype=np.uint64), 31 + j)[0]) >> 11) * 2.0**-53 + 2.0**-54 for t in terms]
            value = [-math.log(x) / max(corpus.idf[t], 1e-9) ** 2 for x, t in zip(draws, terms)]
            assert got[k, j] == (terms[int(np.argmin(value))] if terms else -1)
    assert (packing.signatures([], corpus).shape) == (0, packing.SIGNATURE)


def test_language_of_whole_table(documents):
    model = language.train(documents)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(documents, model).collect()}
    for r in documents.collect():
        text = f" {' '.join((r.text or '').lower().split())} "
        total, n = np.zeros(len(model.languages)), 0
        for size in range(1, language.ORDERS + 1):
            grams = []
            for i in range(len(text) - size + 1):
                g = 0
                for c in text[i : i + size]:
                    g = (g * 1_000_003 + ord(c) + 1) % 2**64
                grams.append(g)
            slots = (T.mix(np.array(grams, dtype=np.uint64), size - 1) >> np.uint64(64 - language.BITS)).astype(int)
            total += model.weights[slots].sum(0, dtype=float)
            n += len(slots)
        if not any(c.isalpha() for c in text):
            assert got[r.doc_id] == ("und", 0.0)
            continue
        z = (total / n + model.bias) / model.temperature
        p = [math.exp(x - max(z)) for x in z]
        best = int(np.argmax(p))
        assert got[r.doc_id][0] == model.languages[best] and got[r.doc_id][1] == pytest.approx(p[best] / sum(p), abs=1e-4)


def test_language_keeps_all_columns_in_order(spark, awkward, documents):
    model = language.train(documents)
    out = language.identify(awkward.withColumn("score", F.lit("x")), model)
    assert out.columns == [*awkward.columns, "lang_pred", "score"]
    assert sorted(map(str, out.select(awkward.columns).collect())) == sorted(map(str, awkward.collect()))
    only = language.identify(awkward.select("text"), model)
    assert only.columns == ["text", "lang_pred", "score"] and only.count() == awkward.count()
