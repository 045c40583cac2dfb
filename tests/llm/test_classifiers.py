"""Held-out accuracy of the classifiers, their parts against plain formulas, and awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wharfline.llm import features, language, quality, suite, toxicity

SF = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


@pytest.mark.parametrize(("query", "label", "least"), [("op3_toxicity", "toxic", 0.9), ("op7_quality", "quality", 0.9)])
def test_held_out(spark, query, label, least):
    got = suite.QUERIES[query](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    pdf = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert pdf.score.between(0, 1).all()
    assert auc(pdf.score.to_numpy(), pdf[label].to_numpy()) > least
    assert (pdf.predicted == pdf[label]).mean() > 0.9


def test_held_out_language(spark):
    got = suite.QUERIES["op10_language"](spark, SF)
    pdf = got.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (pdf.lang_pred == pdf.lang).mean() > 0.97
    assert pdf.score.between(0, 1).all()


def test_non_negative_risk_is_not_overfitted():
    """Words that only single texts have must not decide; the one shared word of the positives must."""
    rows = [[1, 100 + k] for k in range(40)] + [[2, 200 + k] for k in range(200)] + [[1, 500 + k] for k in range(10)]
    positive = np.array([True] * 40 + [False] * 210)
    bounds = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    w, b = toxicity.fit_nnpu(np.concatenate(rows), bounds, positive, 0.05)
    assert features.sigmoid(w[1] + b) > 0.5 > features.sigmoid(w[2] + b) and (w[100:600] == 0).all()


def test_machine_counts_all_pairs():
    rng = np.random.default_rng(0)
    w, v, b = rng.normal(size=20), rng.normal(size=(20, 3)), 0.3
    x = rng.normal(size=5)
    s = np.array([1, 4, 7, 9, 15])
    want = b + w[s] @ x + sum(v[s[i]] @ v[s[j]] * x[i] * x[j] for i in range(5) for j in range(i + 1, 5))
    assert quality._raw(w, v, b, s, x, np.array([0, 5, 5]))[0] == pytest.approx([want, b])


def test_ftrl_is_sparse_and_right():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400)
    slots = np.stack([y, 10 + rng.integers(0, 500, 400)], axis=1).ravel()
    w, _ = language.fit_ftrl(slots, np.ones(800) * 0.1, np.arange(0, 801, 2), y, 2)
    assert w[0].argmax() == 0 and w[1].argmax() == 1 and (w[600:] == 0).all()


def test_temperature():
    rng = np.random.default_rng(2)
    p = rng.uniform(0.05, 0.95, 20_000)
    y = (rng.uniform(size=len(p)) < p).astype(int)
    logits = np.stack([np.zeros(len(p)), np.log(p / (1 - p))], axis=1)
    assert language.fit_temperature(logits * 3, y) == pytest.approx(3, rel=0.1)


def test_ngrams_of_one_text_do_not_depend_on_the_block():
    texts = ["ab c", "", "日本 x", "ab c"]
    slots, bounds = language.ngram_slots(texts)
    for k, t in enumerate(texts):
        assert slots[bounds[k] : bounds[k + 1]].tolist() == language.ngram_slots([t])[0].tolist()


def test_document_frequencies(spark):
    df = spark.createDataFrame([("aa b",), ("b",), ("c",)], "text string").repartition(2)
    n, df_of = language.document_frequencies(df)
    slots, bounds = language.ngram_slots(["aa b", "b", "c"])
    want = np.zeros_like(df_of)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        want[np.unique(slots[a:b])] += 1
    assert n == 3 and (df_of == want).all()


@pytest.mark.parametrize("table", ["awkward", "crowded", "nothing"])
def test_awkward_rows(request, table, documents, labels):
    df = request.getfixturevalue(table)
    n = df.count()
    tox = toxicity.score(df, toxicity.train(documents, labels)).collect()
    good = quality.score(df, quality.train(documents, labels)).collect()
    lang = language.identify(df, language.train(documents)).select("doc_id", "lang_pred", "score").collect()
    assert len(tox) == len(good) == len(lang) == n
    assert all(0 <= r.score <= 1 for r in [*tox, *good, *lang])
    unknown = {r.doc_id for r in lang if r.lang_pred == "und"}
    assert unknown == ({0, 1, 2, 3, 4} if n else set())


def test_nothing_to_learn(spark, nothing, awkward, labels):
    none = labels.limit(0)
    assert all(r.predicted == 0 for r in toxicity.score(awkward, toxicity.train(awkward, none)).collect())
    assert all(r.score == 0.5 for r in quality.score(awkward, quality.train(awkward, none)).collect())
    assert {r.lang_pred for r in language.identify(awkward, language.train(nothing)).collect()} == {"und"}


def test_samples_keep_small_tables_and_bound_large_ones(spark):
    df = spark.range(20_000).withColumn("s", F.when(F.col("id") % 100 == 0, "rare").otherwise("common"))
    assert features.sampled(df, 30_000, F.xxhash64("id")).count() == 20_000
    assert 800 < features.sampled(df, 1_000, F.xxhash64("id")).count() < 1_200
    got = {r.s: r["count"] for r in features.sampled(df, 1_000, F.xxhash64("id"), "s").groupBy("s").count().collect()}
    assert got["rare"] == 200 and 800 < got["common"] < 1_200


def test_every_language_is_learned_from_distinct_texts(spark):
    """Many copies of few texts: no language is lost, and none is learned from more texts than the bound."""
    few = [(f"l{k}", f"words of text {k} {j}") for k in range(6) for j in range(2)] * 60
    many = [("many", f"own text {k}") for k in range(300)] + [("many", "one text of a third")] * 150
    rows = spark.createDataFrame(few + many, "lang string, text string").repartition(4)
    drawn = features.drawn(rows, 50, F.xxhash64(F.lit("l"), "text"), "lang")
    assert {r.lang: r.n for r in drawn.groupBy("lang").agg(F.count_distinct("text").alias("n")).collect()} == {
        "many": 50, **{f"l{k}": 2 for k in range(6)}}
    assert language._profiles(drawn).count() == 62
    assert language.train(rows, sample=50).languages == [*(f"l{k}" for k in range(6)), "many"]
    assert language.train(rows, sample=1).languages == [*(f"l{k}" for k in range(6)), "many"]
