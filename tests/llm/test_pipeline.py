"""The pipeline's stages against brute force on a small table, and the registered queries against SQL."""

import corpus_pipeline
import pytest

from tests.crosscheck import compare, connect, types_differ
from tests.llm.test_dedup import drop_lines, linked, pairs
from tests.llm.test_search_and_leaks import contaminated
from wharfline.llm import suite

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(suite.ORACLE))
def test_query_equals_sql(spark, name):
    con, df = connect(SF), suite.QUERIES[name](spark, SF)
    assert compare(df, con, suite.ORACLE[name]) is None
    assert not types_differ(df, con, suite.ORACLE[name])


def test_stages(spark, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "line_dedup", "near_duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = stages["language"](spark, docs, SF).cache()
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()
    lines = stages["line_dedup"](spark, kept, SF).cache()
    assert sorted(pairs(lines)) == sorted((d, t) for d, t, _, _ in drop_lines(pairs(kept)))
    unique = stages["near_duplicates"](spark, lines, SF).cache()
    assert sorted(r.doc_id for r in unique.collect()) == sorted(d for d, _, _, k in linked(pairs(lines), 5, 80) if k)
    clean = stages["decontamination"](spark, unique, SF).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {d for d, *_ in contaminated(pairs(unique), items)}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in unique.collect()} - dirty
    for df in (lines, unique, clean):
        assert df.columns == docs.columns and df.schema == docs.schema
    packed = stages["packing"](spark, clean, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in clean.collect()}
    whole = corpus_pipeline.run(spark, SF)
    digest = ["doc_id", "start", "length", "ids_crc32"]
    assert {r.doc_id for r in whole.collect()} == {r.doc_id for r in packed.collect()}
    assert whole.select(digest).agg({"length": "sum"}).first() == packed.select(digest).agg({"length": "sum"}).first()


def test_stages_take_awkward_rows(spark, awkward, nothing):
    for df in (awkward, nothing):
        docs = df
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.count()


def test_one_row_of_repeated_documents(spark):
    texts = [" ".join(f"{x}{k}" for k in range(60)) for x in "ab"]
    rows = [(3, texts[0], "en", "s", 1)] * 4 + [(None, texts[1], "en", "s", 1)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.dedup_documents(spark, docs, SF)
    assert got.columns == docs.columns and sorted((r.doc_id or 0) for r in got.collect()) == [0, 3]
