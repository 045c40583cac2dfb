"""A corpus from raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.llm import decontaminate, language, line_dedup, near_dup, packing
from wharfline.llm.suite import tokenizer
from wharfline.session import cut

LEAST_SCORE = 0.4  # of a language; below it a text is in none of the learned languages


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without letters or without a likely language go.

    A null or empty text has no letters.  A corpus without a row that has both a text and a ``lang`` teaches no language,
    so that all its rows go.  Repeated rows are judged alike, null keys matter as little as any; an empty table stays empty.
    """
    found = language.identify(docs, language.train(docs))
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that five or more share, but for one; n_chars, if there is one, follows the text.

    A null text becomes an empty one.  Rows with one key count as one document and keep or lose a line together, and so do
    all rows with a null key.  All rows stay, and an empty table stays empty.
    """
    out = line_dedup.line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: five-word shingles, similarity of 0.8 or more.

    Of a repeated row one stays.  Rows without words, null texts among them, have no links: one of each key stays, and all
    with a null key.  An empty table stays empty.
    """
    return near_dup.one_of_each(docs, shingle=5, percent=80)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark.

    A row is judged by its own text: clean rows with the key of a leaked one, or with a null key, stay.  Null and empty
    texts hold no passage; an empty benchmark or table changes nothing.
    """
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 token ids.

    A null or empty text is its end id alone; a repeated row is a document of its own; an empty table gives no pieces.
    """
    # smaller blocks than packing alone takes: executors still hold what the stages before left them
    return packing.pack(docs, packing.load_model(tokenizer("word_bpe_49k.json")), block_bytes=1 << 20)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("line_dedup", dedup_lines),
    ("near_duplicates", dedup_documents),
    ("decontamination", remove_leaks),
    ("packing", pack_sequences),
]

# The learned language model and the tokenizer have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"stage-{name}")
    return docs
